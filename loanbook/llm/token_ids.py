"""Ids of texts by a byte-level tokenizer file, word by word from a table that a worker keeps."""

from __future__ import annotations

import os
import re
from array import array

WIDTH = 4  # bytes of an id
LITTLE = array("I", [1]).tobytes() == (1).to_bytes(WIDTH, "little")
#: Signs that end a run of letters or digits; an apostrophe does not, as in "it's".
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Words whose ids a worker remembers: as many again stay until they are older than these.
REMEMBERED = 600_000

#: White space other than blanks and line ends.
_RARE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if LITTLE else b"".join(i.to_bytes(WIDTH, "little") for i in ids)


def _byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: its own, or one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


#: Letters below this code point are letters for Python and for the tokenizer alike.
LATIN_END = "\u0250"
_BYTES = _byte_letters()
_BLANK = _BYTES[ord(" ")]
_LATIN = {i: "".join(_BYTES[b] for b in chr(i).encode()) for i in range(ord(LATIN_END))}


class TokenTable(dict):
    """Little-endian ids of a word with a blank before it, or of one that a line end begins.

    The tokenizer cuts a text before it merges, and a single blank or line end always begins
    a cut of its own, so such words can be encoded one by one, with the same ids. The signs at
    the end of a word that a letter or digit precedes are a cut of their own too, so the word
    without them is looked up, and so is a line end before letters. Texts with any other white space
    are encoded whole. Strings of added tokens become their ids, as the file says.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        self._merged = self._tokenizer.model.tokenize
        self._older: dict[str, bytes] = {}
        self._begins: dict[str, bytes] = {}
        self._signs = {"\n": self.whole("\n")}
        self._added = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> bytes:
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self._older = dict(self)
            self.clear()
        if word in self._older:
            found = self[word] = self._older[word]
            return found
        bare = word.rstrip(SIGNS)
        apart = bare != word and bare and bare[-1].isalnum() and bare[-1] < LATIN_END
        if apart and not any(token in word for token in self._added):
            found = self[bare] + self._ending(word[len(bare) :])
            self[word] = found
            return found
        ends = word[0] == "\n" if word else False
        letters = word[1:] if ends else word
        if letters.isalpha() and (letters.isascii() or max(letters) < LATIN_END):
            cut = letters if letters.isascii() else letters.translate(_LATIN)
            if ends:
                found = self._signs["\n"] + _packed([t.id for t in self._merged(cut)])
            else:
                found = _packed([t.id for t in self._merged(_BLANK + cut)])
        else:
            found = self.whole(word if ends else " " + word)
        self[word] = found
        return found

    def _ending(self, signs: str) -> bytes:
        """Ids of the signs that end a word."""
        found = self._signs.get(signs)
        if found is None:
            found = self.whole(signs)
            if len(self._signs) < REMEMBERED // 4:
                self._signs[signs] = found
        return found

    def begin(self, word: str) -> bytes:
        """Ids of a text's first word, which has no blank before it."""
        found = self._begins.get(word)
        if found is None:
            if len(self._begins) >= REMEMBERED // 4:
                self._begins.clear()
            found = self._begins[word] = self.whole(word)
        return found

    def of(self, text: str) -> bytes:
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or _RARE.search(text):
            return self.whole(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        if rest and not rest[-1]:
            return self.whole(text)
        return self.begin(first) + b"".join(map(self.__getitem__, rest))


_loaded: dict[str, TokenTable] = {}


def token_table(tokenizer_path: str) -> TokenTable:
    """One table per worker process."""
    if tokenizer_path not in _loaded:
        _loaded[tokenizer_path] = TokenTable(tokenizer_path)
    return _loaded[tokenizer_path]
