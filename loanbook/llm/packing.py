"""Hierarchical multi-length packing of tokenised documents.

Every document is cut into whole windows of the longest tier and a rest. The rest is routed
to the shortest tier that holds it. Tiers are packed from long to short: a window takes its
rest, and its gap is filled from shorter tiers, with the longest rest that fits and at last
with the front of one that is cut. What no window needs waits for more documents; at a
partition's end it goes into sequences whose lengths are powers of two, so nothing is padded.

Packing needs no shuffle. A task packs the documents of its own partition in a stream, and
holds one batch of rests; a lost task is packed again with the same result. Sequences are
numbered per partition. Steps group sequences of one tier so that all have equally many
tokens.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (1024, 512, 256, 128)
STEP_TOKENS = 65_536
#: Rests that wait until they are packed together.
BATCH = 8_192
#: Words whose ids a worker remembers.
REMEMBERED = 500_000
WIDTH = 4  # bytes of an id

#: White space other than blanks and line ends.
_RARE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class WordIds(dict):
    """Little-endian ids of a word with a blank before it, or of one that a line end begins.

    The vocabulary cuts texts before it merges, and a single blank or line end always begins
    a cut of its own, so words can be looked up one by one. Texts with more white space
    between words are encoded whole. Strings of added tokens become their ids wherever they
    stand, the longest first; what lies between them is encoded as texts of its own.
    """

    def __init__(self, ranks_path: str, pattern: str, added: tuple[tuple[str, int], ...] = ()):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encode = tiktoken.Encoding(
            ranks_path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._added = {token: i.to_bytes(WIDTH, "little") for token, i in added}
        longest = sorted(self._added, key=len, reverse=True)
        self._cuts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None

    def whole(self, text: str) -> bytes:
        ids = self._encode(text)
        return b"".join([i.to_bytes(WIDTH, "little") for i in ids])

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = self.whole(word if word[:1] == "\n" else " " + word)
        return found

    def of(self, text: str) -> bytes:
        if self._cuts is None or not self._cuts.search(text):
            return self._between(text)
        parts = self._cuts.split(text)
        return b"".join(self._added[x] if i % 2 else self._between(x) for i, x in enumerate(parts) if x)

    def _between(self, text: str) -> bytes:
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or _RARE.search(text):
            return self.whole(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        if rest and not rest[-1]:
            return self.whole(text)
        return self.whole(first) + b"".join(map(self.__getitem__, rest))


_loaded: dict[tuple, WordIds] = {}


def _word_ids(*vocabulary) -> WordIds:
    """One table per worker process."""
    if vocabulary not in _loaded:
        _loaded[vocabulary] = WordIds(*vocabulary)
    return _loaded[vocabulary]


class Packer:
    """Packs rests ``(length, serial, document, start, ids)`` and passes pieces to ``emit``."""

    def __init__(self, emit: Callable, tiers: tuple[int, ...] = TIERS):
        self.emit, self.tiers = emit, tiers
        self.sequences = 0
        self.of_tier = dict.fromkeys(tiers, 0)
        self.pools: dict[int, list] = {t: [] for t in tiers}
        self.waiting = self.serial = 0

    def add(self, document: tuple, ids: bytes) -> None:
        longest, total = self.tiers[0], len(ids) // WIDTH
        start = 0
        while total - start >= longest:
            self._sequence([(longest, 0, document, start, ids[start * WIDTH : (start + longest) * WIDTH])], longest)
            start += longest
        if start < total:
            self._wait(document, start, ids[start * WIDTH :])

    def _wait(self, document: tuple, start: int, ids: bytes) -> None:
        length = len(ids) // WIDTH
        tier = min(t for t in self.tiers if t >= length)
        self.serial += 1
        insort(self.pools[tier], (length, self.serial, document, start, ids), key=lambda r: r[0])
        self.waiting += 1

    def _take(self, room: int, below: int) -> tuple | None:
        """The longest rest that fits, from the tiers up to ``below``; else a cut one's front."""
        for tier in self.tiers:
            pool = self.pools[tier]
            if tier <= below and pool:
                at = bisect_right(pool, room, key=lambda r: r[0])
                if at:
                    self.waiting -= 1
                    return pool.pop(at - 1)
        for tier in reversed(self.tiers):  # none fits: cut the shortest
            if self.pools[tier]:
                length, serial, document, start, ids = self.pools[tier].pop(0)
                self.waiting -= 1
                self._wait(document, start + room, ids[room * WIDTH :])
                return room, serial, document, start, ids[: room * WIDTH]
        return None

    def _fill(self, size: int, tier: int) -> list:
        parts, room = [], size
        while room and (part := self._take(room, tier)):
            parts.append(part)
            room -= part[0]
        return parts

    def _tokens(self) -> int:
        return sum(r[0] for pool in self.pools.values() for r in pool)

    def pack(self) -> None:
        """Full windows of every tier, from long to short, as far as the rests reach."""
        left = self._tokens()
        for tier in self.tiers:
            for _ in range(len(self.pools[tier])):
                if not self.pools[tier] or left < tier:
                    break
                self._sequence(self._fill(tier, tier), tier)
                left -= tier

    def finish(self) -> None:
        """Everything that waits, in windows and then in powers of two."""
        self.pack()
        left = self._tokens()
        size = self.tiers[0]
        while left:
            if left < size:
                size //= 2
                continue
            self._sequence(self._fill(size, self.tiers[0]), size)
            left -= size

    def _sequence(self, parts: list, size: int) -> None:
        tier = min(t for t in self.tiers if t >= size)
        step = self.of_tier[tier] // max(1, STEP_TOKENS // tier)
        self.of_tier[tier] += 1
        offset = 0
        for length, _, document, start, ids in parts:
            self.emit(document, start, length, zlib.crc32(ids), self.sequences, offset, size, step)
            offset += length
        self.sequences += 1


def pack_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    end_id: int = 0,
    *,
    added: dict[str, int] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    window (the sequence's length) and step (of its partition and window).

    ``added``: strings that the vocabulary adds as tokens, with their ids.
    A NULL or empty text is the end id alone. Rows that repeat are documents of their own;
    an empty table gives an empty result; other columns are left out.
    """
    told = docs.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_x"))
    kind = dict(told.dtypes)["_k"]
    schema = (
        f"_k {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, window int, step bigint"
    )
    end = end_id.to_bytes(WIDTH, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _word_ids(ranks_path, pattern, tuple(sorted((added or {}).items())))
        first = TaskContext.get().partitionId() << 40
        columns: list[list] = [[] for _ in range(9)]
        key_type = None

        def emit(document, start, length, crc, sequence, offset, window, step):
            row = (document[0], start, length, crc, document[1], first + sequence, offset, window, step)
            for column, value in zip(columns, row):
                column.append(value)

        def rows() -> pa.RecordBatch:
            types = [key_type, *[pa.int64()] * 6, pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            for column in columns:
                column.clear()
            names = "_k start length ids_crc32 doc_tokens sequence_id offset window step".split()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        packer = Packer(emit)
        for batch in batches:
            key_type = batch.column(0).type
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                buffer = ids.of(x.as_py() or "") + end
                packer.add((k, len(buffer) // WIDTH), buffer)
                if packer.waiting >= BATCH:
                    packer.pack()
                if len(columns[0]) >= BATCH:
                    yield rows()
        if key_type is not None:
            packer.finish()
            yield rows()

    out = told.mapInArrow(run, schema)
    return out.select(F.col("_k").alias(key), *[c for c in out.columns if c != "_k"])
