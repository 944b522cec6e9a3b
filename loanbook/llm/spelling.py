"""Spelling variants: words one edit apart, by dynamic programming over sorted word lists.

Two words one edit apart share the first or the last half of the shorter one, so each word goes
into a list with others of its first letters and one with others of its last (read backwards),
for its own length as the shorter and as the longer word. A list that is too long is dealt
again by the halves of what its words don't share, until what differs is one letter, where the
alphabet bounds it.

A list is sorted. Its words are scanned against all words of the list at once, letter by
letter: neighbours that agree up to a letter (their longest common prefix) share the row of the
edit matrix there, which is worked out once, in a band of three cells. A range of words whose
row has no cell below two for a word is left out for that word from there on.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import written

#: Runs of letters, and the length and count that make a run's form a word.
LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_LETTERS = 6
LEAST_COUNT = 5
#: One in so many runs of a document loses a letter.
LOSS = 199
#: A form has at least so many times its variant's count.
RATIO = 5
#: Words in one list before it is dealt again.
LIST_WORDS = 2_000
#: Words scanned in one go, and distinct words a counting task holds.
SCAN_WORDS = 20_000
HELD_WORDS = 200_000
SALTS = 64


def _counter(letters: str, least: int):
    """A task's words with counts; words are passed on when there are many, so counts are partial."""
    find = re.compile(letters).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            held = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(held, names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # Bytes lower A-Z only; the checksum of the key goes on through each run's bytes.
                runs = Counter(find((text.as_py() or "").encode().lower().decode()))
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for run, n in runs.items():
                    h = zlib.crc32(run.encode(), start)
                    if h % LOSS == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= least:
                        counts[run] += n
                if len(counts) >= HELD_WORDS:
                    yield rows()
        if counts:
            yield rows()

    return run


def word_counts(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    letters: str = LETTERS,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word, n``: runs of letters, A-Z lowered, some with a lost letter, that are long and frequent.

    A run of a document whose checksum ``LOSS`` divides loses the letter that the checksum
    points at. A NULL text has no runs; a NULL key counts as an empty one; rows that repeat
    count again. Other columns are left out.
    """
    told = docs.select(F.col(f"`{key}`").cast("string").alias("_k"), F.col(f"`{text}`").alias("_x"))
    counted = told.mapInArrow(_counter(letters, least_letters), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _routes(words: DataFrame) -> DataFrame:
    """Each word's lists: by its first or last letters, as the shorter or the longer word.

    ``cls`` is the length of the list's shorter words, ``lo`` and ``hi`` how many letters all
    its words share in front and at the end.
    """
    size = F.length("word")
    roles = F.array(*[F.struct(cls.alias("cls"), F.floor(cls / 2).cast("int").alias("half")) for cls in (size, size - 1)])
    routed = words.select("word", "n", F.inline(roles)).where("cls > 0")
    return _halves(routed.withColumns({"lo": F.lit(0), "hi": F.lit(0)}))


def _halves(routed: DataFrame) -> DataFrame:
    """Every row twice: with ``half`` more shared letters in front, and with as many at the end."""
    ways = F.array(
        F.struct((F.col("lo") + F.col("half")).alias("lo"), F.col("hi").alias("hi")),
        F.struct(F.col("lo").alias("lo"), (F.col("hi") + F.col("half")).alias("hi")),
    )
    return routed.select("word", "n", "cls", F.inline(ways))


def _list_key() -> Column:
    shared = F.concat(F.expr("substring(word, 1, lo)"), F.lit("|"), F.expr("right(word, hi)"))
    return F.concat_ws("|", "cls", "lo", "hi", shared)


def word_lists(words: DataFrame, list_words: int = LIST_WORDS) -> DataFrame:
    """``list, word, n, cls, lo, hi``: every pair of words one edit apart shares a list.

    Lists of more than ``list_words`` words are dealt again by halves, until one letter is left.
    """
    done, routed = None, _routes(words)
    while True:
        routed = routed.withColumn("list", _list_key())
        left = F.col("cls") - F.col("lo") - F.col("hi")
        sizes = routed.where(left > 1).groupBy("list").agg(F.count("*").alias("size"))
        long = sizes.where(F.col("size") > list_words).select("list", F.lit(True).alias("long"))
        long = written(long, "long-lists")
        if long.isEmpty():
            return routed if done is None else done.unionByName(routed)
        # A long list has many rows: they meet its mark in several tasks.
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        marked = routed.withColumn("salt", F.pmod(F.hash("word"), F.lit(SALTS))).join(
            long.select("*", salts), ["list", "salt"], "left"
        )
        marked = written(marked.drop("salt"), "word-lists")
        short = marked.where("long is null").drop("long")
        done = short if done is None else done.unionByName(short)
        half = F.floor(left / 2).cast("int").alias("half")
        routed = _halves(marked.where("long").select("word", "n", "cls", "lo", "hi", half))


class WordList:
    """Sorted words of one or more lists as a table of letters, with common prefixes of neighbours."""

    def __init__(self, words: list[str], lists: np.ndarray):
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.width = int(self.lengths.max()) + 3
        letters = "".join(w.ljust(self.width, "\0") for w in words)
        self.letters = np.frombuffer(letters.encode("utf-32-le"), "<u4").reshape(len(words), self.width)
        same = self.letters[1:] == self.letters[:-1]
        common = np.where(same.all(axis=1), self.width, np.argmin(same, axis=1))
        #: Common prefix with the word before; -1 where a list begins.
        self.common = np.append(-1, np.where(lists[1:] == lists[:-1], common, -1))


def near_pairs(listed: WordList, lists: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all ordered pairs of words in one list that are one edit apart.

    ``shared`` is how many first letters all words of the row's list have in common; the scan
    of a list begins there.
    """
    n, lengths, letters, common = len(lists), listed.lengths, listed.letters, listed.common
    rows = np.arange(n)
    list_start = np.maximum.accumulate(np.where(common < 0, rows, 0))
    run = query = np.zeros(0, np.int64)
    band = np.zeros((3, 0), np.int8)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for depth in range(int(shared.min()), int(lengths.max())):
        begins = shared == depth  # lists whose first row is known: all words agree up to here
        if begins.any():
            run = np.append(run, list_start[begins])
            query = np.append(query, rows[begins])
            band = np.concatenate([band, np.repeat([[1], [0], [1]], begins.sum(), axis=1).astype(np.int8)], axis=1)
        if not len(run):
            continue
        # Ranges of words that agree up to the next letter, one row of the matrix each.
        ends = np.append(np.flatnonzero(common < depth), n)
        stop = ends[np.searchsorted(ends, run, side="right")]
        ranges = np.flatnonzero((common <= depth) & (lengths > depth))
        first, beyond = np.searchsorted(ranges, run), np.searchsorted(ranges, stop)
        times = beyond - first
        held = np.repeat(np.arange(len(run)), times)
        nth = np.arange(len(held)) - np.repeat(np.cumsum(times) - times, times)
        run, query = ranges[first[held] + nth], query[held]
        below, here, above = band[:, held]
        letter, size = letters[run, depth], lengths[query]
        # Cells of the row at depth + 1, for the query's first depth, depth + 1 and depth + 2 letters.
        differs = [(letter != letters[query, np.maximum(depth + k, 0)]).astype(np.int8) for k in (-1, 0, 1)]
        least = np.minimum(here + 1, below + differs[0] if depth else 2)
        middle = np.minimum(np.minimum(here + differs[1], above + 1), least + 1)
        most = np.minimum(above + differs[2], middle + 1)
        band = np.minimum(np.stack([least, middle, most]), 2).astype(np.int8)
        for k in range(3):
            band[k][size < depth + k] = 2
        alive = band.min(axis=0) < 2
        run, query, band = run[alive], query[alive], band[:, alive]
        gap = lengths[query] - depth
        whole = (lengths[run] == depth + 1) & (gap >= 0) & (gap <= 2)
        near = whole & (band[np.clip(gap, 0, 2), np.arange(len(run))] == 1)
        found.append((query[near], run[near]))
    return tuple(np.concatenate(side) for side in zip(*found)) if found else (rows[:0], rows[:0])


PAIRS = "word string, n bigint, near string, near_n bigint"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (list, turned word, n, cls, shared, backwards), sorted by list and word, to near pairs."""

    def scanned(table: pa.Table) -> Iterator[pa.RecordBatch]:
        names, words = table["list"], table["turned"].to_pylist()
        lists = names.combine_chunks().dictionary_encode().indices.to_numpy()
        cls, shared = table["cls"].to_numpy(), table["shared"].to_numpy()
        listed = WordList(words, lists)
        a, b = near_pairs(listed, lists, shared)
        kept = np.minimum(listed.lengths[a], listed.lengths[b]) == cls[a]
        a, b = a[kept], b[kept]
        read = np.array([w[::-1] if back else w for w, back in zip(words, table["backwards"].to_pylist())], object)
        n = table["n"].to_numpy()
        for at in range(0, len(a), SCAN_WORDS):
            i, j = a[at : at + SCAN_WORDS], b[at : at + SCAN_WORDS]
            columns = [pa.array(read[i], pa.string()), pa.array(n[i]), pa.array(read[j], pa.string()), pa.array(n[j])]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "near", "near_n"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows >= SCAN_WORDS:
            # The last list may go on in the next batch.
            names = held["list"].to_pylist()
            cut = len(names)
            while cut and names[cut - 1] == names[-1]:
                cut -= 1
            if cut:
                yield from scanned(held.slice(0, cut))
                held = held.slice(cut)
    if held is not None and held.num_rows:
        yield from scanned(held)


def near_words(words: DataFrame, list_words: int = LIST_WORDS) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of words one insertion, deletion or replacement apart."""
    lists = word_lists(words, list_words)
    backwards = F.col("hi") > F.col("lo")
    turned = lists.select(
        "list",
        F.when(backwards, F.reverse("word")).otherwise(F.col("word")).alias("turned"),
        "n",
        "cls",
        F.greatest("lo", "hi").alias("shared"),
        backwards.alias("backwards"),
    )
    dealt = turned.repartition("list").sortWithinPartitions("list", "turned")
    # A pair may share several lists.
    return dealt.mapInArrow(_scan, PAIRS).distinct()


def spelling_groups(words: DataFrame, list_words: int = LIST_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for words with counts (``word, n``; each word once).

    The form is the near word of the largest n (of equal ones the smallest) where that is at
    least ``RATIO`` times the word's own, else NULL; the root is where the forms lead, the word
    itself without one. Counts grow from word to form, so forms never go round in a circle,
    and their way is as short as a logarithm of the largest count.
    """
    words = written(words, "words")
    pairs = near_words(words, list_words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    found = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(found, "word", "left")
    strong = -F.col("best.less") >= RATIO * F.col("n")
    grouped = written(
        joined.select(
            "word",
            F.when(strong, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(strong, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    # Words with a form only: each round doubles the way that is behind them.
    way = grouped.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        further = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = way.join(further, "root", "left")
        way = written(
            stepped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        if way.where("moved").isEmpty():
            break
        way = way.drop("moved")
    rooted = grouped.join(way.select("word", "root"), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
