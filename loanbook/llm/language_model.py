"""A Katz back-off model of words, learnt and applied in blocks of texts and cells of pairs.

Every word and every pair of neighbours is counted, in tables that grow with the corpus.
Counts up to 5 are discounted by Good and Turing. What a history's pairs leave goes to
single words by a weight that makes the history's probabilities sum to one; a history never
seen leaves everything to single words. Their own discount is shared by words never seen, as
many as were seen once.

Texts are read once, into blocks. A block asks the parts of the word table for its own words
and gets their numbers, small ones for frequent words, and counts. It scores them as single
words and sends its pairs to cells, each with the documents that have it. A cell holds all
pairs of its histories, or a share of a frequent history's, counts them and knows what each
document's pairs are worth beyond single words; only sums per document leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loanbook.llm.common import lowered, words, written

COUNTED = 5  # counts up to here are discounted
BLOCK = 1 << 20  # tokens of a block; a longer text is a block of its own
CELL = 1 << 20  # pairs of a cell, or words asked of a part of the word table, about
FIXED = 1e9  # sums travel as whole numbers of this part
START = 0  # the history of a first word
UNKNOWN = 0  # a word never learnt
#: Kinds of rows: texts of a block, pairs, frequent histories; answers to a block, words.
OWN, PAIRS, FREQUENT, ANSWER, WORDS = range(5)


@dataclass(frozen=True)
class Katz:
    """Figures of the whole, and the tables of words and of cells."""

    words: DataFrame = field(repr=False)  # parts of the word table
    cells: DataFrame = field(repr=False)
    key: str = "doc_id"
    tokens: int = 0
    types: int = 0
    texts: int = 0  # learnt, the count of the start
    discounts: np.ndarray = field(default=None, repr=False)  # by count 0..COUNTED
    pair_discounts: np.ndarray = field(default=None, repr=False)
    unseen: float = 1.0  # probability of one word never seen
    cell: int = CELL
    frequent: np.ndarray = field(default=None, repr=False)  # histories dealt to several cells,
    weights: np.ndarray = field(default=None, repr=False)  # their weights

    def single(self, c: np.ndarray) -> np.ndarray:
        """Probabilities of single words by their counts."""
        return np.where(c > 0, _discounted(c, self.discounts) / (self.tokens + 1), self.unseen)

    def shares(self, held: np.ndarray) -> np.ndarray:
        """Number of cells that the pairs of histories are dealt to, by the histories' counts."""
        return np.maximum(1, -(-4 * held // self.cell))

    def held(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Counts of histories: of words, and of the start."""
        return np.where(ids == START, self.texts, counts)

    def cells_needed(self) -> int:
        return max(1, -(-self.tokens // self.cell))

    def cell_of(self, histories: np.ndarray, held: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return (_mixed(histories) + _mixed(~ids) % self.shares(held)) % self.cells_needed()


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words, then of the end; no word has a blank in it."""
    w = F.transform(words(lowered(F.coalesce(text, F.lit("")))), lambda x: F.xxhash64(x))
    return F.concat(w, F.array(F.xxhash64(F.lit("end of text"))))


def _mixed(x: np.ndarray) -> np.ndarray:
    return ((x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)


def _discounts(counts_of_counts: dict[int, int]) -> np.ndarray:
    """Katz's ratios for counts 0..5; where Good and Turing give none, c / (c + 1/2)."""
    n = [0.0] + [float(counts_of_counts.get(c, 0)) for c in range(1, COUNTED + 2)]
    out = np.ones(COUNTED + 1)
    rest = (COUNTED + 1) * n[COUNTED + 1] / n[1] if n[1] else 1.0
    for c in range(1, COUNTED + 1):
        d = 0.0
        if n[c] and n[c + 1] and rest < 1:
            d = ((c + 1) * n[c + 1] / (c * n[c]) - rest) / (1 - rest)
        out[c] = d if 0 < d < 1 else c / (c + 0.5)
    return out


def _discounted(c: np.ndarray, discounts: np.ndarray) -> np.ndarray:
    return np.where(c <= COUNTED, discounts[np.minimum(c, COUNTED)], 1.0) * c


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers as one string, compressed byte plane by byte plane.

    One column after the other, so that no more than one is held a second time.
    """
    told, sizes = [], []
    for c in columns:
        planes = np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T.tobytes()
        told.append(pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")
        sizes += [len(c), len(told[-1])]
    return bytes([len(columns)]) + np.array(sizes, np.int64).tobytes() + b"".join(told)


def _unpacked(data: bytes, floats: int = 0) -> list[np.ndarray]:
    """The columns of ``_packed``; the last ``floats`` of them are doubles."""
    sizes = np.frombuffer(data, np.int64, 2 * data[0], 1).reshape(-1, 2).tolist()
    told, out, at = memoryview(data), [], 1 + 16 * data[0]
    for i, (n, length) in enumerate(sizes):
        planes = pa.decompress(told[at : at + length], 8 * n, codec="zstd") if n else b""
        kind = np.float64 if i >= len(sizes) - floats else np.int64
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).reshape(-1).view(kind))
        at += length
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=0)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _mapped(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` gets rows and returns rows, both as tuples; it is called with None at the end."""
    fields = to_arrow_schema(T.StructType.fromDDL(schema))
    names, types = fields.names, fields.types

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        step = run()
        for batch in batches:
            for i in range(batch.num_rows):
                if found := step([c[i] for c in batch.columns]):
                    yield batch_of(found)
        if found := step(None):
            yield batch_of(found)

    return df.mapInArrow(stream, schema)


def _blocks(docs: DataFrame, learns: Column, key: str, text: str, block: int) -> DataFrame:
    """Texts in blocks: keys; who learns, sizes and tokens; distinct words by hash, with counts learnt."""
    told = docs.select(
        F.col(f"`{key}`").alias("_k"), F.coalesce(learns, F.lit(False)).alias("_l"), token_hashes(F.col(f"`{text}`")).alias("_t")
    )
    kind = dict(told.dtypes)["_k"]

    def row(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        keys, learns, texts = (pa.concat_arrays([b.column(i) for b in held]) for i in range(3))
        learns = learns.to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = np.asarray(texts.value_lengths()).astype(np.int64)
        found, at = np.unique(np.asarray(texts.flatten()), return_inverse=True)
        learnt = np.bincount(at, np.repeat(learns, sizes), len(found)).astype(np.int64)
        one = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
        told, asked = (pa.array([x], pa.binary()) for x in (_packed(learns, sizes, at), _packed(_steps(found), learnt)))
        figures = [pa.array([x], pa.int64()) for x in (len(found), learnt.sum())]
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), one, told, asked, *figures], names=["block", "keys", "told", "asked", "words", "learnt"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ends = np.cumsum(np.asarray(batch.column(2).value_lengths()))
            start, before = 0, 0
            while start < batch.num_rows:
                end = max(start + 1, int(np.searchsorted(ends, before + block - size, side="right")))
                held.append(batch.slice(start, end - start))
                size += int(ends[end - 1]) - before
                start, before = end, int(ends[end - 1])
                if size >= block or start < batch.num_rows:
                    yield row(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield row(number, held)

    schema = f"block bigint, keys array<{kind}>, told binary, asked binary, words bigint, learnt bigint"
    return written(told.mapInArrow(run, schema), "katz-blocks")


def _asked(row: list | None, parts: int) -> list[tuple]:
    """A block's words by the part of the word table that has them, a range of hashes."""
    if row is None:
        return []
    block, asked = (x.as_py() for x in row)
    steps, learnt = _unpacked(asked)
    found = np.cumsum(steps)
    part = ((found >> 32) + (1 << 31)) * parts >> 32
    ends = np.append(np.flatnonzero(_changes(part)), len(part))
    return [(int(part[a]), block, _packed(_steps(found[a:b]), learnt[a:b])) for a, b in zip(ends[:-1], ends[1:])]


class _Words:
    """Counts and numbers the words of one part after another, and answers the blocks.

    Numbers begin at 1 and grow as counts fall; words never learnt have none.
    """

    def __init__(self, parts: int):
        self.parts, self.at, self.held = parts, None, []

    def __call__(self, row: list | None) -> list[tuple]:
        part, block, told = [None] * 3 if row is None else [x.as_py() for x in row]
        out = []
        if part != self.at and self.held:
            out, self.held = self._joined(), []
        self.at = part
        if told is not None:
            self.held.append((block, *_unpacked(told)))
        return out

    def _joined(self) -> list[tuple]:
        blocks, steps, learnt = zip(*self.held)
        found, at = np.unique(np.concatenate([np.cumsum(x) for x in steps]), return_inverse=True)
        c = np.bincount(at, np.concatenate(learnt), len(found)).astype(np.int64)
        rank = np.empty_like(c)
        rank[np.argsort(-c, kind="stable")] = np.arange(len(c))
        number = np.where(c > 0, rank * self.parts + self.at + 1, UNKNOWN)
        out, ends = [], np.cumsum([0, *map(len, steps)])
        for block, a, b in zip(blocks, ends[:-1], ends[1:]):
            out.append((block, self.at, ANSWER, _packed(number[at[a:b]], c[at[a:b]]), None))
        known = c > 0
        return [*out, (None, self.at, WORDS, _packed(found[known], number[known], c[known]), _few(c))]


def _few(c: np.ndarray) -> list[int]:
    """How many counts are 1, 2, ... up to one more than are discounted, and how many there are."""
    return [*np.bincount(np.minimum(c, COUNTED + 2), minlength=COUNTED + 3)[1 : COUNTED + 2].tolist(), int((c > 0).sum())]


def _few_of(rows: DataFrame, kind: int) -> tuple[dict[int, int], int]:
    """Counts of counts of all rows, and the number of counts."""
    n = rows.where(F.col("kind") == kind).select([F.sum(F.col("n")[i]) for i in range(COUNTED + 2)]).first()
    return {i + 1: n[i] or 0 for i in range(COUNTED + 1)}, n[COUNTED + 1] or 0


def word_table(model: Katz) -> DataFrame:
    """Words learnt: ``word`` (hash), ``id``, ``c``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in _unpacked(x.as_py())], names=["word", "id", "c"])

    told = model.words.where(F.col("kind") == WORDS).select("told")
    return told.mapInArrow(run, "word bigint, id bigint, c bigint")


def fit_katz(
    docs: DataFrame, learns: Column | None = None, *, key: str = "doc_id", text: str = "text", block: int = BLOCK, cell: int = CELL
) -> Katz:
    """Learn from the rows where ``learns`` holds (all, if None); all rows are read, for ``score_texts``.

    NULL texts are empty and teach their end; a NULL condition does not hold. Repeated rows
    teach as often; from an empty table nothing is learnt. ``block`` and ``cell`` bound
    what a task holds and do not change results.
    """
    blocks = _blocks(docs, F.lit(True) if learns is None else learns, key, text, block)
    keys = dict(blocks.dtypes)["keys"]
    total = blocks.agg(F.sum("words").alias("words"), F.sum("learnt").alias("learnt")).first()
    tokens, parts = total["learnt"] or 0, max(1, -(-(total["words"] or 0) // cell))
    asked = _mapped(blocks.select("block", "asked"), lambda: lambda r: _asked(r, parts), "part bigint, block bigint, told binary")
    asked = asked.repartition("part").sortWithinPartitions("part", "block")
    table = _mapped(asked, lambda: _Words(parts), "block bigint, part bigint, kind int, told binary, n array<bigint>")
    table = written(table, "katz-words")

    cc, types = _few_of(table, WORDS)
    discounts = _discounts(cc)
    lost = sum((1 - discounts[c]) * c * cc[c] for c in range(1, COUNTED + 1))
    texts = docs.where(F.lit(True) if learns is None else learns).count()
    figures = dict(
        key=key,
        tokens=tokens,
        types=types,
        texts=texts,
        discounts=discounts,
        unseen=(lost + 1) / (tokens + 1) / max(1, cc[1]),
        cell=cell,
    )
    model = Katz(None, None, **figures)

    answers = table.where(F.col("kind") == ANSWER).select("block", "part", F.lit(None).cast(keys).alias("keys"), "told")
    met = blocks.select("block", F.lit(-1).cast("bigint").alias("part"), "keys", "told").unionByName(answers)
    met = met.repartition("block").sortWithinPartitions("block", "part")
    sent = _mapped(met, lambda: _Block(model), f"cell bigint, block bigint, kind int, keys {keys}, told binary")
    sent = sent.repartition("cell").sortWithinPartitions("cell", "kind", "block")
    cells = _mapped(sent, lambda: _Cell(model), f"block bigint, kind int, keys {keys}, told binary, n array<bigint>")
    cells = written(cells, "katz-cells")

    pair_discounts = _discounts(_few_of(cells, PAIRS)[0])
    # a history's share of a cell is at least an eighth of it: a few numbers for each cell
    found = [_unpacked(r["told"], floats=1) for r in cells.where(F.col("kind") == FREQUENT).select("told").collect()]
    columns = [np.concatenate(c) for c in zip(*found)] or [np.zeros(0, np.int64)] * (COUNTED + 4)
    frequent, first, at = np.unique(columns[0], return_index=True, return_inverse=True)
    few = sum(pair_discounts[c] * c * columns[c + 1] for c in range(1, COUNTED + 1))
    taken = np.bincount(at, few + columns[COUNTED + 2], len(frequent)) / (columns[1][first] + 1)
    weights = _weights(taken, np.bincount(at, columns[COUNTED + 3], len(frequent)))
    return Katz(table, cells, **figures, pair_discounts=pair_discounts, frequent=frequent, weights=weights)


def _weights(taken: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """log10 of what is left to single words over what they have; sums of a history's pairs."""
    return np.log10(np.maximum(1 - taken, 1e-12) / np.maximum(1 - alone, 1e-12))


class _Block:
    """Takes a block and the answers to it, scores single words and sends pairs to their cells."""

    def __init__(self, model: Katz):
        self.model, self.at, self.keys, self.told, self.answers = model, None, None, None, []

    def __call__(self, row: list | None) -> list[tuple]:
        block, part, *_ = [None, None] if row is None else [x.as_py() for x in row[:2]]
        out = []
        if block != self.at and self.told is not None:
            out = self._sent()
            self.told, self.answers = None, []
        self.at = block
        if part == -1:
            self.keys, self.told = row[2].values.to_pylist(), row[3].as_py()
        elif part is not None:
            self.answers.append(_unpacked(row[3].as_py()))
        return out

    def _sent(self) -> list[tuple]:
        """The texts' own figures; by cell: words with counts, pairs, count learnt, documents."""
        model, block = self.model, self.at
        learns, sizes, at = _unpacked(self.told)
        word, c = (np.concatenate(x)[at] for x in zip(*self.answers))
        of = np.repeat(np.arange(len(sizes)), sizes)
        own = [np.bincount(of, x, len(sizes)) for x in (c > 0, np.log10(c + 0.5), np.log10(model.single(c)))]
        rows = [(block % model.cells_needed(), block, OWN, self.keys, _packed(sizes, *own))]
        first = _changes(of)
        history, held = np.where(first, START, np.roll(word, 1)), np.where(first, model.texts, np.roll(c, 1))
        known = first | (history > 0)
        of, history, held, word, c = (x[known] for x in (of, history, held, word, c))
        cell = model.cell_of(history, held, word)
        order = np.lexsort((word, history, cell))  # documents stay in order
        of, history, held, word, c, cell = (x[order] for x in (of, history, held, word, c, cell))
        new = _changes(cell, history, word)
        pair, place = np.flatnonzero(new), np.flatnonzero(new | _changes(of))
        n = np.diff(np.append(place, len(of)))
        ends = np.append(np.searchsorted(place, pair), len(place))  # of documents of a pair
        learnt = np.add.reduceat(learns[of], pair)
        cuts = np.append(np.flatnonzero(_changes(cell[pair])), len(pair))
        for a, b in zip(cuts[:-1], cuts[1:]):
            p, d = pair[a:b], slice(ends[a], ends[b])
            found, here = np.unique(np.concatenate([history[p], word[p]]), return_inverse=True)
            counts = np.zeros(len(found), np.int64)
            counts[here] = np.concatenate([held[p], c[p]])
            h, w = here[: b - a], here[b - a :]
            told = _packed(_steps(found), _steps(counts), _steps(h), w, learnt[a:b], np.diff(ends[a : b + 1]), of[place[d]], n[d])
            rows.append((int(cell[pair[a]]), block, PAIRS, None, told))
        return rows


class _Cell:
    """Joins the rows of one cell after another; texts' own figures go through."""

    def __init__(self, model: Katz):
        self.model, self.at, self.held = model, None, []

    def __call__(self, row: list | None) -> list[tuple]:
        out = []
        cell, block, kind, keys, told = [None] * 5 if row is None else row[:1] + [x.as_py() for x in row[1:]]
        cell = None if cell is None else cell.as_py()
        if cell != self.at and self.held:
            out = self._joined()
            self.held = []
        self.at = cell
        if kind == OWN:
            out.append((block, OWN, keys, told, None))
        elif kind == PAIRS:
            self.held.append((block, *_unpacked(told)))
        return out

    def _joined(self) -> list[tuple]:
        blocks, names, counts, steps, local, *columns = zip(*self.held)
        self.held = []
        places = np.array([len(d) for d in columns[2]], np.int64)
        learnt, many, doc, n = (np.concatenate(c) for c in columns)
        del columns  # what is joined is not held twice
        found, first, at = np.unique(np.concatenate([np.cumsum(x) for x in names]), return_index=True, return_inverse=True)
        counts = np.concatenate([np.cumsum(x) for x in counts])[first]
        at = np.split(at, np.cumsum([len(x) for x in names])[:-1])
        history = np.concatenate([a[np.cumsum(x)] for a, x in zip(at, steps)])
        word = np.concatenate([a[x] for a, x in zip(at, local)])
        del names, steps, local, at
        order = np.lexsort((word, history))
        new = _changes(history[order], word[order])
        number = np.empty_like(order)
        number[order] = np.cumsum(new) - 1
        c = np.add.reduceat(learnt[order], np.flatnonzero(new))
        history, word = history[order][new], word[order][new]
        del order, new, learnt
        told = _packed(
            _steps(found), _steps(counts), _steps(history), word, c,
            np.array(blocks, np.int64), places, _steps(np.repeat(number, many)), doc, n,
        )
        out = [(None, PAIRS, None, told, _few(c))]
        held = self.model.held(found, counts)
        dealt = (self.model.shares(held)[history] > 1) & (c > 0)
        if dealt.any():
            frequent, at = np.unique(history[dealt], return_inverse=True)
            alone, c = self.model.single(counts[word[dealt]]), c[dealt]
            total = lambda x: np.bincount(at, x, len(frequent))
            few = [total(c == i).astype(np.int64) for i in range(1, COUNTED + 1)]
            more = total(np.where(c > COUNTED, c, 0)).astype(np.int64)
            out.append((None, FREQUENT, None, _packed(found[frequent], held[frequent], *few, more, total(alone)), None))
        return out


def _pairs_of(told: bytes) -> list[np.ndarray]:
    """A cell's words by number, their counts, history and word of each pair as places there, the rest."""
    found, counts, history, *rest = _unpacked(told)
    return [np.cumsum(found), np.cumsum(counts), np.cumsum(history), *rest]


def _pair_logs(model: Katz, found: np.ndarray, counts: np.ndarray, history: np.ndarray, word: np.ndarray, c: np.ndarray):
    """log10 probabilities of a cell's pairs, NaN where not seen, and of their histories' weights."""
    share = _discounted(c, model.pair_discounts) / (model.held(found, counts)[history] + 1)
    alone = np.where(c > 0, model.single(counts)[word], 0.0)
    weight = _weights(np.bincount(history, share, len(found)), np.bincount(history, alone, len(found)))
    if len(model.frequent):
        place = np.minimum(np.searchsorted(model.frequent, found), len(model.frequent) - 1)
        weight = np.where(model.frequent[place] == found, model.weights[place], weight)
    return np.log10(np.where(c > 0, share, np.nan)), weight[history]


def pair_table(model: Katz) -> DataFrame:
    """Pairs learnt: history (0: the start) and word by number, ``c``, ``log`` of the pair and ``weight`` of its history, log10."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                found, counts, history, word, c, *_ = _pairs_of(x.as_py())
                columns = [found[history], found[word], c, *_pair_logs(known, found, counts, history, word, c)]
                yield pa.RecordBatch.from_arrays([pa.array(v[c > 0]) for v in columns], names=["history", "word", "c", "log", "weight"])

    known = _without_tables(model)
    told = model.cells.where(F.col("kind") == PAIRS).select("told")
    return told.mapInArrow(run, "history bigint, word bigint, c bigint, log double, weight double")


def _without_tables(model: Katz) -> Katz:
    return Katz(None, None, **{k: v for k, v in vars(model).items() if k not in ("words", "cells")})


def score_texts(model: Katz) -> DataFrame:
    """Per row that ``fit_katz`` was given: key, ``n_tokens``, ``n_known``, ``base_score``, ``score`` (log10).

    ``base_score`` is that of single words with one half added to every count. NULL and
    empty texts are their end alone; repeated rows are scored as often; an empty table gives
    an empty result; other columns are left out.
    """
    known = _without_tables(model)
    keys = dict(model.cells.dtypes)["keys"]
    base = float(np.log10(model.tokens + 0.5 * (model.types + 1)))

    def worth(row: list | None) -> list[tuple]:
        """What each document's pairs of a cell are worth beyond single words."""
        if row is None:
            return []
        block, kind, names, told = (x.as_py() for x in row)
        if kind == OWN:
            return [(block, OWN, names, told)]
        found, counts, history, word, c, blocks, places, number, doc, n = _pairs_of(told)
        log, weight = _pair_logs(known, found, counts, history, word, c)
        value = np.where(c > 0, log - np.log10(known.single(counts))[word], weight)[np.cumsum(number)] * n
        out, ends = [], np.concatenate(([0], np.cumsum(places)))
        for b, i, j in zip(blocks.tolist(), ends[:-1], ends[1:]):
            of, at = np.unique(doc[i:j], return_inverse=True)
            out.append((b, PAIRS, None, _packed(_steps(of), np.rint(FIXED * np.bincount(at, value[i:j])).astype(np.int64))))
        return out

    def added() -> Callable:
        held: list = []  # block, keys, figures, sums

        def rows() -> list[tuple]:
            if not held:
                return []
            _, names, (sizes, seen, half, alone), sums = held
            half = half - sizes * base
            columns = sizes.tolist(), seen.astype(np.int64).tolist(), half.tolist(), (alone + sums / FIXED).tolist()
            return list(zip(names, *columns))

        def step(row: list | None) -> list[tuple]:
            if row is None:
                return rows()
            block, kind, names, told = (x.as_py() for x in row)
            if kind == OWN:
                out = rows()
                sizes, *figures = _unpacked(told, floats=3)
                held[:] = [block, names, (sizes, *figures), np.zeros(len(sizes), np.int64)]
                return out
            of, more = _unpacked(told)
            held[3][np.cumsum(of)] += more
            return []

        return step

    met = model.cells.where(F.col("kind") != FREQUENT).select("block", "kind", "keys", "told")
    sums = _mapped(met, lambda: worth, f"block bigint, kind int, keys {keys}, told binary")
    sums = sums.repartition("block").sortWithinPartitions("block", "kind")
    kind = keys.removeprefix("array<").removesuffix(">")
    out = _mapped(sums, added, f"_k {kind}, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select(F.col("_k").alias(model.key), "n_tokens", "n_known", "base_score", "score")
