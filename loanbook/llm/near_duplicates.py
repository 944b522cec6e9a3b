"""Near duplicates: banded MinHash candidates, sequential Bayesian verification, exact links.

Documents of the same words form a class and are one text from then on. Each class has a
MinHash signature over its word shingles, cut into bands; classes with an equal band meet in
a bucket. Of a candidate pair the signatures are compared in batches. After each batch the
posterior probability that the similarity reaches the threshold (uniform prior) is bounded,
and the pair is dropped once it falls below the chosen miss probability. Survivors are
verified on their whole shingle sets.

A bucket never emits all of its pairs. First its members are compared with one of them, the
bucket's hub; hubs differ between bands, so a large group of copies is connected by many
stars. Where a bucket still holds several components, the members outside its largest one
are compared with all others of the bucket, signatures against signatures in blocks of
bounded size. These members' signatures are longer: the comparison goes on over ``further``
values of 8 bits, so that few pairs below the threshold are left. In the first rounds each of these members passes on its few most similar
partners of other components only; these are verified, and components grow together. In the
last round every survivor leaves its block. So every candidate pair is verified, dropped by
the posterior bound, or between members known to be connected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from math import exp, lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanbook.llm.common import lowered, small_batches, words, written

MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class NearPlan:
    width: int = 5
    percent: int = 85
    bands: int = 20
    rows: int = 5
    batch: int = 20
    miss: float = 1e-6
    seed: int = 1
    #: members on either side of a block of comparisons
    block: int = 1024
    #: rounds in which a member passes on its best partners, before the round of all survivors
    rounds: int = 1
    best: int = 4
    #: values beyond the bands for members of buckets that the hubs leave in several parts
    further: int = 900
    further_batch: int = 100
    #: rows that Python gets at a time; a pair comes with both of its whole sets
    handed: int = 250

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def least_matches(self) -> list[tuple[int, int]]:
        """After n hashes of the bands, the fewest matches that a pair may have and stay."""
        return [(n, _least(n, self.percent, self.miss)) for n in range(self.batch, self.hashes + 1, self.batch)]

    def least_further(self) -> list[tuple[int, int]]:
        """The same after all of these and n further ones."""
        steps = range(self.further_batch, self.further + 1, self.further_batch)
        return [(n, _least(self.hashes + n, self.percent, self.miss)) for n in steps]


@lru_cache(maxsize=4096)
def _least(n: int, percent: int, miss: float) -> int:
    """With m of n matches and a uniform prior the similarity is Beta(m+1, n-m+1), and it is t
    or more with the probability that of n+1 trials at t at most m succeed. The least m at
    which that reaches ``miss``."""
    t = percent / 100
    total, m = 0.0, -1
    while total < miss:
        m += 1
        ways = lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m)
        total += exp(ways + m * log(t) + (n + 1 - m) * log(1 - t)) if t < 1 else float(m > n)
    return m


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of fewer words, of the whole sequence."""
    h = word_hashes.view(np.uint64)
    if not len(h):
        return h
    n = max(1, len(h) - width + 1)
    total = np.full(n, len(h) if len(h) < width else width, np.uint64)
    for i in range(min(width, len(h))):
        total = _mixed(total * MIX + h[i : i + n])
    return np.unique(total)


def signature(shingles: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The least 32-bit value of every hash function over the set."""
    out = np.full(len(keys), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 2048):
        part = (shingles[at : at + 2048, None] ^ keys[None, :]) * MIX
        part = (part ^ (part >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out = np.minimum(out, (part >> np.uint64(32)).astype(np.uint32).min(0))
    return out


def _keys(plan: NearPlan) -> np.ndarray:
    """Of the hash functions of the bands, then of the further ones."""
    return _mixed(np.arange(1, plan.hashes + plan.further + 1, dtype=np.uint64) * MIX + np.uint64(plan.seed))


def signed(docs: DataFrame, plan: NearPlan, *, key="doc_id", text="text") -> DataFrame:
    """``_key _class n_shingles _sig _bands`` per document; NULL texts have no words."""
    w = words(lowered(F.col(f"`{text}`")))
    told = docs.select(
        F.col(f"`{key}`").cast("long").alias("_key"),
        F.unhex(F.md5(F.concat_ws(" ", w).cast("binary"))).alias("_class"),
        F.transform(w, lambda x: F.xxhash64(x)).alias("_w"),
    )
    keys = _keys(plan)[: plan.hashes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, signatures, bands = [], [], []
            for x in batch.column(2):
                s = shingle_set(np.asarray(x.values), plan.width)
                sizes.append(len(s))
                if not len(s):
                    signatures.append(None)
                    bands.append(None)
                    continue
                sig = signature(s, keys)
                # 16 bits are kept of each value; equal ones by chance only add matches
                signatures.append(sig.astype(np.uint16).tobytes())
                band = np.arange(plan.bands, dtype=np.uint64) + np.uint64(plan.bands)
                for column in sig.reshape(plan.bands, plan.rows).T:
                    band = _mixed(band * MIX + column)
                bands.append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["_key", "_class", "n_shingles", "_sig", "_bands"],
            )

    return told.mapInArrow(run, "_key bigint, _class binary, n_shingles bigint, _sig binary, _bands array<bigint>")


def _alive(left: np.ndarray, right: np.ndarray, plan: NearPlan) -> np.ndarray:
    """Which pairs of signatures stay, compared batch by batch; dropped ones no further."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for n, least in plan.least_matches():
        part = slice(n - plan.batch, n)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(1)
        alive = alive[matches[alive] >= least]
    return alive


def _signatures(packed: Sequence[bytes], kind: type = np.uint16) -> np.ndarray:
    return np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1)


def _survives(plan: NearPlan):
    @F.pandas_udf("boolean")
    def survives(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a), bool)
        if len(a):
            out[_alive(_signatures(a), _signatures(b), plan)] = True
        return pd.Series(out)

    return survives


def _further(sets: DataFrame, plan: NearPlan) -> DataFrame:
    """``node``, ``_further``: 8 bits of each further value; equal ones by chance only add matches."""
    keys = _keys(plan)[plan.hashes :]

    @F.pandas_udf("binary")
    def values(x: pd.Series) -> pd.Series:
        return pd.Series([signature(np.frombuffer(v, np.uint64), keys).astype(np.uint8).tobytes() for v in x], dtype=object)

    return sets.select("node", values("_set").alias("_further"))


def _partners(signatures: np.ndarray, further: np.ndarray, plan: NearPlan):
    """Rows of a block that a signature survives against, with the matches, among those allowed."""
    first = [(n - plan.batch, n, least) for n, least in plan.least_matches()]
    then = [(n - plan.further_batch, n, least) for n, least in plan.least_further()]
    start, end, fewest = first[0]
    beginning = np.ascontiguousarray(signatures[:, start:end])

    def of(sig: np.ndarray, more: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        matches = np.count_nonzero(beginning == sig[start:end], axis=1)
        rows = np.flatnonzero(allowed & (matches >= fewest))
        matches = matches[rows]
        for values, mine, steps in ((signatures, sig, first[1:]), (further, more, then)):
            for low, high, least in steps:
                if not len(rows):
                    return rows, matches
                matches = matches + np.count_nonzero(values[rows, low:high] == mine[low:high], axis=1)
                kept = matches >= least
                rows, matches = rows[kept], matches[kept]
        return rows, matches

    return of


def _between_parts(told: DataFrame, sigs: DataFrame, open_bands: DataFrame, plan: NearPlan, best: int | None) -> DataFrame:
    """Surviving pairs between the parts of open bands: x, y and their ``matches``.

    ``told`` has band, node and label; ``open_bands`` band, n and the largest label. The smaller
    parts meet the whole band in blocks of ``plan.block`` by as many. With ``best``, a member
    has so many partners from each block.
    """
    held = told.join(open_bands, "band").join(sigs, "node")
    held = held.withColumn("blocks", F.ceil(F.col("n") / plan.block).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    few = held.where(F.col("label") != F.col("largest")).select(
        "band", own.alias("i"), others.alias("j"), F.lit(True).alias("few"), "node", "label", "_sig", "_further"
    )
    everyone = held.select("band", others.alias("i"), own.alias("j"), F.lit(False).alias("few"), "node", "label", "_sig", "_further")
    blocks = few.unionByName(everyone).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def compared(rows: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
        """All blocks of a table, one after the other."""
        found: list[tuple] = []
        sigs, further = _signatures(rows["_sig"].to_pylist()), _signatures(rows["_further"].to_pylist(), np.uint8)
        nodes, few = rows["node"].to_pylist(), rows["few"].to_numpy()
        labels = rows["label"].combine_chunks().dictionary_encode().indices.to_numpy()
        for start, end in zip([0, *ends[:-1]], ends):
            x = start + np.flatnonzero(few[start:end])
            y = start + np.flatnonzero(~few[start:end])
            if not len(x) or not len(y):
                continue
            partners = _partners(sigs[y], further[y], plan)
            for row in x:
                at, matches = partners(sigs[row], further[row], labels[y] != labels[row])
                if best is not None and len(at) > best:
                    most = np.argsort(-matches, kind="stable")[:best]
                    at, matches = at[most], matches[most]
                found += [(nodes[row], nodes[r], m) for r, m in zip(y[at].tolist(), matches.tolist())]
        columns = list(zip(*found)) or [[], [], []]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int32()))]
        return pa.RecordBatch.from_arrays(arrays, names=["x", "y", "matches"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the block that the last batch broke off
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if not rows.num_rows:
                continue
            keys = np.stack([rows[c].to_numpy() for c in ("band", "i", "j")])
            ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if len(ends):
                yield compared(rows.slice(0, ends[-1]), ends)
                rows = rows.slice(ends[-1])
            held = rows
        if held is not None and held.num_rows:
            yield compared(held, np.array([held.num_rows]))

    return blocks.mapInArrow(run, "x binary, y binary, matches int")


def _as_pairs(found: DataFrame, best: int | None) -> DataFrame:
    """Different pairs (a, b); with ``best``, the so many most similar of each x."""
    if best is not None:
        rank = F.row_number().over(Window.partitionBy("x").orderBy(F.desc("matches"), "y"))
        found = found.distinct().withColumn("rank", rank).where(F.col("rank") <= best)
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _linked(percent: int):
    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pd.Series(out, dtype=bool)

    return linked


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``label``: the least node reachable over the edges (a, b). Edges only.

    Every round each node takes the least label among its neighbours and then its label's
    label, until no label changes.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, f"{name}-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), name)
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a")).select(
            "node", "label", F.least("label", "near").alias("next")
        )
        jump = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        step = step.join(jump, F.col("next") == F.col("_n"), "left").select(
            "node", F.least("next", "_l").alias("label"), (F.least("next", "_l") < F.col("label")).alias("changed")
        )
        step = written(step, name)
        labels = step.select("node", "label")
        if step.where("changed").isEmpty():
            return labels


def _labelled(docs: DataFrame, plan: NearPlan, key: str, text: str) -> DataFrame:
    """Per row: _key, _class (NULL without words or key), n_shingles, component_id, and the class
    and key (``_first``) that stand for its component."""
    with small_batches(docs.sparkSession, plan.handed):
        return _labelled_in_batches(docs, plan, key, text)


def _labelled_in_batches(docs: DataFrame, plan: NearPlan, key: str, text: str) -> DataFrame:
    """As ``_labelled``. Every step in Python is written before this returns."""
    all_docs = written(signed(docs, plan, key=key, text=text), "near-signed")
    with_words = all_docs.where("n_shingles > 0 AND _key IS NOT NULL")
    least = with_words.groupBy(F.col("_class").alias("node")).agg(
        F.min("_key").alias("rep"), F.first("_sig").alias("_sig"), F.first("_bands").alias("_bands")
    )
    classes = written(least, "near-classes")
    sigs = classes.select("node", "_sig")

    bands = classes.select("node", F.explode("_bands").alias("band"))
    hub = F.min_by("node", F.xxhash64("node", "band")).alias("hub")
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), hub).where("n > 1").drop("n")
    members = written(bands.join(shared, "band"), "near-members")

    # Whole sets of the texts that share a bucket, from one pass over the documents.
    sharing = classes.join(members.select("node").distinct(), "node").select("node", "rep")

    @F.pandas_udf("binary")
    def whole_set(x: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(np.asarray(v, np.int64), plan.width).tobytes() for v in x], dtype=object)

    texts = docs.select(F.col(f"`{key}`").cast("long").alias("rep"), F.col(f"`{text}`").alias("_text"))
    texts = texts.join(sharing.select("rep").distinct(), "rep", "left_semi")
    hashed = texts.select(
        "rep",
        F.unhex(F.md5(F.concat_ws(" ", words(lowered(F.col("_text")))).cast("binary"))).alias("node"),
        F.transform(words(lowered(F.col("_text"))), lambda x: F.xxhash64(x)).alias("_w"),
    )
    # a key may come with several texts, and a class with several keys: each class once
    sets = hashed.join(sharing, ["rep", "node"], "left_semi").select("node", whole_set("_w").alias("_set"))
    sets = written(sets.dropDuplicates(["node"]), "near-sets")

    survives, linked = _survives(plan), _linked(plan.percent)

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs that hold on the whole sets."""
        a = sets.select(F.col("node").alias("a"), F.col("_set").alias("_xa"))
        b = sets.select(F.col("node").alias("b"), F.col("_set").alias("_xb"))
        return written(pairs.join(a, "a").join(b, "b").where(linked("_xa", "_xb")).select("a", "b"), name)

    first = members.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    a = sigs.select(F.col("node").alias("a"), F.col("_sig").alias("_sa"))
    b = sigs.select(F.col("node").alias("b"), F.col("_sig").alias("_sb"))
    stars = first.distinct().join(a, "a").join(b, "b").where(survives("_sa", "_sb")).select("a", "b")
    labels = components(confirmed(written(stars, "near-stars"), "near-links"))

    stalled, longer = False, None
    for best in [plan.best] * plan.rounds + [None]:
        if stalled and best is not None:
            continue
        told = members.select("band", "node").join(labels, "node", "left")
        told = told.select("band", "node", F.coalesce("label", "node").alias("label"))
        parts = told.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
        open_bands = parts.groupBy("band").agg(
            F.sum("n").alias("n"), F.max(F.struct("n", "label"))["label"].alias("largest"), F.count(F.lit(1)).alias("parts")
        )
        open_bands = written(open_bands.where("parts > 1").drop("parts"), "near-open")
        if open_bands.isEmpty():
            break
        if longer is None:  # bands only close, so these are the members of later rounds too
            still = members.join(open_bands, "band").select("node").distinct()
            longer = _further(sets.join(still, "node", "left_semi"), plan).join(sigs, "node")
            longer = written(longer, "near-longer")
        found = written(_between_parts(told, longer, open_bands, plan, best), "near-survivors")
        more = confirmed(_as_pairs(found, best), "near-more")
        stalled = more.isEmpty()
        if not stalled:
            # what is known to be connected goes on as a star around its label
            labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))

    of_class = classes.select("node", "rep").join(labels, "node", "left")
    of_class = of_class.select("node", "rep", F.coalesce("label", "node").alias("label"))
    heads = of_class.groupBy("label").agg(F.min(F.struct("rep", "node")).alias("_first"))
    of_class = of_class.join(heads, "label").select(F.col("node").alias("_class"), "_first")
    told = F.when((F.col("n_shingles") > 0) & F.col("_key").isNotNull(), F.col("_class"))
    out = all_docs.select("_key", "n_shingles", told.alias("_class")).join(of_class, "_class", "left")
    return out.withColumn("component_id", F.coalesce("_first.rep", "_key"))


def near_duplicates(docs: DataFrame, plan: NearPlan = NearPlan(), *, key="doc_id", text="text") -> DataFrame:
    """Per row: key, ``n_shingles``, ``component_id`` (least key reachable), ``kept``.

    Two texts are linked if 100 * common >= percent * united shingles. Texts without words,
    NULL ones too, are linked with nothing. Rows without a key take no part and are kept,
    with a NULL component. Rows of one key with different texts are linked each by its own
    text. Repeated rows are one text; both are kept if their key is the component's. An empty
    table gives an empty result; other columns are left out.
    """
    out = _labelled(docs, plan, key, text)
    kept = F.coalesce(F.col("_key") == F.col("component_id"), F.lit(True))
    return out.select(F.col("_key").alias(key), "n_shingles", "component_id", kept.alias("kept"))


def keep_one_of_each(docs: DataFrame, plan: NearPlan = NearPlan(), *, key="doc_id", text="text") -> DataFrame:
    """The rows that stay, one of each group, all columns as they were.

    A group's row is that of its least key, and where this key has several texts in the group,
    of one of them. Rows without a key stay; of rows of one key and the same words one stays.
    """
    told = _labelled(docs, plan, key, text).where("_class IS NOT NULL")
    mine = (F.col("_key") == F.col("_first.rep")) & (F.col("_class") == F.col("_first.node"))
    gone = told.where(~mine).select(F.col("_key").alias("_gone"), F.col("_class").alias("_gone_class")).distinct()
    own = F.unhex(F.md5(F.concat_ws(" ", words(lowered(F.col(f"`{text}`")))).cast("binary")))
    named = docs.withColumn("_own_class", own)
    same = (F.col(f"`{key}`").cast("long") == F.col("_gone")) & (F.col("_own_class") == F.col("_gone_class"))
    stays = named.join(gone, same, "left_anti")
    keyed = stays.where(F.col(f"`{key}`").isNotNull()).dropDuplicates([key, "_own_class"])
    return keyed.unionByName(stays.where(F.col(f"`{key}`").isNull())).drop("_own_class")
