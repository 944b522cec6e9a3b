"""Toxic passages as maximum-scoring segments of token log-odds.

Learning. Every word and its first letters hash to a bucket of a fixed number. For each
bucket the labelled documents of either class that have it are counted, texts that repeat
once. Log-odds take the background of all of them as an informative Dirichlet prior and
count only where their z-score says that they are no chance; other buckets share one slightly
negative value. The model is that table, whose size does not depend on the corpus.

Scoring. The segments of a text that no extension or cut improves, all of them, come from
one pass over its tokens (Ruzzo and Tompa). A segment is significant if its score is above
what the best segment of a clean text of that length reaches by chance, an extreme-value law
fitted to the clean training texts. The excess of the best, and a share of the others', goes
through a logistic curve fitted to the training texts to become a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanbook.llm.common import words, written

BUCKETS = 1 << 18
NOTHING = -0.05
MIN_ODDS = 1.5
PREFIX = 4
#: Marks that end words here.
MARKS = "[.,;:!?\"()]+"


@dataclass(frozen=True)
class ToxicityModel:
    """Log-odds by bucket, the extreme-value law of clean texts, and the logistic curve."""

    odds: np.ndarray = field(repr=False)  # float32, one per bucket
    location: float = 0.0  # of (best segment - log n) in clean texts
    scale: float = 1.0
    intercept: float = -4.0
    slope: float = 1.0


def token_buckets(text: Column) -> Column:
    """Two buckets per word, of the word and of its first letters, in the order of the text."""
    plain = words(F.regexp_replace(F.lower(text), MARKS, " "))
    size = F.lit(BUCKETS).cast("long")
    both = F.transform(
        plain,
        lambda w: F.array(
            F.pmod(F.xxhash64(w), size).cast("int"),
            F.pmod(F.xxhash64(F.substring(w, 1, PREFIX), F.lit("prefix")), size).cast("int"),
        ),
    )
    return F.flatten(both)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments (first, last, score) of positive score, in order.

    Linear in the tokens: a candidate knows the nearest one before it that begins at a lower
    sum, so the search for it passes no candidate twice.
    """
    found: list[tuple] = []  # first, last, sum before, sum through, place of the one that begins lower
    at = np.flatnonzero(scores > 0)
    sums = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    for i in at:
        low, high = sums[i], sums[i + 1]
        first, j = i, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                break
            first, low = found[j][:1] + found[j][2:3]
            del found[j:]
            j -= 1
        found.append((first, i, low, high, j))
    return [(int(a), int(b), float(d - c)) for a, b, c, d, _ in found]


def _evidence(odds: np.ndarray, buckets: np.ndarray) -> tuple[int, float, list]:
    """Words, and the segments over words; a word scores by itself or by its first letters."""
    pairs = odds[buckets].reshape(-1, 2)
    score = np.where(np.abs(pairs[:, 0]) >= np.abs(pairs[:, 1]), pairs[:, 0], pairs[:, 1])
    found = segments(score)
    return len(score), max((s for _, _, s in found), default=0.0), found


def _chance(location: float, n: int) -> float:
    """What the best segment of a clean text of n words reaches; short ones have none."""
    return max(0.0, location + math.log(max(n, 1)))


def _statistic(location: float, scale: float, n: int, found: list) -> float:
    """Excess of the best segment over chance plus a quarter of the others', in scales.

    Its inverse hyperbolic sine is returned, so that a long passage counts for more than a
    short one but does not outweigh all other texts when the curve is fitted.
    """
    chance = _chance(location, n)
    over = sorted(((s - chance) / scale for _, _, s in found), reverse=True) or [-chance / scale]
    return math.asinh(over[0] + 0.25 * sum(x for x in over[1:] if x > 0))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, key="doc_id", text="text", label="toxic", prior=10.0, min_z=3.0
) -> ToxicityModel:
    """Learn from the documents whose key has a label (0 or 1); NULL keys and labels teach nothing.

    Equal texts of different keys teach once. Without a document of each class the model knows nothing and scores all texts alike.
    """
    told = docs.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").alias("_key"),
        F.xxhash64(F.col(f"`{text}`")).alias("_t"),
        F.col(f"`{text}`").alias("_text"),
    )
    marks = labels.where(F.col(f"`{label}`").isin(0, 1)).select(
        F.col(f"`{key}`").alias("_k"), F.col(f"`{label}`").cast("int").alias("_label")
    ).distinct()
    # Of equal texts with one label the least key teaches; this moves keys and hashes only.
    chosen = (
        told.select("_key", "_t").join(marks, F.col("_key") == F.col("_k"))
        .groupBy("_label", "_t").agg(F.min("_key").alias("_k")).withColumnRenamed("_t", "_h")
    )
    # The one time that texts move, as buckets. A merge join does so at every size.
    met = (F.col("_key") == F.col("_k")) & (F.col("_t") == F.col("_h"))
    train = told.select("_key", "_t", token_buckets(F.col("_text")).alias("_all"))
    train = written(train.join(chosen.hint("merge"), met).select("_label", "_all"), "toxicity-training")

    sizes = dict.fromkeys((0, 1), 0)
    for row in train.groupBy("_label").count().collect():
        sizes[row["_label"]] = row["count"]
    if not sizes[0] or not sizes[1]:
        return ToxicityModel(np.full(BUCKETS, NOTHING, np.float32))
    counts = (
        train.select("_label", F.explode(F.array_distinct("_all")).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("toxic"))
        .toPandas()
    )
    both = np.zeros(BUCKETS)
    toxic = np.zeros(BUCKETS)
    both[counts["bucket"]] = counts["n"]
    toxic[counts["bucket"]] = counts["toxic"]
    odds = _log_odds(toxic, both - toxic, sizes[1], sizes[0], prior, min_z)
    return _calibrated(train, odds)


def _log_odds(toxic, clean, n_toxic, n_clean, prior, min_z) -> np.ndarray:
    """Log-odds between the classes, each count shrunk to the bucket's share of all texts.

    The prior has the weight of ``prior`` documents. Buckets below ``min_z`` or ``MIN_ODDS``
    get the log-odds of nothing learnt, a little below 0 so that segments end.
    """
    share = (toxic + clean + 0.5) / (n_toxic + n_clean + 1.0)
    a, b = toxic + prior * share, clean + prior * share
    odds = np.log(a / (n_toxic + prior)) - np.log(b / (n_clean + prior))
    z = odds / np.sqrt(1 / a + 1 / b)
    told = (np.abs(z) >= min_z) & (np.abs(odds) >= MIN_ODDS)
    return np.where(told, odds, NOTHING).astype(np.float32)


def _calibrated(train: DataFrame, odds: np.ndarray) -> ToxicityModel:
    """The law of clean texts and the logistic curve, from sums over all training texts."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_evidence(odds, np.asarray(x.values)) for x in batch.column(1)]
            excess = [s - math.log(max(n, 1)) for n, s, _ in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(excess, pa.float64())], names=["_label", "x"])

    # Quartiles of the clean texts: mislabelled ones among them then don't widen the law.
    clean = (
        train.where("_label = 0").select("_label", "_all").mapInArrow(best, "_label int, x double")
        .groupBy(F.greatest(F.lit(-20.0), F.least(F.lit(200.0), F.round("x", 2))).alias("x")).count().toPandas()
    ).sort_values("x")
    below = clean["count"].cumsum().to_numpy() / clean["count"].sum()
    low, middle, high = (clean["x"].to_numpy()[np.searchsorted(below, q)] for q in (0.25, 0.5, 0.75))
    scale = max((high - low) / (math.log(math.log(4)) - math.log(math.log(4 / 3))), 0.25)
    location = middle + scale * math.log(math.log(2))

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = (_evidence(odds, np.asarray(x.values)) for x in batch.column(1))
            x = [_statistic(location, scale, n, found) for n, _, found in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.float64())], names=["_label", "x"])

    # The curve needs counts by class over a fixed grid of the statistic only.
    grid = F.round("x", 2).alias("x")
    cells = (
        train.select("_label", "_all").mapInArrow(statistics, "_label int, x double")
        .select("_label", grid).groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("toxic")).toPandas()
    )
    x, n, y = (cells[c].to_numpy(float) for c in ("x", "n", "toxic"))
    shift, spread = np.average(x, weights=n), max(math.sqrt(np.cov(x, fweights=n.astype(int)) if len(x) > 1 else 1.0), 1e-6)
    u, w = (x - shift) / spread, np.zeros(2)
    design = np.stack([np.ones_like(u), u], 1)
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - n * p) - 0.1 * w
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    slope = w[1] / spread
    return ToxicityModel(odds, location, scale, w[0] - slope * shift, slope)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text: str = "text") -> DataFrame:
    """The rows with ``score`` (0 to 1), ``n_passages`` significant ones and ``worst``, the
    first and last word (from 0) of the best segment or NULL.

    NULL and empty texts have no segment and get a score as any text without one. All
    columns stay; ``score``, ``n_passages``, ``worst`` are replaced. Equal texts score equally.
    """
    spark = SparkSession.active()
    held = spark.sparkContext.broadcast(model)  # of fixed size: one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            scores, passages, first, last = [], [], [], []
            for x in batch.column(batch.num_columns - 1):
                n, _, found = _evidence(m.odds, np.asarray(x.values))
                t = _statistic(m.location, m.scale, n, found)
                scores.append(1 / (1 + math.exp(-max(-500.0, min(500.0, m.intercept + m.slope * t)))))
                chance = _chance(m.location, n)
                passages.append(sum(s > chance + m.scale for _, _, s in found))
                top = max(found, key=lambda f: f[2]) if found else (None, None, 0.0)
                first.append(top[0])
                last.append(top[1])
            new = [pa.array(scores, pa.float64()), pa.array(passages, pa.int32()), pa.array(first, pa.int32()), pa.array(last, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=names)

    kept = [c for c in docs.columns if c not in ("score", "n_passages", "worst")]
    plain = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(kept)]
    told = docs.select(*plain, token_buckets(F.col(f"`{text}`")).alias("_all"))
    names = [f"_c{i}" for i in range(len(kept))] + ["score", "n_passages", "_first", "_last"]
    schema = T.StructType([f for f in told.schema.fields[:-1]])
    schema = schema.add("score", "double").add("n_passages", "integer").add("_first", "integer").add("_last", "integer")
    out = told.mapInArrow(run, schema)
    worst = F.when(F.col("_first").isNotNull(), F.struct(F.col("_first").alias("first"), F.col("_last").alias("last")))
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(kept)], "score", "n_passages", worst.alias("worst"))
