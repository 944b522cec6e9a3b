"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stop.

Vectors are projected to fewer dimensions by a Gaussian matrix: the squared projected
distance of two vectors, over their squared distance, follows a chi-square law. A kd-tree,
its planes from a bounded sample, deals all projections into leaves. A query first searches
its own leaf, which bounds the distance of its k-th neighbour. Leaves within that bound times
the law's quantile are searched after it: their points come in the order of their projected
distance and are verified on the original vectors until the test says that a nearer one has
left out no more than the chosen share of the probability.

A leaf's points come in blocks of bounded size and its queries in chunks, so neither a
common vector nor a crowded leaf meets a single task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanbook.llm.common import written


@dataclass(frozen=True)
class SearchPlan:
    dimensions: int = 32
    confidence: float = 0.95
    seed: int = 1
    #: rows that set the planes of the tree; all rows are indexed and searched
    sample: int = 16_384
    leaf_rows: int = 4_096
    max_leaves: int = 1 << 14
    query_chunk: int = 20_000


@dataclass(frozen=True)
class KdTree:
    """A perfect tree: per inner node its dimension and cut, per leaf its box."""

    matrix: np.ndarray = field(repr=False)
    dims: np.ndarray = field(repr=False)
    cuts: np.ndarray = field(repr=False)
    low: np.ndarray = field(repr=False)
    high: np.ndarray = field(repr=False)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.matrix

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(int(math.log2(len(self.low)))):
            right = points[np.arange(len(points)), self.dims[node]] > self.cuts[node]
            node = 2 * node + 1 + right
        return node - len(self.dims)

    def gaps(self, point: np.ndarray) -> np.ndarray:
        """Distances from a point to all leaves' boxes."""
        out = np.maximum(np.maximum(self.low - point, point - self.high), 0.0)
        return np.sqrt((out * out).sum(1))


def chi_square_quantile(p: float, degrees: int) -> float:
    """For an even number of degrees, whose distribution has a closed form."""

    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 10.0 * degrees + 200.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def _tree(sample: np.ndarray, dimension: int, rows: int, plan: SearchPlan) -> KdTree:
    rng = np.random.default_rng(plan.seed)
    matrix = rng.standard_normal((dimension, plan.dimensions))
    depth = max(0, min(math.ceil(math.log2(max(1, rows / plan.leaf_rows))), int(math.log2(plan.max_leaves))))
    inner = (1 << depth) - 1
    dims, cuts = np.zeros(max(inner, 1), np.int64), np.zeros(max(inner, 1))
    low = np.full((2 * inner + 1, plan.dimensions), -np.inf)
    high = np.full((2 * inner + 1, plan.dimensions), np.inf)
    held = {0: sample @ matrix}
    for node in range(inner):
        points = held.pop(node)
        dims[node] = np.argmax(points.std(0)) if len(points) else 0
        cuts[node] = np.median(points[:, dims[node]]) if len(points) else 0.0
        for child, side in ((2 * node + 1, points[:, dims[node]] <= cuts[node]), (2 * node + 2, points[:, dims[node]] > cuts[node])):
            held[child] = points[side]
            low[child], high[child] = low[node], high[node]
        high[2 * node + 1, dims[node]] = low[2 * node + 2, dims[node]] = cuts[node]
    return KdTree(matrix, dims[:inner], cuts[:inner], low[inner:], high[inner:])


def _search_block(points: pd.DataFrame, queries: pd.DataFrame, tree: KdTree, k: int, stop: float) -> pd.DataFrame:
    """The nearest of a block for each query, with the distance test as the end of the search."""
    rows: list[tuple] = []
    if len(points) and len(queries):
        ids = points["_id"].to_numpy()
        vectors = np.stack(points["_vec"].to_numpy()).astype(np.float64)
        projected = tree.project(vectors)
        for query, vector, bound in zip(queries["_query"], queries["_qvec"], queries["_bound"]):
            q = np.asarray(vector, np.float64)
            away = np.sqrt(((projected - tree.project(q)) ** 2).sum(1))
            near = np.flatnonzero(away <= bound * stop)
            near = near[np.argsort(away[near], kind="stable")]
            best: list[tuple[float, int]] = []
            limit = bound
            for at in range(0, len(near), 512):
                if away[near[at]] > limit * stop:
                    break
                part = near[at : at + 512]
                distance = np.sqrt(((vectors[part] - q) ** 2).sum(1))
                best += [(d, i) for d, i in zip(distance.tolist(), ids[part].tolist()) if i != query and d <= limit]
                best = sorted(best)[:k]
                if len(best) == k:
                    limit = min(limit, best[-1][0])
            rows += [(query, i, d) for d, i in best]
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(
    vectors: DataFrame, is_query, k: int = 10, plan: SearchPlan = SearchPlan(), *, key="vec_id", vector="embedding"
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the Euclidean distance.

    ``is_query`` is a condition on the rows. Rows without a key, and vectors that are NULL,
    zero, of another length than most, or hold a NULL or non-finite component take no part.
    Ties go to the smaller key. Rows of one key are one vector: of each key, one row counts.
    Fewer rows than k are all returned; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = finite & F.exists(v, lambda x: x != 0) & F.col(f"`{key}`").isNotNull()
    told = vectors.where(v.isNotNull() & usable).select(
        F.col(f"`{key}`").cast("long").alias("_id"),
        v.cast("array<double>").alias("_vec"),
        F.coalesce(is_query, F.lit(False)).alias("_is_query"),
    )
    lengths = told.groupBy(F.size("_vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id bigint, vec_id bigint, score double"
    if lengths is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dimension, rows = lengths["n"], lengths["count"]
    told = told.where(F.size("_vec") == dimension)
    sample = told.orderBy(F.xxhash64("_id"), "_id").limit(plan.sample).select("_vec").toPandas()
    tree = _tree(np.stack(sample["_vec"].to_numpy()), dimension, rows, plan)
    stop = math.sqrt(chi_square_quantile(plan.confidence, plan.dimensions))

    @F.pandas_udf("int")
    def leaf(v: pd.Series) -> pd.Series:
        return pd.Series(tree.leaf_of(tree.project(np.stack(v.to_numpy()))).astype(np.int32))

    indexed = written(told.withColumn("_leaf", leaf("_vec")), "ann-index")
    # Blocks of a leaf by a hash of the key; crowded leaves have many.
    crowds = indexed.groupBy("_leaf").agg(F.ceil(F.count(F.lit(1)) / plan.leaf_rows).cast("int").alias("_blocks"))
    points = indexed.join(crowds, "_leaf").select(
        "_leaf", F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int").alias("_block"), "_id", "_vec"
    )
    queries = indexed.where("_is_query").select(F.col("_id").alias("_query"), F.col("_vec").alias("_qvec"), "_leaf")
    queries = queries.dropDuplicates(["_query"])

    def names(side: str) -> list[str]:
        return [side + c for c in ("_leaf", "_block", "_chunk")]

    def renamed(side: str) -> list:
        return [F.col(c).alias(side + c) for c in ("_leaf", "_block", "_chunk")]

    def searched(routes: DataFrame) -> DataFrame:
        """Results of (query, leaf) routes with ``_bound``; both sides dealt by block and chunk."""
        load = routes.groupBy("_leaf").agg(F.ceil(F.count(F.lit(1)) / plan.query_chunk).cast("int").alias("_chunks"))
        asked = (
            routes.join(load, "_leaf").join(crowds, "_leaf")
            .withColumn("_chunk", F.pmod(F.xxhash64("_query"), F.col("_chunks")).cast("int"))
            .withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .select(*renamed("_q"), "_query", "_qvec", "_bound")
        )
        met = points.join(load, "_leaf").withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
        met = met.select(*renamed("_p"), "_id", "_vec")

        def search(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            return _search_block(p, q, tree, k, stop)

        return met.groupBy(*names("_p")).cogroup(asked.groupBy(*names("_q"))).applyInPandas(search, schema)

    own = written(_best(searched(queries.withColumn("_bound", F.lit(float("inf")))), k), "ann-own-leaf")
    bounds = own.where(F.col("rank") == k).select(F.col("query_id").alias("_query"), F.col("score").alias("_bound"))

    @F.pandas_udf("array<int>")
    def leaves_within(v: pd.Series, bound: pd.Series, home: pd.Series) -> pd.Series:
        out = []
        for q, b, h in zip(v, bound, home):
            gaps = tree.gaps(tree.project(np.asarray(q, np.float64)))
            out.append([int(i) for i in np.flatnonzero(gaps <= b * stop) if i != h])
        return pd.Series(out)

    further = (
        queries.join(bounds, "_query", "left")
        .withColumn("_bound", F.coalesce("_bound", F.lit(float("inf"))))
        .withColumn("_leaf", F.explode(leaves_within("_qvec", "_bound", "_leaf")))
    )
    both = own.drop("rank").unionByName(searched(further))
    return _best(both, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
