"""Mixing sources to target weights: blocks, multinomial draws, index permutations.

The words of a source, its documents in an order of their own, are cut into blocks of fixed
length. A source's target is a number of slots, and multinomial draws say how many of them
fall on each output shard; with the totals given the draws of the sources are independent.
The slots count on over the shards; slot j reads the block at place ``j mod blocks`` of a
pseudorandom permutation of the source's blocks, another one for each round. Slots and
blocks meet by source and index.

Sources are the only thing counted as a whole. Offsets within a source come from sums over
fixed buckets and then within a bucket, so a source may hold most of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook.llm.common import NOT_SPACE, SPACE, words, written

BUCKETS = 4096


@dataclass(frozen=True)
class MixPlan:
    """Weights repeat over the sources in code-point order, NULL last."""

    weights: tuple[int, ...] = (5, 2, 1)
    most_repeats: int = 3
    block: int = 64
    shards: int = 256
    run: int = 4096
    #: slots that one task draws
    task_slots: int = 500_000
    seed: int = 1
    #: sources up to here are broadcast, some 40 bytes each
    broadcast_sources: int = 100_000


def source_targets(sizes: DataFrame, plan: MixPlan) -> DataFrame:
    """``source``, ``source_size``, ``target``: weighted shares, none above its bound.

    ``sizes`` has source and source_size. A target stops at ``most_repeats`` times its size
    and the excess is shared again by weight. With the sources ordered by bound per weight,
    those before some place stop and all others get the same amount per weight, which is
    found in one pass. The window runs over one row per source.
    """
    ordered = Window.orderBy(F.col("source").isNull(), F.col("source"))
    nth = F.row_number().over(ordered) - 1
    weights = F.array(*[F.lit(float(w)) for w in plan.weights])
    bounded = sizes.withColumn("weight", F.get(weights, nth % len(plan.weights))).withColumn(
        "bound", F.col("source_size") * F.lit(float(plan.most_repeats))
    )
    filling = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("bound").over(earlier), F.lit(0.0))
    weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    level = bounded.withColumn("level", left / weight)
    # the level rises with every source that stops and falls beyond, so the highest is right
    share = F.least("bound", F.max("level").over(whole) * F.col("weight"))
    return level.select("source", "source_size", share.alias("target"))


def permutation(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1 for each key, at the given indexes.

    A Feistel network over the least even power of two of at least ``size``, walked on while
    it leads outside; at most three quarters of the places are outside.
    """
    half = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64).copy()
    todo = np.ones(len(out), bool)
    while todo.any():
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = x >> h, x & m
        for r in range(4):
            mixed = (right + k + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            left, right = right, left ^ (mixed & m)
        out[todo] = (left << h) | right
        todo = out >= size.astype(np.uint64)
    return out.astype(np.int64)


def _size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def _slots(sources: DataFrame, plan: MixPlan) -> DataFrame:
    """``source``, ``shard``, ``block``: one row per slot of the mix.

    A source's slots fall on the output shards in one multinomial draw of its own seed, so
    its total is its target's and the draws of sources are independent of each other.
    """
    kind = dict(sources.dtypes)["source"]
    seed, shards = plan.seed, plan.shards

    def draw(batches):
        for batch in batches:
            rows = []
            for source, blocks, slots, key in zip(batch["source"], batch["blocks"], batch["slots"], batch["key"]):
                rng = np.random.default_rng([seed, int(key) & (2**63 - 1)])
                counts = rng.multinomial(int(slots), np.full(shards, 1 / shards))
                first = np.cumsum(counts) - counts
                rows.append(pd.DataFrame({"source": source, "blocks": blocks, "key": key, "shard": np.arange(shards), "first": first, "n": counts}))
            yield pd.concat(rows) if rows else pd.DataFrame(columns="source blocks key shard first n".split())

    drawn = sources.select("source", "blocks", "slots", F.xxhash64("source").alias("key")).mapInPandas(
        draw, f"source {kind}, blocks bigint, key bigint, shard int, first bigint, n bigint"
    )
    # Slots in runs first, so that no row becomes an array of all of a shard's slots.
    run = F.explode(F.sequence("first", F.col("first") + F.col("n") - 1, F.lit(plan.run)))
    runs = drawn.where("n > 0").withColumn("end", F.col("first") + F.col("n")).withColumn("from", run)
    each = F.explode(F.sequence("from", F.least(F.col("from") + plan.run, "end") - 1))
    total = sources.agg(F.sum("slots")).first()[0] or 0
    tasks = max(1, min(100_000, total // plan.task_slots))
    slots = runs.repartition(tasks, "source", "shard", "from").withColumn("slot", each)

    @F.pandas_udf("bigint")
    def block_of(slot: pd.Series, blocks: pd.Series, key: pd.Series) -> pd.Series:
        slot, size = slot.to_numpy(), blocks.to_numpy()
        rounds = (slot // size).astype(np.uint64)
        keys = key.to_numpy().view(np.uint64) + rounds * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed)
        return pd.Series(permutation(slot % size, size, keys))

    return slots.select("source", "shard", block_of("slot", "blocks", "key").alias("block"))


def mix_plan(docs: DataFrame, plan: MixPlan = MixPlan(), *, key="doc_id", source="source", text="text"):
    """Positions of the documents, the sources with their targets, and the uses of blocks.

    Returns three DataFrames: documents (``_key source size thash at``), sources (``source
    source_size target blocks slots``), uses (``source block uses``).
    """
    sized = docs.select(
        F.col(f"`{key}`").alias("_key"),
        F.col(f"`{source}`").alias("source"),
        _size_of(F.col(f"`{text}`")).alias("size"),
        F.xxhash64(F.col(f"`{text}`")).alias("thash"),
    ).withColumn("bucket", F.pmod(F.xxhash64("_key", "thash"), F.lit(BUCKETS).cast("long")))
    sized = written(sized, "mix-sizes")

    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    blocks = F.ceil(F.col("source_size") / plan.block).cast("long")
    sources = source_targets(totals, plan).withColumn("blocks", blocks)
    slots = F.round(F.col("target") * F.col("blocks") / F.greatest("source_size", F.lit(1).cast("long")))
    sources = written(sources.withColumn("slots", slots.cast("long")), "mix-sources")

    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = sized.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    starts = per_bucket.select(
        F.col("source").alias("_s"), F.col("bucket").alias("_b"), F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("start")
    )
    within = Window.partitionBy("source", "bucket").orderBy("_key", "size", "thash")
    placed = sized.withColumn("in_bucket", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    met = F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b"))
    placed = placed.join(starts, met).select("_key", "source", "size", "thash", (F.col("start") + F.col("in_bucket")).alias("at"))

    uses = _slots(sources.where("slots > 0"), plan).groupBy("source", "block").agg(F.count(F.lit(1)).alias("uses"))
    return placed, sources, uses


def _pieces(placed: DataFrame, uses: DataFrame, plan: MixPlan) -> DataFrame:
    """Documents cut at the blocks' bounds: ``first`` word, ``n`` words and the uses of each."""
    length = plan.block
    ends = F.col("at") + F.col("size")
    blocks = F.explode(F.sequence(F.floor(F.col("at") / length), F.floor((ends - 1) / length)))
    cut = placed.where("size > 0").withColumn("block", blocks)
    low = F.greatest("at", F.col("block") * length)
    high = F.least(ends, (F.col("block") + 1) * length)
    cut = cut.withColumn("first", low - F.col("at")).withColumn("n", high - low)
    uses = uses.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "uses")
    met = cut["source"].eqNullSafe(uses["_s"]) & (cut["block"] == uses["_b"])
    # Spark takes the slots for a few rows, since they grow out of the table of sources
    return cut.join(uses.hint("merge"), met, "left").drop("_s", "_b").na.fill(0, ["uses"])


def mix_shares(docs: DataFrame, plan: MixPlan = MixPlan(), *, key="doc_id", source="source", text="text") -> DataFrame:
    """Per document: key, ``size``, ``source_size``, ``target`` and ``taken`` words.

    NULL and empty texts have no words and give none; a NULL source is a source of its own,
    the last. Repeated rows are documents of their own. A source's taken words differ from
    its target by less than a block and a half for each round. An empty table gives an empty
    result; other columns are left out.
    """
    placed, sources, uses = mix_plan(docs, plan, key=key, source=source, text=text)
    taken = (
        _pieces(placed, uses, plan)
        .groupBy("_key", "source", "size", "thash", "at")
        .agg(F.sum(F.col("n") * F.col("uses")).alias("taken"))
        .select("_key", "source", "size", "taken")
    )
    empty = placed.where("size = 0").select("_key", "source", "size", F.lit(0).cast("long").alias("taken"))
    told = sources.select(F.col("source").alias("_s"), "source_size", "target")
    told = F.broadcast(told) if sources.count() <= plan.broadcast_sources else told
    whole = taken.unionByName(empty)
    return whole.join(told, whole["source"].eqNullSafe(told["_s"])).select(
        F.col("_key").alias(key), "size", "source_size", "target", "taken"
    )


def mix_documents(docs: DataFrame, plan: MixPlan = MixPlan(), *, key="doc_id", source="source", text="text") -> DataFrame:
    """The mix as documents: all columns, the text being what the mix takes of it.

    A document appears once for each round that takes words of it, at most
    ``most_repeats`` times. Where a round takes all of its blocks, its text is unchanged;
    otherwise the blocks' words follow each other with the white space before them.
    """
    placed, _, uses = mix_plan(docs, plan, key=key, source=source, text=text)
    rounds = F.explode(F.sequence(F.lit(1).cast("long"), F.col("uses"))).alias("_round")
    parts = _pieces(placed, uses, plan).where("uses > 0").select("_key", "source", "thash", "at", "first", "n", rounds)
    parts = parts.groupBy("_key", "source", "thash", "at", "_round").agg(
        F.array_sort(F.collect_list(F.struct("first", "n"))).alias("_parts"), F.sum("n").alias("_n")
    )
    # Equal rows are told apart by their place, the nth of them meets the nth.
    same = ["_key", "source", "thash"]
    nth = F.dense_rank().over(Window.partitionBy(*same).orderBy("at"))
    parts = parts.select(*[F.col(c).alias(f"_p{c}") for c in same], nth.alias("_nth"), "_parts", "_n")
    names = docs.columns
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"),
        F.col(f"`{key}`").alias("_key"),
        F.col(f"`{source}`").alias("source"),
        F.xxhash64(F.col(f"`{text}`")).alias("thash"),
    )
    marked = marked.withColumn("_m", F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(1))))
    met = (F.col("_m") == F.col("_nth")) & F.lit(True)
    for c in same:
        met = met & F.col(c).eqNullSafe(F.col(f"_p{c}"))
    joined = marked.join(parts, met)
    whole = F.col("_doc").getField(text)
    spaced = F.regexp_extract_all(whole, F.lit(f"{SPACE}*{NOT_SPACE}+"), F.lit(0))
    joined = joined.withColumn("_w", spaced)
    taken = F.concat_ws("", F.flatten(F.transform("_parts", lambda p: F.slice("_w", (p["first"] + 1).cast("int"), p["n"].cast("int")))))
    new = F.when(F.col("_n") == F.size("_w"), whole).otherwise(taken)
    return joined.select(*[new.alias(c) if c == text else F.col("_doc").getField(c).alias(c) for c in names])
