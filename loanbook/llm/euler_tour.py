"""List ranking of a tree's Euler tour, as Spark jobs.

The tour is a linked list of arcs, each with three weights. A round shortens the list: tasks
take blocks of neighbouring arcs, follow the links inside a block, and put one arc in place of
each chain found, with the chain's sums. Where blocks hold few neighbours, a round of coin
tosses lets arcs swallow their successors instead, which removes a quarter of any list on
average. The last round has one chain; going back, an arc's prefix sums are its chain's and
its own place in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import written

#: Arcs that a task follows together, and the bound of the last round's only block.
BLOCK = 1 << 18

WEIGHTS = ("w1", "w2", "w3")
#: An arc is (a, b), its successor (na, nb) or NULL at the list's end.
LIST = ("a", "b", "na", "nb", *WEIGHTS)
CHAINED = (
    "a bigint, b bigint, ha bigint, hb bigint, o1 bigint, o2 bigint, o3 bigint, "
    "na bigint, nb bigint, w1 bigint, w2 bigint, w3 bigint, last boolean"
)


def _successors(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Row of each arc's successor in a block sorted by (a, b), -1 where it is not in it."""
    names = np.unique(a)
    wide = np.int64(max(b.max(), nb.max()) + 1)
    keys = np.searchsorted(names, a) * wide + b
    at = np.searchsorted(names, na)
    known = there & (at < len(names))
    known[known] = names[at[known]] == na[known]
    wanted = np.where(known, at * wide + nb, -1)
    found = np.searchsorted(keys, wanted)
    hit = known & (found < len(keys))
    hit[hit] = keys[found[hit]] == wanted[hit]
    return np.where(hit, found, -1)


def _chain(block: pa.Table) -> pa.RecordBatch:
    """Every arc of a block with its chain's first arc and the sums before it in the chain."""
    a, b = (block[c].to_numpy() for c in "ab")
    there = np.asarray(block["na"].is_valid())
    na, nb = (block[c].fill_null(0).to_numpy() for c in ("na", "nb"))
    weights = np.stack([block[c].to_numpy() for c in WEIGHTS], axis=1)
    nxt = _successors(a, b, na, nb, there)
    rows = np.arange(len(a))
    inside = nxt >= 0
    head, before = rows.copy(), np.zeros_like(weights)
    head[nxt[inside]] = rows[inside]
    before[nxt[inside]] = weights[inside]
    for _ in range(len(a).bit_length()):  # halves the way to the chain's first arc each time
        before += before[head]
        head = head[head]
    last = ~inside
    sums = before + weights
    ended = ~(last & there)
    columns = [a, b, a[head], b[head], *before.T]
    arrays = [pa.array(np.ascontiguousarray(c)) for c in columns]
    arrays += [pa.array(na, mask=ended), pa.array(nb, mask=ended)]
    arrays += [pa.array(np.ascontiguousarray(c)) for c in sums.T] + [pa.array(last)]
    return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in CHAINED.split(", ")])


def _chains(block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, block_rows - size)
                held.append(taken)
                size += taken.num_rows
                batch = batch.slice(taken.num_rows)
                if size == block_rows:
                    yield _chain(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield _chain(pa.Table.from_batches(held))

    return run


def _by_blocks(arcs: DataFrame, alone: bool, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Members with their chain and the shorter list; ``alone``: in one block."""
    dealt = arcs.coalesce(1) if alone else arcs.repartitionByRange("a", "b")
    sorted_arcs = dealt.sortWithinPartitions("a", "b").select(*LIST)
    chained = written(sorted_arcs.mapInArrow(_chains(block_rows), CHAINED), "tour-blocks")
    ends = chained.where("last").select(F.col("ha").alias("a"), F.col("hb").alias("b"), "na", "nb", *WEIGHTS)
    return chained.select("a", "b", "ha", "hb", "o1", "o2", "o3"), ends


def _by_coins(arcs: DataFrame, toss: int) -> tuple[DataFrame, DataFrame]:
    """Members and the shorter list, where an arc with heads swallows a successor with tails."""

    def heads(*arc: str) -> Column:
        return F.xxhash64(F.lit(toss), *arc) % 2 == 0

    takers = arcs.where(heads("a", "b")).select("a", "b", "na", "nb", *[F.col(w).alias(f"t{w}") for w in WEIGHTS])
    taken = arcs.where(~heads("a", "b")).select(
        F.col("a").alias("na"), F.col("b").alias("nb"), F.col("na").alias("nna"), F.col("nb").alias("nnb"), *WEIGHTS
    )
    pairs = written(takers.join(taken, ["na", "nb"]), "tour-coins")
    gone = pairs.select(F.col("na").alias("a"), F.col("nb").alias("b"), F.col("a").alias("ha"), F.col("b").alias("hb"),
                        *[F.col(f"t{w}").alias(f"o{w[1]}") for w in WEIGHTS])
    stays = arcs.join(gone.select("a", "b"), ["a", "b"], "left_anti")
    longer = pairs.select(
        "a", "b", F.lit(True).alias("longer"), "nna", "nnb", *[F.col(w).alias(f"p{w}") for w in WEIGHTS]
    )
    shorter = stays.join(longer, ["a", "b"], "left").select(
        "a",
        "b",
        *[F.when(F.col("longer"), F.col(f"n{n}")).otherwise(F.col(n)).alias(n) for n in ("na", "nb")],
        *[(F.col(w) + F.coalesce(f"p{w}", F.lit(0))).alias(w) for w in WEIGHTS],
    )
    shorter = written(shorter, "tour-list")
    none = [F.lit(0).cast("bigint").alias(f"o{i}") for i in (1, 2, 3)]
    kept = shorter.select("a", "b", F.col("a").alias("ha"), F.col("b").alias("hb"), *none)
    return kept.unionByName(gone), shorter


def prefix_sums(arcs: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """``a, b, p1, p2, p3``: for every arc, the sums of the weights of all arcs before it.

    ``arcs`` holds one list: a, b, na, nb (the successor; NULL at the end), w1, w2, w3. An
    empty list gives an empty result. Rounds end when one chain is left; their number grows
    with the logarithm of the list, and a round's work with the list that is left.
    """
    levels, left = [], arcs.count()
    shrinks = True
    while True:
        if left <= block_rows or shrinks:
            members, shorter = _by_blocks(arcs, left <= block_rows, block_rows)
        else:
            members, shorter = _by_coins(arcs, len(levels))
        levels.append(members)
        rest = shorter.count()
        if rest <= 1:
            break
        # Blocks are tried again after each round of coins; they mostly shrink the list more.
        shrinks = not shrinks or 2 * rest <= left
        arcs, left = shorter, rest
    found = levels[-1].select("a", "b", F.col("o1").alias("p1"), F.col("o2").alias("p2"), F.col("o3").alias("p3"))
    for members in reversed(levels[:-1]):
        above = found.select(F.col("a").alias("ha"), F.col("b").alias("hb"), "p1", "p2", "p3")
        found = members.join(above, ["ha", "hb"]).select(
            "a", "b", *[(F.col(f"p{i}") + F.col(f"o{i}")).alias(f"p{i}") for i in (1, 2, 3)]
        )
    return found
