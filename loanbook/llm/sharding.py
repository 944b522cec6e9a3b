"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations.

Every shard owns ``vnodes`` points of a ring of ``cells`` positions. A row's key hashes to
a cell; the points cut the ring into arcs, and the next point clockwise names the row's
home. No shard takes more than its bound. Rows beyond it continue clockwise, first come
first served, to the first shard that still has room, so only the overflow moves.

What the walk needs is the number of rows per cell, whose size depends on ``cells`` and not
on the rows. Its outcome is a table of rank ranges, and a row finds its shard by its rank
within its cell. Cells are small, so a row meets a sort over ``rows / cells`` others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanbook.llm.common import written

VNODES = 64
CELLS = 1 << 16


def _long(value: int):
    return F.lit(value).cast("long")


def _arcs(spark, shards: int, vnodes: int, cells: int) -> DataFrame:
    """The points in ring order: arc, shard, and the cells lo..hi that lead to the point.

    The first arc starts beyond the last point; its lo is negative by that much.
    """
    # a shard's points don't depend on how many other shards there are
    shard = F.pmod("id", _long(shards))
    point = F.xxhash64(F.lit("point"), shard, F.floor(F.col("id") / shards))
    points = spark.range(shards * vnodes).select(
        shard.alias("shard"), F.pmod(point, _long(cells)).alias("hi")
    )
    ring = Window.orderBy("hi", "shard")
    before = F.lag("hi").over(ring)
    last = F.max("hi").over(Window.partitionBy())
    return points.select(
        F.row_number().over(ring).cast("long").alias("arc"),
        "shard",
        "hi",
        F.coalesce(before + 1, last + 1 - cells).alias("lo"),
    )


def _bounded_walk(arcs: DataFrame, shards: int) -> DataFrame:
    """Rank ranges of the arcs (arc, from, upto), each with its shard and first slot.

    ``arcs`` has arc, shard and load. The bounds sum up to the number of rows and differ by
    one at most, so in the end every shard is exactly full.
    """
    everything = F.sum("load").over(Window.partitionBy())
    bound = F.floor(everything / shards).cast("long")
    bound = bound + F.when(F.col("shard") < everything - bound * shards, 1).otherwise(0)
    of_shard = Window.partitionBy("shard").orderBy("arc")
    earlier = F.coalesce(F.sum("load").over(of_shard.rowsBetween(Window.unboundedPreceding, -1)), _long(0))
    home = (
        arcs.withColumn("bound", bound)
        .withColumn("stay", F.greatest(_long(0), F.least("load", F.col("bound") - earlier)))
        .withColumn("over", F.col("load") - F.col("stay"))
    )
    # The walk itself: two rounds of the ring over one row of fixed size.
    room = (
        home.groupBy("shard")
        .agg((F.max("bound") - F.sum("stay")).alias("room"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "room"))), lambda x: x["room"]).alias("room"))
    )
    lap = home.agg(F.array_sort(F.collect_list(F.struct("arc", "shard", "over"))).alias("lap"))
    start = "named_struct('room', room, 'waiting', 0L, 'took', CAST(array() AS array<bigint>))"
    taken = "least(s.waiting, element_at(s.room, CAST(x.shard AS int) + 1))"
    walk = f"""
        aggregate(
          concat(transform(lap, x -> struct(x.shard AS shard, x.over AS over)),
                 transform(lap, x -> struct(x.shard AS shard, 0L AS over))),
          {start},
          (s, x) -> named_struct(
            'room', transform(s.room, (r, i) -> IF(i = x.shard, r - {taken}, r)),
            'waiting', s.waiting - {taken} + x.over,
            'took', concat(s.took, array({taken}))))
    """
    steps = (
        room.join(lap)  # one row each
        .select("lap", F.expr(walk).alias("end"))
        .select(F.posexplode("end.took").alias("step", "took"), "lap")
        .select(
            "step",
            "took",
            F.expr("element_at(lap, CAST(step % size(lap) AS int) + 1).shard").alias("to_shard"),
        )
        .where("took > 0")
    )

    # First come first served: both sides are ranges over the same queue. Cut at every start.
    def queue(df, order, length):
        start = F.sum(length).over(Window.orderBy(order)) - F.col(length)
        return df.withColumn("at", start)

    out = queue(home.where("over > 0"), "arc", "over").select(
        "at", "arc", "stay", F.col("at").alias("arc_at"), F.lit(None).cast("long").alias("to_shard")
    )
    into = queue(steps, "step", "took").select(
        "at",
        F.lit(None).cast("long").alias("arc"),
        F.lit(None).cast("long").alias("stay"),
        F.lit(None).cast("long").alias("arc_at"),
        "to_shard",
    )
    cuts = out.unionByName(into).groupBy("at").agg(*[F.max(c).alias(c) for c in ("arc", "stay", "arc_at", "to_shard")])
    along = Window.orderBy("at")
    seen = along.rowsBetween(Window.unboundedPreceding, 0)
    total = home.agg(F.sum("over").alias("total_over"))
    moved = (
        cuts.select(
            "at",
            F.lead("at").over(along).alias("next_at"),
            *[F.last(c, ignorenulls=True).over(seen).alias(c) for c in ("arc", "stay", "arc_at", "to_shard")],
        )
        .join(total)  # one row
        .select(
            "arc",
            (F.col("stay") + F.col("at") - F.col("arc_at")).alias("from"),
            (F.col("stay") + F.coalesce("next_at", "total_over") - F.col("arc_at")).alias("upto"),
            F.col("to_shard").alias("shard"),
        )
    )
    stayed = home.where("stay > 0").select("arc", _long(0).alias("from"), F.col("stay").alias("upto"), "shard")
    length = F.col("upto") - F.col("from")
    in_shard = Window.partitionBy("shard").orderBy("arc", "from")
    return stayed.unionByName(moved).withColumn("first_slot", F.sum(length).over(in_shard) - length)


def ring_shards(
    rows: DataFrame, shards: int, *, vnodes: int = VNODES, cells: int = CELLS
) -> DataFrame:
    """Every row with its ``shard`` (0 to shards-1) and ``slot`` (0, 1, ... in the shard).

    The row itself is its key, so give the columns that identify it and no wide ones. The
    row counts of any two shards differ by one at most. Equal rows are counted before they
    move, so a row that repeats a third of the table costs one row per task. NULL is a value
    like others; an empty table gives an empty result. Reruns agree up to equal rows. The
    columns ``shard``, ``slot`` and names that begin with ``_ring`` are reserved.
    """
    spark, names = rows.sparkSession, rows.columns
    keys = [F.col(f"`{c}`") for c in names]
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ring_copies"))
    counted = counted.withColumn("_ring_cell", F.pmod(F.xxhash64(*keys), _long(cells)))

    arcs = _arcs(spark, shards, vnodes, cells)
    per_cell = counted.groupBy(F.col("_ring_cell").alias("cell")).agg(F.sum("_ring_copies").alias("n"))
    place = arcs.where("lo <= hi").select("arc", F.explode(F.sequence("lo", "hi")).alias("place"))
    ring = place.withColumn("cell", F.pmod("place", _long(cells))).join(per_cell, "cell")
    in_arc = Window.partitionBy("arc").orderBy("place")
    ring = ring.withColumn("first", F.sum("n").over(in_arc) - F.col("n"))
    # Tables of fixed size that are used several times are written once.
    ring = written(ring, "ring-cells")
    loads = ring.groupBy("arc").agg(F.sum("n").alias("load"))
    loaded = arcs.select("arc", "shard").join(loads, "arc", "left").na.fill(0, ["load"])
    ranges = written(_bounded_walk(written(loaded, "ring-arcs"), shards), "ring-ranges")

    begin = F.greatest("from", "first")
    end = F.least("upto", F.col("first") + F.col("n"))
    pieces = (
        ring.join(ranges, "arc")
        .where(begin < end)
        .select(
            F.col("cell").alias("_ring_cell"),
            (begin - F.col("first")).alias("_ring_from"),
            (end - F.col("first")).alias("_ring_upto"),
            "shard",
            (F.col("first_slot") + begin - F.col("from")).alias("slot"),
        )
    )
    ranked = Window.partitionBy("_ring_cell").orderBy(*keys)
    copies = F.col("_ring_copies")
    placed = counted.withColumn("_ring_rank", F.sum(copies).over(ranked.rowsBetween(Window.unboundedPreceding, 0)) - copies)
    begin = F.greatest("_ring_rank", "_ring_from")
    end = F.least(F.col("_ring_rank") + copies, F.col("_ring_upto"))
    met = placed.join(pieces, "_ring_cell").where(begin < end)
    first_slot = F.col("slot") + begin - F.col("_ring_from")
    slots = F.explode(F.sequence(first_slot, first_slot + (end - begin) - 1))
    return met.select(*keys, F.col("shard").cast("int").alias("shard"), slots.alias("slot"))
