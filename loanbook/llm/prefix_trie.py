"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns. Its name is its smallest conversation and its
depth: a conversation has one node per depth. Sequences are told apart by sums of three hashes
of (place, role, text), 93 bits in all; a sum over places can be taken in pieces, so the turns
of one conversation may lie in many tasks. Sorting every node with its children gives each arc
of the tour its successor; ranking that list (``euler_tour``) gives prefix sums, and what a
subtree holds is the difference between a node's exit and its entry.

Nothing gathers a conversation, a node's members or its children in one task: turns and
children are ranked in range partitions, whose borders are put right by one row per partition.
The digest of a node's ends alone must be taken in order; ids are joined to passages first,
in sorted partitions, and the digest is updated with passages as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook.llm.common import written
from loanbook.llm.euler_tour import BLOCK, prefix_sums

#: Characters of joined ids in one passage.
PASSAGE = 4_096
KEY = ("depth", "k1", "k2", "k3")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the partition and the place in it among the rows of equal conv_id, which come sorted."""
    part, last, held = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        begins = np.ones(len(conv), bool)
        begins[1:] = conv[1:] != conv[:-1]
        begins[0] = conv[0] != last
        rows = np.arange(len(conv))
        at = rows - np.maximum.accumulate(np.where(begins, rows, -held))
        last, held = conv[-1], int(at[-1]) + 1
        columns = [*batch.columns, pa.array(np.full(len(conv), part, np.int32)), pa.array(at)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "at"])


def ordered_turns(turns: DataFrame) -> DataFrame:
    """Turns as conv_id, d1, d2 (hashes), n_bytes, part, at (the place in the conversation's part).

    NULL role or text is empty, a NULL turn comes first; equal turns are ordered by role, the
    text's first 64 characters and its hash. Rows without conv_id belong to no conversation
    and are left out.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    hashed = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.substring(text, 1, 64).alias("opening"),
        F.xxhash64(F.lit(1), role, text).alias("d1"),
        F.xxhash64(F.lit(2), role, text).alias("d2"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.monotonically_increasing_id().alias("n"),  # cuts many equal rows into several parts
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), *map(F.col, ("role", "opening", "d1", "d2", "n"))]
    dealt = hashed.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = dealt.select("conv_id", "d1", "d2", "n_bytes")
    return kept.mapInArrow(_runs, "conv_id bigint, d1 bigint, d2 bigint, n_bytes bigint, part int, at bigint")


def _hash31(i: int) -> Column:
    """A hash of 31 bits of a turn and its place, so that sums of 2^32 turns fit a long."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(10 + i), F.col("pos"), "d1", "d2"), 33)


def shared_openings(turns: DataFrame, family: int, lent: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their family, and the places of their turns.

    Families are ``family`` consecutive ids from a multiple of it. Conversation c becomes the
    first ``lent(c)`` turns of its family's first one (all, if it has fewer; none, if it is not
    there) and its own turns after as many; both numbers are small. Returns paths (conv_id,
    depth, k1, k2, k3: the sums of hashes up to a turn; r1, r2, r3: its own; n_bytes) and convs
    (conv_id, length).
    """
    ordered = written(ordered_turns(turns), "trie-turns")
    spans = ordered.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    # A conversation has a row per partition it lies in, a family as many conversations.
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "conv_id",
        "part",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("n_turns"),
    )
    spans = written(spans, "trie-spans")
    first = F.col("conv_id") - F.col("conv_id") % family
    members = spans.where("before = 0").select("conv_id", "n_turns", lent(F.col("conv_id")).alias("h"))
    families = members.groupBy(first.alias("first")).agg(
        F.max(F.when(F.col("conv_id") == first, F.col("n_turns"))).alias("lends"),
        F.collect_list(F.struct("conv_id", "n_turns", "h")).alias("takers"),
    )
    lead = F.least("t.h", F.coalesce("lends", F.lit(0)))
    convs = families.select("first", "takers", "lends", F.explode("takers").alias("t")).select(
        F.col("t.conv_id").alias("conv_id"),
        F.col("t.h").alias("h"),
        lead.alias("lead"),
        (lead + F.greatest(F.lit(0), F.col("t.n_turns") - F.col("t.h"))).alias("length"),
        F.when(F.col("t.conv_id") == F.col("first"), F.col("takers")).alias("takers"),
    )
    convs = written(convs, "trie-convs")

    placed = ordered.join(spans.drop("n_turns").join(convs, "conv_id"), ["conv_id", "part"])
    at = F.col("before") + F.col("at")
    own = F.struct(F.col("conv_id").alias("c"), F.col("part").alias("span"), (at - F.col("h") + F.col("lead")).alias("pos"))
    lends = F.transform(
        F.filter("takers", lambda t: t["h"] > at),
        lambda t: F.struct(t["conv_id"].alias("c"), F.lit(-1).alias("span"), at.alias("pos")),
    )
    # A turn keeps its place, and those that are lent stand in the other conversations as well.
    turned = placed.withColumn("own", F.when(at >= F.col("h"), F.array(own))).withColumn("lends", lends)
    uses = F.flatten(F.array_compact(F.array("own", "lends")))
    steps = turned.select("d1", "d2", "n_bytes", F.inline(uses))
    steps = steps.select("c", "span", "pos", "n_bytes", *[_hash31(i).alias(f"r{i}") for i in (1, 2, 3)])
    inside = Window.partitionBy("c", "span").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    steps = written(steps.withColumns({f"k{i}": F.sum(f"r{i}").over(inside) for i in (1, 2, 3)}), "trie-steps")
    # The sums of a conversation's earlier spans, a row per partition it lies in.
    ends = steps.groupBy("c", "span").agg(*[F.max_by(f"k{i}", "pos").alias(f"e{i}") for i in (1, 2, 3)])
    sooner = Window.partitionBy("c").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "c", "span", *[F.coalesce(F.sum(f"e{i}").over(sooner), F.lit(0)).alias(f"e{i}") for i in (1, 2, 3)]
    )
    paths = steps.join(carried, ["c", "span"]).select(
        F.col("c").alias("conv_id"),
        (F.col("pos") + 1).alias("depth"),
        *[(F.col(f"k{i}") + F.col(f"e{i}")).alias(f"k{i}") for i in (1, 2, 3)],
        *[f"r{i}" for i in (1, 2, 3)],
        "n_bytes",
    )
    return paths, convs.select("conv_id", "length")


def trie_nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: key, conv_id, n_convs, n_bytes, and its parent's sums (q1, q2, q3)."""
    zero = F.lit(0).cast("bigint")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        *[zero.alias(c) for c in KEY],
        "conv_id",
        "n_convs",
        zero.alias("n_bytes"),
        *[zero.alias(f"q{i}") for i in (1, 2, 3)],
    )
    nodes = paths.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("n_bytes").alias("n_bytes"),
        *[F.min(f"r{i}").alias(f"r{i}") for i in (1, 2, 3)],
    )
    above = [(F.col(f"k{i}") - F.col(f"r{i}")).alias(f"q{i}") for i in (1, 2, 3)]
    return root.unionByName(nodes.select(*KEY, "conv_id", "n_convs", "n_bytes", *above))


LINKED = (
    "part int, seq bigint, depth bigint, child boolean, m bigint, saved bigint, "
    "nxt bigint, parent bigint, last boolean"
)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, child, m, saved), each node before its children: the next row where it is a
    child of the same node, and the node that a child was seen after.

    The row that ends a partition is marked, since what follows it is elsewhere; a child whose
    node is in an earlier partition has a NULL parent.
    """
    part, seq, held, node = TaskContext.get().partitionId(), 0, None, None
    names = [f.split()[0] for f in LINKED.split(", ")]

    def linked(rows: pa.RecordBatch, follows: tuple | None) -> pa.RecordBatch:
        nonlocal seq, node
        depth, child, m, saved = (rows.column(c).to_numpy(zero_copy_only=False) for c in range(4))
        nxt, is_child = np.append(m[1:], 0), np.append(child[1:], False)
        if follows is not None:
            is_child[-1], nxt[-1] = follows
        index = np.arange(len(m))
        seen = np.maximum.accumulate(np.where(child, -1, index))
        parent = np.where(seen >= 0, m[seen], 0 if node is None else node)
        unknown = ~child | ((seen < 0) & (node is None))
        if seen[-1] >= 0:
            node = int(m[seen[-1]])
        last = np.zeros(len(m), bool)
        last[-1] = follows is None
        columns = [
            pa.array(np.full(len(m), part, np.int32)),
            pa.array(index + seq),
            *[rows.column(c) for c in range(4)],
            pa.array(nxt, mask=~is_child),
            pa.array(parent, mask=unknown),
            pa.array(last),
        ]
        seq += len(m)
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield linked(held, (batch.column(1)[0].as_py(), batch.column(2)[0].as_py()))
            held = batch
    if held is not None:
        yield linked(held, None)


def tour_arcs(nodes: DataFrame) -> DataFrame:
    """The Euler tour as a list: arcs (conv_id, 2 * depth) in, (conv_id, 2 * depth + 1) out.

    A node's children come in the order of their conv_id. The weights are 1 for each arc, and
    for the arc into a node whether it is childless, and what its text saves. The arc out of a
    node carries its parent.
    """
    headers = nodes.select(
        *KEY,
        F.lit(False).alias("child"),
        F.col("conv_id").alias("m"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
    )
    children = nodes.where("depth > 0").select(
        (F.col("depth") - 1).alias("depth"),
        *[F.col(f"q{i}").alias(f"k{i}") for i in (1, 2, 3)],
        F.lit(True).alias("child"),
        F.col("conv_id").alias("m"),
        F.lit(0).cast("bigint").alias("saved"),
    )
    order = [*KEY, "child", "m"]
    dealt = headers.unionByName(children).repartitionByRange(*order).sortWithinPartitions(*order)
    linked = written(dealt.select("depth", "child", "m", "saved").mapInArrow(_links, LINKED), "trie-links")
    # Borders: what the next partition begins with, and the last node of those before. One row
    # per partition, so the window holds, and the broadcast sends, as many rows as partitions.
    borders = linked.groupBy("part").agg(
        F.min_by(F.struct("child", "m"), "seq").alias("begins"),
        F.max_by("m", F.when(~F.col("child"), F.col("seq"))).alias("node"),
    )
    parts = Window.orderBy("part")
    borders = borders.select(
        "part",
        F.lead("begins").over(parts).alias("follows"),
        F.last("node", ignorenulls=True).over(parts.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"),
    )
    rows = linked.join(F.broadcast(borders), "part")
    after_last = F.when(F.col("last") & F.col("follows.child"), F.col("follows.m"))
    rows = rows.withColumns({"nxt": F.coalesce("nxt", after_last), "parent": F.coalesce("parent", "carried")})
    into, out = 2 * F.col("depth"), 2 * F.col("depth") + 1
    child, nxt = F.col("child"), F.col("nxt")
    one, zero, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    arcs = rows.select(
        F.col("m").alias("a"),
        F.when(child, out + 2).otherwise(into).alias("b"),
        F.coalesce(nxt, F.when(child, F.col("parent")).otherwise(F.col("m"))).alias("na"),
        F.when(nxt.isNotNull(), into + 2).otherwise(out).alias("nb"),
        one.alias("w1"),
        (~child & nxt.isNull()).cast("bigint").alias("w2"),
        F.when(child, zero).otherwise(F.col("saved")).alias("w3"),
        F.when(child, F.col("parent")).alias("parent"),
    )
    end = nodes.where("depth = 0").select(
        F.col("conv_id").alias("a"),
        one.alias("b"),
        none.alias("na"),
        none.alias("nb"),
        one.alias("w1"),
        zero.alias("w2"),
        zero.alias("w3"),
        none.alias("parent"),
    )
    return arcs.unionByName(end)


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to joined ids, in passages of ``PASSAGE`` characters or little more."""
    part, number, key, ids, size = TaskContext.get().partitionId(), 0, None, [], 0
    out: list[tuple] = []

    def close():
        nonlocal number, ids, size
        if ids:
            out.append((*key, part, number, ",".join(ids)))
            number, ids, size = number + 1, [], 0

    def rows() -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 4, pa.int32(), pa.int64(), pa.string()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, names=[*KEY, "part", "number", "passage"])

    for batch in batches:
        for *of, conv in zip(*[c.to_pylist() for c in batch.columns]):
            if of != key or size >= PASSAGE:
                close()
                key = of
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if len(out) >= 1_000:
            yield rows()
    close()
    if out:
        yield rows()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted passages to one SHA-256 per key; the state is all that is held."""
    key, state = None, None
    done: list[tuple] = []

    def rows() -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 4, pa.string()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*done), kinds)]
        done.clear()
        return pa.RecordBatch.from_arrays(arrays, names=[*KEY, "ends_sha256"])

    for batch in batches:
        for *of, passage in zip(*[c.to_pylist() for c in batch.columns]):
            if of == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = of, hashlib.sha256()
            state.update(passage.encode())
        if len(done) >= 1_000:
            yield rows()
    if key is not None:
        done.append((*key, state.hexdigest()))
    if done:
        yield rows()


def end_digests(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """Per node where conversations end: SHA-256 of their ids, ascending and joined by commas."""
    zero = F.lit(0).cast("bigint")
    turnless = convs.where("length = 0").select(*[zero.alias(c) for c in KEY], "conv_id")
    lengths = convs.where("length > 0").select("conv_id", F.col("length").alias("depth"))
    ends = paths.select(*KEY, "conv_id").join(lengths, ["conv_id", "depth"]).select(*KEY, "conv_id")
    ends = written(ends.unionByName(turnless), "trie-ends")
    order = [*KEY, "conv_id"]
    dealt = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    keys = "depth bigint, k1 bigint, k2 bigint, k3 bigint"
    passages = dealt.select(*order).mapInArrow(_passages, f"{keys}, part int, number bigint, passage string")
    in_order = passages.repartition(*KEY).sortWithinPartitions(*KEY, "part", "number")
    return in_order.select(*KEY, "passage").mapInArrow(_digests, f"{keys}, ends_sha256 string")


def prefix_trie(
    turns: DataFrame, family: int, lent: Callable[[Column], Column], *, block_rows: int = BLOCK
) -> DataFrame:
    """All nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, enter and leave (the places of the node's arcs in the tour).

    ``turns`` has conv_id, turn, role, text; other columns are left out. See ``ordered_turns``
    for NULLs, ties and repeated rows and ``shared_openings`` for ``family`` and ``lent``. A
    conversation whose turns are all given up is a member of the root alone. Without turns
    there is no node.
    """
    paths, convs = shared_openings(turns, family, lent)
    paths = written(paths, "trie-paths")
    nodes = written(trie_nodes(paths, convs), "trie-nodes")
    arcs = written(tour_arcs(nodes), "trie-arcs")
    placed = prefix_sums(arcs.drop("parent"), block_rows)
    out = F.col("b") % 2 == 1
    depth = F.floor(F.col("b") / 2).cast("bigint")
    sums = placed.groupBy(F.col("a").alias("conv_id"), depth.alias("depth")).agg(
        *[
            F.max(F.when(at, F.col(f"p{i}"))).alias(f"{side}{i}")
            for at, side in ((~out, "in"), (out, "out"))
            for i in (1, 2, 3)
        ]
    )
    parents = arcs.where(out).select(F.col("a").alias("conv_id"), depth.alias("depth"), "parent")
    above = [F.col(f"q{i}").alias(f"k{i}") for i in (1, 2, 3)]
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *above)
    kids = kids.agg(F.count("*").alias("n_children"))
    named = nodes.join(kids, list(KEY), "left").join(end_digests(paths, convs), list(KEY), "left")
    return (
        named.join(sums, ["conv_id", "depth"])
        .join(parents, ["conv_id", "depth"])
        .select(
            "conv_id",
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            (F.col("out2") - F.col("in2")).alias("n_leaves"),
            (F.col("out3") - F.col("in3")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
            F.col("in1").alias("enter"),
            F.col("out1").alias("leave"),
        )
    )
