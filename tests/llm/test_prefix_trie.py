"""The conversation trie against brute force; list ranking with small blocks and coins."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loanbook.llm.euler_tour import prefix_sums
from loanbook.llm.prefix_trie import ordered_turns, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, part int, a bigint"


def lent(conv):
    return F.crc32(conv.cast("string").cast("binary")) % 9


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(list)
    for node in members:
        if node:
            below[node[:-1]].append(node)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        convs, kids = members[node], [out[k] for k in below[node]]
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        out[node] = (
            min(convs),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(convs),
            len(kids),
            sum(k[5] for k in kids) or 1,
            (len(convs) - 1) * len(node[-1][1].encode() if node else b"") + sum(k[6] for k in kids),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return sorted(out.values())


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, 9) for r in rows], SCHEMA)


def trie(spark, rows, parts=3, **options):
    found = prefix_trie(table(spark, rows).repartition(parts), 5, lent, **options).collect()
    return sorted(tuple(r)[:2] + (r["parent_conv_id"],) + tuple(r)[3:8] for r in found)


def talks(rng, n, words=3):
    rows = []
    for c in range(n):
        if rng.random() < 0.9:
            rows += [(c, t, rng.choice(["user", "bot"]), rng.choice("abcé"[:words])) for t in range(rng.randrange(1, 12))]
    return rows


@pytest.mark.parametrize("block_rows", [4, 1 << 18])
def test_equals_brute_force(spark, block_rows):
    rows = talks(random.Random(block_rows), 120)
    assert trie(spark, rows, block_rows=block_rows) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, 1, "user", "nobody's"), (0, None, "user", "first"), (0, 1, None, None), (0, 2, "bot", "x" * 5000), (0, 2, "a", "tie"),
        (0, 2, "a", "tie"), (1, 1, "", ""), (3, 7, "user", "first"), (2**40, 0, "user", "é"), (2**40 + 1, 5, "user", "far"),
        (17, 0, "user", "one turn, given up"), (18, None, None, None), (18, None, None, None),
    ]
    assert trie(spark, rows) == brute(rows)


def test_no_turns_no_nodes(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x")]) == []


def test_hot_conversation_hot_opening_and_many_copies(spark):
    rng = random.Random(8)
    rows = [(0, t, "user", rng.choice("ab")) for t in range(700)]  # one conversation with a third of the rows
    rows += [(5 * c, t, "user", f"copy {t}") for c in range(1, 200) for t in range(3)]
    rows += [(1000 + c, 0, "user", f"own {c}") for c in range(300)]  # one node with many children
    assert trie(spark, rows, parts=8, block_rows=64) == brute(rows)


def test_places_are_the_tour(spark):
    rows = talks(random.Random(2), 40)
    found = prefix_trie(table(spark, rows), 5, lent, block_rows=16).collect()
    assert sorted([r["enter"] for r in found] + [r["leave"] for r in found]) == list(range(2 * len(found)))
    place = {(r["conv_id"], r["depth"]): (r["enter"], r["leave"]) for r in found}
    for r in found:
        if r["depth"]:
            above = place[r["parent_conv_id"], r["depth"] - 1]
            assert above[0] < r["enter"] < r["leave"] < above[1]


def test_turns_keep_their_order_across_parts(spark):
    rows = [(1, t, "user", f"text {t}") for t in range(500)]
    found = ordered_turns(table(spark, rows).repartition(6)).collect()
    parts = defaultdict(list)
    for r in found:
        parts[r["part"]].append(r["at"])
    assert sum(map(len, parts.values())) == 500
    assert all(sorted(at) == list(range(len(at))) for at in parts.values())


@pytest.mark.parametrize("n,block_rows", [(0, 4), (1, 4), (2, 4), (257, 8), (300, 1), (3_000, 64)])
def test_list_ranking_of_a_shuffled_list(spark, n, block_rows):
    rng = random.Random(n)
    names = rng.sample(range(10 * n + 1), n)
    weights = [(1, rng.randrange(3), rng.randrange(1000)) for _ in range(n)]
    arcs = [(c, c % 3, *((names[i + 1], names[i + 1] % 3) if i + 1 < n else (None, None)), *weights[i]) for i, c in enumerate(names)]
    schema = "a bigint, b bigint, na bigint, nb bigint, w1 bigint, w2 bigint, w3 bigint"
    rng.shuffle(arcs)
    found = {r["a"]: (r["p1"], r["p2"], r["p3"]) for r in prefix_sums(spark.createDataFrame(arcs, schema), block_rows).collect()}
    sums, want = (0, 0, 0), {}
    for name, weight in zip(names, weights):
        want[name] = sums
        sums = tuple(s + w for s, w in zip(sums, weight))
    assert found == want
