"""Spelling variants against brute force over all pairs, short lists, hot prefixes, awkward input."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loanbook.llm.spelling import WordList, near_pairs, near_words, spelling_groups, word_counts, word_lists

SCHEMA = "doc_id bigint, text string, word string, n int, list string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def brute_counts(rows, least=6, count=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= count}


def brute_groups(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 5 * counts[w]:
            form[w] = best
    rows = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(rows)


def variants(rng, n, alphabet="abé", length=(6, 9)):
    words = set()
    while len(words) < n:
        word = "".join(rng.choice(alphabet) for _ in range(rng.randrange(*length)))
        words.add(word)
        at = rng.randrange(len(word))
        words.add(word[:at] + rng.choice(alphabet) + word[at + rng.randrange(2) :])
    return {w: rng.choice([5, 6, 25, 30, 200, 1000]) for w in sorted(words)}


@pytest.mark.parametrize("list_words", [3, 40, 2000])
def test_groups_equal_brute_force(spark, list_words):
    counts = variants(random.Random(list_words), 400)
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert sorted(map(tuple, spelling_groups(words, list_words).collect())) == brute_groups(counts)


def test_long_lists_are_dealt_again_and_lose_no_pair(spark):
    rng = random.Random(4)
    counts = {"prefix" + "".join(rng.choice("abcdefgh") for _ in range(4)) + "suffix": 5 for _ in range(1500)}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(5)
    lists = word_lists(words, 100)
    sizes = lists.groupBy("list", "cls", "lo", "hi").count().collect()
    assert all(r["count"] <= 100 or r["cls"] - r["lo"] - r["hi"] <= 1 for r in sizes)
    found = {(r["word"], r["near"]) for r in near_words(words, 100).collect()}
    assert found == {(a, b) for a in counts for b in counts if one_edit(a, b)}


def test_scan_of_several_lists_keeps_them_apart():
    words = sorted(["abcdef", "abcdeg", "abcdefg"]) + sorted(["abcdef", "abcxef", "zzzzzz", "abcde"])
    lists, shared = np.array([0] * 3 + [1] * 4), np.array([5] * 3 + [0] * 4)
    a, b = near_pairs(WordList(words, lists), lists, shared)
    found = {(lists[i], words[i], words[j]) for i, j in zip(a, b)}
    want = {(g, w, x) for g, w in zip(lists, words) for h, x in zip(lists, words) if g == h and one_edit(w, x)}
    assert found == want and all(lists[i] == lists[j] for i, j in zip(a, b))


def test_counts_of_whole_texts(spark, monkeypatch):
    rng = random.Random(9)
    names = [f"wort{a}{b}é" for a in "abcdefghij" for b in "xyz"]
    rows = [(i, " ".join(rng.choice(names) for _ in range(300)) + " ÀÉabcde short x1y" * 2) for i in range(40)]
    rows += [(None, "nullkey " * 9), (1, None), (2, ""), (3, "a" * 50_000 + " " + "longtext " * 5_000), (7, "same rows")]
    rows += [(9, "repeatedrow")] * 6
    docs = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in rows], SCHEMA).repartition(3)
    found = {r["word"]: r["n"] for r in word_counts(docs).collect()}
    assert found == brute_counts(rows)
    assert any(len(w) == 6 for w in found), "some run has lost a letter"


def test_forms_lead_to_a_root_over_several_steps(spark):
    counts = {"aaaaaaa": 5, "aaaaaab": 25, "aaaaabb": 125, "aaaabbb": 625, "aaabbbb": 3125, "lonely": 7}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = sorted(map(tuple, spelling_groups(words).collect()))
    assert found == brute_groups(counts)
    assert {r[0]: r[2] for r in found}["aaaaaaa"] == "aaabbbb"


def test_ties_go_to_the_smallest_and_empty_tables_stay_empty(spark):
    counts = {"bbbbbb": 50, "bbbbbé": 50, "bbbbbz": 50, "bbbbb!": 5}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert sorted(map(tuple, spelling_groups(words).collect())) == brute_groups(counts)
    none = spark.createDataFrame([], SCHEMA)
    assert word_counts(none).count() == 0
    assert spelling_groups(word_counts(none)).count() == 0
