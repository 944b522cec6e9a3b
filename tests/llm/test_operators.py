"""The operators on small tables: hand-worked rows, brute force, and awkward input."""

from __future__ import annotations

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loanbook.llm.html_text import extract_text, main_text
from loanbook.llm.language_model import fit_katz, pair_table, score_texts, word_table
from loanbook.llm.mixing import MixPlan, mix_documents, mix_shares, permutation, source_targets
from loanbook.llm.near_duplicates import NearPlan, keep_one_of_each, near_duplicates
from loanbook.llm.neighbours import SearchPlan, chi_square_quantile, nearest_neighbours
from loanbook.llm.packing import pack_documents
from loanbook.llm.quality import LineLimits, drop_rejected, frequent_lines, line_quality
from loanbook.llm.sharding import ring_shards
from loanbook.llm.toxicity import fit_toxicity, score_toxicity, segments
from loanbook.llm.url_filter import Rule, url_verdicts

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, bucket int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def docs_of(spark, rows):
    """(doc_id, text, source) rows, with columns whose names clash with operators' own."""
    return spark.createDataFrame([(i, t, "en", s, 0, "x", 7) for i, t, s in rows], SCHEMA)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """NULLs, empty and long texts, ties, repeated rows, a hot source."""
    rng = random.Random(3)
    rows = [(None, None, None), (None, "no id at all", None), (1, "", "a"), (2, None, "a"), (3, " \n\t ", "b")]
    rows += [(4, "twice the same row", "a")] * 2 + [(5, "same id", "a"), (5, "other text", "b")]
    rows += [(6, prose(rng, 30_000), "a"), (7, "äöü  ß\u00a0x\n\nz <|endoftext|>", "c")]
    rows += [(10 + i, prose(rng, 40), "hot" if i % 3 else f"s{i % 5}") for i in range(60)]
    return docs_of(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return docs_of(spark, [])


# --- near duplicates -------------------------------------------------------


def shingles(text):
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    least = min(label[a], label[b])
                    changed |= label[a] != least or label[b] != least
                    label[a] = label[b] = least
    return label


def varied(rng, n_groups=8, size=12):
    """Groups whose members differ in a few words, so that some are linked by chains only."""
    rows, i = [], 0
    for _ in range(n_groups):
        words = prose(rng, 120, 5000).split()
        for _ in range(size):
            words = list(words)
            for _ in range(rng.choice([0, 1, 1, 2])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append((i, " ".join(words)))
            i += 1
    return rows


def test_components_equal_brute_force(spark):
    rows = varied(random.Random(5)) + [(900, "a b c"), (901, "A  b\nc"), (902, "a b d"), (903, ""), (904, None)]
    found = near_duplicates(docs_of(spark, [(i, t, "s") for i, t in rows])).collect()
    expected = brute_components(rows)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(shingles(t)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_small_blocks_give_the_same(spark):
    rows = varied(random.Random(6), 3, 20)
    docs = docs_of(spark, [(i, t, "s") for i, t in rows])
    found = near_duplicates(docs, NearPlan(block=3)).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(rows)


@pytest.mark.parametrize("plan", [NearPlan(rounds=0), NearPlan(rounds=3, best=1, block=4)])
def test_rounds_of_best_partners_lose_no_link(spark, plan):
    rows = varied(random.Random(8), 2, 40)
    found = near_duplicates(docs_of(spark, [(i, t, "s") for i, t in rows]), plan).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(rows)


def test_texts_of_one_key_are_linked_each_by_its_own(spark):
    rng = random.Random(12)

    def near(text):
        return text.rsplit(" ", 1)[0] + " changed"

    rows, kept = [], Counter()
    for i in range(0, 200, 10):
        a, b, c = (prose(rng, 80, 10**6) for _ in range(3))
        # two texts under one key, either with a near copy elsewhere; one text without any
        rows += [(i + 5, a), (i + 5, b), (i + 5, c), (i + 6, near(a)), (i + 3, near(b)), (i + 7, near(b))]
        kept.update({(i + 5, a): 1, (i + 5, c): 1, (i + 3, near(b)): 1})
    docs = docs_of(spark, [(i, t, "s") for i, t in rows])
    least = {}
    for i, t in rows:
        base = min((j for j, u in rows if t.split()[:79] == u.split()[:79]), default=i)
        least[i, t] = base
    found = Counter((r.doc_id, r.component_id) for r in near_duplicates(docs).collect())
    assert found == Counter((i, least[i, t]) for i, t in rows)
    stays = keep_one_of_each(docs).collect()
    assert Counter((r.doc_id, r.text) for r in stays) == kept


def test_two_near_texts_of_one_key_leave_one(spark):
    text = prose(random.Random(3), 90, 10**6)
    docs = docs_of(spark, [(5, text, "s"), (5, text.upper(), "s"), (5, text + " more", "s"), (8, text + " more yet", "s")])
    assert [r.doc_id for r in keep_one_of_each(docs).collect()] == [5]


def test_bounds_keep_pairs_at_the_threshold():
    plan = NearPlan()
    for n, least in plan.least_matches():
        lost = sum(math.comb(n, m) * 0.85**m * 0.15 ** (n - m) for m in range(least))
        assert lost < 20 * plan.miss and 0 < least < n
    for more, least in plan.least_further():
        n = plan.hashes + more
        lost = sum(math.exp(math.lgamma(n + 1) - math.lgamma(m + 1) - math.lgamma(n - m + 1)) * 0.85**m * 0.15 ** (n - m) for m in range(least))
        assert lost < 20 * plan.miss and 0 < least < n


def test_a_similarity_of_all_is_copies_of_shingle_sets(spark):
    rows = varied(random.Random(9), 2, 20)
    found = near_duplicates(docs_of(spark, [(i, t, "s") for i, t in rows]), NearPlan(percent=100)).collect()
    sets = [(i, shingles(t)) for i, t in rows]
    assert {r.doc_id: r.component_id for r in found} == {i: min([j for j, u in sets if u and u == x], default=i) for i, x in sets}


def test_the_pipeline_drops_near_copies_from_a_similarity_of_80(spark):
    def changed(i, at):
        return " ".join(f"new{k}" if k in at else f"t{i}w{k}" for k in range(200))

    rows = []
    for i in range(20):
        rows += [(10 * i, changed(i, ()), "a"), (10 * i + 1, changed(i, (40, 80, 120, 160)), "a")]  # 176 of 216 shingles
        rows += [(10 * i + 2, changed(i, (20, 50, 80, 110, 140)), "a")]  # 171 of 221 with the first, less with the second
    pair = [shingles(t) for _, t, _ in rows[:3]]
    assert [len(pair[0] & x) / len(pair[0] | x) for x in pair[1:]] == [176 / 216, 171 / 221]
    kept = corpus_pipeline.near_dedup(spark, docs_of(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == [j for i in range(20) for j in (10 * i, 10 * i + 2)]
    assert 0.99999 < 1 - (1 - 0.8**corpus_pipeline.NEAR.rows) ** corpus_pipeline.NEAR.bands


def test_near_duplicates_of_awkward_rows(awkward, nothing):
    found = near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    assert {(r.component_id, r.kept) for r in by[4]} == {(4, True)}
    assert {(r.n_shingles, r.component_id, r.kept) for i in (1, 2, 3) for r in by[i]} == {(0, i, True) for i in (1, 2, 3)}
    assert {(r.component_id, r.kept) for r in by[None]} == {(None, True)}
    assert near_duplicates(nothing).count() == 0
    stays = keep_one_of_each(awkward)
    assert stays.columns == awkward.columns
    assert Counter(r.doc_id for r in stays.collect())[4] == 1


# --- nearest neighbours ----------------------------------------------------


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 16))
    v = centres[rng.integers(0, 20, 3000)] + 0.3 * rng.standard_normal((3000, 16))
    v[1500:2500] = v[1500]  # one common vector
    bad = [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] + [1.0] * 15), (9003, [1.0]), (None, [1.0] * 16)]
    bad += [(9004, [None] + [1.0] * 15)]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + bad
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    plan = SearchPlan(leaf_rows=100, query_chunk=7)
    found = nearest_neighbours(table, F.col("vec_id") % 50 == 0, 10, plan).collect()
    hits, total = 0, 0
    for q in range(0, 3000, 50):
        d = np.sqrt(((v - v[q]) ** 2).sum(1))
        d[q] = np.inf
        order = np.lexsort((np.arange(3000), d))[:10]
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert np.allclose([r.score for r in mine], d[[r.vec_id for r in mine]])
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        hits, total = hits + len({r.vec_id for r in mine} & set(order.tolist())), total + 10
    assert hits / total >= 0.9 and {r.query_id for r in found} <= set(range(0, 3000, 50))


def test_few_or_no_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in nearest_neighbours(table, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1.0)]
    assert nearest_neighbours(table.where("vec_id > 5"), F.lit(True)).count() == 0
    assert abs(chi_square_quantile(0.95, 8) - 15.507) < 1e-3


# --- pages -----------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body><header>Top</header><nav><ul><li><a href=/a>Menu</a></ul></nav><div class="ad banner">Buy now, it is cheap.</div>
<div class=cookie-notice>We use cookies and more words than we should.</div><main><article><h1>Head &amp; line</h1>
<p>First   paragraph with <b>bold</b> and <a href=x>a link</a>,<br>over two lines.<p>Second &eacute;&#233; paragraph, unclosed.
<ul><li>one item<li>another</ul><form><p>Search me</p></form><section class=comments><p>Nice article, thanks for it!</p></section>
<p>Last.</p></article></main><aside>Related things to read</aside><footer>&copy; all</footer></body></html>"""


WRAPPERS = ["content has-sidebar", "no-sidebar", "social-share-enabled", "with-banner", "content-related entry"]


@pytest.mark.parametrize("name", WRAPPERS)
def test_part_of_a_class_name_does_not_drop_an_article(name):
    lines = [f"Sentence number {i} of the article goes on for a good while, so that it is long." for i in range(9)]
    article = "".join(f"<p>{x}</p>" for x in lines)
    menu = '<div class="top-nav"><a href="/">Home</a> <a href="/b">News</a></div>'
    comments = f'<div class="comment-list"><p>{"I do not agree at all. " * 60}</p></div>'
    plain = f"<body>{menu}<div>{article}</div>{comments}</body>"
    assert main_text(plain) == "\n".join(lines)
    assert main_text(plain.replace("<div>", f'<div class="{name}">')) == "\n".join(lines)
    nested = plain.replace("<div>", f'<div class="page-widget"><div class="{name}">').replace("</div><div class=\"comment", "</div></div><div class=\"comment")
    assert main_text(nested) == "\n".join(lines)


def test_end_tags_without_a_start_take_time_in_proportion():
    took = []
    for n in (2_000, 16_000):
        for page in ("<b>" * n + "</i>" * n, "<b>" * n + "<hr>" * n):
            began = time.perf_counter()
            main_text(page)
            took.append(time.perf_counter() - began)
    assert took[2] < 32 * max(took[0], 0.02) and took[3] < 32 * max(took[1], 0.02)  # 8 in proportion, 64 by the square


def test_main_text_of_a_page():
    assert main_text(PAGE).split("\n") == [
        "Head & line",
        "First paragraph with bold and a link, over two lines.",
        "Second éé paragraph, unclosed.",
        "one item",
        "another",
        "Last.",
    ]


def test_pages_of_all_kinds(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p>plain"), (3, None, "<p>plain"), (4, "u", "a < b and <3"), (None, "u", deep)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("x"))
    found = extract_text(pages).collect()
    assert sorted((r.text, r.n_chars) for r in found) == sorted(
        [("", 0), ("", 0), ("plain", 5), ("plain", 5), ("a < b and <3", 12), ("deep", 4)]
    )
    assert extract_text(pages.where("page_id > 9")).count() == 0


# --- mixing ----------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), most=3.0):
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(ordered)}
    capped, total = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in sizes if s not in capped]
        level = (total - sum(capped.values())) / max(sum(weight[s] for s in free), 1e-12)
        over = {s: most * sizes[s] for s in free if weight[s] * level > most * sizes[s] + 1e-9}
        if not over:
            return {**capped, **{s: weight[s] * level for s in free}}
        capped.update(over)


def test_targets_equal_brute_force(spark):
    rng = random.Random(2)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 5, 40, 1000, 20000]) for i in range(rng.randrange(2, 9))} | {None: 17}
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        found = {r.source: r.target for r in source_targets(table, MixPlan()).collect()}
        expected = brute_targets(sizes)
        assert all(abs(found[s] - expected[s]) < 1e-6 * max(1, expected[s]) for s in sizes)


def test_permutations_are_permutations():
    for size in (1, 2, 3, 7, 64, 1000):
        out = permutation(np.arange(size), np.full(size, size), np.full(size, 99, np.uint64))
        assert sorted(out.tolist()) == list(range(size))


def test_mix_takes_its_targets(awkward, nothing):
    plan = MixPlan(block=8)
    found = mix_shares(awkward, plan).collect()
    again = mix_shares(awkward, plan).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again)) and len(found) == awkward.count()
    assert all(0 <= r.taken <= 3 * r["size"] for r in found)
    sources = Counter()
    for r in awkward.collect():
        sources[r.source] += len(WORD.findall(r.text or ""))
    expected = brute_targets(sources)
    taken = defaultdict(int)
    for r in found:
        taken[r.target] += r.taken
    for target in set(expected.values()):
        share = sum(v for v in expected.values() if v == target)
        near = [t for t in taken if abs(t - target) < 1e-6]
        assert abs(sum(taken[t] for t in near) - share) <= 60
    assert mix_shares(nothing, plan).count() == 0


def test_mixed_documents_hold_the_taken_words(awkward, nothing):
    plan = MixPlan(block=8)
    mixed = mix_documents(awkward, plan)
    assert mixed.columns == awkward.columns and mix_documents(nothing, plan).count() == 0
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    taken = Counter()
    for r in mix_shares(awkward, plan).collect():
        taken[r.doc_id] += r.taken
    assert +words == +taken


# --- toxicity --------------------------------------------------------------


def brute_segments(scores):
    """Ruzzo and Tompa by definition: the best segment, then the same on both sides."""
    best, at = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-9:
                best, at = total, (i, j)
    if at is None:
        return []
    i, j = at
    left, right = brute_segments(scores[:i]), brute_segments(scores[j + 1 :])
    return left + [(i, j, best)] + [(a + j + 1, b + j + 1, s) for a, b, s in right]


def test_segments_equal_the_definition():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice([-3.1, -1.3, -0.7, 0.9, 1.7, 2.3]) + rng.random() / 100 for _ in range(rng.randrange(1, 25))]
        found = segments(np.array(scores))
        expected = brute_segments(scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for *_, s in found], [s for *_, s in expected])


def test_segments_take_time_in_proportion():
    took = []
    for n in (20_000, 80_000):
        for scores in (np.tile([1.0, -2.0], n // 2), np.tile([2.0, -1.0], n // 2)):
            began = time.perf_counter()
            found = segments(scores)
            took.append(time.perf_counter() - began)
            assert len(found) == (n // 2 if scores[0] == 1 else 1)
    assert took[2] < 16 * max(took[0], 0.01) and took[3] < 16 * max(took[1], 0.01)  # 4 in proportion, 16 by the square


def test_toxic_texts_are_found(spark, awkward, nothing):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        toxic = i % 5 == 0
        words = prose(rng, 60).split() + (rng.sample(["vile", "nasty", "filth", "scorn"], 3) if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(toxic)))
    docs = docs_of(spark, rows)
    marks = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    model = fit_toxicity(docs.where("doc_id % 4 <> 0"), marks)
    held = {r.doc_id: r.score for r in score_toxicity(docs, model).where("doc_id % 4 = 0").collect()}
    assert all((held[i] >= 0.5) == bool(t) for i, t in labels if i in held)
    odd = score_toxicity(awkward, model).collect()
    assert len(odd) == awkward.count() and all(0 <= r.score < 0.5 for r in odd)
    assert score_toxicity(nothing, model).count() == 0
    untaught = fit_toxicity(nothing, marks)
    assert {r.score < 0.5 for r in score_toxicity(awkward, untaught).collect()} == {True}


# --- packing ---------------------------------------------------------------


def test_packing_is_an_exact_round_trip(awkward, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    end = "<|endoftext|>"
    odd = [f"z {end} y", end, f"{end}{end}", f" {end}\n", f"a\n{end} \n b  {end}c", f"<|{end}|>", "<|endoftext |>", f"x{end[:-1]}"]
    awkward = awkward.unionByName(docs_of(awkward.sparkSession, [(300 + i, t, "s") for i, t in enumerate(odd)]))
    pieces = pack_documents(awkward, ranks, public_tokenizers.PATTERN, added={end: 50256}).collect()
    expected = Counter()
    for r in awkward.where("doc_id <> 4 AND doc_id <> 5").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        raw = np.asarray(ids, "<u4").tobytes()
        own = sorted((p for p in pieces if p.doc_id == r.doc_id), key=lambda p: p.start)
        at = 0
        for p in own:
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(raw[4 * at : 4 * (at + p.length)])
            at += p.length
        assert at == len(ids)
        expected[r.doc_id] += 1
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    for held in sequences.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == held[0].window <= 1024 and at & (at - 1) == 0
    assert pack_documents(nothing, ranks, public_tokenizers.PATTERN).count() == 0


# --- sharding --------------------------------------------------------------


def test_shards_differ_by_one_row(awkward, nothing, spark):
    rows = awkward.select("doc_id", "text")
    found = ring_shards(rows, 7, vnodes=8, cells=256).collect()
    again = ring_shards(rows, 7, vnodes=8, cells=256).collect()
    counts = Counter(r.shard for r in found)
    assert len(counts) == 7 and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    assert Counter((r.doc_id, r.text) for r in found) == Counter(map(tuple, rows.collect()))
    assert ring_shards(nothing.select("doc_id"), 7, vnodes=8, cells=256).count() == 0


def test_one_hot_row_and_little_movement(spark):
    same = spark.range(900).select(F.lit(5).cast("long").alias("doc_id")).unionByName(spark.range(2000).select(F.col("id").alias("doc_id")))
    counts = Counter(r.shard for r in ring_shards(same, 24).collect())
    assert max(counts.values()) - min(counts.values()) <= 1
    ids = spark.range(4000).select(F.col("id").alias("doc_id"))
    before = {r.doc_id: r.shard for r in ring_shards(ids, 10).collect()}
    after = {r.doc_id: r.shard for r in ring_shards(ids, 11).collect()}
    assert sum(before[i] != after[i] for i in before) < 0.45 * len(before)


# --- quality ---------------------------------------------------------------


def test_boilerplate_goes_and_copies_stay(spark):
    rng = random.Random(8)
    menu = "Home About Contact 2024"
    rows = [(i, f"{menu}\n{prose(rng, 30)}\n{prose(rng, 30)}", "h") for i in range(30)]
    copy = f"{prose(rng, 30)}\n{prose(rng, 30)}"
    rows += [(100 + i, copy, "h") for i in range(50)]
    rows += [(200, f"home  about contact 1999\n{menu}\n{menu} \n one two three four", "h"), (201, f"{menu}\n" * 3, "other")]
    docs = docs_of(spark, rows)
    assert [(r.host, r.documents, r.families) for r in frequent_lines(docs).collect()] == [("h", 31, 31)] or frequent_lines(docs).count() == 1
    verdicts = {r.doc_id: r for r in line_quality(docs).collect()}
    assert all(verdicts[i].kept and verdicts[i].n_removed_words == 4 for i in range(30))
    assert all(verdicts[100 + i].kept for i in range(50))
    assert not verdicts[200].kept and verdicts[200].n_dup_lines == 0
    kept = drop_rejected(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in verdicts.items() if r.kept}


def test_shared_lines_count_every_distinct_document(spark):
    rng = random.Random(18)
    shared = [f"shared line {x} of nine on every page" for x in "abcdefghi"]
    own = lambda: prose(rng, 40)
    rows = [(i, "\n".join([own(), *rng.sample(shared, 9)]), "nine") for i in range(40)]  # 1 own line, 9 shared ones
    rows += [(100 + i, f"{shared[0]}\n{own()}", "copied") for i in range(12)]
    rows += [(200 + i, rows[40][1], "copied") for i in range(60)]  # copies neither count nor hide the others
    rows += [(300 + i, f"{shared[0]}\n{own()}", "few") for i in range(9)]
    found = defaultdict(list)
    for r in frequent_lines(docs_of(spark, rows)).collect():
        found[r.host].append((r.documents, r.families))
    assert found == {"nine": [(40, 40)] * 9, "copied": [(72, 12)]}
    verdicts = {r.doc_id: r for r in line_quality(docs_of(spark, rows)).collect()}
    assert all(verdicts[i].n_removed_words == 9 * 8 for i in range(40))
    assert all(verdicts[i].n_removed_words == 8 and verdicts[i].kept for i in [*range(100, 112), *range(200, 260)])
    assert all(verdicts[i].n_removed_words == 0 for i in range(300, 309))


def brute_repeated(words):
    at = defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    return len({j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)})


def test_word_figures_equal_brute_force(spark, awkward, nothing):
    rng = random.Random(9)
    rows = [(1000 + i, " ".join(f"w{rng.randrange(6)}" for _ in range(rng.randrange(40))), "q") for i in range(40)]
    docs = awkward.unionByName(docs_of(spark, rows + [(1, "a#b$ |\nx\nx\n\n", "q")]))
    found = Counter()
    for r in line_quality(docs, LineLimits()).collect():
        found[(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)] += 1
    expected = Counter()
    for r in docs.collect():
        text = r.text or ""
        w = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        expected[(r.doc_id, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), brute_repeated(w))] += 1
    assert found == expected
    assert line_quality(nothing).count() == 0


def test_texts_are_read_and_lines_hashed_once(spark, tmp_path):
    docs_of(spark, [(i, f"menu\n{chr(97 + i)} own words", "h") for i in range(20)]).write.parquet(f"{tmp_path}/docs.parquet")
    docs = spark.read.parquet(f"{tmp_path}/docs.parquet")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(frequent_lines(docs)).count("md5(") == 1
    found = line_quality(docs)
    assert "md5(" not in plan(found) and not any(f.startswith(f"file://{tmp_path}/docs") for f in found.inputFiles())
    assert {(r.n_words, r.n_removed_words) for r in found.collect()} == {(4, 1)}


def test_lines_differ_in_letters_beyond_ascii(spark):
    rng = random.Random(28)
    heads = ["Menu \u00c9t\u00e9 12", "MENU\t\u00c9T\u00e9  34\r", "menu \u00e9t\u00e9 12", "menu \u212a", "menu k", "MENU K"]
    rows = [(100 * k + i, f"{head}\n{prose(rng, 30)}", "h") for k, head in enumerate(heads) for i in range(6)]
    docs = docs_of(spark, rows)
    assert sorted((r.documents, r.families) for r in frequent_lines(docs).collect()) == [(12, 12), (12, 12)]
    removed = {r.doc_id: r.n_removed_words for r in line_quality(docs).collect()}
    assert [{removed[100 * k + i] for i in range(6)} for k in range(6)] == [{3}, {3}, {0}, {0}, {2}, {2}]


# --- language model --------------------------------------------------------


@pytest.mark.parametrize("cell", [1 << 20, 16])
def test_history_probabilities_sum_to_one(spark, cell):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("aaabbcdefg") for _ in range(rng.randrange(1, 12))) for _ in range(80)]
    model = fit_katz(docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)]), cell=cell)
    assert len(model.frequent) > 0 if cell == 16 else len(model.frequent) == 0
    words = word_table(model).toPandas()
    assert (words["id"].min(), words["id"].nunique(), words["c"].sum()) == (1, model.types, model.tokens)
    singles = model.single(words["c"].to_numpy())
    of = dict(zip(words["id"], singles))
    once = sum(words["c"] == 1)
    assert abs(singles.sum() + model.unseen * max(1, once) - 1) < 1e-9
    for _, mine in pair_table(model).toPandas().groupby("history"):
        assert mine["weight"].nunique() == 1 and not mine["word"].duplicated().any()
        left = 1 - sum(of[w] for w in mine["word"])
        assert abs((10 ** mine["log"]).sum() + 10 ** mine["weight"].iloc[0] * left - 1) < 1e-6


def test_blank_models(spark, awkward, nothing):
    assert score_texts(fit_katz(nothing)).count() == 0
    found = score_texts(fit_katz(awkward, F.lit(None).cast("boolean")))
    assert found.count() == awkward.count() and found.where("n_known > 0").count() == 0
    named = awkward.select(F.concat(F.lit("k"), "doc_id").alias("doc_id"), "text")
    assert Counter(r.doc_id for r in score_texts(fit_katz(named)).collect()) == Counter(r.doc_id for r in named.collect())


# --- addresses -------------------------------------------------------------


@pytest.mark.parametrize("sizes", [{}, {"block": 100, "cell": 64}])
def test_all_pairs_are_learnt_whatever_their_words_counts(spark, awkward, sizes):
    rng = random.Random(21)
    rare = [f"{prose(rng, 6, 40)} only{i} once{i} {prose(rng, 5, 40)}" for i in range(200)]  # words of a single text
    learnt = awkward.unionByName(docs_of(spark, [(500 + i, t, "s") for i, t in enumerate(rare)]))
    held_out = docs_of(spark, [(900, "never seen w1 w2 w3", "s"), (901, "w5 only7 once7 w5", "s"), (902, None, "s")])
    asked = learnt.unionByName(held_out)
    tokens = lambda t: WORD.findall("".join(c.lower() if c.isascii() else c for c in t or "")) + [None]
    count, pair, held = Counter(), Counter(), Counter()
    for r in learnt.collect():
        t = ["<s>", *tokens(r.text)]
        count.update(t[1:])
        held.update(t[:-1])
        pair.update(zip(t, t[1:]))
    total, types = sum(count.values()), len(count)

    def ratios(counts):
        n = Counter(counts)
        rest = 6 * n[6] / n[1] if n[1] else 1.0
        out = {}
        for c in range(1, 6):
            d = ((c + 1) * n[c + 1] / (c * n[c]) - rest) / (1 - rest) if n[c] and n[c + 1] and rest < 1 else 0.0
            out[c] = d if 0 < d < 1 else c / (c + 0.5)
        return out

    of_words, of_pairs = ratios(count.values()), ratios(pair.values())
    unseen = (sum((1 - of_words.get(c, 1.0)) * c for c in count.values()) + 1) / (total + 1) / max(1, sum(c == 1 for c in count.values()))
    one = lambda w: of_words.get(count[w], 1.0) * count[w] / (total + 1) if count[w] else unseen
    given = lambda h, w: of_pairs.get(pair[h, w], 1.0) * pair[h, w] / (held[h] + 1)
    after = defaultdict(list)
    for h, w in pair:
        after[h].append(w)
    weight = {h: (1 - sum(given(h, w) for w in ws)) / (1 - sum(map(one, ws))) for h, ws in after.items()}
    expected = Counter()
    for r in asked.collect():
        t = tokens(r.text)
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (types + 1))) for w in t)
        p = [given(h, w) if (h, w) in pair else weight.get(h, 1.0) * one(w) for h, w in zip(["<s>", *t], t)]
        expected[(r.doc_id, len(t), sum(count[w] > 0 for w in t), round(base, 3), round(sum(map(math.log10, p)), 3))] += 1
    model = fit_katz(asked, F.coalesce(F.col("doc_id"), F.lit(0)) < 900, **sizes)
    assert (model.tokens, model.types) == (total, types)
    assert pair_table(model).count() == len(pair)
    found = Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 3), round(r.score, 3)) for r in score_texts(model).collect())
    assert found == expected


def test_url_verdicts(spark):
    rules = [Rule("com/", "allow", True), Rule("example.com/en/", "block", True), Rule("^ads^", "block"), Rule("bad*thing", "block"), Rule("^ok^", "allow")]
    rows = [
        (1, "https://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
        (2, "http://example.com/en", "example.com", "/en", "com/", "allow"),
        (3, "http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        (4, "http://x.org/ads/1", "x.org", "/ads/1", None, "block"),
        (5, "http://x.org/loads/1", "x.org", "/loads/1", None, "allow"),
        (6, "http://x.org/verybadlittlething", "x.org", "/verybadlittlething", None, "block"),
        (7, "http://x.org/ok/ads", "x.org", "/ok/ads", None, "allow"),
        (8, None, "", "", None, "allow"),
        (9, "", "", "", None, "allow"),
        (10, "no scheme/ads/", "", "", None, "block"),
        (11, "http://com", "com", "", None, "allow"),
        (12, "x://u/a://b.com/", "u", "/a://b.com/", None, "allow"),
        (13, "http://h?x=/en/", "h", "", None, "allow"),
        (None, "http://x.com/", "x.com", "/", "com/", "allow"),
        (4, "http://x.org/ads/1", "x.org", "/ads/1", None, "block"),
    ]
    pages = spark.createDataFrame([(r[0], r[1], "h") for r in rows], "page_id bigint, url string, rule string")
    found = Counter(map(tuple, url_verdicts(pages, rules).collect()))
    assert found == Counter((i, h, p, rule, v) for i, _, h, p, rule, v in rows)
    assert url_verdicts(pages.where("page_id > 99"), rules).count() == 0
    assert url_verdicts(pages, []).where("verdict <> 'allow'").count() == 0
