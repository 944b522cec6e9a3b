"""Token files: the ids against the tokenizer as loaded, places, pruning, awkward input."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs
import pyarrow.orc
import pytest
from tokenizers import Tokenizer

from loanbook.llm.common import shared_folder
from loanbook.llm.token_files import (
    OrcLayout,
    read_documents,
    read_span,
    read_token_files,
    token_digests,
    write_token_files,
)
from loanbook.llm.token_ids import TokenTable

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, part int, before string, ids string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_table_gives_the_tokenizers_ids(tokenizer):
    rng = random.Random(5)
    parts = [
        " ", "  ", "\n", "\n\n", "\r\n", "\t", "\xa0", "　", "​", "a", "Zb", "word", "ç", "ß", "é", "日本", "😀", "́",
        "ɐ", "ª", "'s", "'ll", "don't", "12", "3.5", ".", ",", "?!", " cd,", "<|endoftext|>", "<|", "-", "_", "The",
    ]
    table = TokenTable(PATH)
    for _ in range(4_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert table.of(text) == np.array(ids_of(tokenizer, text), "<u4").tobytes(), text


def test_forgotten_words_come_back_the_same(tokenizer, monkeypatch):
    monkeypatch.setattr("loanbook.llm.token_ids.REMEMBERED", 3)
    table = TokenTable(PATH)
    text = "one two three four five one two six seven eight one " * 3 + "end"
    for _ in range(2):
        assert table.of(text) == np.array(ids_of(tokenizer, text), "<u4").tobytes()
    assert len(table) <= 3


def test_signs_after_a_word_leave_the_word_as_it_is_remembered(tokenizer):
    table = TokenTable(PATH)
    table.of("a word é 12")
    encoded = []
    whole = table.whole
    table._merged = table.whole = lambda text: encoded.append(text) or whole(text)
    text = "a word,*** word*** é$ 12)"
    assert table.of(text) == np.array(ids_of(tokenizer, text), "<u4").tobytes()
    assert encoded == [",***", "***", "$", ")"]


def test_an_added_token_among_signs_is_one_id(tokenizer):
    table = TokenTable(PATH)
    for text in ("a <|endoftext|>", "a <|endoftext|>--", "a b<|endoftext|>.", "a endoftext|>", "a it's. 'S!"):
        assert table.of(text) == np.array(ids_of(tokenizer, text), "<u4").tobytes(), text


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    told = [(i * 7 % 3001, " ".join(f"w{rng.randrange(999)}" for _ in range(rng.randrange(20)))) for i in range(3000)]
    told += [(5000, None), (5001, ""), (None, "no key"), (None, None), (5002, "long word " * 40_000)]
    return told + [(5003, "same row")] * 500 + [(5004, "a"), (5004, "b"), (5005, "z <|endoftext|> y")]


@pytest.fixture(scope="module")
def folder(spark, rows):
    docs = spark.createDataFrame([(k, t, 1, "x", "y") for k, t in rows], SCHEMA).repartition(7)
    path = shared_folder(spark, "test-tokens")
    write_token_files(docs, path, PATH, 2, layout=OrcLayout(stripe_bytes=1 << 16))
    return path


def test_files_hold_every_document_in_key_order(spark, tokenizer, rows, folder):
    found = read_token_files(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    start = 0
    for row in found:
        assert (row["start"], row["n_tokens"]) == (start, len(row["ids"]))
        start += row["n_tokens"]
    want = sorted((str(k), [*ids_of(tokenizer, t), 2]) for k, t in rows)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in found) == want


def test_digests_are_those_of_the_ids(spark, tokenizer, rows, folder):
    found = token_digests(spark, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    want = sorted(
        (str(k), len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for k, t in rows for i in [[*ids_of(tokenizer, t), 2]]
    )
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in found.collect()) == want


def scanned(df) -> int:
    """Rows that the scan of the token files has passed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, left = 0, [plan]
    while left:
        node = left.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            left.append(node.executedPlan())
        elif name.startswith("Scan orc") and "tokens" in node.toString():
            found += node.metrics().apply("numOutputRows").value()
        elif hasattr(node, "plan") and name.endswith("QueryStage"):
            left.append(node.plan())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found


def test_keys_are_found_without_reading_all(spark, rows, folder):
    found = read_documents(spark, folder, [14, 5002])
    assert sorted(r["doc_id"] for r in found.collect()) == [14, 5002]
    assert 0 < scanned(found) < len(rows)
    # 3002 lies between keys that are there: its row group is ruled out by the Bloom filter.
    assert scanned(read_documents(spark, folder, [3002])) < 2_000
    assert read_documents(spark, folder, [3002]).count() == 0


def test_spans_hold_what_they_overlap(spark, folder):
    all_rows = read_token_files(spark, folder).collect()
    total = max(r["start"] + r["n_tokens"] for r in all_rows)
    for first, last in [(0, 1), (0, total), (100, 900), (total - 1, total), (total, total + 5), (total // 2, total // 2 + 1)]:
        want = sorted(r["start"] for r in all_rows if r["start"] < last and r["start"] + r["n_tokens"] > first)
        assert sorted(r["start"] for r in read_span(spark, folder, first, last).collect()) == want


def test_files_have_stripes_and_small_integers(spark, folder):
    paths = [f for f in spark.read.orc(f"{folder}/tokens").inputFiles() if f.endswith(".orc")]
    files = [pyarrow.orc.ORCFile(p.removeprefix("file://").removeprefix("file:")) for p in paths]
    assert sum(f.nrows for f in files) == 3508
    assert all(f.row_index_stride == 1000 for f in files)
    assert sum(f.nstripes for f in files) >= len([f for f in files if f.nrows])


def test_empty_table_and_text_keys(spark, tokenizer):
    path = shared_folder(spark, "test-none")
    write_token_files(spark.createDataFrame([], SCHEMA), path, PATH, 2)
    assert token_digests(spark, path).count() == 0
    assert read_span(spark, path, 0, 10).count() == 0
    path = shared_folder(spark, "test-names")
    named = spark.createDataFrame([("b", "one"), ("a", "two three")], "`the name` string, body string")
    write_token_files(named, path, PATH, 7, key="the name", text="body")
    found = read_token_files(spark, path).orderBy("start").collect()
    assert [(r["the name"], r["ids"]) for r in found] == [
        ("a", [*ids_of(tokenizer, "two three"), 7]),
        ("b", [*ids_of(tokenizer, "one"), 7]),
    ]
