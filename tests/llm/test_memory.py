"""What workers hold at a time, and what they do once."""

import tracemalloc

import numpy as np
import public_tokenizers

from loanbook.llm import near_duplicates
from loanbook.llm.language_model import _packed, _unpacked
from loanbook.llm.near_duplicates import NearPlan, keep_one_of_each
from loanbook.llm.token_ids import TokenTable


def test_packing_holds_one_column_a_second_time():
    columns = [np.arange(1 << 18) + i for i in range(8)]
    tracemalloc.start()
    told = _packed(*columns)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * columns[0].nbytes


def test_packed_columns_come_back():
    columns = [np.arange(5), np.zeros(0, np.int64), np.array([-1, 1 << 62]), np.array([0.5, np.nan, -np.inf])]
    for mine, back in zip(columns, _unpacked(_packed(*columns), floats=1), strict=True):
        assert mine.dtype == back.dtype
        np.testing.assert_array_equal(mine, back)
    assert _unpacked(_packed()) == []


def test_near_duplicates_hand_python_few_rows_at_a_time(spark, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    def written(df, *args):
        seen.append(spark.conf.get(name))
        return kept(df, *args)

    kept = near_duplicates.written
    monkeypatch.setattr(near_duplicates, "written", written)
    before = spark.conf.get(name)
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, words), (2, f"{words} x"), (3, "other text")], "doc_id long, text string")
    assert sorted(r.doc_id for r in keep_one_of_each(docs).collect()) == [1, 3]
    assert set(seen) == {str(NearPlan().handed)} and int(before) > NearPlan().handed
    assert spark.conf.get(name) == before


def test_first_words_are_encoded_once():
    table, asked = TokenTable(public_tokenizers.path("byte_bpe_50k.json")), []
    whole = table.whole
    table.whole = lambda text: asked.append(text) or whole(text)
    texts = ["Hello there", "Hello again", "", " blank first", "Hello", "\nline"] * 2
    assert [table.of(t) for t in texts] == [whole(t) for t in texts]
    assert asked.count("Hello") == 1
