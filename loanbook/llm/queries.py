"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm.common import shared_folder, ship_package
from loanbook.llm.html_text import extract_text
from loanbook.llm.language_model import fit_katz, score_texts
from loanbook.llm.mixing import mix_shares
from loanbook.llm.near_duplicates import near_duplicates
from loanbook.llm.neighbours import nearest_neighbours
from loanbook.llm.packing import pack_documents
from loanbook.llm.prefix_trie import prefix_trie
from loanbook.llm.quality import line_quality
from loanbook.llm.sharding import ring_shards
from loanbook.llm.spelling import spelling_groups, word_counts
from loanbook.llm.token_files import token_digests, write_token_files
from loanbook.llm.toxicity import fit_toxicity, score_toxicity
from loanbook.llm.url_filter import Rule, url_verdicts

#: The ranks hold the same vocabulary as the tokenizer file byte_bpe_50k.json.
RANKS = "byte_bpe_50k.tiktoken"
#: Fixed value: the token that the tokenizer file adds to the ranks.
ADDED = {"<|endoftext|>": 50256}

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are 85 percent alike."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(_table(spark, sf_dir, "pages"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix by weight takes of every document."""
    return mix_shares(_table(spark, sf_dir, "documents"))


def op5_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from four of five folds."""
    docs = _table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    labels = _table(spark, sf_dir, "labels").where(fold != 0).select("doc_id", "toxic")
    model = fit_toxicity(docs.where(fold != 0), labels)
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(fold == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_passages",
        "worst",
    )


def op6_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    docs = _table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, added=ADDED)


def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 24 shards whose row counts differ by one at most."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = ring_shards(docs, 24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and line figures and the verdict of every document; its source is its host."""
    return line_quality(_table(spark, sf_dir, "documents"))


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all texts under a model of four of five folds."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = fit_katz(docs, fold != 1)
    return score_texts(model).select(
        "doc_id",
        F.coalesce(fold == 1, F.lit(True)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


#: The fixed host rules, and the patterns that decide for addresses no host rule fits.
URL_RULES = [
    Rule("com/", "allow", True),
    Rule("example.com/en/", "block", True),
    Rule("www.example.com/en/", "allow", True),
    Rule("net/es/", "block", True),
    Rule("net/fr/", "block", True),
    *[
        Rule(text, "block")
        for text in (
            "^ads^", "^adserver^", "^advert^", "^banners^", "^popunder^", "^doubleclick^",
            "^casino^", "^poker^", "^viagra^", "^porn^", "^xxx^", "^escort^", "^torrent^",
            "^phishing^", "^malware^", "^track^*^click^", "^affiliate^*^redirect^",
        )
    ],
]


def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's address."""
    return url_verdicts(_table(spark, sf_dir, "pages"), URL_RULES)


def op11_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, from the ORC files they are written to."""
    docs = _table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "token-files")
    write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_digests(spark, folder)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt in families of five."""
    turns = _table(spark, sf_dir, "conversations")
    return prefix_trie(turns, 5, lambda conv: F.crc32(conv.cast("string").cast("binary")) % 9)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words and forms."""
    return spelling_groups(word_counts(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_near_duplicates,
        op2_nearest,
        op3_page_text,
        op4_source_mix,
        op5_toxic_segments,
        op6_tier_packing,
        op7_ring_shards,
        op8_line_quality,
        op9_katz,
        op10_url_verdicts,
        op11_orc_tokens,
        op12_prefix_trie,
        op13_spelling,
    )
}
