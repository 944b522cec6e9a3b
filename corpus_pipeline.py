"""Documents to packed training sequences, in five stages of the operators.

``STAGES`` are (name, function) pairs in order; each function takes (spark, docs, sf_dir)
and returns the documents that stay, the last one the packed pieces. ``run`` applies them
to the whole documents table and writes every stage's result before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm.common import ship_package, written
from loanbook.llm.mixing import mix_documents
from loanbook.llm.near_duplicates import NearPlan, keep_one_of_each
from loanbook.llm.packing import pack_documents
from loanbook.llm.quality import drop_rejected
from loanbook.llm.toxicity import fit_toxicity, score_toxicity

RANKS = "byte_bpe_50k.tiktoken"
#: Fixed value: the token that the tokenizer file adds to the ranks.
ADDED = {"<|endoftext|>": 50256}
TOXIC = 0.5
#: Five words and a similarity of 0.8; a pair at 0.8 shares no band with probability 3e-6.
NEAR = NearPlan(percent=80, bands=32)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the word rules and the line frequencies keep."""
    return drop_rejected(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxic score, learnt from the labels of the documents given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.where(scored["score"] < TOXIC).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 or more alike), the one with the least id."""
    return keep_one_of_each(docs, NEAR)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, once for each round that takes words of it."""
    return mix_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return pack_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, added=ADDED)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: Signatures, permutations and byte-pair ids are no SQL; tests hold brute force against them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
