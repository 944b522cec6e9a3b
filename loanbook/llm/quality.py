"""Cross-document line frequency: boilerplate lines out, documents of little else rejected.

A line is normalised (A-Z lower-cased, digits to 0, white space to single spaces) and
hashed. Per host the distinct documents with it are counted. Copies of one document would
make each of its lines look like boilerplate, so documents count in families: those with
the same set of lines. Documents that differ in any line are told apart, whatever lines
they share. A line is over the limit if at least ``min_families`` families of its host have
it. Lines over the limit are removed, and a document that keeps too few of its words is
rejected.

Texts are read once: the figures and line hashes of every document are written to the
shared folder, and lines are counted and looked up from there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import LOWER, NOT_SPACE, SPACE, UPPER, one_row_each, words, written

#: A removed line's copies in the join; not more than the families it has at least.
SALTS = 8


@dataclass(frozen=True)
class LineLimits:
    min_families: int = 10
    #: kept documents have this many words left, and this share of their words in percent
    min_words: int = 10
    min_percent: int = 30


def _plain(line: Column) -> Column:
    """The normalised line. ``lower`` is many times quicker than ``translate``, equal on ASCII only."""
    low = F.when(F.length(line) == F.octet_length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))
    return F.trim(F.regexp_replace(F.regexp_replace(low, "[0-9]", "0"), f"{SPACE}+", " "))


def _plain_hash(plain: Column) -> Column:
    return F.conv(F.substring(F.md5(plain.cast("binary")), 1, 15), 16, 10).cast("long")


def line_hash(line: Column) -> Column:
    """60 bits of the normalised line's MD5."""
    return _plain_hash(_plain(line))


def _hashes(lines: Column) -> Column:
    """For each line with a word its hash ``line`` and its number of words ``n``."""
    return F.transform(
        F.transform(lines, _plain),
        lambda x: F.struct(
            _plain_hash(x).alias("line"),
            # single spaces stand between its words
            (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).cast("long").alias("n"),
        ),
    )


def _lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(NOT_SPACE))


def _repeated_words(df: DataFrame, width: int = 5) -> DataFrame:
    """``n_repeat_words``: words in windows of ``_w`` found twice or more, each word once.

    Words are hashed once and windows by the hashes of their words. Where some are equal, a
    window's hash gives up the low bits that its place needs, so one sort of plain numbers
    brings equal windows together with their places. Within a document of n words, windows
    are told apart by 63 - log2(n) bits.
    """
    five = ", ".join(["x", *(f"get(_h, i + {k})" for k in range(1, width))])
    df = df.withColumn("_b", F.length(F.bin(F.size("_w")))).withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
    df = df.withColumn(
        "_g", F.expr(f"transform(slice(_h, 1, greatest(size(_h) - {width - 1}, 0)), (x, i) -> xxhash64({five}))")
    )
    placed = F.expr("sort_array(transform(_g, (x, i) -> shiftleft(x, _b) | (i + 1)))")
    df = df.withColumn(
        "_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), placed).otherwise(F.array().cast("array<bigint>"))
    )
    df = df.withColumn(
        "_p",
        F.expr(
            "filter(_s, (x, k) -> shiftright(x, _b) = shiftright(get(_s, k - 1), _b)"
            " OR shiftright(x, _b) = shiftright(get(_s, k + 1), _b))"
        ),
    )
    covered = f"""
        aggregate(sort_array(transform(_p, x -> x & (shiftleft(1L, _b) - 1))),
                  named_struct('end', 0L, 'n', 0L),
                  (s, i) -> named_struct('end', i + {width}, 'n', s.n + i + {width} - greatest(s.end, i)),
                  s -> s.n)
    """
    return df.withColumn("n_repeat_words", F.expr(covered)).drop("_b", "_h", "_g", "_s", "_p")


def _identified(docs: DataFrame, key: str, host: str, text: str) -> DataFrame:
    """Key, host and text; equal rows share ``_t``, so they can be told from others."""
    return docs.select(
        F.col(f"`{key}`").alias("_key"),
        F.col(f"`{host}`").alias("_host"),
        F.xxhash64(F.col(f"`{text}`"), F.col(f"`{text}`").isNull()).alias("_t"),
        F.col(f"`{text}`").alias("_text"),
    )


def _measured(docs: DataFrame, key: str, host: str, text: str) -> DataFrame:
    """Per row of ``docs`` its word and line figures, and ``_each``: its lines' hashes and words."""
    whole = F.coalesce("_text", F.lit(""))
    base = _identified(docs, key, host, text).select(
        "_key",
        "_host",
        "_t",
        words(F.col("_text")).alias("_w"),
        _lines(F.col("_text")).alias("_lines"),
        F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    return _repeated_words(base).select(
        "_key",
        "_host",
        "_t",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        _hashes(F.col("_lines")).alias("_each"),
    )


def _frequent(lines: DataFrame, limits: LineLimits) -> DataFrame:
    """``frequent_lines`` of rows with ``_host`` and ``_lines``, their distinct hashes."""
    family = F.xxhash64(F.sort_array("_lines")).alias("_family")
    # plain explode would work out the lines twice, the first time to drop rows without any
    had = lines.select("_host", family, F.explode_outer("_lines").alias("_line")).where("_line IS NOT NULL")
    by_family = had.groupBy("_host", "_line", "_family").agg(F.count(F.lit(1)).alias("n"))
    counted = by_family.groupBy("_host", "_line").agg(
        F.sum("n").alias("documents"), F.count(F.lit(1)).alias("families")
    )
    return counted.where(F.col("families") >= limits.min_families).select(
        F.col("_host").alias("host"), F.col("_line").alias("line"), "documents", "families"
    )


def frequent_lines(
    docs: DataFrame, limits: LineLimits = LineLimits(), *, key="doc_id", host="source", text="text"
) -> DataFrame:
    """Lines over the limit: ``host``, ``line`` (hash), ``documents``, ``families``."""
    lines = _identified(docs, key, host, text).select(
        "_host", F.array_distinct(F.transform(_lines(F.col("_text")), line_hash)).alias("_lines")
    )
    return _frequent(lines, limits)


def line_quality(
    docs: DataFrame, limits: LineLimits = LineLimits(), *, key="doc_id", host="source", text="text"
) -> DataFrame:
    """One row per document: key, word and line figures, ``base_failed`` and ``kept``.

    ``n_removed_words`` counts the words in removed lines. NULL and empty texts have no
    words and fail the base rules; NULL hosts are a host of their own. Rows that repeat
    (same key, host and text) are documents of their own with equal figures. An empty table
    gives an empty result; other columns are left out.
    """
    told = written(_measured(docs, key, host, text), "line-quality")
    same = ["_key", "_host", "_t"]

    # Words in removed lines. A line that a third of all rows have meets copies of its row.
    lines = told.select("_host", F.array_distinct("_each.line").alias("_lines"))
    salted = _frequent(lines, limits).select(
        F.col("host").alias("_h"),
        F.col("line").alias("_line"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"),
    )
    held = told.select(*same, F.explode("_each").alias("x")).select(
        *same,
        F.col("x.line").alias("_line"),
        F.col("x.n").alias("_n"),
        F.pmod(F.xxhash64("_key", "_t"), F.lit(SALTS).cast("long")).alias("_salt"),
    )
    met = held.join(
        salted,
        held["_host"].eqNullSafe(salted["_h"])
        & (held["_line"] == salted["_line"])
        & (held["_salt"] == salted["_salt"]),
    )

    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    base = told.select(*same, *figures, F.lit(1).alias("_row"), F.lit(0).cast("long").alias("_removed"))
    removed = met.select(
        *same,
        *[F.lit(0).cast("long").alias(c) for c in figures],
        F.lit(0).alias("_row"),
        F.col("_n").alias("_removed"),
    )
    whole = (
        base.unionByName(removed)
        .groupBy(*same)
        .agg(
            *[F.max(c).alias(c) for c in figures],
            F.sum("_row").alias("_copies"),
            (F.sum("_removed") / F.sum("_row")).cast("long").alias("n_removed_words"),
        )
    )
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    enough = (left >= limits.min_words) & (100 * left >= limits.min_percent * F.col("n_words"))
    out = whole.select(
        F.col("_key").alias(key),
        *figures,
        "n_removed_words",
        failed.alias("base_failed"),
        (~failed & enough).alias("kept"),
        "_copies",
    )
    return one_row_each(out, "_copies")


def drop_rejected(
    docs: DataFrame, limits: LineLimits = LineLimits(), *, key="doc_id", host="source", text="text"
) -> DataFrame:
    """The rows of the documents that are kept, all columns as they were.

    Rows are matched on key, host and text, NULLs included.
    """
    # verdicts per key and text; equal rows have equal verdicts
    content = F.xxhash64(F.col(f"`{text}`"), F.col(f"`{text}`").isNull())
    mark = F.struct(F.col(f"`{key}`").alias("k"), content.alias("t"), F.col(f"`{host}`").alias("h"))
    verdicts = line_quality(
        docs.select(mark.alias("_id"), F.col(f"`{host}`").alias("_h"), F.col(f"`{text}`").alias("_x")),
        limits,
        key="_id",
        host="_h",
        text="_x",
    ).where("kept").select("_id").distinct()
    return docs.join(verdicts, mark.eqNullSafe(F.col("_id")), "left_semi")
