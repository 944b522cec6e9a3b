"""Token ids of documents in ORC files, in key order, read back by stripe, key or position.

Documents are range-partitioned and sorted by key, encoded in their tasks and written as ORC:
one file per task, integers run-length encoded, a row index per ``layout.stride`` documents,
Bloom filters on the key. Each row carries its file's number and the ids before it in that
file, so one small table with a row per file turns these into positions in the whole corpus,
and no row moves for it.

Readers split files at stripes, read the columns they name, and skip row groups whose index
or Bloom filter rules the wanted keys, or the wanted span, out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanbook.llm.token_ids import WIDTH, token_table

#: Bytes of ids in one batch of rows that a task hands on.
BATCH_BYTES = 4_000_000


@dataclass(frozen=True)
class OrcLayout:
    """How files are cut and indexed; a row group has ``stride`` documents (1,000 at least)."""

    stripe_bytes: int = 16 << 20
    stride: int = 1_000
    compress: str = "ZSTD"
    false_positives: float = 0.01

    def options(self, key: str) -> dict[str, str]:
        return {
            "compression": self.compress.lower(),
            "orc.stripe.size": str(self.stripe_bytes),
            "orc.create.index": "true",
            "orc.row.index.stride": str(self.stride),
            "orc.bloom.filter.columns": key,
            "orc.bloom.filter.fpp": str(self.false_positives),
        }


def _encoder(tokenizer_path: str, end_id: int):
    """A task's rows: part, before, key, n_tokens, ids; keys keep their type and order."""
    end = end_id.to_bytes(WIDTH, "little")

    def batch(part: int, before: int, keys: pa.Array, buffers: list[bytes]) -> pa.RecordBatch:
        lengths = np.fromiter((len(b) // WIDTH for b in buffers), np.int64, len(buffers))
        ends = np.cumsum(lengths)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        ids = np.frombuffer(b"".join(buffers), "<u4").astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(buffers), part, np.int32)),
                pa.array(before + ends - lengths),
                keys,
                pa.array(lengths.astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
            ],
            names=["part", "before", "_k", "n_tokens", "ids"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(tokenizer_path)
        part, before = TaskContext.get().partitionId(), 0
        for rows in batches:
            first, size, buffers = 0, 0, []
            for row, text in enumerate(rows.column(1), 1):
                buffers.append(table.of(text.as_py() or "") + end)
                size += len(buffers[-1])
                if size >= BATCH_BYTES or row == rows.num_rows:
                    yield batch(part, before, rows.column(0).slice(first, row - first), buffers)
                    before += size // WIDTH
                    first, size, buffers = row, 0, []

    return run


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    *,
    key: str = "doc_id",
    text: str = "text",
    layout: OrcLayout = OrcLayout(),
) -> None:
    """Write the ids of every document and ``end_id`` to ``folder``, in ascending key order.

    ``folder/tokens`` has part, before (ids before it in the part), the key, n_tokens and ids;
    ``folder/files`` one row per part: start (ids before it in the corpus), n_tokens, n_docs,
    first_key, last_key. Keys of any type that sorts; a NULL key comes first, a NULL text is
    empty. Rows of one key follow each other by a hash of the text; rows that repeat are
    documents of their own, and are dealt to several parts where they are many. Other columns
    are left out. An empty table gives files without rows.
    """
    told = docs.select(
        F.col(f"`{key}`").alias("_k"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_x"),
    ).withColumns({"_h": F.xxhash64("_x"), "_n": F.monotonically_increasing_id()})
    order = [F.col("_k").asc_nulls_first(), "_h", "_n"]
    sorted_docs = told.repartitionByRange(*order).sortWithinPartitions(*order).select("_k", "_x")
    kind = dict(told.dtypes)["_k"]
    schema = f"part int, before bigint, _k {kind}, n_tokens int, ids array<int>"
    encoded = sorted_docs.mapInArrow(_encoder(tokenizer_path, end_id), schema)
    named = encoded.withColumnRenamed("_k", key)
    named.write.options(**layout.options(key)).orc(f"{folder}/tokens")

    rows = docs.sparkSession.read.schema(named.schema).orc(f"{folder}/tokens")
    # A file's rows are in key order, so its least and greatest position hold its end keys.
    files = rows.groupBy("part").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.count("*").alias("n_docs"),
        F.min_by(F.col(f"`{key}`"), "before").alias("first_key"),
        F.max_by(F.col(f"`{key}`"), "before").alias("last_key"),
    )
    # One row per file, so the window holds as many rows as there are files.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0).cast("bigint"))
    files.select("part", start.alias("start"), "n_tokens", "n_docs", "first_key", "last_key").write.orc(
        f"{folder}/files"
    )


def _tokens(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.orc(f"{folder}/tokens")


def _placed(rows: DataFrame, folder: str) -> DataFrame:
    """Rows with ``start`` in place of part and before."""
    files = rows.sparkSession.read.orc(f"{folder}/files").select("part", F.col("start").alias("_start"))
    kept = [f"`{c}`" for c in rows.columns if c not in ("part", "before")]
    # A row of two numbers per file: a bound that the files set, not the documents.
    return rows.join(F.broadcast(files), "part").select((F.col("_start") + F.col("before")).alias("start"), *kept)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents: start (ids before it in the corpus), key, n_tokens, ids."""
    return _placed(_tokens(spark, folder), folder)


def read_documents(spark: SparkSession, folder: str, keys: Sequence, *, key: str = "doc_id") -> DataFrame:
    """The documents of the given keys; row groups without them are skipped by index and Bloom filter."""
    return _placed(_tokens(spark, folder).where(F.col(f"`{key}`").isin(*keys)), folder)


def read_span(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """The documents that hold a position from ``first`` up to ``last`` (not included).

    The span is turned into parts and positions in them before the scan, so files and row
    groups outside it are skipped by their index.
    """
    files = spark.read.orc(f"{folder}/files")
    reached = files.where((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))
    # The span's end parts, and where in them it begins and ends: one row.
    ends = reached.agg(
        F.min("part"), F.min_by(F.lit(first) - F.col("start"), "part"),
        F.max("part"), F.max_by(F.lit(last) - F.col("start"), "part"),
    ).first()
    low, skip, high, stop = ends if ends[0] is not None else (0, 0, -1, 0)
    part, before = F.col("part"), F.col("before")
    inside = part.between(low, high) & ((part < high) | (before < stop))
    reaches = (part > low) | (before + F.col("n_tokens") > skip)
    return _placed(_tokens(spark, folder).where(inside & reaches), folder)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        ids = rows.column(rows.num_columns - 1)
        flat = memoryview(ids.values.to_numpy().astype("<u4", copy=False)).cast("B")
        cuts = (np.asarray(ids.offsets) * WIDTH).tolist()
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(cuts, cuts[1:])]
        kept = rows.columns[:-1]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(crc, pa.int64())], names=[*rows.schema.names[:-1], "ids_crc32"])


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: key, start, n_tokens, ids_crc32 (of little-endian 32-bit ids)."""
    rows = _tokens(spark, folder)
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "ids")
    summed = rows.mapInArrow(_checksums, f"{kinds}, ids_crc32 bigint")
    keys = [c for c in rows.columns if c not in ("part", "before", "n_tokens", "ids")]
    return _placed(summed, folder).select(
        *[f"`{c}`" for c in keys], "start", F.col("n_tokens").cast("bigint").alias("n_tokens"), "ids_crc32"
    )
