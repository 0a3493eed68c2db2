"""Token ids of documents in ORC files.

ORC keeps a column in stripes; inside a stripe integers are run-length encoded (direct, delta or patched runs, two
bytes for most ids here) and every few rows have an index entry with minimum, maximum and a Bloom filter of the
document id. Readers split files by stripes, and a lookup of some documents reads only the row groups that may hold
them.

Null texts count as empty ones. Rows that share a doc_id all stay; rows without one come first. An empty table gives
files without rows. Columns other than doc_id and text are left out, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, keep, slices
from tidemark.llm.encoding import ENCODED_TOGETHER, closed, encoder

STRIPE_BYTES = 32 << 20
ROWS_PER_INDEX = 1000


def encode_documents(documents: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id and ids (array of int, ``end_id`` last) of each document; order and partitions stay."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, limit=ENCODED_TOGETHER):
            ids, begins = closed(*encoder(tokenizer).encode(rows["text"]), end_id)
            lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.record_batch({"doc_id": rows["doc_id"], "ids": lists})

    key = documents.schema["doc_id"].dataType.simpleString()
    return in_arrow(documents.select("doc_id", "text"), encode, f"doc_id {key}, ids array<int>")


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int, files: int | None = None) -> None:
    """Encodes all documents into ORC files whose names and rows ascend by doc_id."""
    files = files or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = documents.select("doc_id", "text").repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
    (
        encode_documents(ordered, tokenizer, end_id)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", ROWS_PER_INDEX)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents of a token store; with ``doc_ids``, row groups that cannot hold them are not read."""
    rows = spark.read.schema("doc_id long, ids array<int>").orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(list(doc_ids)))


def digests(tokens: DataFrame) -> DataFrame:
    """Per document of a token store: start (ids of all documents before it), n_tokens and ids_crc32.

    Starts are counted per file and then over the files, so that no task sees more than one file's documents.
    Rows that share a doc_id are counted by crc.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            lists = rows["ids"]
            begins = lists.offsets.to_numpy(zero_copy_only=False)
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            view = memoryview(ids).cast("B") if len(ids) else memoryview(b"")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]
            yield pa.record_batch(
                {
                    "file": rows["file"],
                    "doc_id": rows["doc_id"],
                    "n_tokens": pa.array(np.diff(begins), pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )

    rows = tokens.withColumn("file", F.col("_metadata.file_name")).select("file", "doc_id", "ids")
    rows = keep(in_arrow(rows, digest, "file string, doc_id long, n_tokens long, ids_crc32 long"), "digests")
    by_file = rows.groupBy("file").agg(F.sum("n_tokens").alias("in_file"), F.min("doc_id").alias("least"))
    before = Window.orderBy(F.col("least").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_file.select("file", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first(), "ids_crc32", "n_tokens")
    start = F.col("base") + F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    return rows.join(F.broadcast(bases), "file").select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")
