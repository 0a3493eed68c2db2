"""What several operators share: staged tables, bounded slices of a batch, words of whole texts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import workspace

SLICE_BYTES = 4 << 20
#: bytes of a batch that Spark hands to a Python worker; a session's own setting is kept if it is lower
BATCH_BYTES = 8 << 20
#: seconds between two times that a task gives back freed memory
GIVEN_BACK_EVERY = 0.5
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows written to the shared folder and read back: the lineage ends, lost executors cost a re-read.

    What was shuffled for them is no longer needed. Spark deletes such files once the driver's collector finds that
    nothing refers to them, so it is asked to look.
    """
    folder = workspace.new_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    gc.collect()  # frames of earlier steps hold plans in the driver's JVM
    give_back()
    rows.sparkSession._jvm.System.gc()
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def ship(spark: SparkSession) -> None:
    """Gives this package's code to the executors, once per application; Spark hands the archive out."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(workspace.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="code-"), "tidemark.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for folder, _, names in os.walk(home):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                file.write(path, os.path.relpath(path, os.path.dirname(home)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(spark.sparkContext.applicationId)


def in_arrow(rows: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with this package's code at hand on every executor; a task gives back what it freed now and then, and at its end."""
    ship(rows.sparkSession)
    _bound_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = time.monotonic()
        for rows in function(batches):
            yield rows
            del rows
            if time.monotonic() - given > GIVEN_BACK_EVERY:
                give_back()
                given = time.monotonic()
        give_back()

    return rows.mapInArrow(run, schema)


def _bound_batches(spark: SparkSession) -> None:
    """Batches are cut by bytes before they reach a worker: ten thousand rows of long texts would not fit beside each other."""
    held = spark.conf.get(_BATCH_SETTING, None)
    if held is None or not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def give_back() -> None:
    """Freed memory to the system: a worker lives on between tasks, and what it keeps others lack."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = size[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def whole(texts: pa.Array) -> pa.Array:
    """Texts with nulls as empty, never a view with an offset."""
    filled = pc.fill_null(texts, "")
    return pa.concat_arrays([filled]) if filled.offset else filled


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text with A-Z lower-cased: all words in a row, and where each text begins."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(whole(texts)))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():  # blank text at the ends of a text shows as an empty word
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        flat = flat.filter(pa.array(full))
    return flat, offsets


def coded(flat: pa.Array) -> tuple[list[str], np.ndarray]:
    """The distinct strings of a row of strings, and for each string its place among them."""
    if not len(flat):
        return [], np.zeros(0, np.int64)
    encoded = flat.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.dictionary.to_numpy(zero_copy_only=False).tolist(), encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct numbers in ascending order, by a sort; ``np.unique`` hashes integers first and takes several times as long."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def term_hashes(names: list[str]) -> np.ndarray:
    """A 64-bit hash of each of several distinct strings."""
    return pd.util.hash_array(np.array(names, dtype=object), categorize=False) if names else np.zeros(0, np.uint64)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of many runs, one run behind the other."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(total)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def wrapped(documents: DataFrame, key: Column) -> DataFrame:
    """The text, ``key`` as ``doc``, and all other columns in ``rest``, out of the way of an operator's own names."""
    others = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    return documents.select(key.alias("doc"), F.struct(*others).alias("rest"), "text")


def unwrapped(rows: DataFrame, documents: DataFrame, recount: bool = False) -> DataFrame:
    """The columns of ``documents`` again. With ``recount``, a number in ``n_chars`` follows the text."""
    columns = []
    for field in documents.schema:
        column = F.col("text") if field.name == "text" else F.col(f"rest.`{field.name}`")
        if recount and field.name == "n_chars" and isinstance(field.dataType, T.IntegralType):
            column = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(column).cast(field.dataType)
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by ``key``, cut so that no group of a key is in two of them; groups must be small."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[key].to_numpy(zero_copy_only=False)
        other = np.flatnonzero(keys != keys[-1])
        if len(other) or (held and held[-1][key][-1] != batch[key][0]):
            cut = int(other[-1]) + 1 if len(other) else 0
            yield pa.concat_batches([*held, batch.slice(0, cut)])
            held = []
            batch = batch.slice(cut)
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def in_order(key: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Order by ``others`` of rows that are sorted by ``key``; only rows that share a key move.

    Spark sorts by one number in a fraction of the time that it takes for several.
    """
    order = np.arange(len(key))
    same = key[1:] == key[:-1]
    shared = np.flatnonzero(np.append(same, False) | np.append(False, same)) if len(key) else order
    order[shared] = shared[np.lexsort((*(x[shared] for x in reversed(others)), key[shared]))]
    return order


_WORDS = 1 << 16


def marked(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows with ``_may_match``: false where the key is surely not in ``ids``.

    A bitmap of 2^16 words of 64 bits is all that is broadcast, whatever the number of ids.
    """
    h = F.xxhash64(key)
    word, bit = F.pmod(h, F.lit(_WORDS)), F.shiftrightunsigned(h, 58).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bitmap = ids.select(word.alias("_word"), one.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    found = rows.withColumn("_word", word).join(F.broadcast(bitmap), "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(one) != 0, F.lit(False))
    return found.withColumn("_may_match", hit).drop("_word", "_bits")


def matching(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``ids`` (one column of that name); texts of other rows are hardly ever shuffled."""
    return marked(rows, ids, key).where("_may_match").drop("_may_match").join(ids.select(key).distinct(), key, "left_semi")


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``ids``."""
    judged = marked(rows, ids, key)
    sure = judged.where("not _may_match").drop("_may_match")
    return sure.unionByName(judged.where("_may_match").drop("_may_match").join(ids.select(key).distinct(), key, "left_anti"))
