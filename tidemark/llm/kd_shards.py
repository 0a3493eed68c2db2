"""K-d tree partitioning: shards of equal bytes, each a box of the metadata space.

A node is cut at the weighted median (weight: bytes) along the metadata dimension in which its bytes spread widest,
and its halves are cut in turn until the leaves reach the target. A median is found digit by digit: bytes are summed
per digit of the ordering key of all rows that share the digits found so far, so one round reads back a row per node.
Rows and texts stay where they are; only DataFrame functions are used.

Equal texts share their coordinates and their place in the order (a hash of the text breaks ties of a coordinate), so
a cut goes between two texts, to the side that leaves the smaller error. Only where the copies of one text weigh over
``1 / KEEP_TOGETHER`` of a shard a cut may go through them, by a hash of the row.

Null texts are empty ones, null metadata is a coordinate of its own, rows that repeat are rows of their own, an empty
table has no shards. Columns other than those named are left out.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep

KEEP_TOGETHER = 64
#: rows numbered by one task; bounded together with the number of such groups
ROWS_PER_GROUP, MOST_GROUPS = 2000, 65_536
_SPAN, _TIES = 12, 36  # bits of a coordinate, and of the hash behind it in an ordering key
_DIGITS = (16, 16, 16)
_LAST = 2**63 - 1


def metadata(documents: DataFrame) -> DataFrame:
    """row, doc_id, size, text_crc32 and the text's hash; lang and source as of the first copy of the text."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    ).withColumn("row", F.monotonically_increasing_id())


def _place(value: Column) -> Column:
    return F.when(value.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(value), F.lit(2**_SPAN))).cast("long")


def points(meta: DataFrame) -> DataFrame:
    """The rows with their coordinates: logarithm of the size, source and language."""
    first = meta.groupBy("text_hash").agg(F.min("lang").alias("lang"), F.min("source").alias("source"))
    rows = meta.drop("lang", "source").join(first, "text_hash")
    size = F.least(F.log2("size") / 40 * 2**_SPAN, F.lit(2**_SPAN - 1)).cast("long")
    at = F.array(size, _place(F.col("source")), _place(F.col("lang")))
    return rows.select("row", "doc_id", "size", "text_crc32", "text_hash", at.alias("at"))


def _as_frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """Some rows as a frame; they come as an Arrow table, as lists of tuples would pass through Python workers."""
    types = {"long": pa.int64(), "int": pa.int32()}
    fields = [pa.field(name, types[kind]) for name, kind in (c.split() for c in schema.split(", "))]
    columns = zip(*rows) if rows else [()] * len(fields)
    return F.broadcast(spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))))


def _medians(rows: DataFrame, wants: dict[int, int]) -> dict[int, tuple[int, int, int]]:
    """Of each node: the key at which the running bytes reach what is wanted, the bytes below that key and at it.

    rows: node, key, size. A node's sums are one list of at most 2^16 entries.
    """
    spark = rows.sparkSession
    found = {node: (0, 0, 0) for node in wants}
    rest = sum(_DIGITS)
    for bits in _DIGITS:
        rest -= bits
        known = _as_frame(spark, [(n, k, b, wants[n]) for n, (k, b, _) in found.items()], "node long, known long, below long, want long")
        digit = F.shiftright("key", rest)
        sums = (
            rows.join(known, "node")
            .where(F.shiftright(digit, bits) == F.col("known"))
            .groupBy("node", digit.alias("digit"))
            .agg(F.sum("size").alias("bytes"), F.first("below").alias("below"), F.first("want").alias("want"))
            .groupBy("node")
            .agg(F.sort_array(F.collect_list(F.struct("digit", "bytes"))).alias("sums"), F.first("below").alias("below"), F.first("want").alias("want"))
        )
        nothing = F.struct(F.lit(-1).cast("long").alias("digit"), F.lit(0).cast("long").alias("bytes"), F.col("below").alias("upto"))

        def step(s: Column, x: Column) -> Column:
            more = F.struct(x["digit"].alias("digit"), x["bytes"].alias("bytes"), (s["upto"] + x["bytes"]).alias("upto"))
            return F.when(s["upto"] >= F.col("want"), s).otherwise(more)

        hit = sums.select("node", F.aggregate("sums", nothing, step).alias("x")).select("node", "x.*")
        found = {r["node"]: (r["digit"], r["upto"] - r["bytes"], r["bytes"]) for r in hit.collect()}
    return found


def _split(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows moved to the child nodes 2n and 2n + 1; rows of nodes without a cut stay."""
    key = _key(F.col("axis"))
    left = (key < F.col("cut")) | ((key == F.col("cut")) & (_row_key() <= F.col("row_cut")))
    node = F.when(F.col("axis").isNull(), F.col("node")).when(left, F.col("node") * 2).otherwise(F.col("node") * 2 + 1)
    return rows.join(cuts, "node", "left").withColumn("node", node).drop("axis", "cut", "row_cut")


def _key(axis: Column) -> Column:
    return F.shiftleft(F.element_at("at", axis), _TIES).bitwiseOR(F.shiftrightunsigned("text_hash", 64 - _TIES))


def _row_key() -> Column:
    return F.shiftrightunsigned(F.xxhash64("row"), 64 - _SPAN - _TIES)


def kd_shards(rows: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Rows of ``points`` with ``shard``, from 0: so many shards, or as many as the target needs."""
    spark = rows.sparkSession
    total = rows.agg(F.sum("size")).first()[0] or 0
    shards = shards or max(1, -(-total // target_bytes))
    tolerance = max(1, total // shards // KEEP_TOGETHER)
    rows, leaves = rows.withColumn("node", F.lit(1).cast("long")), {1: shards}
    while any(n > 1 for n in leaves.values()) and total:
        spread = [F.sum(F.col("size") * F.element_at("at", i)).alias(f"x{i}") for i in (1, 2, 3)]
        squares = [F.sum(F.col("size") * F.pow(F.element_at("at", i).cast("double"), 2)).alias(f"y{i}") for i in (1, 2, 3)]
        stats = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *spread, *squares).collect()}
        axes, wants = {}, {}
        for node, n in leaves.items():
            if n > 1 and node in stats:
                r = stats[node]
                width = {i: r[f"y{i}"] / r["bytes"] - (r[f"x{i}"] / r["bytes"]) ** 2 for i in (1, 2, 3)}
                axes[node] = max(width, key=width.get)
                wants[node] = max(1, r["bytes"] * (n // 2) // n)
        if not axes:
            break
        chosen = _as_frame(spark, list(axes.items()), "node long, axis int")
        found = _medians(rows.join(chosen, "node").select("node", _key(F.col("axis")).alias("key"), "size"), wants)
        row_cuts, through = {}, {}
        for node, (cut, below, at) in found.items():
            row_cuts[node] = _LAST if wants[node] - below > at / 2 else -1
            if at > tolerance:
                through[node] = wants[node] - below
        if through:
            cuts = _as_frame(spark, [(n, axes[n], found[n][0]) for n in through], "node long, axis int, cut long")
            copies = rows.join(cuts, "node").where(_key(F.col("axis")) == F.col("cut")).select("node", _row_key().alias("key"), "size")
            row_cuts |= {n: cut for n, (cut, _, _) in _medians(copies, through).items()}
        cuts = [(n, axes[n], found[n][0], row_cuts[n]) for n in axes]
        rows = _split(rows, _as_frame(spark, cuts, "node long, axis int, cut long, row_cut long"))
        leaves = {k: v for n, m in leaves.items() for k, v in ({2 * n: m // 2, 2 * n + 1: m - m // 2} if n in axes else {n: m}).items()}
    # leaves from left to right: a node's path below the root, as a fraction
    order = sorted(leaves, key=lambda n: (n - 2 ** (n.bit_length() - 1)) / 2 ** (n.bit_length() - 1))
    numbers = _as_frame(spark, [(n, i) for i, n in enumerate(order)], "node long, shard int")
    return rows.join(numbers, "node").drop("node")


def with_slots(rows: DataFrame, n_rows: int) -> DataFrame:
    """``slot``: each shard's rows numbered without gaps, by groups of rows whose sizes are added up first."""
    groups = max(1, min(MOST_GROUPS, -(-n_rows // ROWS_PER_GROUP)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(groups)))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row"))
    return rows.withColumn("inside", inside).join(F.broadcast(bases), ["shard", "part"]).withColumn("slot", (F.col("base") + F.col("inside") - 1).cast("long"))


def shard_documents(documents: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of all documents."""
    placed = keep(points(keep(metadata(documents), "kd-rows")), "kd-points")
    n_rows = placed.count()
    sharded = with_slots(kd_shards(placed, shards, target_bytes), n_rows)
    return sharded.select("doc_id", "size", "text_crc32", "shard", "slot")
