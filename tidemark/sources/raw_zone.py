"""Readers of the raw zone: full extracts, change files in dated folders, and table discovery."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.schemas import merged_schema
from tidemark.tables import storage

# Zones, catalog prefixes and folders left out of discovery.
FULL, INCREMENTAL = "full", "incremental"
PREFIXES = {FULL: "full_", INCREMENTAL: "incr_"}
EXCLUDED_FOLDERS = ("control_tables",)


def raw_folder(root: str, zone: str, source_folder: str) -> str:
    return f"{root.rstrip('/')}/{zone}/{source_folder}"


def read_extract(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(folder)


def read_changes(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """All change files below a folder, whatever its sub-folders (days, physical partitions) are called."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("recursiveFileLookup", True).parquet(folder)


def stream_changes(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """The same files as a stream: each file is read once per checkpoint."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(folder)


def with_provenance(rows: DataFrame, **tags: str) -> DataFrame:
    """Constant source tags per row and, for rows read from files, the file they came from."""
    return rows.select(
        "*", *[F.lit(v).alias(k) for k, v in tags.items()], F.col("_metadata.file_name").alias("source_file")
    )


def matches(table_name: Column, pattern: str, schema: str | None = None, schema_name: Column | None = None) -> Column:
    """Selection rule: ``%`` stands for any text, all else for itself; schema and table must both match."""
    chosen = table_name.like(_like(pattern))
    return chosen if schema is None else chosen & schema_name.like(_like(schema))


def _like(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("_", "\\_")


def selects(name: str, pattern: str) -> bool:
    """The same rule for one name, for lists of tables."""
    return re.fullmatch(".*".join(re.escape(piece) for piece in pattern.split("%")), name) is not None


@dataclass(frozen=True)
class RawTable:
    name: str
    folder: str
    zone: str
    schema: T.StructType


def discover(
    spark: SparkSession, root: str, zone: str, pattern: str = "%", merge_files: int | None = None
) -> list[RawTable]:
    """One table per ``<database>/<schema>/<table>`` folder of a zone, its schema from its newest file's footer.

    Only folder names and one footer per table are read; marker files and control tables are skipped. Folders
    without a file are no tables. With ``merge_files``, the schema is the common one of that many files, from the first to the
    last.
    """
    base = f"{root.rstrip('/')}/{zone}"
    found = []
    for database in storage.folders(spark, base):
        for schema in storage.folders(spark, f"{base}/{database}"):
            if schema in EXCLUDED_FOLDERS:
                continue
            for table in storage.folders(spark, f"{base}/{database}/{schema}"):
                if selects(table, pattern):
                    folder = f"{base}/{database}/{schema}/{table}"
                    newest = _last_file(spark, folder)
                    if newest:
                        name = f"{PREFIXES[zone]}{database}_{schema}_{table}"
                        kinds = merged_schema(spark, folder, merge_files) if merge_files else spark.read.parquet(newest).schema
                        found.append(RawTable(name, folder, zone, kinds))
    return found


def _last_file(spark: SparkSession, folder: str) -> str | None:
    """A data file below the folder, from the last sub-folder (the newest day) that has one."""
    names = storage.children(spark, folder)
    files = [n for n in names if n.endswith(".parquet")]
    if files and not storage.is_folder(spark, f"{folder}/{files[-1]}"):
        return f"{folder}/{files[-1]}"
    for name in reversed(names):
        if storage.is_folder(spark, f"{folder}/{name}") and (found := _last_file(spark, f"{folder}/{name}")):
            return found
    return None


def register(spark: SparkSession, table: RawTable, database: str) -> str:
    """A catalog entry on the raw files, without copying them. An entry of that name on another folder is an error."""
    name = f"`{database}`.`{table.name}`"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"OPTIONS ('recursiveFileLookup' = 'true') LOCATION '{table.folder}'"
    )
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    if storage.plain(spark, described["data_type"]) != storage.plain(spark, table.folder):
        raise ValueError(f"{name} is registered on {described['data_type']}, not on {table.folder}")
    return name
