"""Catalog entries of keyed tables: a table over the current files, a view of its live rows, lineage."""

from __future__ import annotations

import json
from collections.abc import Collection, Iterable, Mapping, Sequence
from itertools import islice

from pyspark.sql import DataFrame, SparkSession

from tidemark.tables.lake_table import BASE, VERSION, LakeTable

# The table property that lists source tables.
LINEAGE = "Lineage"
SOURCE_TABLES = "SourceTables"

_PER_STATEMENT = 200


def _chunks(items: Iterable, size: int):
    iterator = iter(items)
    while chunk := list(islice(iterator, size)):
        yield chunk


def _partition_clause(spark: SparkSession, name: str) -> str:
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    pairs = [piece.split("=", 1) for piece in name.split("/")]
    values = [f"`{unescape(c)}` = '" + unescape(v).replace("'", "\\'") + "'" for c, v in pairs]
    return f"PARTITION ({', '.join(values)})"


def create_database(spark: SparkSession, database: str, folder: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{folder}'")


def sync_table(table: LakeTable, database: str, name: str, compact: bool = True) -> tuple[str, str]:
    """Register the files of the last commit and a view of the live rows; returns (files table, view).

    Only partitions whose folder changed since the last sync are altered, and an entry is never dropped, so
    readers always find one. The view shows base files: a merge-on-read table is compacted first, so that the view
    equals ``LakeTable.snapshot``. With ``compact=False`` its pending changes show up after the next compaction.
    """
    if compact and any(part.pending for part in table.state().parts.values()):
        table.compact()
    spark, state = table.spark, table.state()
    files, view = f"`{database}`.`{name}_files`", f"`{database}`.`{name}`"
    partition_by = table.spec.partition_by
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.struct())
    if not partition_by:
        version = next((p.base for p in state.parts.values() if p.base), state.instant)
        location = f"LOCATION '{table.path}/{BASE}/{VERSION}={version}'"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {files} ({columns}) USING parquet {location}")
        _add_columns(spark, files, state)
        spark.sql(f"ALTER TABLE {files} SET {location}")
        spark.catalog.refreshTable(files)
    else:
        by = ", ".join(f"`{c}`" for c in partition_by)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {files} ({columns}) USING parquet PARTITIONED BY ({by}) "
            f"LOCATION '{table.path}/{BASE}'"
        )
        _add_columns(spark, files, state)
        _sync_partitions(table, files, state)
    # flagged rows stay in the files, so readers use the view
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {files} "
        f"WHERE NOT coalesce(`{table.spec.delete_flag}`, false)"
    )
    return files, view


def _add_columns(spark: SparkSession, files: str, state) -> None:
    known = set(spark.table(files).columns)
    new = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.struct() if f.name not in known)
    if new:
        spark.sql(f"ALTER TABLE {files} ADD COLUMNS ({new})")


def _sync_partitions(table: LakeTable, files: str, state) -> None:
    spark = table.spark
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {files}").collect()}
    synced = int(properties.get("tidemark.commit", "0"))
    before = table.log.read(synced).parts if synced in table.log.numbers() else {}
    # without the commit of the last sync (cleaned or never synced), every partition is set again
    known = set(before)
    if not before:
        known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {files}").collect()}
    moved = [n for n, p in state.parts.items() if p.base and (n not in before or before[n].base != p.base)]
    places = {n: f"{table.path}/{BASE}/{VERSION}={state.parts[n].base}/{n}" for n in moved}
    place_partitions(spark, files, {_partition_clause(spark, n): f for n, f in places.items()}, {_partition_clause(spark, n) for n in known})
    for chunk in _chunks(sorted(known - set(state.parts)), _PER_STATEMENT):
        clauses = ", ".join(_partition_clause(spark, n) for n in chunk)
        spark.sql(f"ALTER TABLE {files} DROP IF EXISTS {clauses}")
    spark.sql(f"ALTER TABLE {files} SET TBLPROPERTIES ('tidemark.commit' = '{state.number}')")


def place_partitions(spark: SparkSession, table: str, places: Mapping[str, str], known: Collection[str]) -> None:
    """Point partitions (by their clause) at folders. One that is known moves in place: no reader misses its rows."""
    for chunk in _chunks([c for c in places if c not in known], _PER_STATEMENT):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"{c} LOCATION '{places[c]}'" for c in chunk))
    for clause in places:
        if clause in known:
            spark.sql(f"ALTER TABLE {table} {clause} SET LOCATION '{places[clause]}'")
    spark.catalog.refreshTable(table)


def set_lineage(spark: SparkSession, table: str, sources: Sequence[str]) -> None:
    """Store the list of source tables on a derived table."""
    value = json.dumps({SOURCE_TABLES: list(sources)}).replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LINEAGE}' = '{value}')")


def lineage(spark: SparkSession, table: str) -> list[str]:
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return json.loads(properties[LINEAGE])[SOURCE_TABLES] if LINEAGE in properties else []


def lineage_of(rows: DataFrame) -> list[str]:
    """The sources of a result, from the leaves of its analyzed plan: catalog tables by name, files by their folder.

    Views and temporary views are followed to what they read; folders of one data set are named once.
    """
    leaves = rows._jdf.queryExecution().analyzed().collectLeaves()
    found = set()
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            table, relation = leaf.catalogTable(), leaf.relation()
            if table.isDefined():
                found.add(table.get().identifier().unquotedString())
            elif relation.getClass().getSimpleName() == "HadoopFsRelation":
                paths = relation.location().rootPaths()
                found |= {paths.apply(i).toUri().getPath() for i in range(paths.size())}
            elif relation.getClass().getSimpleName() == "JDBCRelation":
                found.add(relation.jdbcOptions().tableOrQuery())
        elif leaf.getClass().getSimpleName() == "HiveTableRelation":
            found.add(leaf.tableMeta().identifier().unquotedString())
    return sorted(found)


def store_lineage(spark: SparkSession, table: str, rows: DataFrame) -> list[str]:
    """Store the sources of ``rows``, from which a derived table is made, on that table."""
    sources = lineage_of(rows)
    set_lineage(spark, table, sources)
    return sources
