"""The stages that keep a lake current, in the order they are run: load, seed, then incremental or continuous,
then derived tables. Each is one call; when to call it is up to the scheduler in use."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.envelope import full_load_envelope
from tidemark.sinks.landing import land_full_extract
from tidemark.sources.jdbc import read_table
from tidemark.sources.raw_zone import FULL, INCREMENTAL, raw_folder, read_extract
from tidemark.spec import CUSTOM_STEP, TableSpec, resolve
from tidemark.streaming.upsert import (
    SEED_STAGE,
    Feed,
    run_continuously,
    run_once,
    seed_from_extract,
    session_for,
)
from tidemark.tables.catalog import sync_table
from tidemark.tables.lake_table import LakeTable

# The stage that copies a source table to the raw zone.
LOAD_STAGE = "load"


@dataclass(frozen=True)
class Lake:
    """Folders of the raw and the keyed zone, the source database and the prefix of keyed tables.

    With a ``catalog`` database, every stage that writes a keyed table brings its catalog entry up to date.
    """

    raw: str
    keyed: str
    database: str
    prefix: str
    catalog: str | None = None

    def publish(self, table: LakeTable) -> None:
        if self.catalog:
            sync_table(table, self.catalog, table.spec.target(self.prefix))

    def extract(self, spec: TableSpec) -> str:
        return raw_folder(self.raw, FULL, spec.source_folder(self.database))

    def changes(self, spec: TableSpec) -> str:
        return raw_folder(self.raw, INCREMENTAL, spec.source_folder(self.database))

    def path(self, spec: TableSpec) -> str:
        return f"{self.keyed}/{spec.target(self.prefix)}"

    def table(self, spark: SparkSession, spec: TableSpec) -> LakeTable:
        return LakeTable(spark, self.path(spec), spec)

    def feed(self, spark: SparkSession, spec: TableSpec, **options) -> Feed:
        """The change feed of a table: its files have the columns of the full extract."""
        schema = read_extract(spark, self.extract(spec)).schema
        # next to the table, not inside it
        checkpoint = f"{self.keyed}/_checkpoints/{spec.target(self.prefix)}"
        options = {"after_batch": self.publish, **options}
        return Feed(spec, self.changes(spec), schema, self.path(spec), checkpoint, **options)


def load_full(
    spark: SparkSession, lake: Lake, spec: TableSpec, url: str, login: Mapping[str, str], started: datetime
) -> None:
    """Copy one table from its database to the raw zone. ``started`` must lie before the first row is read."""
    spark = session_for(spark, spec, LOAD_STAGE)
    source = read_table(spark, spec.name, url, {**spec.jdbc, **login})
    land_full_extract(full_load_envelope(source, started), lake.extract(spec))


def seed(spark: SparkSession, lake: Lake, spec: TableSpec, replace: bool = False) -> LakeTable:
    spark = session_for(spark, spec, SEED_STAGE)
    table = seed_from_extract(spark, spec, lake.extract(spec), lake.path(spec), replace=replace)
    lake.publish(table)
    return table


def incremental(spark: SparkSession, lake: Lake, specs: Iterable[TableSpec], **options) -> None:
    """Apply what landed since the last run, all tables side by side."""
    run_once(spark, [lake.feed(spark, spec, **options) for spec in specs])


def continuous(spark: SparkSession, lake: Lake, specs: Iterable[TableSpec], **options) -> list[StreamingQuery]:
    return run_continuously(spark, [lake.feed(spark, spec) for spec in specs], **options)


def run_custom_steps(spark: SparkSession, items: Iterable[Mapping], name: str) -> dict[str, object]:
    """Run the enabled ``step::<name>::…`` documents in their order. The entry point is a function
    ``package.module:function`` that takes the session and the remaining arguments."""
    results = {}
    prefix = CUSTOM_STEP.format(name=name)
    for item in items:
        if item["config"].startswith(prefix) and item.get("enabled") is True:
            function, *arguments = item["entrypoint"]
            results[item["config"].removeprefix(prefix)] = resolve(function)(spark, *arguments)
    return results
