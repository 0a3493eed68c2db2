"""Table specs: what a keyed table is made of, and the JSON documents they are loaded from."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import DataFrame

from tidemark.functions import envelope
from tidemark.operators.merge import LATEST_WINS, POLICIES, MergeRule


# What a batch whose columns differ from the table's does.
KEEP, ADD, FAIL = "keep", "add", "fail"


class TableType(str, Enum):
    COPY_ON_WRITE = "COPY_ON_WRITE"
    MERGE_ON_READ = "MERGE_ON_READ"


@dataclass(frozen=True)
class TableSpec:
    """One source table and the keyed table it is merged into.

    ``stable_partition`` promises that a key never changes its partition. Without that promise, and with
    partition columns outside the key, an upsert looks up where its keys are stored.

    A merge-on-read table is compacted once ``compact_after`` batches wait to be merged. Files that none of
    the last ``kept_commits`` commits needs are deleted after a commit. A deleted key stays flagged for
    ``deletes_kept_days``, as long as the change feed is kept, so that no late change brings it back.

    A batch that lacks columns of the table leaves their stored values (``missing_columns`` "keep"), and unknown
    columns are added to the table (``new_columns`` "add"); with "fail" such a batch is refused. Both are logged.
    """

    name: str
    keys: tuple[str, ...]
    ordering: str = envelope.SEQUENCE
    delete_flag: str = envelope.DELETED
    partition_by: tuple[str, ...] = ()
    table_type: TableType = TableType.COPY_ON_WRITE
    policy: str = LATEST_WINS
    stable_partition: bool = False
    compact_after: int = 5
    kept_commits: int = 5
    deletes_kept_days: int | None = 8
    missing_columns: str = KEEP
    new_columns: str = ADD
    target_name: str | None = None
    enabled: bool = True
    transformer_sql: str | None = None
    transformer: Callable[[DataFrame], DataFrame] | None = None
    jdbc: Mapping[str, str] = field(default_factory=dict)
    stage_conf: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def __post_init__(self):
        if not self.keys:
            raise ValueError(f"{self.name}: a keyed table needs at least one key column")
        if len(set(self.keys)) != len(self.keys):
            raise ValueError(f"{self.name}: key columns repeat: {self.keys}")
        if self.ordering in self.keys:
            raise ValueError(f"{self.name}: the ordering column {self.ordering} cannot be a key")
        if self.policy not in POLICIES:
            raise ValueError(f"{self.name}: policy must be one of {POLICIES}")
        if self.missing_columns not in (KEEP, FAIL) or self.new_columns not in (ADD, FAIL):
            raise ValueError(f"{self.name}: missing_columns is {KEEP} or {FAIL}, new_columns {ADD} or {FAIL}")

    @property
    def moves_partitions(self) -> bool:
        """Whether a key may turn up in another partition than the one it is stored in."""
        return not self.stable_partition and not set(self.partition_by) <= set(self.keys)

    @property
    def rule(self) -> MergeRule:
        return MergeRule(self.keys, self.ordering, self.delete_flag, self.policy, self.partition_by)

    def source_folder(self, database: str) -> str:
        """Where the raw zone keeps this table, always by its source name."""
        return f"{database}/{self.name.replace('.', '/')}"

    def target(self, prefix: str) -> str:
        """Name of the keyed table."""
        return self.target_name or f"{prefix}_{self.name.replace('.', '_')}"


# Prefixes and field names of the config documents.
SYSTEM_STEP = "step::system::"
CUSTOM_STEP = "step::{name}::"
DATABASE_ITEM = "database::config"
MERGE_SECTION = "hudi_config"
UPSERT = "UPSERT"


def _names(text: str) -> tuple[str, ...]:
    return tuple(name.strip() for name in text.split(",") if name.strip())


def resolve(path: str) -> Callable:
    """``package.module:function`` to the function."""
    module, _, attribute = path.partition(":")
    if not attribute:
        raise ValueError(f"expected package.module:function, not {path!r}")
    return getattr(importlib.import_module(module), attribute)


def spec_from_item(item: Mapping) -> TableSpec:
    """One ``step::system::<table>`` document to a spec."""
    merge = item[MERGE_SECTION]
    name = item["config"].removeprefix(SYSTEM_STEP)
    partitioned = merge.get("is_partitioned", False)
    if partitioned and not merge.get("partition_path"):
        raise ValueError(f"{name}: is_partitioned needs partition_path")
    if merge.get("op", UPSERT).upper() != UPSERT:
        raise ValueError(f"{name}: later batches are merged; op may only be {UPSERT}, seeding inserts in bulk")
    # an SQL transformer names its class too; the SQL text alone says what to do
    transformer = merge.get("transformer_class") if "transformer_sql" not in merge else None
    return TableSpec(
        name=name,
        keys=_names(merge["primary_key"]),
        ordering=merge.get("watermark", envelope.SEQUENCE),
        partition_by=_names(merge["partition_path"]) if partitioned else (),
        table_type=TableType(merge.get("table_type", TableType.COPY_ON_WRITE)),
        target_name=item.get("override_target_table_name"),
        enabled=item.get("enabled") is True,
        transformer_sql=merge.get("transformer_sql"),
        transformer=resolve(transformer) if transformer else None,
        jdbc=dict(item.get("spark_jdbc_config", {})),
        stage_conf={stage: dict(conf) for stage, conf in item.get("spark_conf", {}).items()},
    )


def load_specs(items: Iterable[Mapping] | str) -> dict[str, TableSpec]:
    """All enabled tables of a config document (a list of items, or its JSON text), by source name."""
    documents = json.loads(items) if isinstance(items, str) else items
    specs = [spec_from_item(i) for i in documents if i["config"].startswith(SYSTEM_STEP)]
    return {spec.name: spec for spec in specs if spec.enabled}
