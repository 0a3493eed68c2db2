"""Merge changes into stored rows by key, as DataFrame to DataFrame functions.

Both sides hold a key at most once (see ``precombine``). A winning delete leaves a flagged row with keys,
ordering and no payload, so that a late older change cannot bring the row back.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LATEST_WINS = "latest_wins"
INCOMING_WINS = "incoming_wins"
POLICIES = (LATEST_WINS, INCOMING_WINS)

_IN = "_in_"
_MET = "_met_"
_MATCHED, _STORED, _TAKE = "_matched", "_stored", "_take"
RUN = "_tidemark_run"


@dataclass(frozen=True)
class MergeRule:
    keys: tuple[str, ...]
    ordering: str
    delete_flag: str
    policy: str = LATEST_WINS
    partition_by: tuple[str, ...] = ()

    def __post_init__(self):
        if self.policy not in POLICIES:
            raise ValueError(f"policy must be one of {POLICIES}, not {self.policy!r}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _incoming_name(column: str) -> str:
    return _quoted(_IN + column)


def blank_deleted(rows: DataFrame, rule: MergeRule, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the payload of deleted rows; keys, ordering, flag, partition columns and ``keep`` stay."""
    kept = {*rule.keys, rule.ordering, rule.delete_flag, *rule.partition_by, *keep}
    live = f"NOT coalesce({_quoted(rule.delete_flag)}, false)"
    return rows.selectExpr(
        *[_quoted(c) if c in kept else f"CASE WHEN {live} THEN {_quoted(c)} END AS {_quoted(c)}" for c in rows.columns]
    )


def live_rows(rows: DataFrame, delete_flag: str) -> DataFrame:
    return rows.where(f"NOT coalesce({_quoted(delete_flag)}, false)")


def _incoming(changes: DataFrame) -> DataFrame:
    renamed = [f"{_quoted(c)} AS {_incoming_name(c)}" for c in changes.columns]
    return changes.selectExpr(*renamed, f"true AS {_MATCHED}")


def _same_key(keys: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"{_quoted(k)} = {_incoming_name(k)}" for k in keys))


def _incoming_wins(rule: MergeRule) -> str:
    """Whether an incoming row replaces the stored one; a NULL ordering is the lowest, ties go to incoming."""
    if rule.policy == INCOMING_WINS:
        return f"coalesce({_MATCHED}, false)"
    stored, incoming = _quoted(rule.ordering), _incoming_name(rule.ordering)
    return f"coalesce({_MATCHED}, false) AND ({stored} IS NULL OR coalesce({incoming} >= {stored}, false))"


def _picked(column: str, rule: MergeRule) -> str:
    old, new = _quoted(column), _incoming_name(column)
    if column in rule.keys:
        return f"coalesce({old}, {new}) AS {old}"
    if column in rule.partition_by:
        # a delete may come without its partition value: the flagged row stays where the row was
        new = f"CASE WHEN {_incoming_name(rule.delete_flag)} THEN coalesce({old}, {new}) ELSE {new} END"
    return f"CASE WHEN {_TAKE} THEN {new} ELSE {old} END AS {old}"


def winners(stored: DataFrame, changes: DataFrame, rule: MergeRule, small_batch: bool) -> DataFrame:
    """The changes that replace or add a row: all but those that lose against a later stored row.

    Of the stored rows only key, ordering and partition columns are read.
    """
    columns, keys = changes.columns, list(rule.keys)
    if rule.policy == INCOMING_WINS and not rule.partition_by:
        return changes

    def side(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if small_batch else rows

    narrow = list(dict.fromkeys([*keys, rule.ordering, *rule.partition_by]))
    # one row per incoming key, hence never more than the batch has
    by_key = [_quoted(k) for k in keys]
    met = stored.select(*map(_quoted, narrow)).join(side(changes.select(*by_key)), keys, "left_semi")
    met = met.groupBy(*by_key).agg(*[F.max(_quoted(c)).alias(c) for c in narrow if c not in keys])
    renamed = [f"{_quoted(c)} AS {_quoted(_MET + c)}" for c in narrow]
    same = F.expr(" AND ".join(f"{_quoted(k)} = {_quoted(_MET + k)}" for k in keys))
    joined = changes.join(side(met.selectExpr(*renamed)), same, "left")
    if rule.policy != INCOMING_WINS:
        old, new = _quoted(_MET + rule.ordering), _quoted(rule.ordering)
        joined = joined.where(f"{old} IS NULL OR coalesce({new} >= {old}, false)")

    def output(column: str) -> str:
        name = _quoted(column)
        if column in rule.partition_by and column not in keys:
            # a delete may come without its partition value: the flagged row stays where the row was
            kept = f"coalesce({_quoted(_MET + column)}, {name})"
            return f"CASE WHEN {_quoted(rule.delete_flag)} THEN {kept} ELSE {name} END AS {name}"
        return name

    return joined.selectExpr(*[output(c) for c in columns])


def merge_broadcast(stored: DataFrame, changes: DataFrame, rule: MergeRule) -> DataFrame:
    """Merge a batch whose keys are of checked, broadcastable size; its payload is not broadcast.

    The stored side is scanned, never shuffled. Rows that stay and rows that change come from different
    tasks, hence end up in different files, so that an incremental read skips the files of rows that stay.
    """
    winning = winners(stored, changes, rule, small_batch=True)
    winning_keys = winning.select(*map(_quoted, rule.keys))
    kept = stored.join(F.broadcast(winning_keys), list(rule.keys), "left_anti")
    return kept.select(*map(_quoted, stored.columns)).unionByName(winning)


def has_runs(rows: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the last of several key columns is a whole number."""
    return len(keys) > 1 and isinstance(rows.schema[keys[-1]].dataType, T.IntegralType)


def with_runs(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the run of sixteen numbers that the last key column falls into."""
    if RUN in rows.columns:
        return rows
    return rows.selectExpr("*", f"shiftright(CAST({_quoted(keys[-1])} AS BIGINT), 4) AS {RUN}")


def merge_shuffled(stored: DataFrame, changes: DataFrame, rule: MergeRule) -> DataFrame:
    """Merge a batch of any size: one full outer join, one shuffle of each side on the key.

    Keys are unique on both sides, so no key can be hot in this join. Where the last of several key columns is a whole
    number, such as that of a line in an order, sixteen numbers in a row are shuffled as one: rows that share the columns before
    it stay together and compress better.
    """
    columns, keys = stored.columns, list(rule.keys)
    same = _same_key(keys)
    if has_runs(stored, keys) and has_runs(changes, keys):
        stored, changes = with_runs(stored, keys), with_runs(changes, keys)
        last, other = _quoted(keys[-1]), _incoming_name(keys[-1])
        # not as an equality, by which Spark would shuffle each number for itself
        same = _same_key([*keys[:-1], RUN]) & F.expr(f"{last} <= {other} AND {last} >= {other}")
    joined = stored.selectExpr("*", f"true AS {_STORED}").join(_incoming(changes), same, "full")
    joined = joined.selectExpr("*", f"{_STORED} IS NULL OR ({_incoming_wins(rule)}) AS {_TAKE}")
    return joined.selectExpr(*[_picked(c, rule) for c in columns])


def merge(stored: DataFrame, changes: DataFrame, rule: MergeRule, small_batch: bool) -> DataFrame:
    """Stored rows after ``changes``; ``small_batch`` says that the size of ``changes`` was checked."""
    return (merge_broadcast if small_batch else merge_shuffled)(stored, changes, rule)


def measured(rows: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, Observation]:
    """The rows, and the size of these columns in memory, from row count and real text lengths.

    The size is known once the returned rows are written: it is summed up by the writing tasks themselves.
    """
    row_overhead, per_column = 16, 16
    fields = [f for f in rows.schema if columns is None or f.name in columns]
    lengths = []
    for field in fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            lengths.append(f"octet_length({_quoted(field.name)})")
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            lengths.append(f"octet_length(to_json({_quoted(field.name)}))")
    texts = " + ".join(f"coalesce({length}, 0)" for length in lengths) or "0"
    row = row_overhead + per_column * len(fields)
    size = Observation()
    return rows.observe(size, F.expr(f"coalesce(sum(CAST({row} + {texts} AS BIGINT)), 0) AS bytes")), size


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own limit for broadcast sides, in bytes; negative means never."""
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    units = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    text = size.strip().lower().removesuffix("b") or "0"
    if text[-1] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)


def planned_bytes(rows: DataFrame) -> int:
    """The size that Spark itself expects of these rows when it chooses a join."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def touched_rows(stored: DataFrame, changes: DataFrame, partition_by: Sequence[str], small_batch: bool) -> DataFrame:
    """Stored rows of the partitions that a batch names; other partitions are not read.

    The partitions come from the batch while the job runs (dynamic pruning of the scan by the broadcast partition
    values), so no list of them passes the driver. ``small_batch`` says that the size of ``changes`` was checked; of a
    larger batch the distinct partition values are joined as their size allows.
    """
    by = list(partition_by)
    # Spark prunes only by sides that it takes for selective; a comparison makes this one so
    counted = changes.groupBy(*map(_quoted, by)).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 0").drop("_rows")
    values = counted.where(" AND ".join(f"{_quoted(c)} IS NOT NULL" for c in by))
    return stored.join(F.broadcast(values) if small_batch else values, by, "left_semi")
