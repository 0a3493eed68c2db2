"""A keyed table on plain parquet: versioned partition folders and a commit log.

    <path>/base/tidemark_version=<instant>/<partition>/…      rows after the commit, one per key (deleted ones flagged)
    <path>/changes/tidemark_version=<instant>/<partition>/…   the batch of a commit, one row per key
    <path>/commits/<number>.json               which folders make up the table

New files always go to a new version folder and count only once their commit record exists, so a job that
dies half way leaves the table as it was. One writer per table: a second one fails when it commits.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import replace as dc_replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.layout import (
    clustered,
    shuffles_sized_for,
    sorted_in_tasks,
    spread_for_write,
    tasks_for,
)
from tidemark.operators.merge import (
    INCOMING_WINS,
    RUN,
    blank_deleted,
    broadcast_limit,
    has_runs,
    live_rows,
    measured,
    merge,
    winners,
    with_runs,
)
from tidemark.operators.precombine import precombine
from tidemark.operators.schema import ADDED, REMOVED, conform, drift
from tidemark.spec import FAIL, TableSpec, TableType
from tidemark.tables import storage
from tidemark.tables.commits import INSTANT_DIGITS, Commit, CommitLog, Part, days_before, next_instant
from tidemark.workspace import LARGE_STEP, release_shuffles

COMMIT_TIME = "_commit_time"
# Spark takes the name of a version folder for a column, so no table may have a column of that name
VERSION = "tidemark_version"
BASE, CHANGES = "base", "changes"


class LakeTable:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.log = CommitLog(spark, f"{self.path}/commits")

    # ---- reading ---------------------------------------------------------------------------------

    def exists(self) -> bool:
        return bool(self.log.numbers())

    def state(self) -> Commit:
        newest = self.log.newest()
        if newest is None:
            raise FileNotFoundError(f"no committed table at {self.path}")
        return newest

    def snapshot(self, include_deletes: bool = False) -> DataFrame:
        """The latest row of every key. Pending changes are merged in; deleted rows are left out."""
        state = self.state()
        return self._visible(self._rows(state, state.parts), include_deletes)

    def incremental(self, begin: str, include_deletes: bool = False) -> DataFrame:
        """Rows whose commit is later than ``begin``; partitions without a later commit are not read."""
        state = self.state()
        begin = begin.ljust(INSTANT_DIGITS, "0")
        names = {n for n, part in state.parts.items() if part.newest > begin}
        waiting = {n for n, part in state.parts.items() if part.pending}
        if self.spec.moves_partitions and names & waiting:
            names |= waiting
        if any((state.parts[n].base or "") > begin for n in names & waiting):
            rows = self._rows(state, names)
        elif names & waiting:
            rows = self._winning_changes(state, names & waiting)
            if names - waiting:
                rows = rows.unionByName(self._rows(state, names - waiting))
        else:
            rows = self._rows(state, names)
        return self._visible(rows.where(F.col(COMMIT_TIME) > begin), include_deletes)

    def _winning_changes(self, state: Commit, names: Iterable[str]) -> DataFrame:
        """Pending changes that replace or add a row. Of the base files, only key and ordering are read."""
        pending, small = self._pending(state, names)
        stored = self._read(state, BASE, self._base_folders(state, names))
        return winners(stored, pending, self.spec.rule, small)

    def read_optimized(self, include_deletes: bool = False) -> DataFrame:
        """Base files only: the table as of its last compaction, without a merge."""
        state = self.state()
        return self._visible(self._read(state, BASE, self._base_folders(state, state.parts)), include_deletes)

    def _visible(self, rows: DataFrame, include_deletes: bool) -> DataFrame:
        return rows if include_deletes else live_rows(rows, self.spec.delete_flag)

    def _rows(self, state: Commit, names: Iterable[str]) -> DataFrame:
        """All rows of the named partitions, flagged ones included, with pending changes merged in."""
        settled = [n for n in names if not state.parts[n].pending]
        waiting = [n for n in names if state.parts[n].pending]
        frames = []
        if settled or not waiting:
            frames.append(self._read(state, BASE, self._base_folders(state, settled)))
        if waiting:
            stored = self._read(state, BASE, self._base_folders(state, waiting))
            pending, small = self._pending(state, waiting, in_runs=True)
            frames.append(merge(stored, pending, self.spec.rule, small))
        return reduce(DataFrame.unionByName, frames)

    def _pending(self, state: Commit, names: Iterable[str], in_runs: bool = False) -> tuple[DataFrame, bool]:
        """The changes that wait in these partitions, one per key, and whether they can be broadcast.

        ``in_runs`` deals them out as ``merge_shuffled`` joins them, so that they are shuffled once.
        """
        folders = [(v, n) for n in names for v in state.parts[n].changes]
        versions = {v for v, _ in folders}
        pending, keys = self._read(state, CHANGES, folders), list(self.spec.keys)
        small = self._is_small(sum(state.key_bytes[v] for v in versions))
        if len(versions) > 1:
            if in_runs and not small and has_runs(pending, keys):
                before = [F.col(f"`{c}`") for c in (*keys[:-1], RUN)]
                pending = with_runs(pending, keys).repartition(*before)
                keys = [*keys[:-1], RUN, keys[-1]]
            # one row per key and version: instants tell versions apart, no further column is compared
            pending = precombine(pending, keys, self._change_order(), tie_break=[])
        return pending, small

    def _change_order(self) -> list[str]:
        arrival = [COMMIT_TIME, self.spec.ordering]
        return arrival if self.spec.policy == INCOMING_WINS else arrival[::-1]

    @staticmethod
    def _base_folders(state: Commit, names: Iterable[str]) -> list[tuple[str, str]]:
        return [(state.parts[n].base, n) for n in names if state.parts[n].base]

    def _folder(self, kind: str, version: str, name: str = "") -> str:
        return f"{self.path}/{kind}/{VERSION}={version}/{name}".rstrip("/")

    def _read(self, state: Commit, kind: str, folders: list[tuple[str, str]], extra: Sequence = ()) -> DataFrame:
        """The listed (version, partition) folders, with the registered schema: no footer is read for it."""
        schema = state.struct()
        if not folders:
            return self.spark.createDataFrame([], schema)
        by_version: dict[str, list[str]] = {}
        for version, name in sorted(folders):
            by_version.setdefault(version, []).append(name)
        paths = []
        for version, names in by_version.items():
            whole = len(names) == state.folder_counts.get(f"{kind}/{version}")
            paths += [self._folder(kind, version, n) for n in ([""] if whole else names)]
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}")
        return reader.parquet(*paths).select(*schema.names, *extra)

    # ---- writing ---------------------------------------------------------------------------------

    def seed(
        self,
        rows: DataFrame,
        instant: str | None = None,
        replace: bool = False,
        unique_keys: bool = False,
        source: tuple[str, int] | None = None,
        read_up_to: dict[str, str] | None = None,
    ) -> Commit:
        """Bulk insert into an empty table: no merge, sorted inside tasks. ``replace`` starts anew.

        A table holds a key once and never NULL: merges rely on it. NULL keys are refused, and if a key repeats
        its latest row is taken. Whether one does is found out from the key columns alone, so that an extract with
        unique keys is written without a shuffle of its rows. ``unique_keys`` says that the rows come from where
        keys are unique already, such as another keyed table; it saves that step.
        """
        last = self.log.newest()
        if self._already_applied(last, source):
            return last
        if last and last.parts and not replace:
            raise ValueError(f"{self.path} holds rows; seed it again only with replace=True")
        instant = next_instant(last, instant)
        rows = self._refuse_null_keys(self._with_envelope(rows))
        if not unique_keys and self._repeats_a_key(rows):
            rows = precombine(rows, self.spec.keys, self.spec.ordering)
        rows = rows.withColumn(COMMIT_TIME, F.lit(instant))
        # a table that starts anew has read nothing yet, whatever the old one had
        empty = dc_replace(last, batches={}, read_up_to={}) if last else Commit(0, "", "", "")
        commit = empty.next(
            instant,
            "seed",
            schema=_nullable(rows.schema).json(),
            **self._progress(empty, source, read_up_to),
        )
        self._write(BASE, sorted_in_tasks(rows, self.spec.partition_by, self.spec.keys), instant)
        return self._publish_base(commit, {})

    def upsert(
        self,
        changes: DataFrame,
        instant: str | None = None,
        source: tuple[str, int] | None = None,
        read_up_to: dict[str, str] | None = None,
        unique_keys: bool = False,
    ) -> Commit:
        """Merge a batch by key. A batch of ``source`` that was committed before changes nothing.

        ``unique_keys`` says that no key repeats in the batch, as in ``seed``; it saves a shuffle of whole rows.

        Columns that the batch lacks keep their stored values and unknown ones are added, or either makes the
        batch fail: see ``TableSpec.missing_columns`` and ``new_columns``.
        """
        last = self.log.newest()
        if self._already_applied(last, source):
            return last
        instant = next_instant(last, instant)
        changes = self._with_envelope(changes)
        if last is None:
            with_time = changes.withColumn(COMMIT_TIME, F.lit(instant))
            last = Commit(0, "", "", _nullable(with_time.schema).json())
        commit = last.next(instant, "upsert", **self._progress(last, source, read_up_to))

        commit, missing = self._reconciled(commit, changes)
        batch = conform(changes, T.StructType([f for f in commit.struct() if f.name != COMMIT_TIME]))
        batch = self._refuse_null_keys(batch)
        if not unique_keys:
            batch = precombine(batch, self.spec.keys, self.spec.ordering)
        if missing and last.parts:
            batch = self._with_stored(last, batch, missing)
        batch = blank_deleted(batch, self.spec.rule).withColumn(COMMIT_TIME, F.lit(instant))
        broadcast_columns = {*self.spec.keys, self.spec.ordering, *self.spec.partition_by}
        batch, observed = measured(spread_for_write(batch, self.spec.partition_by), broadcast_columns)
        self._write(CHANGES, batch, instant)
        size = observed.get["bytes"]
        if size == 0:
            return self._publish(commit, dict(last.parts))
        arrived = self._written(CHANGES, instant)
        staged = self._read(commit, CHANGES, [(instant, n) for n in arrived])
        homes = self._stored_in(last, staged, size) if self.spec.moves_partitions else set()

        if self.spec.table_type is TableType.MERGE_ON_READ:
            parts = dict(last.parts)
            for name in arrived:
                old = parts.get(name, Part())
                parts[name] = Part(old.base, (*old.changes, instant), old.linked)
            for name in homes - set(arrived):
                parts[name] = Part(parts[name].base, parts[name].changes, linked=True)
            self._publish(commit, parts, {f"{CHANGES}/{instant}": len(arrived)}, {instant: size})
            return self._maintain()

        touched = homes | set(arrived)
        stored = conform(self._rows(last, [n for n in touched if n in last.parts]), commit.struct())
        small = self._is_small(size)
        merged = self._without_old_deletes(merge(stored, staged, self.spec.rule, small), instant)
        # a small batch leaves stored rows in the tasks that read their partition; nothing to spread
        if not small:
            merged = spread_for_write(merged, self.spec.partition_by)
        arrived_bytes = storage.size(self.spark, self._folder(CHANGES, instant))
        with shuffles_sized_for(self.spark, self._stored_bytes(last, touched) + arrived_bytes):
            self._write(BASE, merged, instant)
        untouched = {n: part for n, part in last.parts.items() if n not in touched}
        self._publish_base(commit, untouched)
        return self._maintain()

    def _maintain(self) -> Commit:
        """What follows a commit: compaction when enough batches wait, removal of files no longer needed."""
        state = self.state()
        waiting = {v for part in state.parts.values() for v in part.changes}
        if len(waiting) >= self.spec.compact_after:
            state = self.compact()
        elif len(self.log.numbers()) > self.spec.kept_commits:
            self.clean()
        return state

    def _stored_bytes(self, state: Commit, names: Iterable[str]) -> int:
        """Size of the files of these partitions."""
        parts = [(n, state.parts[n]) for n in names if n in state.parts]
        folders = [self._folder(BASE, part.base, n) for n, part in parts if part.base]
        folders += [self._folder(CHANGES, v, n) for n, part in parts for v in part.changes]
        return sum(storage.size(self.spark, folder) for folder in folders)

    def compact(self, instant: str | None = None, purge_before: str | None = None) -> Commit:
        """Fold pending changes into new base files. Flagged rows older than ``purge_before`` go away; if not
        given, those older than the days that the spec keeps deletes."""
        last = self.state()
        waiting = [n for n, part in last.parts.items() if part.pending]
        return self._rewrite("compact", last, waiting, instant, purge_before, self.spec.keys)

    def cluster(
        self, columns: Sequence[str], instant: str | None = None, purge_before: str | None = None
    ) -> Commit:
        """Rewrite the whole table sorted by ``columns`` across files."""
        last = self.state()
        return self._rewrite("cluster", last, list(last.parts), instant, purge_before, columns)

    def _rewrite(self, operation, last, names, instant, purge_before, columns) -> Commit:
        if not names:
            return last
        instant = next_instant(last, instant)
        rows = self._without_old_deletes(self._rows(last, names), instant, purge_before)
        stored_bytes = self._stored_bytes(last, names)
        if operation == "cluster":
            columns = [*self.spec.partition_by, *columns]
            rows = clustered(rows, columns, self.spec.keys, tasks_for(stored_bytes))
        else:
            rows = sorted_in_tasks(rows, self.spec.partition_by, columns)
        with shuffles_sized_for(self.spark, stored_bytes):
            self._write(BASE, rows, instant)
        kept = {n: part for n, part in last.parts.items() if n not in set(names)}
        commit = self._publish_base(last.next(instant, operation), kept)
        if len(self.log.numbers()) > self.spec.kept_commits:
            self.clean()
        return commit

    def stale_folders(self, retain: int | None = None) -> list[str]:
        """Version folders that none of the last ``retain`` commits needs."""
        commits = self.log.last(retain or self.spec.kept_commits)
        needed = set()
        for commit in commits:
            for name, part in commit.parts.items():
                needed |= {(BASE, part.base, name)} | {(CHANGES, v, name) for v in part.changes}
        depth = len(self.spec.partition_by)
        stale = []
        for kind in (BASE, CHANGES):
            for folder in storage.children(self.spark, f"{self.path}/{kind}"):
                version = folder.removeprefix(f"{VERSION}=")
                if version > commits[-1].instant:
                    continue  # a commit in progress
                for name in storage.partition_folders(self.spark, f"{self.path}/{kind}/{folder}", depth):
                    if (kind, version, name) not in needed:
                        stale.append(f"{kind}/{folder}/{name}".rstrip("/"))
        return stale

    def clean(self, retain: int | None = None) -> list[str]:
        """Delete what ``stale_folders`` names and the commit records before the last ``retain``."""
        retain = retain or self.spec.kept_commits
        stale = self.stale_folders(retain)
        self.log.remove(self.log.numbers()[:-retain])
        for folder in stale:
            storage.delete(self.spark, f"{self.path}/{folder}")
        return stale

    # ---- steps -----------------------------------------------------------------------------------

    def _already_applied(self, last: Commit | None, source: tuple[str, int] | None) -> bool:
        return bool(last and source and last.batches.get(source[0], -1) >= source[1])

    @staticmethod
    def _progress(last: Commit, source, read_up_to) -> dict:
        batches = {**last.batches, source[0]: source[1]} if source else last.batches
        return {"batches": batches, "read_up_to": {**last.read_up_to, **(read_up_to or {})}}

    def _with_envelope(self, rows: DataFrame) -> DataFrame:
        """Rows without a delete flag are live ones; the commit time is always this table's own."""
        missing = [c for c in (*self.spec.keys, *self.spec.partition_by, self.spec.ordering) if c not in rows.columns]
        if any(c.lower() == VERSION for c in rows.columns):
            raise ValueError(f"{self.spec.name}: a column may not be called {VERSION}")
        if missing:
            raise ValueError(f"{self.spec.name}: columns {missing} are missing")
        rows = rows.drop(COMMIT_TIME)
        if self.spec.delete_flag not in rows.columns:
            rows = rows.withColumn(self.spec.delete_flag, F.lit(False))
        return rows

    def _repeats_a_key(self, rows: DataFrame) -> bool:
        counts = rows.groupBy(*self.spec.keys).agg(F.count(F.lit(1)).alias("_rows"))
        return bool(counts.where("_rows > 1").select("_rows").head(1))

    def _reconciled(self, commit: Commit, changes: DataFrame) -> tuple[Commit, list[str]]:
        """The commit with columns that are new in this batch, and the stored columns that the batch lacks."""
        registered = commit.struct()
        found = [d for d in drift(changes.schema, registered) if d[0] != COMMIT_TIME]
        missing = [name for name, change, _, _ in found if change == REMOVED]
        new = [name for name, change, _, _ in found if change == ADDED]
        if found:
            logging.getLogger(__name__).warning("%s: the batch differs from the table: %s", self.spec.name, found)
        if missing and self.spec.missing_columns == FAIL:
            raise ValueError(f"{self.spec.name}: the batch lacks columns {missing}")
        if new and self.spec.new_columns == FAIL:
            raise ValueError(f"{self.spec.name}: the batch has unknown columns {new}")
        if new:
            added = [T.StructField(f.name, f.dataType, True) for f in changes.schema if f.name in new]
            commit = dc_replace(commit, schema=T.StructType([*registered, *added]).json())
        return commit, missing

    def _with_stored(self, last: Commit, batch: DataFrame, missing: list[str]) -> DataFrame:
        """The batch with the stored values of columns that it lacks; new keys have NULL there."""
        keys = list(self.spec.keys)
        if not self.spec.moves_partitions and not set(self.spec.partition_by) & set(missing):
            # a key is stored in the partition that the batch names: only those partitions are read
            keys = list(dict.fromkeys([*self.spec.partition_by, *keys]))
        stored = self._rows(last, list(last.parts)).select(*keys, *missing)
        return batch.drop(*missing).join(stored, keys, "left").select(*batch.columns)

    def _refuse_null_keys(self, rows: DataFrame) -> DataFrame:
        def checked(key: str):
            refusal = F.raise_error(F.lit(f"{self.spec.name}: NULL in key column {key}; quarantine such rows"))
            return F.when(F.col(key).isNull(), refusal).otherwise(F.col(key))

        return rows.withColumns({key: checked(key) for key in self.spec.keys})

    def _without_old_deletes(self, rows: DataFrame, instant: str, before: str | None = None) -> DataFrame:
        """Drop flagged rows that no change still on its way can be older than."""
        if before is None and self.spec.deletes_kept_days is None:
            return rows
        oldest = before.ljust(INSTANT_DIGITS, "0") if before else days_before(instant, self.spec.deletes_kept_days)
        deleted = F.coalesce(F.col(self.spec.delete_flag), F.lit(False))
        return rows.where(~(deleted & (F.col(COMMIT_TIME) < oldest)))

    def _is_small(self, size: int) -> bool:
        return size <= broadcast_limit(self.spark)

    def _stored_in(self, last: Commit, staged: DataFrame, size: int) -> set[str]:
        """Names of the partitions whose base rows carry a key of the batch: a scan of the key columns."""
        folders = self._base_folders(last, last.parts)
        if not folders:
            return set()
        keys = list(self.spec.keys)
        file_path = F.col("_metadata.file_path")
        stored = self._read(last, BASE, folders, extra=[file_path]).select(*keys, "file_path")
        batch_keys = staged.select(*keys)
        if self._is_small(size):
            batch_keys = F.broadcast(batch_keys)
        hit = stored.join(batch_keys, keys, "left_semi").select("file_path").distinct()
        # file paths are URI-encoded; "+" stands for itself there
        plain = F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B")))
        name = F.regexp_extract(plain, rf".*/{BASE}/{VERSION}=[^/]+/(?:(.*)/)?[^/]+$", 1)
        return {row["name"] for row in hit.select(name.alias("name")).distinct().collect()}

    def _write(self, kind: str, rows: DataFrame, instant: str) -> None:
        writer = rows.write.mode("errorifexists")
        if self.spec.partition_by:
            writer = writer.partitionBy(*self.spec.partition_by)
        writer.parquet(self._folder(kind, instant))
        if storage.size(self.spark, self._folder(kind, instant)) >= LARGE_STEP:
            release_shuffles(self.spark)

    def _written(self, kind: str, instant: str) -> list[str]:
        return storage.partition_folders(self.spark, self._folder(kind, instant), len(self.spec.partition_by))

    def _publish(self, commit: Commit, parts: dict[str, Part], written=None, key_bytes=None) -> Commit:
        commit = commit.with_parts(parts, written or {}, key_bytes or {})
        self.log.append(commit)
        return commit

    def _publish_base(self, commit: Commit, kept: dict[str, Part]) -> Commit:
        """Publish kept partitions and those just written to the base folder of this commit."""
        names = self._written(BASE, commit.instant)
        new = {n: Part(commit.instant) for n in names}
        return self._publish(commit, {**kept, **new}, {f"{BASE}/{commit.instant}": len(names)})


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])
