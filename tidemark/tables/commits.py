"""Commit records: one small JSON file per commit that says which folders make up the table."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.functions.envelope import TIME_DIGITS, TIME_FORMAT
from tidemark.tables import storage

INSTANT_DIGITS = 17  # TIME_FORMAT and milliseconds


@dataclass(frozen=True)
class Part:
    """One partition folder: the version of its base files and the change versions still to merge.

    ``linked`` marks a partition whose rows may be replaced by pending changes of other partitions.
    """

    base: str | None = None
    changes: tuple[str, ...] = ()
    linked: bool = False

    @property
    def pending(self) -> bool:
        return bool(self.changes) or self.linked

    @property
    def newest(self) -> str:
        return max(v for v in (self.base or "", *self.changes))


@dataclass(frozen=True)
class Commit:
    number: int
    instant: str
    operation: str
    schema: str
    parts: dict[str, Part] = field(default_factory=dict)
    key_bytes: dict[str, int] = field(default_factory=dict)
    folder_counts: dict[str, int] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    read_up_to: dict[str, str] = field(default_factory=dict)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def next(self, instant: str, operation: str, **changes) -> Commit:
        return replace(self, number=self.number + 1, instant=instant, operation=operation, **changes)

    def with_parts(self, parts: dict[str, Part], written: dict[str, int], key_bytes: dict[str, int]) -> Commit:
        """The commit over these partitions; sizes of versions that no partition uses are forgotten.

        ``written`` counts the partition folders of new versions, by ``kind/version``.
        """
        pending = {v for part in parts.values() for v in part.changes}
        used = {f"base/{part.base}" for part in parts.values()} | {f"changes/{v}" for v in pending}
        counts = {**self.folder_counts, **written}
        sizes = {**self.key_bytes, **key_bytes}
        return replace(
            self,
            parts=parts,
            folder_counts={k: n for k, n in counts.items() if k in used},
            key_bytes={v: n for v, n in sizes.items() if v in pending},
        )

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Commit:
        values = json.loads(text)
        parts = {
            name: Part(p["base"], tuple(p["changes"]), p["linked"]) for name, p in values.pop("parts").items()
        }
        return Commit(parts=parts, **values)


class CommitLog:
    """The numbered commit records of one table. The newest one alone describes the whole table."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in storage.children(self._spark, self._path)]

    def _file(self, number: int) -> str:
        return f"{self._path}/{number:012d}.json"

    def read(self, number: int) -> Commit:
        return Commit.from_json(storage.read_text(self._spark, self._file(number)))

    def newest(self) -> Commit | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def last(self, count: int) -> list[Commit]:
        return [self.read(n) for n in self.numbers()[-count:]]

    def append(self, commit: Commit) -> None:
        """Publish a commit. A second writer that started from the same commit fails here."""
        storage.create_text(self._spark, self._file(commit.number), commit.to_json())

    def remove(self, numbers: Iterable[int]) -> None:
        for number in numbers:
            storage.delete(self._spark, self._file(number))


def _parse(instant: str) -> datetime:
    whole = datetime.strptime(instant[:TIME_DIGITS], TIME_FORMAT)
    return whole + timedelta(milliseconds=int(instant[TIME_DIGITS:]))


def _format(moment: datetime) -> str:
    return moment.strftime(TIME_FORMAT) + f"{moment.microsecond // 1000:03d}"


def days_before(instant: str, days: int) -> str:
    return _format(_parse(instant) - timedelta(days=days))


def next_instant(last: Commit | None, wanted: str | None = None) -> str:
    """A commit instant later than the last one: the wanted one, or the clock."""
    if wanted is not None:
        instant = wanted.ljust(INSTANT_DIGITS, "0")
        if _format(_parse(instant)) != instant:
            raise ValueError(f"not a commit instant: {wanted!r}")
        if last and instant <= last.instant:
            raise ValueError(f"instant {instant} is not later than the last commit {last.instant}")
        return instant
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    if last and _format(now) <= last.instant:
        now = _parse(last.instant) + timedelta(milliseconds=1)
    return _format(now)
