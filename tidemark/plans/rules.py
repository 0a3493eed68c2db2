"""Rule documents: which tables of a mixed change feed are taken, what they are called, and what is added to their rows.

A document holds selection rules (include or exclude, with filters on columns), transformation rules (names of schemas and
tables; added, removed and renamed columns) and tag rules. ``compile_rules`` turns it into one projection with
one filter, so that a feed of any number of tables is read once and written once, whatever tables turn up in it.

Rules apply in the order of their ids and match the names that the source uses, with ``%`` for any text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import OP
from tidemark.operators.layout import spread_for_write
from tidemark.sources.raw_zone import matches

# Words of rule documents.
SELECTION, TRANSFORMATION, TAGS = "selection", "transformation", "post-processing"
INCLUDE, EXCLUDE = "include", "exclude"
ADD_COLUMN, REMOVE_COLUMN, RENAME, ADD_TAG = "add-column", "remove-column", "rename", "add-tag"
HEADER_OPERATION, HEADER_SEQUENCE, HEADER_TIME = "$AR_H_OPERATION", "$AR_H_CHANGE_SEQ", "$AR_H_TIMESTAMP"
OPERATIONS = {"I": "INSERT", "U": "UPDATE", "D": "DELETE"}
TYPES = {
    "string": "string",
    "boolean": "boolean",
    "int4": "int",
    "int8": "bigint",
    "real8": "double",
    "datetime": "timestamp_ntz",
    "date": "date",
}
#: columns that name the table a row goes to, as folders of the landed feed
SCHEMA_FOLDER, TABLE_FOLDER, PART_FOLDER = "schema_folder", "table_folder", "part_folder"
WHOLE = "whole"


@dataclass(frozen=True)
class Header:
    """Columns of the feed that are not part of a row's image."""

    schema: str = "schema_name"
    table: str = "table_name"
    operation: str = OP
    sequence: str = "change_seq"
    time: str = "changed_at"

    def columns(self) -> tuple[str, ...]:
        return self.schema, self.table, self.operation, self.sequence, self.time


@dataclass(frozen=True)
class Rules:
    """A compiled document. ``route`` needs no list of tables: names are columns of the feed."""

    header: Header
    keep: Callable[[], Column]
    schema: Callable[[], Column]
    table: Callable[[], Column]
    added: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    renamed: tuple[tuple[Mapping, str, str], ...] = ()
    removed: tuple[tuple[Mapping, str], ...] = ()
    tags: Mapping[str, Callable[[], Column]] = field(default_factory=dict)

    def route(self, feed: DataFrame) -> DataFrame:
        """The rows taken, under their new names and with added columns; tags are in the map ``tags``.

        ``table_folder`` is the logical table. A name with a slash, such as a physical partition put below its table by a
        prefix, has its rest in ``part_folder``. A column removed or renamed for some tables is NULL in their rows.
        """
        image = [c for c in feed.columns if c not in self.header.columns()]
        values: dict[str, Column] = {c: F.col(f"`{c}`") for c in image}
        for locator, old, new in self.renamed:
            here = _located(locator, self.header)
            moved = F.when(here, values.get(old, F.lit(None)))
            values[new] = F.coalesce(moved, values[new]) if new in values else moved
            if old in values:
                values[old] = F.when(~here, values[old])
        for locator, name in self.removed:
            if name in values:
                values[name] = F.when(~_located(locator, self.header), values[name])
        for name, value in self.added.items():
            values[name] = F.coalesce(value(), values[name]) if name in values else value()
        table = self.table()
        folders = {
            SCHEMA_FOLDER: self.schema(),
            TABLE_FOLDER: F.substring_index(table, "/", 1),
            PART_FOLDER: F.when(F.contains(table, F.lit("/")), F.expr("substring(_table, locate('/', _table) + 1)")).otherwise(WHOLE),
        }
        operation = F.col(f"`{self.header.operation}`").alias(self.header.operation)
        tags = F.map_from_arrays(F.array(*map(F.lit, self.tags)), F.array(*[v() for v in self.tags.values()])) if self.tags else F.create_map()
        taken = feed.where(self.keep()).withColumn("_table", table)
        return taken.select(
            *[v.alias(k) for k, v in folders.items()], operation, *[v.alias(k) for k, v in values.items()], tags.alias("tags")
        )


def compile_rules(document: Mapping | str, header: Header = Header(), variables: Mapping[str, str] | None = None) -> Rules:
    """The rules of a document (a mapping, or its JSON text). ``variables`` fill in what tag values refer to."""
    found = json.loads(document) if isinstance(document, str) else document
    rules = sorted(found["rules"], key=lambda r: int(r["rule-id"]))
    if len({r["rule-id"] for r in rules}) < len(rules):
        raise ValueError("rule ids repeat")
    by_kind: dict[str, list[Mapping]] = {SELECTION: [], TRANSFORMATION: [], TAGS: []}
    for rule in rules:
        if rule["rule-type"] not in by_kind:
            raise ValueError(f"rule {rule['rule-id']}: unknown type {rule['rule-type']!r}")
        by_kind[rule["rule-type"]].append(rule)
    names = [r for r in by_kind[TRANSFORMATION] if r["rule-target"] in ("schema", "table")]
    columns = [r for r in by_kind[TRANSFORMATION] if r["rule-target"] == "column"]
    for rule in names + columns:
        if rule["rule-action"] not in (_COLUMN_ACTIONS if rule in columns else _NAME_ACTIONS):
            raise ValueError(f"rule {rule['rule-id']}: unknown action {rule['rule-action']!r}")
    return Rules(
        header,
        lambda: _selected(by_kind[SELECTION], header),
        lambda: _named(F.col(header.schema), [r for r in names if r["rule-target"] == "schema"], header),
        lambda: _named(F.col(header.table), [r for r in names if r["rule-target"] == "table"], header),
        _added([r for r in columns if r["rule-action"] == ADD_COLUMN], header),
        tuple((r["object-locator"], r["object-locator"]["column-name"], r["value"]) for r in columns if r["rule-action"] == RENAME),
        tuple((r["object-locator"], r["object-locator"]["column-name"]) for r in columns if r["rule-action"] == REMOVE_COLUMN),
        _tags(by_kind[TAGS], header, variables or {}),
    )


def land_routed(feed: DataFrame, rules: Rules, folder: str) -> None:
    """All tables of the feed below one folder, in one partitioned write; a hot table is spread over tasks."""
    folders = [SCHEMA_FOLDER, TABLE_FOLDER, PART_FOLDER]
    spread_for_write(rules.route(feed), folders).write.mode("append").partitionBy(*folders).parquet(folder)


def _located(locator: Mapping, header: Header) -> Column:
    return matches(F.col(header.table), locator["table-name"], locator["schema-name"], F.col(header.schema))


def _any(conditions: Iterable[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found


# Operators of filters.
_CONDITIONS: dict[str, Callable[[Column, Mapping], Column]] = {
    "eq": lambda c, v: c == v["value"],
    "noteq": lambda c, v: c != v["value"],
    "ste": lambda c, v: c <= v["value"],
    "gte": lambda c, v: c >= v["value"],
    "between": lambda c, v: c.between(v["start-value"], v["end-value"]),
    "null": lambda c, v: c.isNull(),
    "notnull": lambda c, v: c.isNotNull(),
}


def _filtered(rule: Mapping) -> Column:
    """Conditions of one column are alternatives, filters of several columns hold together."""
    found = F.lit(True)
    for one in rule.get("filters", ()):
        column = F.col(f"`{one['column-name']}`")
        found = found & _any(_CONDITIONS[c["filter-operator"]](column, c) for c in one["filter-conditions"])
    return F.coalesce(found, F.lit(False))


def _selected(rules: list[Mapping], header: Header) -> Column:
    """Taken if an include rule matches and no exclude rule does; without include rules nothing is taken."""
    included = _any(_located(r["object-locator"], header) & _filtered(r) for r in rules if r["rule-action"] == INCLUDE)
    excluded = _any(_located(r["object-locator"], header) & _filtered(r) for r in rules if r["rule-action"] == EXCLUDE)
    return F.coalesce(included & ~excluded, F.lit(False))


# Actions on names.
_NAME_ACTIONS: dict[str, Callable[[Column, str], Column]] = {
    "add-prefix": lambda name, value: F.concat(F.lit(value), name),
    "remove-prefix": lambda name, value: F.regexp_replace(name, "^" + re.escape(value), ""),
    "add-suffix": lambda name, value: F.concat(name, F.lit(value)),
    "rename": lambda name, value: F.lit(value),
    "convert-lowercase": lambda name, value: F.lower(name),
    "convert-uppercase": lambda name, value: F.upper(name),
}
_COLUMN_ACTIONS = (ADD_COLUMN, REMOVE_COLUMN, RENAME)


def _named(name: Column, rules: list[Mapping], header: Header) -> Column:
    for rule in rules:
        changed = _NAME_ACTIONS[rule["rule-action"]](name, rule.get("value", ""))
        name = F.when(_located(rule["object-locator"], header), changed).otherwise(name)
    return name


def _expression(text: str, header: Header) -> Column:
    """An expression over header fields (``$AR_H_…``) and columns of the row (``$name``)."""
    operation = "CASE " + " ".join(f"WHEN `{header.operation}` = '{k}' THEN '{v}'" for k, v in OPERATIONS.items()) + " END"
    fields = {HEADER_OPERATION: f"({operation})", HEADER_SEQUENCE: f"`{header.sequence}`", HEADER_TIME: f"`{header.time}`"}

    def written(found: re.Match) -> str:
        name = found[0]
        if name.startswith("$AR_H_") and name not in fields:
            raise ValueError(f"unknown header field {name}")
        return fields.get(name, f"`{name[1:]}`")

    return F.expr(re.sub(r"\$[A-Za-z_][A-Za-z0-9_]*", written, text))


def _added(rules: list[Mapping], header: Header) -> dict[str, Callable[[], Column]]:
    """Added columns by name; where rules add the same column to a table, the first one does."""
    found: dict[str, list[Mapping]] = {}
    for rule in rules:
        found.setdefault(rule["value"], []).append(rule)

    def value(mine: list[Mapping]) -> Column:
        chosen = None
        for rule in mine:
            kind = TYPES[rule["data-type"]["type"]]
            made = _expression(rule["expression"], header).cast(kind)
            here = _located(rule["object-locator"], header)
            chosen = F.when(here, made) if chosen is None else chosen.when(here, made)
        return chosen

    return {name: (lambda mine=mine: value(mine)) for name, mine in found.items()}


def _tags(rules: list[Mapping], header: Header, variables: Mapping[str, str]) -> dict[str, Callable[[], Column]]:
    """Tag values with ``${schema-name}``, ``${table-name}`` and the caller's variables filled in."""
    found: dict[str, Callable[[], Column]] = {}
    for rule in rules:
        if rule["rule-action"] != ADD_TAG:
            raise ValueError(f"rule {rule['rule-id']}: unknown action {rule['rule-action']!r}")
        for tag in rule["tag-set"]:
            pieces = re.split(r"(\$\{[^}]*\})", tag["value"])
            found[tag["key"]] = lambda pieces=pieces, rule=rule: F.when(
                _located(rule["object-locator"], header), F.concat(*[_tag_piece(p, header, variables) for p in pieces if p])
            )
    return found


def _tag_piece(piece: str, header: Header, variables: Mapping[str, str]) -> Column:
    name = piece[2:-1] if piece.startswith("${") else None
    if name is None:
        return F.lit(piece)
    if name in ("schema-name", "table-name"):
        return F.col(header.schema if name == "schema-name" else header.table)
    return F.lit(variables[name])
