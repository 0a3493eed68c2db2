"""The Merkle manifest against a tree built by hand."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from compare import connect, differences
from fixtures import LOWER, SCHEMA, documents, odd_texts
from pyspark.sql import functions as F

from tidemark.llm import merkle


def h(joined: str) -> str:
    return hashlib.sha256(joined.encode()).hexdigest()


def leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes):
    """All levels, the lone root last."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    return levels


def fold(levels, place, node):
    """The siblings' digests joined, and the root with ``node`` put in."""
    joined = ""
    for level in levels[:-1]:
        first = place // 16 * 16
        run = level[first : first + 16]
        joined += "".join(run[: place - first] + run[place - first + 1 :])
        run = run[: place - first] + [node] + run[place - first + 1 :]
        node, place = h("".join(run)), place // 16
    return joined, node


def by_hand(rows):
    by_source: dict = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    found = []
    for at, s in enumerate(names):
        for place, (_, _, original, row) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            node = original
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0:
                node = leaf(row, row["text"] and row["text"].translate(LOWER))
            inner, sub = fold(trees[s], place, node)
            outer, folded = fold(top, at, sub)
            found.append((row["doc_id"], original, trees[s][-1][0], top[-1][0], h(inner + outer), folded, folded == top[-1][0]))
    return sorted(found, key=str)


def rows_of(frame):
    return sorted([tuple(r) for r in frame.collect()], key=str)


@pytest.mark.parametrize("count", [1, 2, 16, 17, 256, 300, 4400])
def test_trees_of_any_size_equal_those_built_by_hand(spark, count):
    texts = [f"Text {i} ABC" if i % 3 else f"text {i}" for i in range(count)]
    frame = documents(spark, texts).withColumn("source", F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit("é"), F.col("doc_id") % 7)).when(F.col("doc_id") % 11 != 1, "s"))
    made = rows_of(merkle.manifest(frame))
    assert made == by_hand([r.asDict() for r in frame.collect()])
    assert not all(r[-1] for r in made) or count < 256


def test_many_sources(spark):
    frame = documents(spark, [f"A{i}" for i in range(600)]).withColumn("source", F.concat(F.lit("s"), F.col("doc_id")))
    assert rows_of(merkle.manifest(frame)) == by_hand([r.asDict() for r in frame.collect()])


def test_odd_rows(spark):
    frame = documents(spark, odd_texts() + [(5, None), (5, None), (-3, "NEGATIVE"), (7, "Ä É")])
    frame = frame.withColumn("n_chars", F.when(F.col("doc_id") % 2 == 0, F.col("n_chars")))
    assert rows_of(merkle.manifest(frame)) == by_hand([r.asDict() for r in frame.collect()])


def test_an_empty_table_has_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_versions_copy_only_ancestors(spark):
    frame = documents(spark, [f"Text {i}" for i in range(700)]).withColumn("source", F.lit("s"))
    built = merkle.build(frame, merkle.tampered(), merkle.lower_cased())
    made = built.versions().collect()
    changed = [i for i in range(700) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted({r["doc_id"] for r in made}) == changed
    assert len(made) == 4 * len(changed)  # the leaf and one node on each of three levels
    folded = {r["doc_id"]: r["folded_root"] for r in built.checked().collect()}
    assert all(folded[r["doc_id"]] == r["digest"] for r in made if r["height"] == 3)


def test_the_query_equals_its_sql(spark):
    tables = "/root/testdata/sf0.001"
    assert differences(spark, connect(tables), tables, "op11_merkle") == ""
