"""Merkle manifest of a table of documents, with one version of the tree for every tampered leaf.

A row's leaf is the sha256 of its fields. The leaves of a source ascend by doc_id; runs of 16 nodes become their hash
until one node, the subroot, remains, and the subroots, by source, become the root in the same way.

The tree is cut into aligned blocks of 256 nodes, two levels each, so that no task holds more than one block: blocks of
leaves give the nodes of the next tree of blocks, and so on to the root. On the way down each block is given what stands
left and right of it on all levels above (one short row per block). A tampered leaf makes a version of the tree: only
its ancestors are copied, first inside its block, then, in the same task, on the levels above; all other nodes are
shared with the untouched tree.

Null fields hash as ``-``; documents without a source make up the first tree, those without a doc_id its first leaves.
Rows that share a doc_id are ordered by their leaf; equal rows are leaves each. An empty table has no root and gives no
rows. Whole texts are hashed, however long. Columns other than the five hashed ones are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, keep

RUN = 16
#: nodes of a block: two levels of runs
BLOCK = RUN * RUN
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: the tree of the subroots, beside one tree for each source
_SOURCES = "sources"
_UPPER = "array<struct<before: binary, after: binary>>"


def written(value: Column) -> Column:
    """A field as it is hashed: ``-``, or its length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**fields: Column) -> Column:
    """The leaf of a row, 32 bytes; ``fields`` stand in for columns of that name."""
    return F.unhex(F.sha2(F.concat(*[written(fields.get(name, F.col(name))) for name in FIELDS]).cast("binary"), 256))


def tampered() -> Column:
    """Rows whose text somebody has lower-cased."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def lower_cased() -> Column:
    return F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class BlockTree:
    """The nodes of one block: its own, then those of each level above it. Digests are hex as bytes."""

    def __init__(self, nodes: list[bytes], depth: int):
        self.levels = [nodes]
        for _ in range(depth):
            below = self.levels[-1]
            self.levels.append([digest(b"".join(below[i : i + RUN])) for i in range(0, len(below), RUN)])

    def around(self, i: int) -> list[tuple[bytes, bytes]]:
        """What stands left and right of node ``i`` and of its ancestors in their runs."""
        found = []
        for level in self.levels[:-1]:
            first = i - i % RUN
            found.append((b"".join(level[first:i]), b"".join(level[i + 1 : first + RUN])))
            i //= RUN
        return found


def digest(joined: bytes) -> bytes:
    return hashlib.sha256(joined).hexdigest().encode()


def copied_path(node: bytes, around: list[tuple[bytes, bytes]]) -> list[bytes]:
    """A version of the tree with ``node`` in the place of another: the node and its copied ancestors, root last."""
    path = [node]
    for before, after in around:
        path.append(digest(before + path[-1] + after))
    return path


def depth_of(nodes: int) -> int:
    """Levels that a block adds in a tree of so many nodes: none above a lone node."""
    return 0 if nodes <= 1 else 1 if nodes <= RUN else 2


def placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``place`` of each row in its tree, from 0, and ``size`` of the tree, by one range partitioning and counts of its parts."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keep(rows.repartitionByRange(parts, tree, *order).withColumn("part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("part", tree).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "part",
        tree,
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("base"),
        F.sum("rows").over(Window.partitionBy(tree)).alias("size"),
    )
    inside = F.row_number().over(Window.partitionBy("part", tree).orderBy(*order))
    return ranged.withColumn("inside", inside).join(bases, ["part", tree]).withColumn("place", F.col("base") + F.col("inside") - 1)


def in_blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """One row per block of a tree: tree, size, block, and its ``nodes`` in order, at most ``BLOCK``."""
    node = F.struct("place", "digest", *carried)
    block = F.floor(F.col("place") / BLOCK).cast("long").alias("block")
    grouped = nodes.groupBy("tree", "size", block).agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    return keep(grouped, "blocks")


def roots(blocks: DataFrame) -> DataFrame:
    """The root of each block, as a node of the next tree of blocks."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for size, nodes in zip(batch["size"].to_pylist(), batch["nodes"]):
                leaves = [x.hex().encode() for x in nodes.values.field("digest").to_pylist()]
                found.append(bytes.fromhex(BlockTree(leaves, depth_of(size)).levels[-1][0].decode()))
            size = [-(-s // BLOCK) for s in batch["size"].to_pylist()]
            yield pa.record_batch(
                {"tree": batch["tree"], "size": pa.array(size, pa.int64()), "place": batch["block"], "digest": pa.array(found, pa.binary())}
            )

    narrow = blocks.select("tree", "size", "block", F.transform("nodes", lambda n: F.struct(n["digest"].alias("digest"))).alias("nodes"))
    return in_arrow(narrow, climb, "tree string, size long, place long, digest binary")


def paths(blocks: DataFrame) -> DataFrame:
    """For each node of blocks with their ``upper`` path: what stands around it on all levels up to the root."""

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                upper = [(x["before"], x["after"]) for x in row["upper"]]
                leaves = [x["digest"].hex().encode() for x in row["nodes"]]
                tree = BlockTree(leaves, depth_of(row["size"]))
                found = [[{"before": b, "after": a} for b, a in tree.around(i) + upper] for i in range(len(leaves))]
                yield pa.record_batch(
                    {
                        "tree": pa.array([row["tree"]] * len(leaves), pa.string()),
                        "place": pa.array([x["place"] for x in row["nodes"]], pa.int64()),
                        "digest": pa.array([x["digest"] for x in row["nodes"]], pa.binary()),
                        "upper": pa.array(found, pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))),
                    }
                )

    return in_arrow(blocks, descend, f"tree string, place long, digest binary, upper {_UPPER}")


@dataclass
class Manifest:
    """A built tree: the blocks of the leaves with the paths above them, the subroots, and the root (None without rows)."""

    blocks: DataFrame
    root: str | None

    def checked(self) -> DataFrame:
        """Per leaf: leaf, subroot, proof_sha256 and the root folded from its version (or from the leaf itself)."""
        root = self.root

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    nodes, upper = row["nodes"], [(x["before"], x["after"]) for x in row["upper"]]
                    above = b"".join([b + a for b, a in upper])
                    leaves = [x["digest"].hex().encode() for x in nodes]
                    tree = BlockTree(leaves, depth_of(row["size"]))
                    proofs, folded = [], []
                    for i, node in enumerate(nodes):
                        around = tree.around(i)
                        proofs.append(hashlib.sha256(b"".join([b + a for b, a in around]) + above).hexdigest())
                        changed = leaves[i] if node["changed"] is None else node["changed"].hex().encode()
                        folded.append(copied_path(changed, around + upper)[-1].decode())
                    yield pa.record_batch(
                        {
                            "doc_id": pa.array([x["doc_id"] for x in nodes], pa.int64()),
                            "leaf": pa.array([x.decode() for x in leaves], pa.string()),
                            "subroot": pa.array([row["subroot"].hex()] * len(nodes), pa.string()),
                            "proof_sha256": pa.array(proofs, pa.string()),
                            "folded_root": pa.array(folded, pa.string()),
                        }
                    )

        rows = in_arrow(self.blocks, fold, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
        return rows.withColumn("root", F.lit(root).cast("string")).withColumn("verified", F.col("folded_root") == F.col("root"))

    def versions(self) -> DataFrame:
        """The copied nodes of each tampered leaf's version: doc_id, place (of the leaf in its tree), height, digest."""

        def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    tree = BlockTree([x["digest"].hex().encode() for x in row["nodes"]], depth_of(row["size"]))
                    upper = [(x["before"], x["after"]) for x in row["upper"]]
                    found = [
                        (node["doc_id"], node["place"], height, made.decode())
                        for i, node in enumerate(row["nodes"])
                        if node["changed"] is not None
                        for height, made in enumerate(copied_path(node["changed"].hex().encode(), tree.around(i) + upper))
                    ]
                    columns = list(zip(*found)) or [(), (), (), ()]
                    types = [pa.int64(), pa.int64(), pa.int32(), pa.string()]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "place", "height", "digest"])

        return in_arrow(self.blocks.where(F.exists("nodes", lambda n: n["changed"].isNotNull())), copy, "doc_id long, place long, height int, digest string")


def _levels(blocks: DataFrame) -> list[DataFrame]:
    """Blocks of a forest, then the blocks over them, up to one block per tree."""
    found = [blocks]
    largest = blocks.agg(F.max("size")).first()[0] or 0
    while largest > BLOCK:
        found.append(in_blocks(roots(found[-1])))
        largest = -(-largest // BLOCK)
    return found


def _down(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest blocks with the path above each; ``tops``: tree, subroot, upper."""
    above = levels[-1].join(tops, "tree")
    for lower in levels[-2::-1]:
        subroots = tops.select("tree", "subroot")
        over = keep(paths(above.drop("subroot")).drop("digest"), "paths").withColumnRenamed("place", "block")
        above = lower.join(over.hint("merge"), ["tree", "block"]).join(subroots, "tree")
    return above


def build(documents: DataFrame, changed: Column, text: Column) -> Manifest:
    """The manifest of all rows; ``text`` is what tampering makes of the text of the rows where ``changed``."""
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))  # rows without a source come first
    leaves = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        tree.alias("tree"),
        leaf_of().alias("digest"),
        F.when(changed, leaf_of(text=text)).alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = placed(keep(leaves, "leaves"), "tree", ["doc_id", "digest", "row"])
    levels = _levels(in_blocks(rows, "doc_id", "changed"))
    subroots = keep(roots(levels[-1]).select("tree", "digest"), "subroots")
    over = placed(subroots.select(F.lit(_SOURCES).alias("tree"), "digest", F.col("tree").alias("source")), "tree", ["source"])
    top = _levels(in_blocks(over, "source"))
    root = roots(top[-1]).select(F.hex("digest")).first()
    if root is None:
        return Manifest(levels[0].withColumns({"subroot": F.lit(None).cast("binary"), "upper": F.lit(None).cast(_UPPER)}), None)
    nothing = top[-1].select("tree").withColumns({"subroot": F.lit(None).cast("binary"), "upper": F.array().cast(_UPPER)})
    named = _down(top, nothing).select("tree", "size", "block", "nodes", "upper")
    sources = over.select("place", "source")
    tops = keep(paths(named).join(sources, "place").select(F.col("source").alias("tree"), F.col("digest").alias("subroot"), "upper"), "tops")
    return Manifest(_down(levels, tops), root[0].lower())


def manifest(documents: DataFrame) -> DataFrame:
    """Per document: leaf, subroot, root, proof_sha256, folded_root and verified, with every fifth row tampered."""
    rows = build(documents, tampered(), lower_cased()).checked()
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
