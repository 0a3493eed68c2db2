"""N-gram Jaccard join by parity sketches, and the classes of documents that it links.

A document's set holds its distinct shingles (``width`` words in a row; fewer words are one shingle). Two sets that
share ``share`` of their union differ in at most (a + c) * (1 - share) / (1 + share) shingles, a and c their sizes.

* Sketch: every shingle flips bits in one word of a sketch (the XOR of the hashes of a word's shingles), and a bit in a
  plain bit sketch. The words, or bits, in which two sketches differ are at most the shingles in which the sets differ.
  So if one of two linked sets has more words of two shingles or more than linked sets can differ in, one of these
  words is equal in both (pigeonhole). Words of one shingle, which texts with a common phrase share, and empty words join
  nothing. Sets with too few such words for the argument, mostly short ones, also join by a sketch all of whose full
  words count; and the very few with too few of these share a word of their own.
* Bands: sizes fall into bands so that linked sets are in one band or in two next to each other. A set has a sketch
  for its own band and one for the band below; both have words enough for the largest difference of their band.
* Equal words join: the documents of a word are linked to its first one, which takes as many links as documents.
  What these links connect is a cluster of candidates, a superset of linked classes.
* Verification: inside a cluster all sets are compared, in blocks of bounded bytes when it is large: sizes first, then
  wide sketches, then the sets themselves, until what is linked hangs together. Equal sets count as one.

Nothing is capped and no link between different sets is lost; of a class only a spanning forest is written.

Null and blank texts have an empty set and are linked with nothing. Documents that repeat, also with their doc_id, are
rows of their own; a null doc_id is a document without a name. An empty table has no classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import coded, in_arrow, keep, matching, mix, ship, slices, unwrapped, whole_groups, without, words, wrapped
from tidemark.llm.components import components

BLOCK_SETS, BLOCK_SHINGLES = 1024, 2_000_000
_NO_ID = -(2**63)
_FACTORS = mix(np.arange(11, 11 + 64)) | np.uint64(1)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    flat, begins = words(texts)
    names, codes = coded(flat)
    if not names:
        return [np.zeros(0, np.uint64)] * (len(begins) - 1)
    hashes = pd.util.hash_array(np.array(names, dtype=object))[codes]
    n = len(hashes)
    with np.errstate(over="ignore"):
        rows = hashes * _FACTORS[0]
        for k in range(1, width):
            rows[: n - k] += hashes[k:] * _FACTORS[k]
        rows = mix(rows)
        out = []
        for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
            if b - a >= width:
                out.append(np.unique(rows[a : b - width + 1]))
            elif b > a:
                short = sum((hashes[a + k] * _FACTORS[k] for k in range(b - a)), np.uint64(b - a))
                out.append(mix(np.array([short])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    with np.errstate(over="ignore"):
        parts = mix(shingles).sum(dtype=np.uint64), mix(shingles ^ _FACTORS[-1]).sum(dtype=np.uint64)
    return int(parts[0].view(np.int64)), int(parts[1].view(np.int64))


class Bands:
    """Bands of set sizes and the number of words of a band's sketches, for a share of the union that links."""

    def __init__(self, share: Fraction):
        self.share = share
        self.edges = [1]
        # words with two shingles or more, per shingle, when words have this many on average
        pairs = lambda load: (1 - np.exp(-load) * (1 + load)) / load
        loads = np.linspace(1.8, 40, 2000)
        enough = loads[pairs(loads) >= 1.06 * float((1 - share) / share)]
        self.load = float(enough[-1]) if len(enough) else 1.8

    def difference(self, a: int, c: int) -> int:
        """The most shingles in which linked sets of these sizes differ."""
        return int((a + c) * (1 - self.share) / (1 + self.share))

    def of(self, size: int) -> int:
        while self.edges[-1] <= size:
            self.edges.append(int(self.edges[-1] / self.share) + 1)
        return int(np.searchsorted(self.edges, size, side="right")) - 1

    def words(self, band: int) -> tuple[int, int]:
        """Words of the first and of the second sketch for two sets of the band, or one of it and one of the next.

        (0, 0): such sets are equal. In the first a word has as many shingles as leave 6 % more words of two
        shingles than linked sets differ in; in the second, words are a little more than the sets differ in.
        """
        while len(self.edges) < band + 2:
            self.of(self.edges[-1])
        top = self.edges[band + 1] - 1
        most = self.difference(top, int(top / self.share))
        return (int(top / self.load) + 1, int(1.06 * (most + 1)) + 6) if most else (0, 0)


def parity(shingles: np.ndarray, n_words: int, salt: int) -> np.ndarray:
    """A sketch of ``n_words`` 64-bit words."""
    with np.errstate(over="ignore"):
        bits = mix(shingles + np.uint64(salt)) % np.uint64(64 * n_words)
    sketch = np.zeros(n_words, np.uint64)
    np.bitwise_xor.at(sketch, (bits >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bits & np.uint64(63)))
    return sketch


def folded(shingles: np.ndarray, n_words: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """A sketch of ``n_words`` words, each the XOR of the hashes of its shingles, and how many shingles a word has."""
    hashes = mix(shingles ^ mix(np.array([salt], np.int64).view(np.uint64)))
    word = (hashes % np.uint64(n_words)).astype(np.int64)
    sketch = np.zeros(n_words, np.uint64)
    np.bitwise_xor.at(sketch, word, mix(hashes ^ _FACTORS[-2]))
    return sketch, np.bincount(word, minlength=n_words)


def join_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """The words of a set's sketches, each with its band and place, as 64-bit keys."""
    band, out = bands.of(len(shingles)), []
    for at in (band - 1, band):
        first, second = bands.words(at) if at >= 0 else (0, 0)
        if not first:
            continue
        # the set is the smaller one of a pair, or in the upper band the larger one
        n = len(shingles)
        most = bands.difference(n, int(n / bands.share) if at == band else n)
        place = mix(np.arange(max(first, second) + 1, dtype=np.uint64) + np.uint64((2 * at + 1) << 32))
        sketch, count = folded(shingles, first, at)
        full = np.flatnonzero(count > 1)
        out.append(mix(sketch[full] ^ place[full]))
        if len(full) <= most:
            place = mix(place)
            sketch, count = folded(shingles, second, -1 - at)
            full = np.flatnonzero(count)
            out.append(mix(sketch[full] ^ place[full]))
            if len(full) <= most:
                out.append(place[-1:])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sets_of(documents: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles and the set's hash (h1, h2) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            sets = shingle_sets(rows["text"], width)
            names = np.array([set_hash(s) for s in sets], np.int64).reshape(-1, 2)
            yield pa.record_batch({"doc_id": rows["doc_id"], "n_shingles": pa.array([len(s) for s in sets], pa.int64()), "h1": pa.array(names[:, 0]), "h2": pa.array(names[:, 1])})

    return in_arrow(documents, run, "doc_id long, n_shingles long, h1 long, h2 long")


def keys_of(documents: DataFrame, width: int, share: Fraction) -> DataFrame:
    """(key, doc) of each document; of equal sets in one task, those of the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(share), set()
        for rows in slices(batches):
            keys, counts = [], []
            for shingles in shingle_sets(rows["text"], width):
                name = set_hash(shingles)
                keys.append(join_keys(shingles, bands) if len(shingles) and name not in seen else np.zeros(0, np.uint64))
                counts.append(len(keys[-1]))
                seen.add(name)
            if len(seen) > 1_000_000:
                seen.clear()
            docs = rows["doc_id"].fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            yield pa.record_batch({"key": pa.array(np.concatenate(keys).view(np.int64)), "doc": pa.array(np.repeat(docs, counts))})

    return in_arrow(documents, run, "key long, doc long")


def to_first(keys: DataFrame) -> DataFrame:
    """(a, b): each document of a key and the key's first one. Keys are read in order, a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, None
        for rows in batches:
            if not rows.num_rows:
                continue
            key, doc = rows["key"].to_numpy(), rows["doc"].to_numpy()
            new = np.concatenate([[key[0] != last], key[1:] != key[:-1]])
            at = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            heads = np.where(at >= 0, doc[np.maximum(at, 0)], first if first is not None else 0)
            last, first = key[-1], heads[-1]
            linked = heads != doc
            if linked.any():
                pairs = np.unique(np.stack([heads[linked], doc[linked]], axis=1), axis=0)
                yield pa.record_batch({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return in_arrow(keys.repartition(parts, "key").sortWithinPartitions("key", "doc"), run, "a long, b long").distinct()


def linked(sets: list[np.ndarray], side: np.ndarray, share: Fraction, bands: Bands) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of side 0 and 1, or of the links among all if there is one side."""
    n = np.array([len(s) for s in sets], np.int64)
    most = max(bands.difference(int(n.max()), int(n.max())), 1)
    n_words = min(256, max(4, most // 8))
    wide = np.stack([parity(s, n_words, 0xA5) for s in sets])
    up, down = share.numerator, share.denominator
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    forest = []
    two = len(np.unique(side)) > 1
    for i in range(len(sets)):
        others = np.arange(i + 1, len(sets))
        others = others[side[others] != side[i]] if two else others
        a, c = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
        others = others[a * down >= c * up]
        if not len(others):
            continue
        apart = np.bitwise_count(wide[others] ^ wide[i]).sum(1, dtype=np.int64)
        near = apart * (down + up) <= (n[others] + n[i]) * (down - up)
        for j in others[near][np.argsort(apart[near], kind="stable")].tolist():
            if root(i) == root(j):
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if down * both >= up * (len(sets[i]) + len(sets[j]) - both):
                parent[root(j)] = root(i)
                forest.append((i, j))
    return forest


def jaccard_classes(documents: DataFrame, width: int, share: Fraction) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id that links reach) of each document."""
    return _classes(documents, width, share).select("doc_id", "n_shingles", "component_id")


def _classes(documents: DataFrame, width: int, share: Fraction) -> DataFrame:
    """The same with the hash of each document's set."""
    ship(documents.sparkSession)
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = keep(sets_of(documents, width), "sets")
    name = ["h1", "h2", "n_shingles"]
    classes = sets.where("n_shingles > 0").groupBy(*name).agg(F.min("doc_id").alias("least"))
    # a class is named by its place in this table
    classes = keep(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    named = sets.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), *name).distinct().join(classes, name).select("doc", "node")
    named = keep(named, "class-names")
    links = keep(to_first(keys_of(documents, width, share)), "key-links")
    near = links.join(named.select(F.col("doc").alias("a"), F.col("node").alias("x")), "a")
    near = near.join(named.select(F.col("doc").alias("b"), F.col("node").alias("y")), "b")
    clusters = components(near.select(F.col("x").alias("a"), F.col("y").alias("b")))
    members = keep(clusters.withColumnRenamed("root", "cluster").join(classes, "node"), "clusters")
    verified = keep(_verify(documents, members, width, share), "verified")
    roots = components(verified)
    found = classes.join(roots, "node", "left").select(*name, F.coalesce("root", "node").alias("root"), "least")
    least = found.groupBy("root").agg(F.min("least").alias("component"))
    found = keep(found.join(least, "root").select(*name, "component"), "components")
    rows = sets.join(found, name, "left")
    return rows.select("doc_id", *name, F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def _verify(documents: DataFrame, members: DataFrame, width: int, share: Fraction) -> DataFrame:
    """(a, b): a spanning forest of the links inside each cluster, found in blocks of bounded size."""
    size = members.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    parts = F.ceil(F.greatest(F.col("n") / F.lit(BLOCK_SETS / 2), F.col("shingles") / F.lit(BLOCK_SHINGLES / 2)))
    parts = F.when((F.col("n") <= BLOCK_SETS) & (F.col("shingles") <= BLOCK_SHINGLES), F.lit(1)).otherwise(parts).cast("int")
    placed = members.join(size.select("cluster", parts.alias("parts")), "cluster").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    placed = placed.select(
        F.coalesce("least", F.lit(_NO_ID)).alias("doc"), "node", "h1", "h2", (F.col("part") == low).alias("first"), F.xxhash64("cluster", low, high).alias("block")
    )
    placed = keep(placed, "blocks")
    named = documents.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), "text")
    texts = matching(named, placed.select("doc"), "doc").join(placed, "doc")
    bands_share = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(bands_share)
        for rows in whole_groups(batches, "block"):
            sets = shingle_sets(rows["text"], width)
            blocks, nodes = rows["block"].to_numpy(), rows["node"].to_numpy()
            first = rows["first"].to_numpy(zero_copy_only=False)
            # a doc_id may come with several texts: only the text of the class counts, once
            right = [set_hash(s) == name for s, name in zip(sets, zip(rows["h1"].to_pylist(), rows["h2"].to_pylist()))]
            ends = np.flatnonzero(np.append(blocks[1:] != blocks[:-1], True)) + 1
            pairs = []
            for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist()):
                own = {}
                for i in range(a, b):
                    if right[i]:
                        own.setdefault(nodes[i], i)
                at = list(own.values())
                if len(at) > 1:
                    pairs += [(nodes[at[i]], nodes[at[j]]) for i, j in linked([sets[i] for i in at], first[at], bands_share, bands)]
            found = np.array(pairs, np.int64).reshape(-1, 2)
            yield pa.record_batch({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})

    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return in_arrow(texts.repartition(parts, "block").sortWithinPartitions("block"), run, "a long, b long")


def one_of_each(documents: DataFrame, width: int = 5, share: Fraction = Fraction(4, 5)) -> DataFrame:
    """The documents without near copies: of each class the one with the least doc_id stays, of equal rows one.

    Documents with an empty set stay.
    """
    rows = keep(_classes(documents, width, share), "classes-of-rows")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    rows = rows.withColumn("doc", doc)
    # a doc_id that names one row says which row goes; of the others, few or none, the sets are looked at again
    again = keep(rows.groupBy("doc").count().where((F.col("count") > 1) | (F.col("doc") == _NO_ID)).select("doc"), "repeated")
    gone = rows.where("n_shingles > 0 and not doc_id <=> component_id").select("doc").distinct()
    all_rows = wrapped(documents, doc)
    schema = T.StructType([*all_rows.schema, *[T.StructField(c, T.LongType()) for c in ("n_shingles", "h1", "h2")]])

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch["text"], width)
            names = np.array([(len(s), *set_hash(s)) for s in sets], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(names[:, i]) for i in range(3)]], names=schema.names)

    repeated = in_arrow(matching(all_rows, again, "doc"), with_sets, schema)
    empty = repeated.where("n_shingles = 0").select("doc", "rest", "text")
    stays = rows.where("n_shingles > 0 and doc_id <=> component_id").select("doc", "n_shingles", "h1", "h2").distinct()
    one = repeated.join(stays, ["doc", "n_shingles", "h1", "h2"]).groupBy("doc", "n_shingles", "h1", "h2")
    one = one.agg(F.first(F.struct("rest", "text")).alias("kept")).select("doc", "kept.*")
    plain = without(without(all_rows, again, "doc"), gone, "doc")
    return unwrapped(plain.unionByName(empty).unionByName(one), documents)
