"""I-Match fingerprints with randomised lexicons.

The lexicon holds the terms (words, A-Z lower-cased) whose inverse document frequency log(N / df) lies in a band: too
common words tell nothing, too rare ones are slips and names. At most (mean distinct terms of a document) * exp(upper
end) terms can be in it, so its size does not grow with the number of documents and it may be broadcast.

Of a document the distinct terms in the lexicon are sorted, and the sorted terms in each of several random subsets of
the lexicon are hashed. Subsets come in levels; one of level l keeps a term with probability 2^-l. A document with n
terms uses the two levels at which a subset keeps about one of them, so that short and very long documents are equally
tolerant to edits: the share of equal hashes, among subsets that keep a term of either document on a level that both
use, falls with the share of terms they do not have in common.

Frequencies are those of distinct content: documents of one sketch (least hashes of their terms, SKETCH of them, equal for
copies and mostly for near copies) count as one document if they are more than 1 in HOT of all. So the terms of a group
of copies that holds much of the corpus stay in the band.

A document without a term in the band gets the hash of all its terms and is like equal ones only. Null texts are empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import coded, distinct, in_arrow, mix, slices, term_hashes, words

#: lower and upper end of the band, in natural logarithms
BAND = (1.4, 7.6)
SUBSETS = 32
SKETCH, HOT = 6, 1024
#: what a document weighs in a frequency; a whole number, so that sums do not depend on their order
_UNIT = 1 << 20
_SALT = mix(np.arange(1, SUBSETS + 1)) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FLUSH = 2_000_000


def distinct_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a batch's terms, and the (text, term) pairs without repeats, by text."""
    flat, begins = words(texts)
    names, codes = coded(flat)
    hashes = term_hashes(names)
    of = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    pairs = distinct(of * max(1, len(names)) + codes)
    docs = pairs // max(1, len(names))
    return hashes, docs, pairs - docs * max(1, len(names))


def sketches(hashes: np.ndarray, docs: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
    """A hash of the SKETCH least hashes of each text's terms, 0 for texts without any; pairs are sorted by text."""
    out = np.zeros(n, np.uint64)
    if len(docs):
        first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
        total = np.zeros(len(first), np.uint64)
        with np.errstate(over="ignore"):
            for s in range(SKETCH):
                total = mix(total + np.minimum.reduceat(mix(hashes ^ _SALT[s])[terms], first))
        out[docs[first]] = total
    return out.view(np.int64)


def hot_sketches(documents: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sketches of more than 1 in HOT documents (fewer than HOT, sorted) and how many documents have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            yield pa.record_batch({"sketch": pa.array(sketches(*distinct_terms(rows["text"]), rows.num_rows))})

    counts = in_arrow(documents.select("text"), run, "sketch long").where("sketch != 0").groupBy("sketch").count()
    hot = counts.where((F.col("count") > max(1, n / HOT))).toPandas().sort_values("sketch")
    return hot["sketch"].to_numpy(np.int64), hot["count"].to_numpy(np.int64)


def document_frequencies(documents: DataFrame, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """term (hash) and df in _UNITs of all documents, those of a hot sketch as one; counted per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def ready() -> pa.RecordBatch:
            terms, df = np.concatenate([h for h, _ in held]), np.concatenate([n for _, n in held]).astype(np.int64)
            held.clear()
            order = np.argsort(terms)
            terms = terms[order]
            first = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
            df = np.add.reduceat(df[order], first) if len(terms) else df
            return pa.record_batch({"term": pa.array(terms[first].view(np.int64)), "df": pa.array(df)})

        for rows in slices(batches):
            hashes, docs, terms = distinct_terms(rows["text"])
            weights = np.full(rows.num_rows, _UNIT, np.int64)
            if len(hot[0]):
                mine = sketches(hashes, docs, terms, rows.num_rows)
                place = np.minimum(np.searchsorted(hot[0], mine), len(hot[0]) - 1)
                weights = np.where(hot[0][place] == mine, np.maximum(_UNIT // hot[1][place], 1), weights)
            held.append((hashes, np.bincount(terms, weights[docs], len(hashes))))
            if sum(len(h) for h, _ in held) > _FLUSH:
                yield ready()
        if held:
            yield ready()

    counts = in_arrow(documents.select("text"), count, "term long, df long")
    return counts.groupBy("term").agg(F.sum("df").alias("df"))


def lexicon(documents: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """Sorted hashes of the terms in the band; all documents are counted."""
    n = documents.count()
    hot = hot_sketches(documents, n)
    distinct = n - int(hot[1].sum()) + len(hot[1])
    idf = F.log(F.lit(float(max(distinct, 1)) * _UNIT) / F.col("df"))
    terms = document_frequencies(documents, hot).where((idf >= band[0]) & (idf <= band[1])).select("term").toPandas()["term"]
    return np.sort(terms.to_numpy(np.int64).view(np.uint64))


class Fingerprints:
    """Fingerprints of a batch of texts: level of each, and on two levels the hash of what each subset keeps."""

    def __init__(self, texts: pa.Array, lexicon: np.ndarray):
        hashes, docs, terms = distinct_terms(texts)
        n = len(texts)
        everything = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            if len(docs):
                first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
                everything[docs[first]] = np.add.reduceat(mix(hashes)[terms], first)
        place = np.searchsorted(lexicon, hashes)
        known = (place < len(lexicon)) & (lexicon[np.minimum(place, len(lexicon) - 1)] == hashes) if len(lexicon) else np.zeros(len(hashes), bool)
        used = known[terms] if len(terms) else np.zeros(0, bool)
        docs, values = docs[used], hashes[terms[used]]
        ranks = np.empty(len(hashes), np.int64)
        ranks[np.argsort(hashes)] = np.arange(len(hashes))
        order = np.argsort(docs * max(1, len(hashes)) + ranks[terms[used]])
        docs, values = docs[order], values[order]
        self.count = np.bincount(docs, minlength=n)
        self.level = np.where(self.count > 0, np.floor(np.log2(np.maximum(self.count, 1))), 0).astype(np.int64)
        self.hashes = np.zeros((n, 2, SUBSETS), np.uint32)
        self.filled = np.zeros((n, 2, SUBSETS), bool)
        level = self.level[docs]
        low, high = ((np.uint64(1) << (64 - np.minimum(level + up, 31)).astype(np.uint64)) - np.uint64(1) for up in (0, 1))
        for s in range(SUBSETS):
            with np.errstate(over="ignore"):
                draw = mix(values * _SALT[s])
            first = np.flatnonzero(draw <= low)
            for up, kept in enumerate((first, first[draw[first] <= high[first]])):
                if len(kept):
                    self._fold(docs[kept], values[kept], up, s)
        plain = self.count == 0
        self.hashes[plain] = (mix(everything[plain]) >> np.uint64(32)).astype(np.uint32)[:, None, None]
        self.filled[plain] = True
        self.level[plain] = -2

    def _fold(self, docs: np.ndarray, values: np.ndarray, up: int, subset: int) -> None:
        """Hash of each document's sorted terms: a polynomial in them."""
        first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
        nth = np.arange(len(docs)) - np.repeat(first, np.diff(np.append(first, len(docs))))
        with np.errstate(over="ignore"):
            weight = np.power(np.full(len(docs), _STEP), nth.astype(np.uint64))
            total = mix(np.add.reduceat(mix(values) * weight, first))
        self.hashes[docs[first], up, subset] = (total >> np.uint64(32)).astype(np.uint32)
        self.filled[docs[first], up, subset] = True

    def strings(self) -> list[str]:
        raw = self.hashes.astype(">u4")
        empty = np.flatnonzero(~self.filled.reshape(len(raw), -1).any(1))
        raw[empty] = 0
        return [f"{'--' if l < 0 else format(l, '02d')}:{raw[i].tobytes().hex()}" for i, l in enumerate(self.level.tolist())]

    def likeness(self, mine: np.ndarray, other: "Fingerprints", theirs: np.ndarray) -> np.ndarray:
        """Of pairs of texts: equal hashes among the subsets that keep a term of either, on the levels of both."""
        same, either = np.zeros(len(mine)), np.zeros(len(mine))
        apart = other.level[theirs] - self.level[mine]
        for up in (0, 1):
            for down in (0, 1):
                at = np.flatnonzero(apart == up - down)
                a, b = self.hashes[mine[at], up], other.hashes[theirs[at], down]
                full = self.filled[mine[at], up] | other.filled[theirs[at], down]
                equal = full & (a == b) & self.filled[mine[at], up] & other.filled[theirs[at], down]
                same[at] += equal.sum(1)
                either[at] += full.sum(1)
        return np.where(either > 0, same / np.maximum(either, 1), 0.0)


def fingerprint(documents: DataFrame, terms: np.ndarray) -> DataFrame:
    """doc_id and fingerprint of each document."""
    held = documents.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            yield pa.record_batch({"doc_id": rows["doc_id"], "fingerprint": pa.array(Fingerprints(rows["text"], held.value).strings(), pa.string())})

    return in_arrow(documents.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, fingerprint string")


def with_next(documents: DataFrame) -> DataFrame:
    """The documents in runs of ascending doc_id, each run followed by the first row of the next one (``extra``).

    Runs are cut at quantiles of doc_id; the last run is followed by the first row of all. Null doc_ids come first.
    """
    spark = documents.sparkSession
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"), "doc_id", "text")
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = sorted(set(rows.approxQuantile("key", [i / parts for i in range(1, parts)], 0.25 / parts)))
    edges = F.array(*[F.lit(int(x)).cast("long") for x in edges]) if edges else F.array().cast("array<long>")
    run = lambda key: F.size(F.filter(edges, lambda e: e <= key))
    firsts = sorted((r["run"], r["first"]) for r in rows.groupBy(run(F.col("key")).alias("run")).agg(F.min("key").alias("first")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    here = F.struct(run(F.col("key")).alias("run"), F.lit(False).alias("extra"))
    places = F.array(here)
    if before:
        known = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
        also = F.struct(known[F.col("key")].alias("run"), F.lit(True).alias("extra"))
        places = F.when(known[F.col("key")].isNotNull(), F.array(here, also)).otherwise(places)
    rows = rows.withColumn("place", F.explode(places)).select("place.run", "place.extra", "key", "doc_id", "text")
    return rows.repartition(parts // 4, "run").sortWithinPartitions("run", "extra", "key")


def compare_edited(documents: DataFrame, terms: np.ndarray) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    The edited text: the last quarter of the code points replaced by as many from the start of the next document.
    """
    held = documents.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for rows in slices(batches):
            if carried is not None:
                rows = pa.concat_batches([carried, rows])
            texts = [t or "" for t in rows["text"].to_pylist()]
            runs, extra = rows["run"].to_numpy(), rows["extra"].to_numpy(zero_copy_only=False)
            carried = rows.slice(rows.num_rows - 1)
            at = np.flatnonzero((runs[1:] == runs[:-1]) & ~extra[:-1])
            if not len(at):
                continue
            mine = Fingerprints(rows["text"], held.value)
            edited = []
            for i in at.tolist():
                quarter = len(texts[i]) // 4
                edited.append(texts[i][: len(texts[i]) - quarter] + texts[i + 1][:quarter])
            changed = Fingerprints(pa.array(edited, pa.string()), held.value)
            names = mine.strings()
            yield pa.record_batch(
                {
                    "doc_id": rows["doc_id"].take(pa.array(at)),
                    "n_chars": pa.array([len(texts[i]) for i in at], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                    "fingerprint": pa.array([names[i] for i in at], pa.string()),
                    "edited_fingerprint": pa.array(changed.strings(), pa.string()),
                    "near_edited": pa.array(mine.likeness(at, changed, np.arange(len(at)))),
                    "near_next": pa.array(mine.likeness(at, mine, at + 1)),
                }
            )

    columns = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    rows = with_next(documents).select("run", "extra", F.col("doc_id").cast("long").alias("doc_id"), "text")
    return in_arrow(rows, run, columns)
