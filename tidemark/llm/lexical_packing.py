"""Lexical retrieval packing: training windows filled with documents that are about the same things.

Every document's ids (with an end id) are cut: windows that a document fills alone are sequences of their own, its
rest is packed. Rests are ordered by a min-hash of their tokens, so that like ones come together, and cut into index
shards of bounded size. A shard is a BM25 inverted index over token ids, with document frequencies and the mean length
of all documents. The rest of a cut document, or else the first unused one, is the seed of the next window: the index
returns its best unused neighbours, which fill the window in this order; the last one is cut at the window's end. A
shard's last window goes on in the next shard of its task, so a task pads one sequence at most.

Null texts are empty: their end id is packed like any other. Rows that repeat are packed each; an empty table gives no
pieces. Columns other than doc_id and text are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import distinct, in_arrow, keep, mix, slices
from tidemark.llm.encoding import ENCODED_TOGETHER, closed, encoder

SHARD_DOCS, SHARD_IDS = 2048, 1 << 20
#: terms of a seed that are looked up, and neighbours that are returned
QUERY_TERMS, NEIGHBOURS = 24, 24
K1, B = 1.2, 0.75
PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long"


def with_ids(pieces: dict[str, np.ndarray], ids: list[np.ndarray]) -> dict[str, pa.Array]:
    """The ids themselves: a piece's real output."""
    begins = np.cumsum([0, *map(len, ids)])
    return pieces | {"ids": pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32()))}


def with_crc(pieces: dict[str, np.ndarray], ids: list[np.ndarray]) -> dict[str, pa.Array]:
    """In place of a piece's ids their crc32, as little-endian unsigned 32-bit integers."""
    return pieces | {"ids_crc32": pa.array([zlib.crc32(np.ascontiguousarray(x, "<u4")) for x in ids], pa.int64())}


#: with their ids, pieces take the more room beside a batch's text the more of it is encoded at a time
_TOGETHER = {with_ids: ENCODED_TOGETHER // 4, with_crc: ENCODED_TOGETHER}
_EXTRA = {with_ids: "ids array<int>", with_crc: "ids_crc32 long"}


class Index:
    """BM25 over the token ids of a shard's documents."""

    def __init__(self, ids: np.ndarray, begins: np.ndarray, idf: np.ndarray, mean_length: float):
        lengths = np.diff(begins)
        self.n = len(lengths)
        of = np.repeat(np.arange(self.n), lengths)
        keys = np.sort(ids.astype(np.int64) * self.n + of)
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        keys, tf = keys[at], np.diff(np.append(at, len(keys)))
        term, self.doc = keys // self.n, keys % self.n
        norm = K1 * (1 - B + B * lengths / max(mean_length, 1))
        self.weight = (idf[term] * tf * (K1 + 1) / (tf + norm[self.doc])).astype(np.float32)
        starts = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
        self.first = np.zeros(len(idf), np.int64)
        self.last = np.zeros(len(idf), np.int64)
        self.first[term[starts]], self.last[term[starts]] = starts, np.append(starts[1:], len(term))
        # a document's terms, those first that weigh most in it
        order = np.lexsort((-self.weight, self.doc))
        self.terms, at = term[order], np.searchsorted(self.doc[order], np.arange(self.n + 1))
        self.terms_from, self.terms_to = at[:-1], np.minimum(at[:-1] + QUERY_TERMS, at[1:])

    def neighbours(self, doc: int, unused: np.ndarray) -> list[int]:
        """The unused documents that score best for the heaviest terms of a document."""
        score = np.zeros(self.n, np.float32)
        for term in self.terms[self.terms_from[doc] : self.terms_to[doc]].tolist():
            a, b = self.first[term], self.last[term]
            score[self.doc[a:b]] += self.weight[a:b]
        score *= unused
        score[doc] = 0
        top = np.argpartition(score, -NEIGHBOURS)[-NEIGHBOURS:] if self.n > NEIGHBOURS else np.arange(self.n)
        top = top[np.lexsort((top, -score[top]))]
        return top[score[top] > 0].tolist()


def fill(index: Index, lengths: np.ndarray, window: int) -> tuple[list[list[tuple[int, int, int]]], bool]:
    """Windows as lists of (document, from, to); whether the last one is full."""
    rest, at = lengths.tolist(), [0] * len(lengths)
    unused = np.ones(len(lengths), np.float32)
    windows: list[list[tuple[int, int, int]]] = []
    following, left, room = 0, sum(rest), 0
    cut = -1

    def place(d: int) -> None:
        nonlocal room, left, cut
        n = min(rest[d], room)
        windows[-1].append((d, at[d], at[d] + n))
        rest[d], at[d], room, left = rest[d] - n, at[d] + n, room - n, left - n
        cut = d if rest[d] else -1
        if not rest[d]:
            unused[d] = 0

    while left:
        windows.append([])
        room = window
        while not rest[following]:
            following += 1
        seed = cut if cut >= 0 else following
        place(seed)
        if room and left:
            for d in index.neighbours(seed, unused):
                if room and rest[d]:
                    place(d)
        while room and left:
            while not rest[following]:
                following += 1
            place(following)
    return windows, not windows or room == 0


def pack(documents: DataFrame, tokenizer: str, end_id: int, window: int = 1024, finish: Callable = with_ids) -> DataFrame:
    """Pieces: doc_id, start (ids of the document before it), length, doc_tokens, sequence_id, offset and what ``finish`` adds."""
    extra = _EXTRA[finish]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Full windows as pieces (kind 0), rests (kind 1), and in how many documents of the task each id stands (kind 2)."""
        found = np.zeros(0, np.int64)
        part, count = TaskContext.get().partitionId(), 0
        for rows in slices(batches, limit=_TOGETHER[finish]):
            ids, begins = closed(*encoder(tokenizer).encode(rows["text"]), end_id)
            lengths = np.diff(begins)
            full = lengths // window
            of = np.repeat(np.arange(len(lengths)), full)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(full) - full, full)
            names = rows["doc_id"]
            pieces = {
                "doc_id": names.take(pa.array(of)),
                "start": pa.array(nth * window),
                "length": pa.array(np.full(len(of), window)),
                "doc_tokens": pa.array(lengths[of]),
                "sequence_id": pa.array(2 * ((part << 32) + count + np.arange(len(of)))),
                "offset": pa.array(np.zeros(len(of), np.int64)),
            }
            count += len(of)
            whole = [ids[a : a + window] for a in (begins[of] + nth * window).tolist()]
            yield as_rows(0, finish(pieces, whole))
            at = np.flatnonzero(lengths > full * window)
            rests = [ids[a:b] for a, b in zip((begins[:-1] + full * window)[at].tolist(), begins[1:][at].tolist())]
            like = [int(mix(x).min() >> np.uint64(1)) for x in rests]
            flat = pa.array(np.concatenate([np.zeros(0, np.int32), *rests]), pa.int32())
            offsets = pa.array(np.cumsum([0, *map(len, rests)]), pa.int32())
            yield as_rows(1, {
                "doc_id": names.take(pa.array(at)),
                "start": pa.array((full * window)[at]),
                "length": pa.array((lengths - full * window)[at]),
                "doc_tokens": pa.array(lengths[at]),
                "like": pa.array(like, pa.int64()),
                "rest": pa.ListArray.from_arrays(offsets, flat),
            })
            most = int(ids.max(initial=0)) + 1
            if most > len(found):
                found = np.concatenate([found, np.zeros(most - len(found), np.int64)])
            pairs = [distinct(ids[a:b]) for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]
            found += np.bincount(np.concatenate(pairs), minlength=len(found)) if pairs else 0
        at = np.flatnonzero(found)
        yield as_rows(2, {"start": pa.array(at), "length": pa.array(found[at])})

    names = [*PIECE.replace(",", "").split()[::2], extra.split()[0], "like", "rest"]
    types = {n: pa.int64() for n in names} | {"rest": pa.list_(pa.int32())} | ({"ids": pa.list_(pa.int32())} if finish is with_ids else {})

    def as_rows(kind: int, columns: dict) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.record_batch({"kind": pa.array(np.full(n, kind, np.int32))} | {c: columns.get(c, pa.nulls(n, types[c])) for c in names})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = keep(in_arrow(rows, cut, f"kind int, {PIECE}, {extra}, like long, rest array<int>"), "cuts")
    # one row per id of the vocabulary
    frequencies = cuts.where("kind = 2").groupBy("start").agg(F.sum("length").alias("df")).toPandas()
    ends = F.col("start") + F.col("length") == F.col("doc_tokens")
    sizes = cuts.where("kind < 2").agg(F.count(F.when(ends, 1)), F.sum("length")).first()
    n_docs, n_ids = sizes[0], sizes[1] or 0
    idf = np.zeros(int(frequencies["start"].max()) + 1 if len(frequencies) else 1)
    df = frequencies["df"].to_numpy(np.float64)
    idf[frequencies["start"].to_numpy(np.int64)] = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    statistics = documents.sparkSession.sparkContext.broadcast((idf, n_ids / max(n_docs, 1)))

    def fill_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def shard(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal count
            ids = [h[3] for h in held]
            lengths = np.array([len(x) for x in ids], np.int64)
            index = Index(np.concatenate(ids), np.concatenate([[0], np.cumsum(lengths)]), *statistics.value)
            windows, complete = fill(index, lengths, window)
            open_ = [] if complete or last else windows.pop()
            out, parts = [], []
            for pieces in windows:
                offset = 0
                for d, a, b in pieces:
                    doc_id, start, tokens, _ = held[d]
                    out.append((doc_id, start + a, b - a, tokens, 2 * ((part << 32) + count) + 1, offset))
                    parts.append(ids[d][a:b])
                    offset += b - a
                count += 1
            held[:] = [(held[d][0], held[d][1] + a, held[d][2], ids[d][a:b]) for d, a, b in open_]
            columns = {c: pa.array([r[i] for r in out], pa.int64()) for i, c in enumerate(PIECE.replace(",", "").split()[::2])}
            yield pa.record_batch(finish(columns, parts))

        size = 0
        for batch in batches:
            lists = batch["rest"]
            begins, flat = lists.offsets.to_numpy(zero_copy_only=False), lists.values.to_numpy(zero_copy_only=False)
            names = zip(batch["doc_id"].to_pylist(), batch["start"].to_pylist(), batch["doc_tokens"].to_pylist(), begins[:-1].tolist(), begins[1:].tolist())
            for doc_id, start, tokens, a, b in names:
                held.append((doc_id, start, tokens, flat[a:b].copy()))
                size += b - a
                if len(held) >= SHARD_DOCS or size >= SHARD_IDS:
                    yield from shard(False)
                    size = sum(len(h[3]) for h in held)
        if held:
            yield from shard(True)

    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rests = cuts.where("kind = 1").select("doc_id", "start", "doc_tokens", "like", "rest")
    rests = rests.repartitionByRange(parts, "like", F.xxhash64("doc_id")).sortWithinPartitions("like", "doc_id", "start")
    packed = in_arrow(rests, fill_windows, f"{PIECE}, {extra}")
    return cuts.where("kind = 0").select(*packed.columns).union(packed)
