"""Scores of whole documents by a gated recurrent language model.

Tokens are words (A-Z lower-cased) and an end behind each text. All training texts are counted. The model's vocabulary
is every word of the corpus, factored into classes: the most frequent words in classes of 32 of similar frequency, all
others in classes by their endings. A class with words of its own has a softmax over them; inside an ending class a
word has its share (c + 1) of the class's counts, and one more for words that training never saw. So probabilities sum
to one over all known words and an unknown one per class, however large the vocabulary is, while the network stays small.

The network (gru.py) starts at the words' frequencies and warms up on a bounded sample of training documents. Then every task trains a copy on all of its
training documents, cut into streams, by backpropagation through windows of WINDOW steps with the state carried from
window to window, and the copies are averaged by their tokens. Scoring carries the state through the complete document.

Counts of words under a share of 1 / FREQUENT of all tokens are joined; those of the rest, at most FREQUENT words, are
broadcast. Null and empty texts have the end as their one token. An empty training set leaves the network untrained.
Rows that repeat are scored each. Columns other than doc_id and text are left out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import gru
from tidemark.llm.common import coded, in_arrow, keep, ship, slices, words

FREQUENT = 4_000_000
HEAD_CLASSES, ENDINGS = 32, 32
HEAD = HEAD_CLASSES * gru.SLOTS
#: streams of a training step, steps of a window, words of a training stream, documents of the warm-up
STREAMS, WINDOW, STREAM_WORDS, WARM_DOCUMENTS = 512, 16, 256, 1500
WARM_PASSES, WARM_TOKENS = 8, 400_000
_END = np.uint64(1)
_FLUSH = 2_000_000


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch: hashes and ending classes of its distinct words, their numbers in text order, and where texts begin."""
    flat, begins = words(texts)
    names, codes = coded(flat)
    hashes = pd.util.hash_array(np.array(names, dtype=object)) if names else np.zeros(0, np.uint64)
    return hashes, np.fromiter(map(ending, names), np.int16, len(names)), codes, begins


def ending(word: str) -> int:
    """A class from 0 to 31 by the sign a word ends with and by the letters before it."""
    last = word[-1]
    if last.isalnum():
        return 16 + (7 * ord(last) + ord(word[-2:-1] or "a")) % 16
    kind = 0 if last == "." else 5 if last == "," else 10
    return kind + (7 * ord(word[-2:-1] or "a") + ord(word[-3:-2] or "a")) % (6 if kind == 10 else 5)


def count_words(documents: DataFrame) -> DataFrame:
    """word (hash), ending and c over all documents; an end for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def ready() -> pa.RecordBatch:
            hashes, endings, counts = (np.concatenate(x) for x in zip(*held))
            held.clear()
            found, first, place = np.unique(hashes, return_index=True, return_inverse=True)
            c = np.bincount(place, counts, len(found)).astype(np.int64)
            return pa.record_batch({"word": pa.array(found.view(np.int64)), "ending": pa.array(endings[first]), "c": pa.array(c)})

        for rows in slices(batches):
            hashes, endings, codes, _ = hashed(rows["text"])
            held.append((hashes, endings, np.bincount(codes, minlength=len(hashes))))
            held.append((np.array([_END]), np.array([-1], np.int16), np.array([rows.num_rows])))
            if sum(len(h[0]) for h in held) > _FLUSH:
                yield ready()
        if held:
            yield ready()

    counts = in_arrow(documents.select("text"), run, "word long, ending short, c long")
    return counts.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("c").alias("c"))


class Vocabulary:
    """What a task needs to know of the counts: bounded by FREQUENT words."""

    def __init__(self, frequent: pd.DataFrame, endings: pd.DataFrame, n: int, v: int):
        self.n, self.v = n, v
        words_ = frequent["word"].to_numpy(np.int64).view(np.uint64)
        counts = frequent["c"].to_numpy(np.int64)
        rank = np.lexsort((words_, -counts))
        heads = rank[words_[rank] != _END][: HEAD - 1]
        symbol = np.full(len(words_), -1, np.int32)
        symbol[heads] = np.arange(1, len(heads) + 1)  # 0 is the end
        order = np.argsort(words_)
        self.words, self.counts, self.symbols = words_[order], counts[order], symbol[order]
        # counts of an ending class: all of its words, one more each, and one for a word not seen, without the heads
        total = np.ones(ENDINGS)
        total[endings["ending"].to_numpy(np.int64)] += endings["total"].to_numpy(np.float64)
        np.subtract.at(total, frequent["ending"].to_numpy(np.int64)[heads], counts[heads] + 1.0)
        self.log_total = np.log10(np.maximum(total, 1.0))
        self.n_symbols, self.n_classes = HEAD + ENDINGS, HEAD_CLASSES + ENDINGS
        # where training starts: every word at its own frequency
        own = np.zeros(HEAD)
        own[0] = counts[words_ == _END].sum()
        own[1 : len(heads) + 1] = counts[heads]
        self.head_counts = (own + 0.5).reshape(HEAD_CLASSES, gru.SLOTS)
        self.class_counts = np.concatenate([self.head_counts.sum(1), np.maximum(total, 0.5)])
        symbols = np.arange(self.n_symbols)
        self.class_of = np.where(symbols < HEAD, symbols // gru.SLOTS, HEAD_CLASSES + symbols - HEAD)
        self.slot_of = np.where(symbols < HEAD, symbols % gru.SLOTS, -1)

    def network(self) -> dict[str, np.ndarray]:
        """A network that has learned nothing but the counts."""
        p = gru.initial(self.n_symbols, self.n_classes, HEAD_CLASSES)
        p["cb"] = np.log(self.class_counts / self.class_counts.sum()).astype(np.float32)
        p["wb"] = np.log(self.head_counts / self.head_counts.sum(1, keepdims=True)).astype(np.float32)
        return p

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts (0: not frequent) and head symbols (-1: none) of words."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        hit = self.words[place] == hashes
        return np.where(hit, self.counts[place], 0), np.where(hit, self.symbols[place], -1)


def vocabulary(counts: DataFrame) -> Vocabulary:
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = counts.where(F.col("c") * FREQUENT >= n).toPandas()
    endings = counts.where("ending >= 0").groupBy(F.col("ending").cast("int").alias("ending")).agg(F.sum(F.col("c") + 1).alias("total")).toPandas()
    return Vocabulary(frequent, endings, n, v)


_KEPT = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, inside double, symbols array<short>, rare array<long>, times array<int>"


def symbols_of(documents: DataFrame, held) -> DataFrame:
    """Per document its symbols, sums over frequent words, and its rare words with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab: Vocabulary = held.value
        part, count = TaskContext.get().partitionId(), 0
        end_count = int(vocab.look_up(np.array([_END]))[0][0])
        for rows in slices(batches):
            hashes, endings, codes, begins = hashed(rows["text"])
            c, head = vocab.look_up(hashes)
            symbol = np.where(head >= 0, head, HEAD + endings).astype(np.int16)
            logs = np.log10(c + 1.0)
            inside = np.where(head >= 0, 0.0, logs - vocab.log_total[endings])
            lengths = np.diff(begins)
            n = len(lengths)
            sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[codes])])[begins])
            of = np.repeat(np.arange(n), lengths)
            flat = np.insert(symbol[codes], begins[1:], 0)
            rare = np.flatnonzero(c[codes] == 0)
            pairs, times = np.unique(of[rare] * max(1, len(hashes)) + codes[rare], return_counts=True)
            doc = pairs // max(1, len(hashes))
            offsets = pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32())
            yield pa.record_batch(
                {
                    "row": pa.array((part << 33) + count + np.arange(n)),
                    "doc_id": rows["doc_id"],
                    "held_out": rows["held_out"],
                    "n_tokens": pa.array(lengths + 1),
                    "known": pa.array(sums((c > 0).astype(np.int64)) + int(end_count > 0)),
                    "base": pa.array(sums(logs) + np.log10(end_count + 1.0)),
                    "inside": pa.array(sums(inside)),
                    "symbols": pa.ListArray.from_arrays(pa.array(begins + np.arange(n + 1), pa.int32()), pa.array(flat)),
                    "rare": pa.ListArray.from_arrays(offsets, pa.array(hashes[pairs % max(1, len(hashes))].view(np.int64))),
                    "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                }
            )
            count += n

    return in_arrow(documents, run, _KEPT)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)


def train_streams(p: dict, flat: np.ndarray, begins: np.ndarray, vocab: Vocabulary, rate: float) -> int:
    """One pass over documents, in streams; the state is carried from window to window. Returns the number of tokens."""
    lengths = np.diff(begins)
    parts = -(-lengths // STREAM_WORDS)
    of = np.repeat(np.arange(len(lengths)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = begins[of] + nth * STREAM_WORDS
    size = np.minimum(lengths[of] - nth * STREAM_WORDS, STREAM_WORDS)
    order = np.random.RandomState(len(flat) % 2**31).permutation(len(size))
    order = order[np.argsort(-(size[order] // WINDOW), kind="stable")]
    groups = [order[a : a + STREAMS] for a in range(0, len(order), STREAMS)]
    adam = gru.Adam(p, rate)
    for g in np.random.RandomState(len(order)).permutation(len(groups)):
        at, n = first[groups[g]], size[groups[g]]
        h = np.zeros((len(at), gru.HIDDEN), np.float32)
        for t in range(0, int(n.max(initial=0)), WINDOW):
            steps = t + np.arange(min(WINDOW, int(n.max()) - t))[:, None]
            live = steps < n
            symbols = flat[np.where(live, at + steps, at)].astype(np.int64)
            grads, h, _ = gru.gradient(p, symbols, vocab.class_of[symbols], vocab.slot_of[symbols], live, h)
            adam.update(p, grads)
    return int(size.sum())


def train(kept: DataFrame, held) -> dict[str, np.ndarray]:
    """Parameters: a warm-up on a bounded sample, then all training documents in copies that are averaged."""
    spark = kept.sparkSession
    vocab: Vocabulary = held.value
    documents = kept.where("not held_out").select("row", "symbols")

    def copy(start: dict | None, rate: float):
        given = spark.sparkContext.broadcast(start)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocab = held.value
            p = {k: v.copy() for k, v in (given.value or vocab.network()).items()}
            tokens = 0
            for rows in batches:
                if rows.num_rows:
                    flat, begins = _flat(rows["symbols"])
                    tokens += train_streams(p, flat, begins, vocab, rate)
                    # the warm-up goes over a small sample again
                    for _ in range(0 if given.value else min(WARM_PASSES, WARM_TOKENS // max(1, len(flat)))):
                        train_streams(p, flat, begins, vocab, rate)
            if tokens:
                yield pa.record_batch({"part": pa.array([TaskContext.get().partitionId()], pa.int64()), "tokens": pa.array([tokens], pa.int64()), "p": pa.array([pickle.dumps(p)], pa.binary())})

        return run

    schema = "part long, tokens long, p binary"
    sample = documents.orderBy(F.xxhash64("row"), "row").limit(WARM_DOCUMENTS).repartition(1)
    warm = in_arrow(sample, copy(None, 0.02), schema).toPandas()
    if not len(warm):
        return vocab.network()
    copies = keep(in_arrow(documents, copy(pickle.loads(warm["p"][0]), 0.004), schema), "copies")

    def mean(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, tokens = None, 0
        for rows in batches:
            for n, raw in zip(rows["tokens"].to_pylist(), rows["p"].to_pylist()):
                p = {k: v.astype(np.float64) * n for k, v in pickle.loads(raw).items()}
                total = p if total is None else {k: total[k] + p[k] for k in p}
                tokens += n
        averaged = {k: (v / tokens).astype(np.float32) for k, v in total.items()}
        yield pa.record_batch({"part": pa.array([key[0].as_py()], pa.int64()), "tokens": pa.array([tokens], pa.int64()), "p": pa.array([pickle.dumps(averaged)], pa.binary())})

    # a bounded number of averages is read back, whatever the number of tasks
    few = copies.withColumn("group", F.pmod("part", F.lit(16))).groupBy("group").applyInArrow(mean, schema).toPandas()
    weights = few["tokens"].to_numpy(float) / few["tokens"].sum()
    parts = [pickle.loads(x) for x in few["p"]]
    return {k: sum(w * q[k].astype(np.float64) for w, q in zip(weights, parts)).astype(np.float32) for k in parts[0]}


def document_scores(p: dict, flat: np.ndarray, begins: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """log10 of the probability of each document's symbols; the state runs through the whole document."""
    lengths = np.diff(begins)
    order = np.argsort(-lengths, kind="stable")
    active = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), side="left")
    out = np.zeros(len(lengths))
    h = np.zeros((len(lengths), gru.HIDDEN), np.float32)
    states, targets, docs, held = [], [], [], 0

    def flush() -> None:
        nonlocal held
        symbols = np.concatenate(targets)
        found = gru.log_likelihood(p, np.concatenate(states), vocab.class_of[symbols], vocab.slot_of[symbols])
        out[:] += np.bincount(np.concatenate(docs), found, len(out))
        states.clear(), targets.clear(), docs.clear()
        held = 0

    for t, n in enumerate(active.tolist()):
        now = order[:n]
        symbols = flat[begins[now] + t].astype(np.int64)
        h = h[:n]
        states.append(h)
        targets.append(symbols)
        docs.append(now)
        held += n
        if held >= 1 << 16:
            flush()
        h = gru.step(p, symbols, h)[0]
    if held:
        flush()
    return out / np.log(10)


def lm_scores(documents: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document.

    ``held_out`` (of doc_id) says which documents are not learned from.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts = keep(count_words(rows.where("not held_out")), "word-counts")
    vocab = vocabulary(counts)
    held = spark.sparkContext.broadcast(vocab)
    kept = keep(symbols_of(rows, held), "symbols")
    network = spark.sparkContext.broadcast(train(kept, held))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = document_scores(network.value, *_flat(batch["symbols"]), held.value)
                yield batch.drop_columns(["symbols"]).append_column("network", pa.array(found))

    columns = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, inside double"
    scored = in_arrow(kept.select(*columns.replace(",", "").split()[::2], "symbols"), score, columns + ", network double")
    rare = kept.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    few = counts.where(F.col("c") * FREQUENT < vocab.n).select("word", "c")
    sums = rare.join(few, "word").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("logs"))
    everything = scored.join(sums, "row", "left").fillna(0, ["more", "logs"])
    return everything.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.col("more")).cast("long").alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(vocab.n + vocab.v + 1)))).alias("base_score"),
        (F.col("network") + F.col("inside") + F.col("logs")).alias("score"),
    )
