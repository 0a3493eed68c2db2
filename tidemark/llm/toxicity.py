"""Toxicity of documents by a subsequence string kernel and a support vector machine on Nystrom landmarks.

The kernel of two words counts the letter triples they share as subsequences: a triple found in a span of letters
weighs DECAY^(letters skipped), up to MOST_SKIPPED letters, and the sum is divided by the words' own lengths in that
measure. An insult with a letter inserted, doubled or parted by a sign shares nearly all of its triples with the plain
one. Digits that stand for letters are read as these; other signs are gaps. Lone letters in a row count as one word.

Training. Labelled documents, at most ``most_labels`` of the training rows (by hash), are cut into sentences, each with
its document's label, and counted per word. The words that tell toxic from clean sentences best and some common ones
are landmarks; Nystrom features of a word are its kernels with them, whitened. A squared-hinge machine learns on words
weighted by their sentences. It is fitted again without the words of toxic sentences that it found clean (a toxic
document has clean sentences too), and three times more with the clean words of all sentences that came closest to the margin. Because the kernel
is an inner product over triples, the machine is one weight per triple, and that table is all that scoring needs.

Insults made of several words, or parted by a blank, are learned by a second machine on sentences (``phrases``): the
toxic training documents whose words do not tell them from the clean ones (their margin is not above that of all but one
in a hundred of these) show it which pairs of words do.

A document's margin is the largest of its words, wherever they stand, and that of the second machine the largest of its
sentences; a logistic curve of both, fitted on the training documents, turns them into a score. Every word and every
sentence of every text is scored. Null and empty texts, and those without letters, get
the margin of no evidence. Labels that are null or for unknown documents are not used; of several labels for one
document the largest counts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import phrases
from tidemark.llm.common import coded, in_arrow, keep, matching, ship, slices, whole
from tidemark.llm.string_kernel import SIZE, margins, projected, triples_of

MOST_LABELS = 20_000
LANDMARKS = 320
#: rounds in which the clean words with the largest margins join the training
HARD_ROUNDS = 3
#: words that one round of training looks at
TRAINING_WORDS = 12_000
THRESHOLD = 0.3
#: rows of features that training widens to doubles at a time
ROWS_TOGETHER = 1024
#: share of the clean training documents whose words must be below those of a toxic one that its words explain
EXPLAINED = 0.99


def spread_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words between blanks, and where each text begins; runs of lone letters follow as one word each."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(whole(texts)))
    flat, begins = lists.flatten(), lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    lone = pc.equal(pc.utf8_length(flat), 1).to_numpy(zero_copy_only=False)
    ends = np.zeros(len(flat) + 1, bool)
    ends[begins] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[0], lone.view(np.int8), [0]])))
    runs = [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= 3]
    if not runs:
        return flat, begins
    joined, at = [], []
    for a, b in runs:
        cuts = [a, *(np.flatnonzero(ends[a + 1 : b]) + a + 1).tolist(), b]
        for x, y in itertools.pairwise(cuts):
            if y - x >= 3:
                joined.append("".join(flat.slice(x, y - x).to_pylist()))
                at.append(int(np.searchsorted(begins, x, side="right")) - 1)
    if not joined:
        return flat, begins
    of = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    order = np.argsort(np.concatenate([of, at]), kind="stable")
    everything = pa.concat_arrays([flat, pa.array(joined, flat.type)]).take(pa.array(order))
    counts = np.diff(begins) + np.bincount(at, minlength=len(begins) - 1)
    return everything, np.concatenate([[0], np.cumsum(counts)])


@dataclass
class Model:
    table: np.ndarray
    bias: float
    nothing: float = -2.0
    slope: float = 4.0
    offset: float = 0.0
    phrases: phrases.PhraseMachine | None = None
    phrase_slope: float = 0.0

    def margins(self, texts: pa.Array) -> np.ndarray:
        flat, begins = spread_words(texts)
        names, codes = coded(flat)
        out = np.full(len(begins) - 1, self.nothing)
        if names:
            value = margins(names, self.table, self.bias)[codes]
            some = np.flatnonzero(np.diff(begins))
            out[some] = np.maximum.reduceat(value, begins[some])
        return np.maximum(out, self.nothing)

    def scores(self, texts: pa.Array) -> np.ndarray:
        value = self.slope * self.margins(texts) + self.offset
        if self.phrases is not None:
            value = value + self.phrase_slope * self.phrases.margins(texts)
        return 1 / (1 + np.exp(-np.clip(value, -60, 60)))


def labelled(documents: DataFrame, labels: DataFrame, training, most_labels: int = MOST_LABELS) -> DataFrame:
    """text and toxic of at most ``most_labels`` labelled training documents, chosen by a hash of their id."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & training)
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labels)
    rows = matching(documents.select("doc_id", "text"), chosen.select("doc_id"), "doc_id")
    return rows.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def sentence_words(rows: DataFrame) -> DataFrame:
    """word, toxic and clean: in how many sentences of toxic and of clean documents each word stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            cut = pc.split_pattern_regex(whole(batch["text"]), r"[.!?\n]+")
            toxic = batch["toxic"].to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(len(cut)), np.diff(cut.offsets.to_numpy(zero_copy_only=False)))
            flat, begins = spread_words(cut.flatten())
            names, codes = coded(flat)
            if not names:
                continue
            sentence = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
            pairs = np.unique(sentence * len(names) + codes)
            label = toxic[of[pairs // len(names)]]
            counts = [np.bincount(pairs % len(names), label == y, len(names)).astype(np.int64) for y in (1, 0)]
            yield pa.record_batch({"word": pa.array(names, pa.string()), "toxic": pa.array(counts[0]), "clean": pa.array(counts[1])})

    counted = in_arrow(rows, run, "word string, toxic long, clean long")
    return counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _wide(z: np.ndarray, at: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """The rows ``at`` of z with a last column of ones, in doubles, a block at a time."""
    for begin in range(0, len(at), ROWS_TOGETHER):
        part = slice(begin, begin + ROWS_TOGETHER)
        rows = np.ones((len(at[part]), z.shape[1] + 1))
        rows[:, :-1] = z[at[part]]
        yield part, rows


def _machine(z: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.1, at: np.ndarray | None = None) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps; the last weight is the bias.

    It learns from the rows ``at`` (all, if not given), to which ``y`` and ``weight`` belong. The driver holds z once, and
    a block of rows.
    """
    at = np.arange(len(z)) if at is None else at
    w = np.zeros(z.shape[1] + 1)
    for _ in range(25):
        gram, right = penalty * np.eye(len(w)), np.zeros(len(w))
        for part, rows in _wide(z, at):
            inside = y[part] * (rows @ w) < 1
            rows, own = rows[inside], weight[part][inside]
            right += rows.T @ (own * y[part][inside])
            gram += rows.T @ (rows * own[:, None])
        new = np.linalg.solve(gram, right)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def fit(documents: DataFrame, labels: DataFrame, training, most_labels: int = MOST_LABELS) -> Model:
    """A model learned from the labelled documents for which ``training`` (of doc_id) holds."""
    ship(documents.sparkSession)
    rows = labelled(documents, labels, training, most_labels)
    counts = keep(sentence_words(rows), "sentence-words")
    telling = F.col("toxic") / (F.col("clean") + 1)
    top = counts.orderBy(F.desc(telling), F.desc("toxic"), "word").limit(TRAINING_WORDS // 2)
    common = counts.orderBy(F.desc("clean"), "word").limit(TRAINING_WORDS // 4)
    any_ = counts.where("clean > 0").orderBy(F.xxhash64("word"), "word").limit(TRAINING_WORDS // 4)
    known = top.union(common).union(any_).distinct().orderBy("word").toPandas()
    if not len(known) or not known["toxic"].sum():
        return Model(np.zeros(SIZE**3), -1.0)
    model = fit_words(known)
    for _ in range(HARD_ROUNDS):
        near = in_arrow(counts.where("clean > 0"), _word_margins(model), "word string, toxic long, clean long, margin double")
        near = near.orderBy(F.desc("margin"), "word").limit(TRAINING_WORDS // 4).select("word", "toxic", "clean").toPandas()
        known = pd.concat([known, near]).drop_duplicates("word").sort_values("word", ignore_index=True)
        model = fit_words(known)
    found = in_arrow(rows, _margin_rows(model), "toxic int, margin double").toPandas()
    margin, toxic = found["margin"].to_numpy(), found["toxic"].to_numpy()
    model.nothing = min(model.nothing, float(margin.min()))
    if (toxic == 0).any():
        cut = float(np.quantile(margin[toxic == 0], EXPLAINED))
        if ((toxic == 1) & (margin <= cut)).sum() >= phrases.LEAST_SEEN:
            open_ = in_arrow(rows, _unexplained(model, cut), "text string, toxic int")
            model.phrases = phrases.fit(open_, _machine)
    if model.phrases is None:
        return calibrated(model, margin[:, None], toxic)
    found = in_arrow(rows, _margin_rows(model), "toxic int, margin double, phrase double").toPandas()
    return calibrated(model, found[["margin", "phrase"]].to_numpy(), found["toxic"].to_numpy())


def fit_words(known: pd.DataFrame) -> Model:
    """The machine for words (word, toxic, clean)."""
    names, toxic, clean = known["word"].tolist(), known["toxic"].to_numpy(float), known["clean"].to_numpy(float)
    rate = toxic.sum() / max(clean.sum(), 1)
    odds = np.log((toxic + 0.5) / (rate * clean + 0.5)) * np.sqrt(toxic)
    places = [np.argsort(-odds, kind="stable")[: LANDMARKS // 2], np.argsort(-clean, kind="stable")[: LANDMARKS // 4]]
    places.append(np.linspace(0, len(names) - 1, LANDMARKS // 4).astype(np.int64))
    marks = [triples_of(names[i]) for i in np.unique(np.concatenate(places))]
    used, column = np.unique(np.concatenate([t for t, _ in marks]), return_inverse=True)
    phi = np.zeros((len(marks), len(used)))
    np.add.at(phi, (np.repeat(np.arange(len(marks)), [len(t) for t, _ in marks]), column), np.concatenate([v for _, v in marks]))
    size, axes = np.linalg.eigh(phi @ phi.T)
    whiten = axes[:, size > 1e-6] / np.sqrt(size[size > 1e-6])
    project = np.zeros((len(used) + 1, whiten.shape[1]), np.float32)
    project[1:] = phi.T @ whiten  # triples to Nystrom features
    place = np.zeros(SIZE**3, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    z, everything = projected(names, place, project), np.arange(len(names))
    del project
    sure = (toxic >= 10) & (toxic > 20 * rate * clean)
    use = np.ones(len(names), bool)
    w = np.zeros(z.shape[1] + 1)
    for _ in range(3):
        at_toxic = np.flatnonzero(use & (toxic > 0))
        at = np.concatenate([at_toxic, np.flatnonzero(clean > 0)])
        y = np.concatenate([np.ones(len(at_toxic)), -np.ones(len(at) - len(at_toxic))])
        weight = np.concatenate([toxic[at_toxic], 4 * rate * clean[clean > 0] + 1])
        w = _machine(z, y, np.minimum(weight, 200), at=at)
        use = sure | (np.concatenate([rows @ w for _, rows in _wide(z, everything)]) > 0)
    table = np.zeros(SIZE**3)
    table[used] = phi.T @ (whiten @ w[:-1])
    return Model(table, float(w[-1]))


def _word_margins(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = margins(batch["word"].to_numpy(zero_copy_only=False).tolist(), model.table, model.bias)
            yield batch.append_column("margin", pa.array(found))

    return run


def _margin_rows(model: Model):
    """toxic and the margins of each row, that of phrases where the model has a machine for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = {"toxic": batch["toxic"].cast(pa.int32()), "margin": pa.array(model.margins(batch["text"]))}
            if model.phrases is not None:
                found["phrase"] = pa.array(model.phrases.margins(batch["text"]))
            yield pa.record_batch(found)

    return run


def _unexplained(model: Model, cut: float):
    """The clean rows, and the toxic ones whose margin is not above ``cut``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            clean = batch["toxic"].to_numpy(zero_copy_only=False) == 0
            stays = pa.array(clean | (model.margins(batch["text"]) <= cut))
            kept = pa.record_batch({"text": batch["text"], "toxic": batch["toxic"].cast(pa.int32())})
            yield kept.filter(stays)

    return run


def calibrated(model: Model, margin: np.ndarray, toxic: np.ndarray) -> Model:
    """Slopes and offset of a logistic curve from margins (one column or two) to labels (Platt, 1999), by Newton steps.

    A column whose slope is not above 0 is left out; with none left the model stays as it is.
    """
    n1, n0 = (toxic == 1).sum(), (toxic == 0).sum()
    if not n1 or not n0:
        return model
    target = np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    columns = list(range(margin.shape[1]))
    while columns:
        x = np.hstack([margin[:, columns], np.ones((len(margin), 1))])
        w = np.append(np.ones(len(columns)), 0.0)
        ridge = np.append(np.full(len(columns), 1e-3), 1e-6)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
            v = np.maximum(p * (1 - p), 1e-9)
            g = x.T @ (p - target) + np.append(1e-3 * w[:-1], 0.0)
            step = np.clip(np.linalg.solve(x.T @ (x * v[:, None]) + np.diag(ridge), g), -1, 1)
            w = w - step
            if np.abs(step).max() < 1e-8:
                break
        if (w[:-1] > 0).all():
            slope = dict(zip(columns, w[:-1].tolist()))
            of_phrases = model.phrases if 1 in slope else None
            return Model(model.table, model.bias, model.nothing, slope.get(0, 0.0), float(w[-1]), of_phrases, slope.get(1, 0.0))
        columns.remove(columns[int(np.argmin(w[:-1]))])
    return Model(model.table, model.bias, model.nothing)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with ``score`` (0 to 1) and ``predicted`` (score reaches the threshold), in place of columns so named."""
    ship(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in documents.schema.fields if f.name not in ("score", "predicted")]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            found = held.value.scores(rows["text"])
            columns = [rows.column(i) for i in range(rows.num_columns)]
            more = [pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns + more, names=[*rows.schema.names, "score", "predicted"])

    return in_arrow(documents.select(*[F.col(f"`{f.name}`") for f in kept]), run, schema)
