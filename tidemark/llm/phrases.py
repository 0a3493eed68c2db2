"""Insults made of several words: a subsequence kernel of sentences over pairs of words, and a machine on landmarks.

A landmark is an ordered pair of words from labelled sentences. Its kernel with a sentence is the largest, over the
pairs of words of the sentence in that order with at most MOST_BETWEEN words between them, of FADE^(words between)
times the kernels of the two first and of the two second words. Words are compared by ``string_kernel``, without signs
at their ends; equal ones have 1, and what is below LEAST_ALIKE counts as 0. Both words must be there, so words that
are harmless apart stay so, and letters inserted into either cost little.

A sentence ends at a word with one of ``.!?`` among the signs at its end, and with its text. Equal sentences count once.

Learning. Pairs are counted by the toxic texts that hold them, the ``CANDIDATES`` most frequent ones also by clean
texts (equal texts count once; the sentences of one text speak alike, so they are no evidence by themselves). Those that
tell toxic texts by a log-likelihood ratio of ``EVIDENCE`` or more are landmarks, at most ``LANDMARKS``. A squared-hinge machine learns on Nystrom features of the sentences that hold a landmark, at most
``MOST_SENTENCES`` of either label, chosen by hash. Texts without words have no sentences, whatever they hold;
without telling pairs there is no machine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import coded, in_arrow, keep, slices, whole
from tidemark.llm.string_kernel import PIECE, SIZE, margins, projected, triples_of

MOST_BETWEEN, FADE = 2, 0.8
LEAST_ALIKE = 0.6
LANDMARKS, EVIDENCE = 96, 12.0
#: pairs of toxic texts that are counted in clean ones too, and in how many toxic texts each is at least
CANDIDATES, LEAST_SEEN = 20_000, 5
MOST_SENTENCES = 6_000
#: pairs of words that are compared with all landmarks at once
_CHUNK = 1 << 14


def _bare(name: str) -> tuple[str, bool]:
    """A word without the signs at its ends, and whether a sentence ends with it."""
    if name.isalnum():
        return name, False
    begin, end = 0, len(name)
    while begin < end and not name[begin].isalnum():
        begin += 1
    while end > begin and not name[end - 1].isalnum():
        end -= 1
    return name[begin:end], any(c in ".!?" for c in (name[end:] if begin < end else name))


@dataclass
class Sentences:
    """Words (places in ``names``) of texts in a row, with the sentence of each and the text of each sentence."""

    names: list[str]
    words: np.ndarray
    sentence: np.ndarray
    text: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> Sentences:
        lists = pc.utf8_split_whitespace(pc.utf8_lower(whole(texts)))
        begins = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        spelled, codes = coded(lists.flatten())
        if not spelled:
            return Sentences([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        bare = [_bare(name) for name in spelled]
        names = list(dict.fromkeys(b for b, _ in bare if b))
        place = {name: i for i, name in enumerate(names)} | {"": -1}
        words = np.array([place[b] for b, _ in bare], np.int64)[codes]
        ends = np.array([e for _, e in bare])[codes]
        starts = np.concatenate([[True], ends[:-1]])
        starts[begins[:-1][begins[:-1] < len(starts)]] = True
        sentence = np.cumsum(starts) - 1
        text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))[starts]
        full = words >= 0
        return Sentences(names, words[full], sentence[full], text)

    def pairs(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First word, second word, words between and sentence of the pairs whose words may be first and second."""
        found = []
        for between in range(MOST_BETWEEN + 1):
            step = between + 1
            a, b = self.words[:-step], self.words[step:]
            at = np.flatnonzero((self.sentence[:-step] == self.sentence[step:]) & first[a] & second[b])
            found.append((a[at], b[at], np.full(len(at), between), self.sentence[at]))
        a, b, between, sentence = map(np.concatenate, zip(*found))
        order = np.argsort(sentence, kind="stable")
        return a[order], b[order], between[order], sentence[order]


def alike(names: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the names that are like one of ``others``, and their kernels with all of these."""
    marks = [triples_of(other) for other in others]
    used, column = np.unique(np.concatenate([t for t, _ in marks]), return_inverse=True)
    phi = np.zeros((len(used) + 1, len(others)))
    of = np.repeat(np.arange(len(others)), [len(t) for t, _ in marks])
    np.add.at(phi, (column + 1, of), np.concatenate([v for _, v in marks]))
    most = np.zeros(SIZE**3)
    most[used] = phi[1:].max(axis=1)
    lengths = np.fromiter(map(len, names), np.int64, len(names))
    same = {other: i for i, other in enumerate(others)}
    equal = np.fromiter((same.get(name, -1) for name in names), np.int64, len(names))
    # no kernel with any of them is above the sum of the largest weights
    near = np.flatnonzero((lengths <= PIECE) & (margins(names, most, 0.0) >= LEAST_ALIKE - 1e-9) | (equal >= 0))
    place = np.zeros(SIZE**3, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    found = projected([names[i] for i in near], place, phi)
    found[lengths[near] > PIECE] = 0
    found[found < LEAST_ALIKE] = 0
    exact = np.flatnonzero(equal[near] >= 0)
    found[exact, equal[near][exact]] = 1
    return near, np.minimum(found, 1)


@dataclass
class Landmarks:
    words: list[str]
    first: np.ndarray
    second: np.ndarray

    @staticmethod
    def of(pairs: list[tuple[str, str]]) -> Landmarks:
        words = sorted({w for pair in pairs for w in pair})
        at = {w: i for i, w in enumerate(words)}
        return Landmarks(words, np.array([at[a] for a, _ in pairs]), np.array([at[b] for _, b in pairs]))

    def gram(self) -> np.ndarray:
        """The kernels of the landmarks with one another."""
        near, k = alike(self.words, self.words)
        among = np.zeros((len(self.words), len(self.words)))
        among[near] = k
        return among[np.ix_(self.first, self.first)] * among[np.ix_(self.second, self.second)]

    def kernels(self, read: Sentences) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sentences that hold something like a landmark, in ascending order, and their kernels with all landmarks."""
        if not read.names:
            return
        near, k = alike(read.names, self.words)
        row = np.zeros(len(read.names), np.int64)
        row[near] = np.arange(len(near))
        first, second = k[:, self.first], k[:, self.second]
        may = np.zeros((2, len(read.names)), bool)
        may[0, near], may[1, near] = first.any(axis=1), second.any(axis=1)
        a, b, between, sentence = read.pairs(may[0], may[1])
        open_, best = -1, np.zeros(0)
        for begin in range(0, len(a), _CHUNK):
            part = slice(begin, begin + _CHUNK)
            value = first[row[a[part]]] * second[row[b[part]]] * (FADE ** between[part])[:, None]
            ids, starts = np.unique(sentence[part], return_index=True)
            value = np.maximum.reduceat(value, starts, axis=0)
            if open_ == ids[0]:
                value[0] = np.maximum(value[0], best)
            elif open_ >= 0:
                yield np.array([open_]), best[None, :]
            open_, best = int(ids[-1]), value[-1]
            yield ids[:-1], value[:-1]
        if open_ >= 0:
            yield np.array([open_]), best[None, :]


@dataclass
class PhraseMachine:
    landmarks: Landmarks
    weight: np.ndarray
    bias: float

    def margins(self, texts: pa.Array) -> np.ndarray:
        """The largest value of a text's sentences; the bias where no sentence holds anything like a landmark."""
        out = np.full(len(texts), self.bias)
        read = Sentences.of(texts)
        for ids, value in self.landmarks.kernels(read):
            np.maximum.at(out, read.text[ids], value @ self.weight + self.bias)
        return out


def labelled_sentences(rows: DataFrame) -> DataFrame:
    """sentence (its words, blanks between), toxic and clean: in how many texts of either label it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            read = Sentences.of(batch["text"])
            if not len(read.words):
                continue
            ids, starts = np.unique(read.sentence, return_index=True)
            words = pa.array(read.names, pa.string()).take(pa.array(read.words))
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(words)).astype(np.int32)), words)
            toxic = batch["toxic"].to_numpy(zero_copy_only=False)[read.text[ids]]
            yield pa.record_batch({"sentence": pc.binary_join(lists, " "), "label": pa.array(toxic.astype(np.int32))})

    said = in_arrow(rows, run, "sentence string, label int").where("instr(sentence, ' ') > 0")
    return said.groupBy("sentence").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))


def _pair_counts(texts: DataFrame, only: list[str] | None = None) -> DataFrame:
    """pair (two words, a blank between) and n: in how many texts it stands; ``only`` some pairs, if given."""
    held = texts.sparkSession.sparkContext.broadcast(only) if only is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(held.value, pa.string()) if held is not None else None
        for batch in slices(batches):
            read = Sentences.of(batch["text"])
            if not read.names:
                continue
            short = np.fromiter(map(len, read.names), np.int64, len(read.names)) <= PIECE
            first = second = short
            if wanted is not None:
                sides = [set(side) for side in zip(*(p.split(" ") for p in held.value))]
                first, second = (np.fromiter((n in side for n in read.names), bool, len(read.names)) for side in sides)
            a, b, _, sentence = read.pairs(first, second)
            if not len(a):
                continue
            n = len(read.names)
            kind, code = np.unique(a * n + b, return_inverse=True)
            once = np.unique(read.text[sentence] * len(kind) + code) % len(kind)
            names = pa.array(read.names, pa.string())
            pair = pc.binary_join_element_wise(names.take(pa.array(kind // n)), names.take(pa.array(kind % n)), " ")
            count = pa.array(np.bincount(once, minlength=len(kind)).astype(np.int64))
            found = pa.record_batch({"pair": pair, "n": count})
            yield found if wanted is None else found.filter(pc.is_in(pair, value_set=wanted))

    return in_arrow(texts.select("text"), run, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _kernel_rows(landmarks: Landmarks) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "sentence"):
            read = Sentences.of(batch["sentence"])
            for ids, value in landmarks.kernels(read):
                if len(ids):
                    rows = batch.take(pa.array(read.text[ids]))
                    offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * value.shape[1])
                    yield rows.append_column("kernels", pa.ListArray.from_arrays(offsets, pa.array(value.ravel())))

    return run


def telling(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Log-likelihood ratio of counts against the share of toxic texts; 0 where they are not above it."""
    n = toxic + clean
    ratio = toxic * np.log(toxic / (n * share)) + np.where(clean > 0, clean * np.log(np.maximum(clean, 1) / (n * (1 - share))), 0)
    return np.where(toxic > n * share, ratio, 0.0)


def fit(rows: DataFrame, machine: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> PhraseMachine | None:
    """A machine learned from ``rows`` (text, toxic), or None where no pair of words tells toxic sentences.

    ``machine`` (features, labels of 1 and -1, weights) gives the weights of a linear machine, its bias last.
    """
    texts = keep(rows.where("text is not null").groupBy("text").agg(F.max("toxic").alias("toxic")), "labelled-texts")
    counted = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if not counted.get(1) or not counted.get(0):
        return None
    share = counted[1] / (counted[0] + counted[1])
    often = _pair_counts(texts.where("toxic = 1")).where(F.col("n") >= LEAST_SEEN)
    often = often.orderBy(F.desc("n"), "pair").limit(CANDIDATES).toPandas()
    if not len(often):
        return None
    clean = _pair_counts(texts.where("toxic = 0"), often["pair"].tolist()).toPandas()
    both = often.merge(clean.rename(columns={"n": "clean"}), "left", "pair").fillna({"clean": 0})
    both["evidence"] = telling(both["n"].to_numpy(float), both["clean"].to_numpy(float), share)
    chosen = both[both["evidence"] >= EVIDENCE].sort_values(["evidence", "pair"], ascending=[False, True])[:LANDMARKS]
    if not len(chosen):
        return None
    landmarks = Landmarks.of([tuple(p.split(" ")) for p in chosen["pair"]])
    sentences = labelled_sentences(texts)
    found = in_arrow(sentences, _kernel_rows(landmarks), "sentence string, toxic long, clean long, kernels array<double>")
    found = keep(found.select(F.xxhash64("sentence").alias("at"), "toxic", "clean", "kernels"), "sentence-kernels")
    sides = [found.where(f"{c} > 0").orderBy("at", "kernels").limit(MOST_SENTENCES).select(F.col(c).alias("n"), "kernels").toPandas() for c in ("toxic", "clean")]
    size, axes = np.linalg.eigh(landmarks.gram())
    whiten = axes[:, size > 1e-6] / np.sqrt(size[size > 1e-6])
    stacked = [np.vstack(side["kernels"].to_list()) if len(side) else np.zeros((0, len(chosen))) for side in sides]
    z = np.vstack([*stacked, np.zeros((1, len(chosen)))]) @ whiten  # the last row: sentences without landmarks
    y = np.concatenate([np.ones(len(sides[0])), -np.ones(len(sides[1]) + 1)])
    weight = np.concatenate([np.minimum(side["n"].to_numpy(float), 20) for side in sides] + [[max(len(sides[0]), 1)]])
    w = machine(z, y, weight)
    return PhraseMachine(landmarks, whiten @ w[:-1], float(w[-1]))
