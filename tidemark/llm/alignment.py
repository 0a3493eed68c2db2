"""Alignment of two tokenizers' tokens of the same text, by the bytes they cover.

Both tokenizers write a text as tokens whose bytes, joined, are a space and the text. Per batch, two as-of joins keyed by
document find for each token start the other side's token that covers it; both directions together give every pair of
tokens that overlap (of two such tokens the later start lies in the other). Where tokens of both sides end, a group ends.

A link's weight is the number of documents that hold its pair of ids linked. Pairs are counted over all documents. The
heaviest ``HEAVY`` pairs at most go to every task, as they make up most links; links of all other pairs are joined with
their counts, which are small, so no key is hot.

Null and empty texts, and texts that either tokenizer cannot give back byte for byte, have no tokens: zeros and an empty
string. Whole texts are aligned. Repeated rows count as documents each, whatever their doc_id; an empty table gives no
rows. Columns other than doc_id and text are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tidemark.llm.common import coded, in_arrow, keep, slices, whole
from tidemark.llm.encoding import byte_letters, encoder

#: words a process remembers; a full memory is emptied, which costs time and changes no result
REMEMBERED = 900_000
#: text aligned together
ALIGNED_TOGETHER = 1 << 20
#: pairs of ids, of the most documents, that every task gets: 16 bytes each
HEAVY = 1 << 18
#: ids of either side lie below this
MOST_IDS = 1 << 17
_MARK = "▁"
_PAIRS = "a array<int>, b array<int>, n array<int>"
_LOADED: dict[tuple[str, str], "Tokens"] = {}


def tokens(kind: str, path: str) -> "Tokens":
    """The tokenizer of a file, loaded once by each process."""
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = {"bytes": ByteTokens, "pieces": PieceTokens}[kind](path)
    return _LOADED[kind, path]


class Tokens:
    """A tokenizer's ids of texts, and the bytes of each id."""

    spelled: pa.Array

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text begins (one more than texts)."""
        raise NotImplementedError

    def lengths(self) -> np.ndarray:
        return pc.binary_length(self.spelled).to_numpy(zero_copy_only=False).astype(np.int64)


class ByteTokens(Tokens):
    """Byte-level BPE of a space and the text."""

    def __init__(self, path: str):
        self.encoder = encoder(path)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        vocabulary = self.encoder.tokenizer.get_vocab(with_added_tokens=True)
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, at in vocabulary.items():
            spelled[at] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.spelled = pa.array(spelled, pa.binary())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.encoder.encode(pc.binary_join_element_wise(" ", texts, ""))


class PieceTokens(Tokens):
    """Pieces of a model that puts a space before the text.

    No merge crosses into a run of spaces if no piece holds a space behind another sign and texts are taken as they are;
    then each distinct word of a batch, with the spaces before it, is encoded once. Other models encode whole texts.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelled = pa.array([self._bytes(p) for p in pieces], pa.binary())
        plan = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            plan.ParseFromString(file.read())
        how = plan.normalizer_spec
        self.by_words = (
            how.name == "identity"
            and not how.precompiled_charsmap
            and how.add_dummy_prefix
            and how.escape_whitespaces
            and not how.remove_extra_whitespaces
            and not plan.trainer_spec.treat_whitespace_as_suffix
            and not any(_MARK in p.lstrip(_MARK) for p in pieces)
        )
        self.ids: dict[str, bytes] = {}

    @staticmethod
    def _bytes(piece: str) -> bytes:
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(_MARK, " ").encode()

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as 32-bit integers; a memory that is full is emptied."""
        new = [w for w in words if w not in self.ids]
        if len(self.ids) + len(new) > REMEMBERED:
            self.ids.clear()
            new = words
        for word, ids in zip(new, self.model.encode(new, num_threads=1)):
            self.ids[word] = np.array(ids if word else [self.model.piece_to_id(_MARK)], "<i4").tobytes()  # a lone last space
        return [self.ids[w] for w in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_words:
            found = self.model.encode(texts.to_pylist(), num_threads=1)
            return np.concatenate([np.zeros(0, "<i4"), *[np.array(x, "<i4") for x in found]]), np.cumsum([0, *map(len, found)])
        # Words parted by single spaces; where spaces follow one another or end a text, its words keep theirs.
        odd = pc.match_substring_regex(texts, f"  |^ | $|{_MARK}").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        if odd.any():
            parts = [_runs(t) if o else w for t, o, w in zip(texts.to_pylist(), odd, lists.to_pylist())]
            lists = pa.array(parts, pa.list_(pa.string()))
        distinct, codes = coded(lists.flatten())
        found = self._words(distinct)
        begins = np.cumsum([0, *map(len, found)], dtype=np.int64) // 4
        taken = pa.LargeListArray.from_arrays(pa.array(begins), pa.array(np.frombuffer(b"".join(found), "<i4"))).take(pa.array(codes))
        return taken.flatten().to_numpy(zero_copy_only=False), taken.offsets.to_numpy(zero_copy_only=False)[lists.offsets.to_numpy(zero_copy_only=False)]


def _runs(text: str) -> list[str]:
    """Words with the spaces before them but one, and the spaces at the end; a text that holds the mark of a space is left whole."""
    return [text] if _MARK in text else [w[1:] for w in re.findall(" *[^ ]+| +$", " " + text)]


class Side:
    """The tokens of a batch: ids, the document of each, and the bytes they cover, counted over the batch."""

    def __init__(self, tokenizer: Tokens, texts: pa.Array):
        self.ids, begins = tokenizer.encode(texts)
        self.begins = begins.astype(np.int64)
        self.docs = np.repeat(np.arange(len(texts)), np.diff(self.begins))
        self.ends = np.cumsum(tokenizer.lengths()[self.ids])
        self.starts = self.ends - tokenizer.lengths()[self.ids]
        self.joined = tokenizer.spelled.take(pa.array(self.ids))

    def spelled(self) -> np.ndarray:
        """The bytes of all tokens in a row."""
        offsets = np.frombuffer(self.joined.buffers()[1], np.int32, len(self.joined) + 1)
        return np.frombuffer(self.joined.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]

    def spells(self, texts: pa.Array) -> np.ndarray:
        """For each document whether its tokens, joined, are its text."""
        at = np.concatenate([[0], self.ends])[self.begins]
        offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1)
        made, wanted = self.spelled(), np.frombuffer(texts.buffers()[2], np.uint8)
        if np.array_equal(at, offsets) and np.array_equal(made, wanted[: len(made)]):
            return np.ones(len(texts), bool)
        pairs = zip(at[:-1], at[1:], offsets[:-1], offsets[1:])
        return np.array([np.array_equal(made[i:j], wanted[k:m]) for i, j, k, m in pairs], bool)


def covering(left: Side, right: Side) -> np.ndarray:
    """For each token of ``left``, the token of ``right`` in the same document that covers its first byte."""
    starts = pd.DataFrame({"doc": left.docs, "start": left.starts})
    others = pd.DataFrame({"doc": right.docs, "start": right.starts, "token": np.arange(len(right.ids))})
    return pd.merge_asof(starts, others, on="start", by="doc")["token"].to_numpy().astype(np.int64)


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that share a byte, once each."""
    over_a, over_b = covering(a, b), covering(b, a)
    later = a.starts[over_b] != b.starts  # equal starts are in both directions
    return np.concatenate([np.arange(len(a.ids)), over_b[later]]), np.concatenate([over_a, np.flatnonzero(later)])


def _written(a: Side, b: Side, numbers: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Number of groups of each document, and the sha256 of its groups written out.

    ``numbers`` holds all ids as text, four times: before a comma, a bar, a semicolon and the end.
    """
    most = len(numbers) // 4
    ends = a.ends[np.isin(a.ends, b.ends, assume_unique=True)]
    docs = len(a.begins) - 1
    borders = np.concatenate([[0], a.ends])[a.begins]  # where documents begin, in bytes
    last_of_doc = np.isin(ends, borders[1:])
    group = [np.searchsorted(ends, side.ends) for side in (a, b)]
    mark = []
    for k, side in enumerate((a, b)):
        closes = side.ends == ends[group[k]]
        ending = np.full(len(ends), 1) if k == 0 else np.where(last_of_doc, 3, 2)
        mark.append(np.where(closes, ending[group[k]], 0))
    order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
    codes = (np.concatenate(mark) * most + np.concatenate([a.ids, b.ids]))[order]
    text = numbers.take(pa.array(codes))
    at = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1)[a.begins + b.begins]
    view = memoryview(text.buffers()[2])
    hashes = [hashlib.sha256(view[i:j]).hexdigest() for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
    counts = np.bincount(np.searchsorted(borders[1:], ends), minlength=docs)
    return counts, hashes


def _aligned(left: Side, right: Side, numbers: pa.Array) -> dict[str, np.ndarray | list]:
    """The columns of documents whose tokens of either side spell a space and the text."""
    size = len(left.begins) - 1
    first, second = overlaps(left, right)
    docs = left.docs[first]
    key = (docs * MOST_IDS + left.ids[first]) * MOST_IDS + right.ids[second]
    key, n = np.unique(key, return_counts=True)
    groups, hashes = _written(left, right, numbers)
    return {
        "n_a": np.diff(left.begins),
        "n_b": np.diff(right.begins),
        "n_groups": groups,
        "n_links": np.bincount(docs, minlength=size),
        "groups_sha256": hashes,
        "pairs": np.bincount(key // MOST_IDS**2, minlength=size),
        "a": key // MOST_IDS % MOST_IDS,
        "b": key % MOST_IDS,
        "n": n,
    }


def align(documents: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and each linked pair of ids with its links."""
    key = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokens("bytes", byte_bpe), tokens("pieces", pieces)
        most = max(len(a.spelled), len(b.spelled))
        if most > MOST_IDS:
            raise ValueError(f"ids must lie below {MOST_IDS}")
        numbers = pa.array([f"{i}{end}" for end in (",", "|", ";", "") for i in range(most)], pa.string())
        for rows in slices(batches, limit=ALIGNED_TOGETHER):
            texts = whole(rows["text"])
            chosen = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            found = None
            while len(chosen) and found is None:
                some = texts.take(pa.array(chosen))
                spelled = pc.binary_join_element_wise(" ", some, "")
                sides = Side(a, some), Side(b, some)
                same = sides[0].spells(spelled) & sides[1].spells(spelled)
                if same.all():
                    found = _aligned(*sides, numbers)
                chosen = chosen[same]
            yield _batch(rows["doc_id"], chosen, found)

    columns = f"doc_id {key}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, {_PAIRS}"
    return in_arrow(documents.select("doc_id", "text"), run, columns)


def _batch(doc_ids: pa.Array, chosen: np.ndarray, found: dict | None) -> pa.RecordBatch:
    """The rows of all documents; those not in ``chosen`` have no tokens."""
    columns: dict = {"doc_id": doc_ids}
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        column = np.zeros(len(doc_ids), np.int64)
        if found:
            column[chosen] = found[name]
        columns[name] = column
    hashes = [""] * len(doc_ids)
    sizes = np.zeros(len(doc_ids), np.int64)
    if found:
        sizes[chosen] = found["pairs"]
        for k, made in zip(chosen.tolist(), found["groups_sha256"]):
            hashes[k] = made
    columns["groups_sha256"] = pa.array(hashes, pa.string())
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    for name in "abn":
        columns[name] = pa.ListArray.from_arrays(offsets, pa.array(found[name] if found else [], pa.int32()))
    return pa.record_batch(columns)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per pair of ids: ``docs`` that hold it linked, and whether that is the highest of its first id."""
    pairs = aligned.select(F.explode(F.arrays_zip("a", "b")).alias("pair")).groupBy("pair.a", "pair.b").agg(F.count(F.lit(1)).alias("docs"))
    # an id has at most as many partners as the other vocabulary has ids
    return pairs.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))


def _heavy_from(counts: DataFrame, most: int) -> int:
    """The least number of documents, a power of two, that at most ``most`` pairs reach."""
    sizes = dict(counts.groupBy(F.floor(F.log2("docs")).cast("int")).count().collect())
    reached = 0
    for power in sorted(sizes, reverse=True):
        reached += sizes[power]
        if reached > most:
            return 1 << (power + 1)
    return 1


def weigh(aligned: DataFrame, most_heavy: int = HEAVY) -> DataFrame:
    """``aligned`` (a written table) with n_best and count_sum in the place of its pairs."""
    spark = aligned.sparkSession
    counts = keep(pair_counts(aligned), "pairs")
    least = _heavy_from(counts, most_heavy)
    heavy = counts.where(F.col("docs") >= least).select((F.col("a") * F.lit(MOST_IDS).cast("long") + F.col("b")).alias("key"), "docs", "best").toArrow()
    order = np.argsort(heavy["key"].to_numpy())
    shared = spark.sparkContext.broadcast([heavy[c].to_numpy()[order] for c in ("key", "docs", "best")])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, best = shared.value
        for rows in batches:
            offsets = rows["a"].offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            a, b, n = [rows[c].flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in "abn"]
            wanted = a * MOST_IDS + b
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            hit = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
            doc = np.repeat(np.arange(rows.num_rows), np.diff(offsets))
            columns = {c: rows[c] for c in rows.schema.names if c not in "abn"}
            for name, value in (("n_best", np.where(best[at] & hit, n, 0) if len(keys) else n * 0), ("count_sum", np.where(hit, n * docs[at], 0) if len(keys) else n * 0)):
                total = np.concatenate([[0], np.cumsum(value)])
                columns[name] = total[offsets[1:] - offsets[0]] - total[offsets[:-1] - offsets[0]]
            rest = np.concatenate([[0], np.cumsum(np.bincount(doc[~hit], minlength=rows.num_rows))])
            for name, value in (("a", a), ("b", b), ("n", n)):
                columns[name] = pa.ListArray.from_arrays(pa.array(rest, pa.int32()), pa.array(value[~hit], pa.int32()))
            yield pa.record_batch(columns)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name not in "abn")
    numbered = aligned.withColumn("_row", F.monotonically_increasing_id())
    half = keep(in_arrow(numbered, look_up, f"{kinds}, _row long, n_best long, count_sum long, {_PAIRS}"), "weighed")
    light = half.select("_row", F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("_row", "p.a", "p.b", "p.n")
    joined = light.join(counts.where(F.col("docs") < least), ["a", "b"])
    rest = joined.groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("_best"), F.sum(F.col("n") * F.col("docs")).alias("_sum"))
    whole_rows = half.drop("a", "b", "n").join(rest, "_row", "left")
    added = {"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}
    return whole_rows.withColumns(added).drop("_row", "_best", "_sum")


def alignments(documents: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    rows = weigh(keep(align(documents, byte_bpe, pieces), "aligned"))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
