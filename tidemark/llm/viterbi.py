"""SentencePiece encoding and decoding: the best segmentation of whole texts, for many words at once.

A text is escaped as the library does it (a space in front, spaces as U+2581) and cut in front of every run of spaces;
no piece reaches over such a cut. Distinct words are grouped by length, and all words of one length advance together:
at each position the hashes of the substrings that end there, from rolling hashes, probe the sorted hashes of the
pieces, a maximum over their lengths extends the best segmentations, and the winning lengths are the backpointers.
A character that is no piece is written as its UTF-8 bytes. Of equally good segmentations the one whose last piece is
longest wins, and so on towards the front.

Scores are those of the file. If these are only ranks (files of merges), a piece of rank r has the logarithm of
1 / (r + 1), normalised over all pieces: frequencies that fall with the rank. Byte pieces score BYTE each.

Decoding gives the text back, whatever it holds; ids that are not bytes of a character become U+FFFD. A null text is an
empty one and has no ids, null ids give an empty text. Other columns are left out; rows that repeat stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tidemark.llm.common import coded, gather, in_arrow, mix, slices, whole

BYTE = -30.0
REMEMBERED = 600_000
ENCODED_TOGETHER = 16 << 20
_SPACE, _LITERAL = "▁", "\udc81"  # a space, and U+2581 where the text itself has it
_RUNS = regex.compile(f"{_SPACE}+[^{_SPACE}]*")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOADED: dict[str, "Pieces"] = {}


def pieces_of(path: str) -> "Pieces":
    if path not in _LOADED:
        processor = SentencePieceProcessor(model_file=path)
        n = processor.get_piece_size()
        names = [processor.id_to_piece(i) for i in range(n)]
        kinds = ["byte" if processor.is_byte(i) else "other" if processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i) else "" for i in range(n)]
        _LOADED[path] = Pieces(names, [processor.get_score(i) for i in range(n)], kinds)
    return _LOADED[path]


def _hash(codes: np.ndarray) -> np.ndarray:
    """Rolling hashes of rows of characters: column j is that of the first j."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(codes.shape[1]):
            out[:, j + 1] = out[:, j] * _BASE + codes[:, j].astype(np.uint64) + np.uint64(1)
    return out


class Pieces:
    def __init__(self, names: list[str], scores: list[float], kinds: list[str]):
        self.names = names
        plain = [i for i, k in enumerate(kinds) if not k and names[i]]
        if any(_SPACE in names[i].lstrip(_SPACE) for i in plain):
            raise ValueError("pieces that reach over a space are not supported")
        value = np.array(scores, np.float64)
        if len(plain) and (value[plain] == np.round(value[plain])).all():
            rank = np.empty(len(plain))
            rank[np.argsort(-value[plain], kind="stable")] = np.arange(len(plain))
            value[plain] = -np.log(rank + 1) - np.log((1 / (np.arange(len(plain)) + 1)).sum())
        self.scores = value
        self.byte = np.full(256, -1)
        for i, k in enumerate(kinds):
            if k == "byte":
                self.byte[int(names[i][3:-1], 16)] = i
                self.scores[i] = BYTE
        self.raw = [bytes([int(n[3:-1], 16)]) if k == "byte" else b"" if k else n.replace(_SPACE, " ").encode() for n, k in zip(names, kinds)]
        self.longest = max((len(names[i]) for i in plain), default=1)
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.array([1, *[_BASE] * self.longest], np.uint64), dtype=np.uint64)
        keys = np.zeros(len(plain), np.uint64)
        for length in {len(names[i]) for i in plain}:
            at = [k for k, i in enumerate(plain) if len(names[i]) == length]
            text = np.array([names[plain[k]] for k in at], dtype=f"<U{length}").view(np.uint32).reshape(len(at), length)
            keys[at] = self._key(_hash(text)[:, -1], length)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(plain, np.int64)[order]
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _key(hashes: np.ndarray, length: int) -> np.ndarray:
        return mix(hashes + np.uint64(length << 50))

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids, as 32-bit integers, of the best segmentation of each word."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(lengths[lengths > 0]).tolist():
            at = np.flatnonzero(lengths == length)
            codes = np.frombuffer("".join([words[i] for i in at]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(at), length)
            for i, ids in zip(at.tolist(), self._viterbi(codes)):
                out[i] = ids
        return out

    def _viterbi(self, codes: np.ndarray) -> list[bytes]:
        n, length = codes.shape
        rolling = _hash(codes)
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0
        step, piece = np.zeros((n, length + 1), np.int16), np.full((n, length + 1), -1, np.int32)
        n_bytes = np.where(codes == 0xDC81, 3, 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))
        for end in range(1, length + 1):
            # a character in bytes comes last: any piece is better
            best[:, end] = best[:, end - 1] + BYTE * n_bytes[:, end - 1]
            step[:, end] = 1
            for size in range(1, min(self.longest, end) + 1):
                with np.errstate(over="ignore"):
                    key = self._key(rolling[:, end] - rolling[:, end - size] * self.power[size], size)
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = np.flatnonzero(self.keys[place] == key)
                if not len(hit):
                    continue
                ids = self.ids[place[hit]]
                value = best[hit, end - size] + self.scores[ids]
                better = value >= best[hit, end]
                rows = hit[better]
                best[rows, end], step[rows, end], piece[rows, end] = value[better], size, ids[better]
        return self._backwards(codes, step, piece)

    def _backwards(self, codes: np.ndarray, step: np.ndarray, piece: np.ndarray) -> list[bytes]:
        n, length = codes.shape
        at, rows = np.full(n, length), np.arange(n)
        ids, starts = [], []
        while len(rows):
            ids.append(np.stack([rows, at[rows], piece[rows, at[rows]]], axis=1))
            at[rows] -= step[rows, at[rows]]
            rows = rows[at[rows] > 0]
        steps = np.concatenate(ids)
        steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
        starts = np.searchsorted(steps[:, 0], np.arange(n + 1))
        flat = steps[:, 2].astype("<i4")
        plain = flat >= 0
        if plain.all():
            return [flat[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
        out = []
        for row, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
            parts = []
            for k in range(a, b):
                if plain[k]:
                    parts.append(flat[k : k + 1])
                else:
                    code = int(codes[row, steps[k, 1] - 1])
                    char = _SPACE if code == 0xDC81 else chr(code)
                    parts.append(self.byte[list(char.encode("utf-8", "replace"))].astype("<i4"))
            out.append(np.concatenate(parts).tobytes())
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text begins."""
        texts = whole(texts)
        literal = pc.match_substring(texts, _SPACE).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, "^ |  ").to_numpy(zero_copy_only=False) | literal
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        lists = pc.split_pattern(plain, " ")
        offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        names, codes = coded(lists.flatten())
        names = [_SPACE + x for x in names]
        counts = np.diff(offsets)
        counts[pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) | odd] = 0
        extra: dict[int, list[str]] = {}
        for i in np.flatnonzero(odd).tolist():
            text = texts[i].as_py().replace(_SPACE, _LITERAL).replace(" ", _SPACE)
            extra[i] = _RUNS.findall(_SPACE + text)
        codes = codes[gather(offsets[:-1], counts)]
        if extra:
            more = {w: None for ws in extra.values() for w in ws}
            place = {w: len(names) + k for k, w in enumerate(more)}
            names += list(more)
            begins = np.concatenate([[0], np.cumsum(counts)])
            parts, last = [], 0
            for i, ws in extra.items():
                parts += [codes[last : begins[i]], np.array([place[w] for w in ws], np.int64)]
                last = begins[i]
                counts[i] = len(ws)
            codes = np.concatenate([*parts, codes[last:]])
        found = [self.known.get(w) for w in names]
        missing = [k for k, f in enumerate(found) if f is None]
        if len(self.known) + len(missing) > REMEMBERED:
            self.known.clear()
        for k, ids in zip(missing, self.segment([names[k] for k in missing])):
            found[k] = ids
            if len(self.known) < REMEMBERED:
                self.known[names[k]] = ids
        begins = np.cumsum([0, *map(len, found)], dtype=np.int64) // 4
        runs = pa.LargeListArray.from_arrays(pa.array(begins), pa.array(np.frombuffer(b"".join(found), "<i4")))
        taken = runs.take(pa.array(codes))
        of_text = np.concatenate([[0], np.cumsum(counts)])
        return taken.flatten().to_numpy(zero_copy_only=False), taken.offsets.to_numpy(zero_copy_only=False)[of_text]

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def encode_documents(documents: DataFrame, model: str) -> DataFrame:
    """doc_id and ids of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, limit=ENCODED_TOGETHER):
            ids, begins = pieces_of(model).encode(rows["text"])
            yield pa.record_batch({"doc_id": rows["doc_id"], "ids": pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids, pa.int32()))})

    return in_arrow(documents.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of encoded documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = [pieces_of(model).decode(np.array(x.as_py() or [], np.int64)) for x in rows["ids"]]
            yield pa.record_batch({"doc_id": rows["doc_id"], "text": pa.array(texts, pa.string())})

    return in_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trips(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, n_chars, n_pieces, n_bytes (pieces that are bytes), score, ids_crc32, and whether decoding gives the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        is_byte = np.zeros(len(pieces.names), np.int64)
        is_byte[pieces.byte[pieces.byte >= 0]] = 1
        for rows in slices(batches, limit=ENCODED_TOGETHER):
            ids, begins = pieces.encode(rows["text"])
            ends = list(zip(begins[:-1].tolist(), begins[1:].tolist()))
            totals = np.concatenate([[0], np.cumsum(is_byte[ids])])
            scores = np.concatenate([[0], np.cumsum(pieces.scores[ids])])
            texts = whole(rows["text"])
            same = [pieces.decode(ids[a:b]) == (t or "") for (a, b), t in zip(ends, texts.to_numpy(zero_copy_only=False).tolist())]
            ids = ids.astype("<u4")
            yield pa.record_batch(
                {
                    "doc_id": rows["doc_id"],
                    "n_chars": pc.cast(pc.utf8_length(texts), pa.int64()),
                    "n_pieces": pa.array(np.diff(begins), pa.int64()),
                    "n_bytes": pa.array(totals[begins[1:]] - totals[begins[:-1]]),
                    "score": pa.array(np.round(scores[begins[1:]] - scores[begins[:-1]], 4)),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in ends], pa.int64()),
                    "round_trip": pa.array(same, pa.bool_()),
                }
            )

    columns = "doc_id long, n_chars long, n_pieces long, n_bytes long, score double, ids_crc32 long, round_trip boolean"
    return in_arrow(documents.select(F.col("doc_id").cast("long"), "text"), run, columns)
