"""Token ids of whole texts by a file of the tokenizers library, a batch at a time.

A byte-level BPE treats a text as separate pieces that its split pattern cuts, so each distinct piece of a batch is
encoded once, by the library's own model, and the ids are gathered for all its occurrences. Arrow does the rest;
only pieces that a process has not met are objects in Python. Other kinds of
tokenizer files go through ``encode_batch``. Either way the ids are those of ``encode(text, add_special_tokens=False)``
with the special tokens' strings taken as ordinary text.
"""

from __future__ import annotations

import itertools
import json
import string
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from tidemark.llm.common import gather, whole

#: pieces a process remembers; a full memory is emptied, which costs time and changes no result
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 64 << 20

#: white space as the split pattern takes it
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: the split of byte-level vocabularies: contractions, letters, digits and other signs with a space before them, blanks
_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_BLANKS}\p{{L}}\p{{N}}]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
#: bytes of text encoded together; the more, the more often a piece repeats
ENCODED_TOGETHER = 16 << 20
_LOADED: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The encoder of a file, loaded once by each process."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        split = plan.get("pre_tokenizer") or {}
        self.in_pieces = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and plan.get("normalizer") is None
            and plan["model"]["type"] == "BPE"
            and plan.get("truncation") is None
        )
        self.ids = Remembered()
        self.letters = {b: letter for b, letter in enumerate(byte_letters())}
        self.split = regex.compile(_SPLIT)

    def fresh(self, piece: str) -> list[int]:
        """Ids of one piece of the split, by the library's model."""
        plain = piece.isascii() and piece.isprintable()  # of these signs only the space has another letter
        written = piece.replace(" ", self.letters[32]) if plain else piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(written)]

    def pieces(self, runs: pa.Array, spaced: np.ndarray, odd: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of runs (with a space before those ``spaced``) and then of odd texts: all in a row, and where each run's begin.

        Letters, then signs, are two pieces, for no letter follows an apostrophe; Arrow parts them. Other runs are split one by one.
        """
        words = pc.utf8_rtrim(runs, characters=string.punctuation)
        letters = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        signs = behind(runs, words)
        signed = (pc.binary_length(signs).to_numpy(zero_copy_only=False) > 0) & letters
        words = pa.concat_arrays([words.filter(pa.array(letters & ~spaced)), pc.binary_join_element_wise("", words.filter(pa.array(letters & spaced)), " ")])
        other = np.flatnonzero(~letters)
        split = [self.split.findall(x if not s else " " + x) for x, s in zip(runs.take(pa.array(other)).to_pylist(), spaced[other].tolist())]
        split += [self.split.findall(x) for x in odd.to_pylist()]
        counts = np.concatenate([1 + signed, np.zeros(len(odd), np.int64)])
        counts[np.append(other, np.arange(len(runs), len(counts)))] = list(map(len, split))
        begins = np.concatenate([[0], np.cumsum(counts)])
        place = np.concatenate([  # of the words, signs and other pieces behind each other
            begins[:-1][np.append(letters & ~spaced, np.zeros(len(odd), bool))],
            begins[:-1][np.append(letters & spaced, np.zeros(len(odd), bool))],
            begins[:-1][np.append(signed, np.zeros(len(odd), bool))] + 1,
            gather(begins[:-1][np.append(other, np.arange(len(runs), len(counts)))], np.array(list(map(len, split)), np.int64)),
        ])
        found = pa.concat_arrays([words, signs.filter(pa.array(signed)), pa.array(itertools.chain.from_iterable(split), pa.string())])
        order = np.empty(len(place), np.int64)
        order[place] = np.arange(len(place))
        return found.take(pa.array(order)), begins

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row as 32-bit integers, and where each text begins (one more than texts)."""
        texts = whole(texts)
        if not self.in_pieces:
            found = [np.array(x.ids, "<i4") for x in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, "<i4"), *found]), np.cumsum([0, *map(len, found)])
        # A space begins a new run unless a blank follows or the text ends there; such texts are one run as a whole.
        odd = pc.match_substring_regex(texts, f" [{_BLANKS}]| $").to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        lists = pc.split_pattern(plain, " ")
        offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        spaced = np.ones(len(flat), bool)
        spaced[offsets[:-1]] = False
        heads, head_codes = dictionary(flat.filter(pa.array(~spaced)))
        rest, rest_codes = dictionary(flat.filter(pa.array(spaced)))
        del plain, lists, flat  # a worker's memory counts
        codes = np.empty(len(spaced), np.int64)
        codes[~spaced], codes[spaced] = head_codes, rest_codes + len(heads)
        codes[offsets[:-1][odd]] = len(heads) + len(rest) + np.arange(odd.sum())
        del head_codes, rest_codes
        behind_space = np.arange(len(heads) + len(rest)) >= len(heads)
        pieces, begins = self.pieces(pa.concat_arrays([heads, rest]), behind_space, texts.filter(pa.array(odd)))
        del heads, rest
        pieces, places = dictionary(pieces)
        ids, at = self.ids.lists(pieces, self.fresh)
        lengths = np.diff(at)[places]
        ids = ids[gather(at[places], lengths)]  # of all distinct runs
        at = np.concatenate([[0], np.cumsum(lengths)])[begins]
        del pieces, places, lengths
        lengths = np.diff(at)[codes]
        begins = np.concatenate([[0], np.cumsum(lengths)])[offsets]
        taken = pa.LargeListArray.from_arrays(pa.array(at), pa.array(ids)).take(pa.array(codes))
        return taken.flatten().to_numpy(zero_copy_only=False), begins


def dictionary(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct strings, and the place of each string among them."""
    encoded = values.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def behind(texts: pa.Array, heads: pa.Array) -> pa.Array:
    """What is left of each text behind its head."""
    lengths = pc.binary_length(heads).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    left = np.diff(offsets) - lengths
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    ends = np.concatenate([[0], np.cumsum(left)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(data[gather(offsets[:-1] + lengths, left)]))


class Remembered:
    """Pieces with their ids, as Arrow strings and two arrays of numbers: some 40 bytes a piece."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.known, self.flat, self.begins = pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __contains__(self, piece: str) -> bool:
        return pc.index_in(pa.array([piece]), value_set=self.known)[0].is_valid

    def lists(self, pieces: pa.Array, fresh: Callable[[str], list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces in a row and where each piece's begin; what is not known is asked of ``fresh``."""
        at = pc.fill_null(pc.index_in(pieces, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        unknown = np.flatnonzero(at < 0)
        asked = pieces.take(pa.array(unknown))
        found = [fresh(x) for x in asked.to_numpy(zero_copy_only=False).tolist()]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(found), np.int32, int(lengths.sum()))])
        begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(lengths)])
        at[unknown] = len(self.known) + np.arange(len(unknown))
        lengths = np.diff(begins)[at]
        ids = flat[gather(begins[at], lengths)]
        if len(begins) > REMEMBERED or self.known.nbytes + asked.nbytes + flat.nbytes > REMEMBERED_BYTES:
            self.clear()
        else:
            self.known, self.flat, self.begins = pa.concat_arrays([self.known, asked]), flat, begins
        return ids, np.concatenate([[0], np.cumsum(lengths)])


def closed(ids: np.ndarray, begins: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` behind each text."""
    return np.insert(ids, begins[1:], end_id), begins + np.arange(len(begins))
