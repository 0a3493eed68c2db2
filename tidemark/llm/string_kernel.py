"""The subsequence kernel of words: letter triples, weighed by the letters they skip, on arrays of equal-length words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

DECAY, MOST_SKIPPED = 0.6, 2
#: the longest word that is taken in one piece
PIECE = 40
_LEET = dict(zip("013457", "oieast"))
SIZE, _EDGE = 64, 63


def _letters() -> np.ndarray:
    """A code from 1 to 62 for each letter of the basic plane, 0 for signs; 63 stands for either end of a word."""
    codes = np.zeros(0x110000, np.uint8)
    for c in range(0x10000):
        ch = _LEET.get(chr(c), chr(c))
        if "a" <= ch <= "z":
            codes[c] = ord(ch) - 96
        elif ch.isalnum():
            codes[c] = 27 + c % (_EDGE - 27)
    return codes


_CODES = _letters()
#: (offset of the second letter, of the third, weight)
_SHAPES = [(j, k, DECAY ** (k - 2)) for k in range(2, 3 + MOST_SKIPPED) for j in range(1, k)]


def kernel_triples(chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Of equal-length words (one row of letter codes each): triple numbers, whether they are letters only, weight."""
    length = chars.shape[1]
    for j, k, weight in _SHAPES:
        for i in range(length - k):
            a, b, c = chars[:, i], chars[:, i + j], chars[:, i + k]
            yield (a * SIZE + b) * SIZE + c, (a > 0) & (b > 0) & (c > 0), weight


def by_length(names: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of each length, and their letter codes. Long words come in overlapping pieces."""
    lengths = np.fromiter(map(len, names), np.int64, len(names))
    for length in np.unique(lengths[(lengths >= 3) & (lengths <= PIECE)]).tolist():
        at = np.flatnonzero(lengths == length)
        text = np.array([names[i] for i in at], dtype=f"<U{length}")
        chars = np.full((len(at), length + 2), _EDGE, np.int32)
        chars[:, 1:-1] = _CODES[text.view(np.uint32).reshape(len(at), length)]
        yield at, chars
    for i in np.flatnonzero(lengths > PIECE).tolist():
        chars = _CODES[np.frombuffer(names[i].encode("utf-32-le"), np.uint32)].astype(np.int32)
        step = PIECE - 12
        starts = np.arange(0, len(chars) - 12, step)
        padded = np.concatenate([chars, np.zeros(PIECE, np.int32)])
        yield np.full(len(starts), i), padded[starts[:, None] + np.arange(PIECE)]


def projected(names: list[str], place: np.ndarray, project: np.ndarray) -> np.ndarray:
    """The words' normalised triple weights times a matrix; ``place`` has the matrix row of each triple."""
    out = np.zeros((len(names), project.shape[1]), project.dtype)
    for at, chars in by_length(names):
        total, norm = np.zeros((len(at), project.shape[1]), project.dtype), np.zeros(len(at))
        for triple, ok, weight in kernel_triples(chars):
            total += project[np.where(ok, place[triple], 0)] * project.dtype.type(weight)
            norm += ok * weight**2
        out[at] = total / np.sqrt(np.maximum(norm, 1e-9))[:, None].astype(project.dtype)
    return out


def triples_of(name: str) -> tuple[np.ndarray, np.ndarray]:
    """A word's triples, maybe repeated, and their normalised weights."""
    found, weights = [np.zeros(0, np.int64)], [np.zeros(0)]
    for _, chars in by_length([name]):
        for triple, ok, weight in kernel_triples(chars[:1]):
            found.append(triple[ok])
            weights.append(np.full(int(ok.sum()), weight))
    weights = np.concatenate(weights)
    return np.concatenate(found), weights / np.sqrt(max((weights**2).sum(), 1e-9))


def margins(names: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """The machine's value for each word; words without a triple get the bias."""
    out = np.full(len(names), -np.inf)
    for at, chars in by_length(names):
        total, norm = np.zeros(len(at)), np.zeros(len(at))
        for triple, ok, weight in kernel_triples(chars):
            total += weight * table[triple]
            norm += ok * weight**2
        np.maximum.at(out, at, total / np.sqrt(np.maximum(norm, 1e-9)))
    return np.where(np.isfinite(out), out, 0.0) + bias
