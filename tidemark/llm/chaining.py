"""Substring dedup by collinear chaining: passages that a document shares, word for word or nearly, with an earlier one.

* Seeds: of every WINDOW runs of SEED_WORDS words the one with the least hash. Two passages with an equal stretch of
  SEED_WORDS + WINDOW - 1 words have a seed in common.
* Join: in order of doc_id, each occurrence of a seed is matched with the seed's first document and with the one just
  before its own, so a seed of n documents makes at most 2n matches. Tasks match their own documents first; only the
  first document of a task stands for the seed in the shuffle, and a passage of a third of all documents
  sends a row per task.
* Exact windows: the seeds of a passage may have different first documents, none of which has the whole. Windows of
  ``min_words`` words whose seeds all occur elsewhere and which no passage found so far covers are therefore looked up
  by a hash of all their words, so every window that an earlier document has word for word is reported.
* Chains: the matches of two documents are chained in ascending order of both positions; a match alone is a chain, too.
  A chain gains GAIN per match and pays GAP_COST per word between matches in either document, so the best predecessor is a maximum over
  earlier positions, kept in a Fenwick tree. Where that one is too far away, those within MOST_GAP are compared.
* Lone matches are many and mostly chance. One is a passage only if it grows by half of ``min_words`` on one side, so both
  documents send four bits per word of that much text, and only lone matches whose bits allow it are aligned; equal
  words have equal bits, so none is lost.
* Alignment: words are compared along a chain, the gaps between its diagonals are aligned, and its ends are extended as
  long as words agree. What has ``min_words`` words and ``min_identity`` of them equal is a repeated passage.

A passage stays in the document with the smallest doc_id. Null texts and texts shorter than ``min_words`` have none.
A document is its doc_id and text (``row``, a hash of both): rows that share a doc_id, or have none, are documents of
their own unless their texts are equal, and come in the order of their hashes. No document is compared with itself.
Where no doc_id repeats, ``row`` is the doc_id itself, which takes fewer bytes in every shuffle.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SLICE_BYTES, distinct, gather, in_arrow, in_order, keep, marked, matching, mix, ship, slices, term_hashes, unwrapped, whole, whole_groups, without, wrapped

SEED_WORDS, WINDOW = 5, 4
#: what a match adds to the score of a chain
GAIN = 7
GAP_COST, MOST_GAP, MOST_SHIFT = 0.1, 60, 30
MARGIN = 48
#: the score that an extension may lose before it ends
DROP = 8
#: seeds that a worker sorts at a time
_FLUSH = 250_000
_ASKS_TOGETHER = 100_000
_NO_ID = -(2**63)
#: bits of the maps of hashes that are broadcast, whatever the number of hashes
_MAP_BITS = 24
_BASE = 0x9E3779B97F4A7C15
_FACTORS = mix(np.arange(101, 101 + SEED_WORDS)) | np.uint64(1)
_WORD = regex.compile(r"[^\x20\x09-\x0D]+")
#: bytes hashed together, and bytes of the words that are hashed so at most
_BLOCK, _LONG = 1 << 16, 256
_IN_WORD = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LETTERS = mix(np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)]) + 1)
with np.errstate(over="ignore"):
    _UP = np.cumprod(np.full(_BLOCK + 1, _BASE, np.uint64))
    _DOWN = np.cumprod(np.full(_BLOCK + 1, pow(_BASE, -1, 2**64), np.uint64))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, and where each text begins.

    Differences of sums of powers, modulo 2^64, over the bytes of a block; no word becomes a string. Longer words than
    _LONG bytes, whose powers could be chosen to cancel out, are hashed as strings.
    """
    texts = whole(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[: len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[: offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8)
    inside = np.concatenate([[False], _IN_WORD[data], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = np.flatnonzero(inside[1:-1] & (edge[:-1] | ~inside[:-2]))
    end = np.flatnonzero(inside[1:-1] & (edge[1:] | ~inside[2:])) + 1
    hashes = np.empty(len(begin), np.uint64)
    size = end - begin
    long = np.flatnonzero(size > _LONG)
    reach = np.where(size > _LONG, begin, end)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(begin):
            first = begin[at]
            to = max(at + 1, int(np.searchsorted(end, first + _BLOCK, side="right")))
            stop = end[to - 1] if to > at + 1 or size[at] <= _LONG else first
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[data[first:stop]] * _UP[: stop - first])])
            a, b = begin[at:to] - first, reach[at:to] - first
            hashes[at:to] = (sums[b] - sums[a]) * _DOWN[a]
            at = to
    hashes = mix(hashes)
    if len(long):
        hashes[long] = term_hashes([data[a:b].tobytes().lower().decode("latin-1") for a, b in zip(begin[long].tolist(), end[long].tolist())])
    return hashes, np.searchsorted(begin, offsets)


def _picked(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of SEED_WORDS words, and of each WINDOW runs the place of the least; texts are not told apart."""
    n = len(hashes)
    with np.errstate(over="ignore"):
        runs = hashes[: n - SEED_WORDS + 1] * _FACTORS[0]
        for k in range(1, SEED_WORDS):
            runs += hashes[k : n - SEED_WORDS + 1 + k] * _FACTORS[k]
    runs = mix(runs)
    return runs, np.lib.stride_tricks.sliding_window_view(runs, WINDOW).argmin(1) + np.arange(len(runs) - WINDOW + 1)


def seeds(hashes: np.ndarray, begins: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed, number of its text and place in the text, of all texts with ``min_words`` words."""
    least = max(min_words, SEED_WORDS + WINDOW - 1)
    if len(hashes) < least:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs, picked = _picked(hashes)
    lengths = np.diff(begins)
    of = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(picked))
    inside = (lengths[of[at]] >= least) & (at + SEED_WORDS + WINDOW - 1 <= begins[of[at] + 1])
    place = picked[inside]  # of windows in a row: in ascending order
    place = place[np.append(True, place[1:] != place[:-1])] if len(place) else place
    return runs[place], of[place], place - begins[of[place]]


def _mark(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - _MAP_BITS)).astype(np.int64)


def _in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False where a hash is surely not among those of the map."""
    mark = _mark(hashes)
    return (bits[mark >> 6] >> (mark & 63).astype(np.uint64)) & np.uint64(1) != 0


def _map(marks: DataFrame) -> np.ndarray:
    """The map of all ``mark``; 2 MB at most pass the driver."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("mark").bitwiseAND(63).cast("int"))
    found = marks.groupBy(F.shiftright("mark", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    bits = np.zeros(1 << (_MAP_BITS - 6), np.int64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bits.view(np.uint64)


def likely_windows(hashes: np.ndarray, begins: np.ndarray, min_words: int, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of its text and place among all words, of each window of ``min_words`` words all of whose seeds are shared."""
    n = len(hashes)
    if n < min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.diff(begins)
    of = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(n - min_words + 1)
    likely = at + min_words <= begins[of[at] + 1]
    inside = min_words - (SEED_WORDS + WINDOW - 1) + 1
    if inside > 0:
        runs, picked = _picked(hashes)
        lone = np.concatenate([[0], np.cumsum(~_in_map(shared, runs[picked]))])
        likely &= lone[at + inside] == lone[at]
    at = at[likely]
    return of[at], at


def window_hashes(hashes: np.ndarray, at: np.ndarray, min_words: int) -> np.ndarray:
    """A hash of the ``min_words`` words from each place: differences of sums of powers, modulo 2^64."""
    n = len(hashes)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n + 1, _BASE, np.uint64))
        down = np.cumprod(np.full(n + 1, pow(_BASE, -1, 2**64), np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes) * up[:n])])
        return mix((sums[at + min_words] - sums[at]) * down[at])


def matches(seed: np.ndarray, doc: np.ndarray, row: np.ndarray, pos: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of occurrences sorted by seed, doc, row and pos: (row, pos, ref, ref_pos, mark) rows, and which are of first documents.

    Only occurrences that are ``asked`` are matched; any may be what they are matched with.
    """
    n = len(seed)
    new_seed = np.append(True, seed[1:] != seed[:-1])
    new_row = new_seed | np.append(True, (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]))
    head = np.maximum.accumulate(np.where(new_seed, np.arange(n), 0))
    mine = np.maximum.accumulate(np.where(new_row, np.arange(n), 0))
    starts = np.flatnonzero(new_row)
    before = starts[np.maximum(np.searchsorted(starts, mine) - 1, 0)]
    later = mine != head
    rows = np.flatnonzero(later & asked)
    mark = _mark(seed)
    found = np.stack([row[rows], pos[rows], row[head[rows]], pos[head[rows]], mark[rows]], axis=1)
    more = rows[before[rows] != head[rows]]
    found = np.concatenate([found, np.stack([row[more], pos[more], row[before[more]], pos[before[more]], mark[more]], axis=1)])
    return found, ~later


_MATCH = {"row": pa.int64(), "pos": pa.int32(), "ref": pa.int64(), "ref_pos": pa.int32(), "mark": pa.int32()}
_MATCH_DDL = "row long, pos int, ref long, ref_pos int, mark int"


def _match_batches(found: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(found), 200_000):
        part = found[a : a + 200_000]
        yield pa.record_batch({c: pa.array(part[:, i]).cast(t) for i, (c, t) in enumerate(_MATCH.items())})


_FOUND, _FIRST, _FIRST_ROW = 0, 1, 2
#: columns of each kind of block, and buckets that a task of the shuffle works on one after the other
_WIDTH, _BUCKETS = {_FOUND: 4, _FIRST: 3, _FIRST_ROW: 4}, 8


def blocks(kind: int, spread: np.ndarray, parts: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of numbers in ascending order of ``spread`` (64 bits), cut into a block for each bucket: (part, bucket, kind, data).

    A block holds the first byte of all its numbers, then the second, and so on: bytes that are alike compress well.
    """
    if not len(spread):
        return
    bucket = ((spread >> np.uint64(32)) * np.uint64(parts * _BUCKETS) >> np.uint64(32)).astype(np.int64)
    data = np.stack([c.astype(np.int64, copy=False) for c in columns], axis=1).view(np.uint8)
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    ends, bucket = np.append(starts[1:], len(data)), bucket[starts]
    for a in range(0, len(starts), 4096):
        some = slice(a, a + 4096)
        held = [data[i:j].T.tobytes() for i, j in zip(starts[some].tolist(), ends[some].tolist())]
        columns = {"part": bucket[some] // _BUCKETS, "bucket": bucket[some] % _BUCKETS, "kind": np.full(len(held), kind)}
        yield pa.record_batch({**{c: pa.array(v, pa.int32()) for c, v in columns.items()}, "data": pa.array(held, pa.binary())})


def in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, np.ndarray]]:
    """The numbers of ``blocks`` of one part, sorted by bucket: per bucket, the rows of each kind."""
    for rows in whole_groups(batches, "bucket"):
        bucket, kind = rows["bucket"].to_numpy(), rows["kind"].to_numpy()
        data = rows["data"]
        for one in distinct(bucket).tolist():
            kinds = {}
            for k in distinct(kind[bucket == one]).tolist():
                held = [np.frombuffer(data[i].as_buffer(), np.uint8).reshape(8 * _WIDTH[k], -1).T for i in np.flatnonzero((bucket == one) & (kind == k)).tolist()]
                kinds[k] = np.concatenate(held, out=np.empty((sum(map(len, held)), 8 * _WIDTH[k]), np.uint8)).view(np.int64)
            yield kinds


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))


def _row(documents: DataFrame) -> Column:
    counts = documents.groupBy(_doc().alias("doc")).agg(F.count(F.lit(1)).alias("rows"))
    return F.xxhash64(_doc(), "text") if counts.where("rows > 1").select("rows").head(1) else _doc()


def identified(documents: DataFrame, row: Column | None = None) -> DataFrame:
    """doc (doc_id as a number, the least for none), row (hash of doc and text, or doc where none repeats) and text."""
    return documents.select(_doc().alias("doc"), (_row(documents) if row is None else row).alias("row"), "text")


def all_matches(documents: DataFrame, pick: Callable, asked: DataFrame | None = None) -> DataFrame:
    """(row, pos, ref, ref_pos, mark): what ``pick`` takes at pos of row is found in ref, the row of an earlier document.

    ``pick`` gives hash, number of text and place of what it takes from a batch of texts. With ``asked`` (column ``row``), rows
    that are surely not among them are not matched, though others may be matched with them. Texts are read once: a
    task sends the matches inside it, spread by their row, together with the first document of each of its hashes. A match
    is (mark, ref, row, both places), a first document (hash, doc, place and whether asked, row unless that is doc).
    They are shuffled as ``blocks``, each bucket of which is put in order by the task that gets it.
    """
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def ready() -> Iterator[pa.RecordBatch]:
            seed, doc, row, pos, wanted = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(seed)
            order = order[in_order(seed[order], doc[order], row[order], pos[order])]
            seed, doc, row, pos, wanted = (x[order] for x in (seed, doc, row, pos, wanted))
            found, first = matches(seed, doc, row, pos, wanted)
            spread = mix(found[:, 0])
            order = np.argsort(spread)
            mark, ref, row_found, places = found[:, 4], found[:, 2], found[:, 0], found[:, 1] << 31 | found[:, 3]
            yield from blocks(_FOUND, spread[order], parts, *(x[order] for x in (mark, ref, row_found, places)))
            seed, doc, row, places = seed[first], doc[first], row[first], 2 * pos[first] + wanted[first]
            # a block has the hashes of a range, in the order of signed numbers
            spread = seed.view(np.uint64) ^ np.uint64(1 << 63)
            if np.array_equal(row, doc):
                yield from blocks(_FIRST, spread, parts, seed, doc, places)
            else:
                yield from blocks(_FIRST_ROW, spread, parts, seed, doc, places, row)

        for rows in slices(batches):
            seed, of, pos = pick(*word_hashes(rows["text"]))
            doc, row = (rows[c].to_numpy(zero_copy_only=False)[of] for c in ("doc", "row"))
            wanted = rows["_may_match"].to_numpy(zero_copy_only=False)[of]
            held.append((seed.view(np.int64), doc, row, pos, wanted))
            if sum(len(h[0]) for h in held) > _FLUSH:
                yield from ready()
        if any(len(h[0]) for h in held):
            yield from ready()

    def between_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kinds in in_buckets(batches):
            if _FOUND in kinds:
                mark, ref, row, places = kinds[_FOUND].T
                yield from _match_batches(np.stack([row, places >> 31, ref, places & (2**31 - 1), mark], axis=1))
            firsts = [kinds[_FIRST][:, [0, 1, 2, 1]]] if _FIRST in kinds else []
            firsts += [kinds[_FIRST_ROW]] if _FIRST_ROW in kinds else []
            if not firsts:
                continue
            seed, doc, pos, row = np.concatenate(firsts).T
            order = np.argsort(seed)
            same = seed[order][1:] == seed[order][:-1]
            several = order[np.append(same, False) | np.append(False, same)]  # the others have no match
            seed, doc, pos, row = (x[several] for x in (seed, doc, pos, row))
            order = in_order(seed, doc, row, pos)
            seed, doc, pos, row = (x[order] for x in (seed, doc, pos, row))
            found, _ = matches(seed, doc, row, pos >> 1, pos & 1 == 1)
            yield from _match_batches(found)

    texts = documents.select("doc", "row", "text")
    texts = texts.withColumn("_may_match", F.lit(True)) if asked is None else marked(texts, asked.select("row"), "row")
    rows = in_arrow(texts, sent, "part int, bucket int, kind int, data binary").repartitionById(parts, "part")
    return in_arrow(rows.sortWithinPartitions("bucket"), between_tasks, _MATCH_DDL)


def seed_matches(documents: DataFrame, min_words: int) -> DataFrame:
    return all_matches(documents, lambda hashes, begins: seeds(hashes, begins, min_words))


class Fenwick:
    """Maximum, with the item that has it, over all places up to one."""

    def __init__(self, n: int):
        self.best = [(-np.inf, -1)] * (n + 1)

    def put(self, place: int, value: float, item: int) -> None:
        place += 1
        best, new = self.best, (value, item)
        while place < len(best) and value > best[place][0]:  # places behind it that cover this one are no less
            best[place] = new
            place += place & -place

    def upto(self, place: int) -> tuple[float, int]:
        best, found = self.best, (-np.inf, -1)
        while place > 0:
            if best[place][0] > found[0]:
                found = best[place]
            place &= place - 1
        return found


def _may_follow(pos: list[int], ref_pos: list[int], j: int, i: int) -> bool:
    gap, ref_gap = pos[i] - pos[j], ref_pos[i] - ref_pos[j]
    return 0 < gap <= MOST_GAP and 0 < ref_gap <= MOST_GAP and abs(gap - ref_gap) <= MOST_SHIFT


def chains(pos: list[int], ref_pos: list[int]) -> list[list[int]]:
    """Chains of two or more matches, best first; every match is in one at most. Matches are sorted by pos."""
    n = len(pos)
    steps = [q - p for p, q in zip(pos, pos[1:])]
    if n > 1 and all(0 < x <= GAIN / (2 * GAP_COST) for x in steps) and steps == [q - p for p, q in zip(ref_pos, ref_pos[1:])]:
        return [list(range(n))]  # one diagonal on which every step gains
    levels = sorted(set(ref_pos))
    tree = Fenwick(len(levels))
    upto, put = tree.upto, tree.put
    rank = {r: k for k, r in enumerate(levels)}
    level = [rank[r] for r in ref_pos]
    cost = [GAP_COST * (p + r) for p, r in zip(pos, ref_pos)]
    score, before = [float(GAIN)] * n, [-1] * n
    i = 0
    while i < n:
        end = i
        while end < n and pos[end] == pos[i]:  # matches at one position are not before each other
            value, j = upto(level[end])
            gain = value - cost[end] + GAIN
            if j >= 0 and gain > score[end]:
                if _may_follow(pos, ref_pos, j, end):
                    score[end], before[end] = gain, j
                else:  # the best of all is too far; the best of those near enough
                    for j in range(i - 1, bisect.bisect_left(pos, pos[end] - MOST_GAP) - 1, -1):
                        gain = score[j] - GAP_COST * (pos[end] - pos[j] + ref_pos[end] - ref_pos[j]) + GAIN
                        if gain > score[end] and _may_follow(pos, ref_pos, j, end):
                            score[end], before[end] = gain, j
            end += 1
        for k in range(i, end):
            put(level[k], score[k] + cost[k], k)
        i = end
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda k: -score[k]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if len(chain) > 1:
            out.append(chain[::-1])
    return out


def candidate_chains(found: DataFrame) -> DataFrame:
    """row, ref and the matches (pos, ref_pos: arrays) of each chain between two documents, lone matches included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "pair"):
            row, ref, pair = rows["row"].to_numpy(), rows["ref"].to_numpy(), rows["pair"].to_numpy()
            pos, ref_pos = rows["pos"].to_numpy(), rows["ref_pos"].to_numpy()
            order = in_order(pair, row, ref, pos, ref_pos)
            row, ref, pair, pos, ref_pos = (x[order] for x in (row, ref, pair, pos, ref_pos))

            def as_chains(taken: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
                begins = np.cumsum(np.append(0, sizes))
                columns = {"row": pa.array(row[taken[begins[:-1]]]), "ref": pa.array(ref[taken[begins[:-1]]])}
                for c, values in (("pos", pos), ("ref_pos", ref_pos)):
                    columns[c] = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(values[taken], pa.int32()))
                return pa.record_batch(columns)

            new = (pair[1:] != pair[:-1]) | (row[1:] != row[:-1]) | (ref[1:] != ref[:-1])
            starts = np.flatnonzero(np.append(True, new))
            ends = np.append(starts[1:], len(row))
            single = starts[ends - starts == 1]  # most pairs share one seed
            yield as_chains(single, np.ones(len(single), np.int64))
            several = ends - starts > 1
            taken, sizes = [], []  # matches of chains in a row, and how many each chain has
            for a, b in zip(starts[several].tolist(), ends[several].tolist()):
                p, r = pos[a:b].tolist(), ref_pos[a:b].tolist()
                whole = chains(p, r)
                used = {i for chain in whole for i in range(chain[0], chain[-1] + 1)}
                for chain in whole:
                    # of matches on one diagonal an alignment needs the first and the last
                    shift = [None, *[r[i] - p[i] for i in chain], None]
                    chain = [a + i for k, i in enumerate(chain) if not shift[k] == shift[k + 1] == shift[k + 2]]
                    taken += chain
                    sizes.append(len(chain))
                if len(used) < b - a:
                    lone = [i for i in range(a, b) if i - a not in used]
                    taken += lone
                    sizes += [1] * len(lone)
            yield as_chains(np.array(taken, np.int64), np.array(sizes, np.int64))

    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pair = F.xxhash64("row", "ref")
    pairs = found.repartition(parts, pair).withColumn("pair", pair)  # made anew behind the shuffle, which is narrower without it
    return in_arrow(pairs.sortWithinPartitions("pair"), run, "row long, ref long, pos array<int>, ref_pos array<int>")


def _gap_matches(a: np.ndarray, b: np.ndarray) -> int:
    """Words of the longest common subsequence of two short stretches."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        up = np.maximum(row[1:], row[:-1] + (b == x))
        row[1:] = np.maximum.accumulate(up)
    return int(row[-1])


def _extension(equal: np.ndarray) -> tuple[int, int]:
    """How many words an end grows by, and how many of them agree."""
    if not len(equal):
        return 0, 0
    score = np.cumsum(np.where(equal, 1, -2))
    drop = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score > DROP)
    score = score[: drop[0]] if len(drop) else score
    if not len(score) or score.max() <= 0:
        return 0, 0
    n = int(score.argmax()) + 1
    return n, int(equal[:n].sum())


def align(a: np.ndarray, b: np.ndarray, pos: np.ndarray, ref_pos: np.ndarray) -> tuple[int, int, int, int, int]:
    """Begin and end in a, begin and end in b, and equal words of a chain's alignment; positions are those in a and b."""
    shift = ref_pos - pos
    starts = np.flatnonzero(np.append(True, shift[1:] != shift[:-1]))
    equal, last_a, last_b = 0, None, None
    for first, end in zip(starts.tolist(), np.append(starts[1:], len(pos)).tolist()):
        p, q, d = int(pos[first]), int(pos[end - 1]) + SEED_WORDS, int(shift[first])
        if last_a is not None:
            late = max(0, last_a - p, last_b - (p + d))  # diagonals may overlap by less than a seed
            p += late
            if p >= q:
                continue
            equal += _gap_matches(a[last_a:p], b[last_b : p + d])
        equal += int((a[p:q] == b[p + d : q + d]).sum())
        last_a, last_b = q, q + d
    p, d = int(pos[0]), int(shift[0])
    n = min(p, p + d)
    left, more = _extension((a[p - n : p] == b[p + d - n : p + d])[::-1])
    n = min(len(a) - last_a, len(b) - last_b)
    right, again = _extension(a[last_a : last_a + n] == b[last_b : last_b + n])
    return p - left, last_a + right, p + d - left, last_b + right, equal + more + again


def _extensions(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_extension`` of each row; places behind the end of a text are unequal."""
    score = np.cumsum(np.where(equal, 1, -2), axis=1)
    dropped = np.maximum.accumulate(np.maximum.accumulate(np.maximum(score, 0), axis=1) - score > DROP, axis=1)
    score[dropped] = -1
    n = np.where(score.max(1) > 0, score.argmax(1) + 1, 0)
    return n, np.where(n > 0, np.cumsum(equal, axis=1)[np.arange(len(n)), np.maximum(n - 1, 0)], 0)


def align_straight(words: np.ndarray, begin: np.ndarray, end: np.ndarray, ref_begin: np.ndarray, ref_end: np.ndarray, pos: np.ndarray, ref_pos: np.ndarray, size: np.ndarray):
    """What ``align`` gives for chains on one diagonal, many at once; texts are words[begin:end], chains have ``size`` words from pos."""
    at, ref = begin + pos, ref_begin + ref_pos
    most = len(words) - 1

    def same(a: np.ndarray, b: np.ndarray, n: np.ndarray, step: int) -> np.ndarray:
        k = np.arange(max(int(n.max(initial=0)), 1))
        return (words[np.clip(a[:, None] + step * k, 0, most)] == words[np.clip(b[:, None] + step * k, 0, most)]) & (k < n[:, None])

    sums = np.concatenate([[0], np.cumsum(words[gather(at, size)] == words[gather(ref, size)])])
    equal = np.diff(sums[np.concatenate([[0], np.cumsum(size)])])
    left, more = _extensions(same(at - 1, ref - 1, np.minimum(pos, ref_pos), -1))
    right, again = _extensions(same(at + size, ref + size, np.minimum(end - at, ref_end - ref) - size, 1))
    return pos - left, pos + size + right, ref_pos - left, ref_pos + size + right, equal + more + again


def align_lone(words: np.ndarray, begin: np.ndarray, end: np.ndarray, ref_begin: np.ndarray, ref_end: np.ndarray, pos: np.ndarray, ref_pos: np.ndarray):
    """``align_straight`` for chains of one match."""
    return align_straight(words, begin, end, ref_begin, ref_end, pos, ref_pos, np.full(len(pos), SEED_WORDS))


def _windows(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The words around each chain in its two documents: chain, side, doc, shift (place of the first word) and hashes."""
    ask = lambda row, pos, side: found.select(
        F.col(row).alias("row"),
        F.struct(
            "chain", F.lit(side).alias("side"), F.greatest(F.element_at(pos, 1) - MARGIN, F.lit(0)).alias("first"), (F.element_at(pos, -1) + SEED_WORDS + MARGIN).alias("last")
        ).alias("ask"),
    )
    asked = ask("row", "pos", 0).union(ask("ref", "ref_pos", 1)).groupBy("row").agg(F.collect_list("ask").alias("asks"))
    texts = matching(documents, asked.select("row"), "row").dropDuplicates(["row"]).join(asked, "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            hashes, begins = word_hashes(rows["text"])
            short = (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)
            lists = rows["asks"]
            asks = lists.flatten()
            of = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            shift, last = (asks.field(c).to_numpy() for c in ("first", "last"))
            first = np.minimum(begins[of] + shift, begins[of + 1])
            lengths = np.minimum(begins[of] + last, begins[of + 1]) - first
            ends = np.concatenate([[0], np.cumsum(4 * lengths)]).astype(np.int32)
            held = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(ends), pa.py_buffer(short[gather(first, lengths)])])
            columns = [asks.field("chain"), asks.field("side"), rows["doc"].take(pa.array(of)), pa.array(shift), held]
            yield pa.record_batch(columns, ["chain", "side", "doc", "shift", "hashes"])

    return in_arrow(texts.select("doc", "text", "asks"), run, "chain long, side int, doc long, shift int, hashes binary")


def _reach(min_words: int) -> int:
    """Words by which a lone match that becomes a passage grows on one side at least, as far as alignment looks."""
    return min(MARGIN, max(1, -(-(min_words - SEED_WORDS) // 2)))


def packed_words(hashes: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Four bits of each word's hash, two words to a byte, for each text."""
    lengths = np.diff(begins)
    ends = np.concatenate([[0], np.cumsum((lengths + 1) // 2)])
    bits = np.zeros(2 * int(ends[-1]), np.uint8)
    bits[gather(2 * ends[:-1], lengths)] = (hashes[begins[0] : begins[-1]] >> np.uint64(60)).astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(bits[0::2] << 4 | bits[1::2])])


def unpacked_words(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bits of all words of ``packed_words`` (a text of an odd number has one more), and where each text begins."""
    packed = pa.concat_arrays([packed]) if packed.offset else packed
    ends = np.frombuffer(packed.buffers()[1], np.int32)[: len(packed) + 1].astype(np.int64)
    data = np.frombuffer(packed.buffers()[2], np.uint8)[: ends[-1]] if ends[-1] else np.zeros(0, np.uint8)
    return np.stack([data >> 4, data & 15], axis=1).reshape(-1), 2 * ends[:-1]


def packed_sides(bits: np.ndarray, begin: np.ndarray, end: np.ndarray, pos: np.ndarray, reach: int) -> np.ndarray:
    """Per match: how many words lie on its left and right (up to ``reach``), then four bits of each, nearest first.

    ``bits`` are those four bits of all words, or their hashes of 64 bits.
    """
    place, k = begin + pos, np.arange(reach)
    bits = bits if bits.dtype == np.uint8 else (bits >> np.uint64(60)).astype(np.uint8)
    room = np.stack([np.minimum(pos, reach), np.clip(end - place - SEED_WORDS, 0, reach)], axis=1).astype(np.uint8)
    near = np.concatenate([place[:, None] - 1 - k, place[:, None] + SEED_WORDS + k], axis=1)
    found = bits[np.clip(near, 0, max(len(bits) - 1, 0))]
    return np.concatenate([room, found[:, 0::2] << 4 | found[:, 1::2]], axis=1)


def may_grow(a: np.ndarray, b: np.ndarray, reach: int) -> np.ndarray:
    """Whether each pair of ``packed_sides`` may grow by ``reach`` words on one side."""
    room = np.minimum(a[:, :2], b[:, :2])
    differ = a[:, 2:] ^ b[:, 2:]
    equal = np.empty((len(a), 2 * reach), bool)
    equal[:, 0::2], equal[:, 1::2] = differ >> 4 == 0, differ & 15 == 0
    grows = np.zeros(len(a), bool)
    for side in range(2):
        score = np.cumsum(np.where(equal[:, side * reach : (side + 1) * reach], 1, -2), axis=1)
        dropped = np.maximum.accumulate(np.maximum(score, 0), axis=1) - score > DROP
        grows |= (room[:, side] >= reach) & ~dropped.any(axis=1)
    return grows


def lone_survivors(documents: DataFrame, lone: DataFrame, min_words: int) -> DataFrame:
    """``chain`` of the lone matches (chain, row, ref, pos, ref_pos) that may become passages."""
    reach = _reach(min_words)
    ask = lambda row, pos, side: lone.select(F.col(row).alias("row"), F.struct("chain", (2 * F.col(pos) + side).alias("at")).alias("ask"))
    asked = ask("row", "pos", 0).union(ask("ref", "ref_pos", 1)).groupBy("row").agg(F.collect_list("ask").alias("asks"))
    texts = marked(documents.select("row", "text"), asked.select("row"), "row").where("_may_match")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            hashes, begins = word_hashes(rows["text"])
            yield pa.record_batch({"row": rows["row"], "n": pa.array(np.diff(begins)), "words": packed_words(hashes, begins)})

    # the bits of the words are an eighth of the texts
    texts = in_arrow(texts.select("row", "text"), packed, "row long, n long, words binary").dropDuplicates(["row"]).join(asked, "row")

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "words", SLICE_BYTES >> 4):
            bits, begins = unpacked_words(rows["words"])
            ends = begins + rows["n"].to_numpy()
            asks = rows["asks"].flatten()
            of = np.repeat(np.arange(rows.num_rows), pc.list_value_length(rows["asks"]).to_numpy(zero_copy_only=False))
            at = asks.field("at").to_numpy()
            for a in range(0, len(of), _ASKS_TOGETHER):
                part = slice(a, a + _ASKS_TOGETHER)
                found = packed_sides(bits, begins[of[part]], ends[of[part]], at[part] // 2, reach)
                held = pa.FixedSizeBinaryArray.from_buffers(pa.binary(found.shape[1]), len(found), [None, pa.py_buffer(np.ascontiguousarray(found))])
                columns = {"chain": asks.field("chain").slice(a, len(found)), "side": pa.array(at[part] % 2, pa.int8()), "words": held.cast(pa.binary())}
                yield pa.record_batch(columns)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, "chain"):
            side, chain = batch["side"].to_numpy(), batch["chain"].to_numpy()
            second = np.flatnonzero((side[1:] == 1) & (side[:-1] == 0) & (chain[1:] == chain[:-1])) + 1
            held = batch["words"].cast(pa.binary(2 + reach))
            held = pa.concat_arrays([held]) if held.offset else held
            found = np.frombuffer(held.buffers()[1], np.uint8).reshape(-1, 2 + reach)[: len(held)]
            grows = may_grow(found[second - 1], found[second], reach)
            yield pa.record_batch({"chain": pa.array(chain[second[grows]])})

    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = in_arrow(texts.select("n", "words", "asks"), sides, "chain long, side byte, words binary")
    return in_arrow(sent.repartition(parts, "chain").sortWithinPartitions("chain", "side"), judge, "chain long")


_PASSAGE = ("row", "doc", "begin", "end", "ref", "ref_doc", "ref_begin", "ref_end", "n_equal")


def passages(documents: DataFrame, min_words: int, min_identity: float) -> DataFrame:
    """Repeated passages of ``identified`` documents, with the row and doc of both."""
    matched = keep(seed_matches(documents, min_words), "matches")
    found = keep(candidate_chains(matched.drop("mark")), "chains")
    found = found.withColumn("chain", F.xxhash64("row", "ref", "pos", "ref_pos"))
    lone = found.where(F.size("pos") == 1).select("chain", "row", "ref", F.col("pos")[0].alias("pos"), F.col("ref_pos")[0].alias("ref_pos"))
    grown = keep(lone_survivors(documents, lone, min_words), "grown")
    found = keep(found.where(F.size("pos") > 1).unionByName(matching(found.where(F.size("pos") == 1), grown, "chain")), "candidates")
    windows = _windows(documents, found)
    lack = lambda *columns: [F.lit(None).cast(t).alias(c) for c, t in columns]
    anchors = found.select("chain", F.lit(2).alias("side"), *lack(("doc", "long")), F.lit(0).alias("shift"), *lack(("hashes", "binary")), "row", "ref", "pos", "ref_pos")
    rows = windows.select("*", *lack(("row", "long"), ("ref", "long"), ("pos", "array<int>"), ("ref_pos", "array<int>"))).union(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, "chain"):
            out = []
            side, chain, shift = (batch[c].to_numpy() for c in ("side", "chain", "shift"))
            last = np.flatnonzero(side == 2)
            last = last[last > 1]
            last = last[(side[last - 2] == 0) & (side[last - 1] == 1) & (chain[last - 2] == chain[last])]
            held = batch["hashes"]
            held = pa.concat_arrays([held]) if held.offset else held
            places = np.frombuffer(held.buffers()[1], np.int32)[: len(held) + 1].astype(np.int64) // 4
            words = np.frombuffer(held.buffers()[2], np.int32) if held.buffers()[2] else np.zeros(1, np.int32)
            lists = [batch[c].take(pa.array(last)) for c in ("pos", "ref_pos")]
            n = pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False).astype(np.int64)
            pos, ref_pos = (x.flatten().to_numpy().astype(np.int64) for x in lists)
            head = np.cumsum(n) - n
            tail = head + n - 1
            # of a chain on one diagonal no more than two matches are left
            straight = (n == 1) | ((n == 2) & (ref_pos[head] - pos[head] == ref_pos[tail] - pos[tail]))
            row, ref, doc = (pc.fill_null(batch[c], 0).to_numpy() for c in ("row", "ref", "doc"))
            one = last[straight]
            if len(one):
                sa, sb = shift[one - 2].astype(np.int64), shift[one - 1].astype(np.int64)
                a, b = head[straight], tail[straight]
                ends = (places[one - 2], places[one - 1], places[one - 1], places[one])
                p, q, rp, rq, equal = align_straight(words, *ends, pos[a] - sa, ref_pos[a] - sb, pos[b] - pos[a] + SEED_WORDS)
                good = np.flatnonzero((q - p >= min_words) & (equal >= min_identity * (q - p)))
                columns = (row[one], doc[one - 2], p + sa, q + sa, ref[one], doc[one - 1], rp + sb, rq + sb, equal)
                out += list(zip(*(c[good].tolist() for c in columns)))
            for i, k, m in zip(last[~straight].tolist(), head[~straight].tolist(), n[~straight].tolist()):
                sa, sb = int(shift[i - 2]), int(shift[i - 1])
                a, b = words[places[i - 2] : places[i - 1]], words[places[i - 1] : places[i]]
                p, q, rp, rq, equal = align(a, b, pos[k : k + m] - sa, ref_pos[k : k + m] - sb)
                if q - p >= min_words and equal >= min_identity * max(q - p, rq - rp):
                    out.append(tuple(map(int, (row[i], doc[i - 2], p + sa, q + sa, ref[i], doc[i - 1], rp + sb, rq + sb, equal))))
            columns = list(zip(*out)) if out else [()] * len(_PASSAGE)
            yield pa.record_batch({c: pa.array(v, pa.int64()) for c, v in zip(_PASSAGE, columns)})

    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    aligned = in_arrow(rows.repartition(parts, "chain").sortWithinPartitions("chain", "side"), run, ", ".join(f"{c} long" for c in _PASSAGE))
    aligned = keep(aligned.distinct(), "passages")
    return aligned.unionByName(exact_passages(documents, matched, aligned, min_words))


def _uncovered(first: int, last: int, spans: list, min_words: int) -> list[tuple[int, int]]:
    """Of the windows that begin at first to last (included), those with a word outside all spans, as such runs."""
    out, at, reach = [], first, -1
    merged: list[list[int]] = []
    for begin, end in sorted(spans):
        if merged and begin <= reach:
            merged[-1][1] = reach = max(reach, end)
        else:
            merged.append([begin, end])
            reach = end
    for begin, end in merged:
        if end - begin < min_words or end - min_words < at:
            continue
        if begin > last:
            break
        if begin > at:
            out.append((at, begin - 1))
        at = end - min_words + 1
    return [*out, (at, last)] if at <= last else out


def exact_passages(documents: DataFrame, matched: DataFrame, passages: DataFrame, min_words: int) -> DataFrame:
    """Passages of windows that an earlier document has word for word and that ``passages`` do not cover."""
    context = documents.sparkSession.sparkContext
    shared = context.broadcast(_map(matched.select("mark")))
    texts = documents.select("doc", "row", "text")
    # overlapping passages are joined first: every stretch below carries the spans of its row
    order = Window.partitionBy("row").orderBy("begin", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = passages.select("row", "begin", "end").distinct().withColumn("new", F.coalesce(F.col("begin") > reach, F.lit(True)).cast("int"))
    spans = spans.withColumn("span", F.sum("new").over(order)).groupBy("row", "span").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    spans = keep(spans.groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans")), "covered")

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            hashes, begins = word_hashes(rows["text"])
            of, at = likely_windows(hashes, begins, min_words, shared.value)
            new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(of) != 0)])) if len(at) else np.zeros(0, np.int64)
            end = np.append(new[1:], len(at)) - 1 if len(at) else new
            places = at - begins[of]
            yield pa.record_batch({"row": rows["row"].take(pa.array(of[new])), "first": pa.array(places[new]), "last": pa.array(places[end])})

    def left(rows: DataFrame) -> DataFrame:
        """The runs (row, first, last, further columns) cut down to windows that are not covered."""
        others = [c for c in rows.columns if c not in ("row", "first", "last")]
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = {"of": [], "first": [], "last": []}
                lists = batch["spans"]
                found = list(zip(*(lists.flatten().field(c).to_pylist() for c in ("begin", "end"))))
                ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)).tolist()
                for i, (first, last, k, end) in enumerate(zip(batch["first"].to_pylist(), batch["last"].to_pylist(), [0, *ends], ends)):
                    for a, b in _uncovered(first, last, found[k:end], min_words):
                        out["of"].append(i)
                        out["first"].append(a)
                        out["last"].append(b)
                take = pa.array(out["of"], pa.int64())
                columns = {"row": batch["row"].take(take), "first": pa.array(out["first"], pa.int64()), "last": pa.array(out["last"], pa.int64())}
                yield pa.record_batch(columns | {c: batch[c].take(take) for c in others})

        return in_arrow(rows.join(spans, "row", "left"), run, ", ".join(f"{c} long" for c in ("row", "first", "last", *others)))

    # kept, so that no task runs two workers at once
    asked = left(keep(in_arrow(texts, stretches, "row long, first long, last long"), "stretches"))
    asked = keep(asked.groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("asked")), "asked")

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            hashes, begins = word_hashes(rows["text"])
            at = [np.arange(x["first"], x["last"] + 1) + begins[i] for i, runs in enumerate(rows["asked"].to_pylist()) for x in runs]
            yield pa.record_batch({"mark": pa.array(_mark(distinct(window_hashes(hashes, np.concatenate(at), min_words)))).cast(pa.int32())})

    wanted = matching(texts, asked.select("row"), "row").join(asked, "row").select("text", "asked")
    wanted = context.broadcast(_map(in_arrow(wanted, marks, "mark int")))

    def pick(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        of, at = likely_windows(hashes, begins, min_words, shared.value)
        keys = window_hashes(hashes, at, min_words)
        hit = _in_map(wanted.value, keys)
        return keys[hit], of[hit], (at - begins[of])[hit]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "row"):
            row, ref, first, ref_pos = (rows[c].to_numpy().astype(np.int64) for c in ("row", "ref", "pos", "ref_pos"))
            fresh = np.append(True, (np.diff(row) != 0) | (np.diff(ref) != 0) | (np.diff(first) != 0) | (np.diff(ref_pos) != 0))
            row, ref, first, ref_pos = row[fresh], ref[fresh], first[fresh], ref_pos[fresh]
            joined = (np.diff(row) == 0) & (np.diff(ref) == 0) & (np.diff(first) == 1) & (np.diff(ref_pos) == 1)
            new = np.flatnonzero(np.append(True, ~joined))
            end = np.append(new[1:], len(row)) - 1
            columns = (row[new], first[new], first[end], ref[new], ref_pos[new] - first[new])
            yield pa.record_batch(dict(zip(("row", "first", "last", "ref", "shift"), map(pa.array, columns))))

    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = all_matches(documents, pick, asked).drop("mark").repartition(parts, "row")
    found = found.sortWithinPartitions("row", "ref", F.col("ref_pos") - F.col("pos"), "pos")
    found = keep(in_arrow(found, runs, "row long, first long, last long, ref long, shift long"), "runs")
    found = keep(left(found), "exact")
    ids = found.select("row").union(found.select(F.col("ref").alias("row")))
    docs = keep(matching(documents.select("row", "doc"), ids, "row").distinct(), "docs")
    found = found.join(docs, "row").join(docs.select(F.col("row").alias("ref"), F.col("doc").alias("ref_doc")), "ref")
    found = found.withColumn("begin", F.col("first")).withColumn("end", F.col("last") + min_words).withColumn("n_equal", F.col("end") - F.col("begin"))
    return found.withColumn("ref_begin", F.col("begin") + F.col("shift")).withColumn("ref_end", F.col("end") + F.col("shift")).select(*_PASSAGE)


def repeated_passages(documents: DataFrame, min_words: int = 50, min_identity: float = 0.8) -> DataFrame:
    """doc_id, begin, end (words), ref_id, ref_begin, ref_end and n_equal of every passage that an earlier document has.

    ``doc_id`` and ``ref_id`` are null for documents without an id.
    """
    ship(documents.sparkSession)
    named = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    rows = passages(identified(documents), min_words, min_identity).distinct()
    return rows.select(named("doc").alias("doc_id"), "begin", "end", named("ref_doc").alias("ref_id"), "ref_begin", "ref_end", "n_equal")


def cut_passages(documents: DataFrame, min_words: int = 50, min_identity: float = 0.8) -> DataFrame:
    """The documents without their repeated passages. n_chars, if there, follows; a document left without words goes."""
    ship(documents.sparkSession)
    row = _row(documents)
    found = passages(identified(documents, row), min_words, min_identity)
    spans = found.groupBy(F.col("row").alias("doc")).agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    spans = keep(spans, "spans")
    rows = wrapped(documents, row)
    hit = matching(rows, spans.select("doc"), "doc").join(spans, "doc").select("rest", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for text, found in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                texts.append(without_words(text or "", [(s["begin"], s["end"]) for s in found]))
            out = pa.record_batch({"rest": batch["rest"], "text": pa.array(texts, pa.string())})
            yield out.filter(pa.array([bool(_WORD.search(t)) for t in texts], pa.bool_()))

    cut = in_arrow(hit, run, T.StructType([rows.schema["rest"], T.StructField("text", T.StringType())]))
    untouched = without(rows, spans.select("doc"), "doc").select("rest", "text")
    return unwrapped(untouched.unionByName(cut), documents, recount=True)


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and without the blanks behind them."""
    places = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, at = [], 0
    for begin, end in sorted(spans):
        begin, end = min(begin, len(places) - 1), min(end, len(places) - 1)
        if places[end] > at:
            out.append(text[at : max(at, places[begin])])
            at = places[end]
    return "".join([*out, text[at:]])
