"""Fingerprints, Jaccard classes, repeated passages, shards and nearest vectors against brute force."""

from __future__ import annotations

import hashlib
import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from fixtures import documents, odd_texts, prose, words_of
from pyspark.sql import functions as F

from tidemark.llm import chaining, imatch, kd_shards, parity_join, va_file
from tidemark.llm.queries import OP9_SQL


def test_fingerprints_of_texts_and_edited_texts(spark):
    draw = random.Random(6)
    texts = [None, "", "a", *[prose(draw, draw.randrange(20, 200)) for _ in range(30)]]
    texts += [texts[5], texts[5]]
    rows = documents(spark, texts)
    got = {r["doc_id"]: r for r in imatch.compare_edited(rows, imatch.lexicon(rows, (0.1, 7.6))).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        mine, following = text or "", texts[(i + 1) % len(texts)] or ""
        edited = mine[: len(mine) - len(mine) // 4] + following[: len(mine) // 4]
        assert got[i]["n_chars"] == len(mine)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    assert got[5]["fingerprint"] == got[len(texts) - 1]["fingerprint"] != got[6]["fingerprint"]
    assert got[len(texts) - 2]["near_next"] == 1.0  # the same text comes next
    middle = range(3, 32)
    assert np.mean([got[i]["near_edited"] for i in middle]) > 0.3 > 0.15 > np.mean([got[i]["near_next"] for i in middle])


@pytest.mark.parametrize("near", [False, True])
def test_fingerprints_where_copies_hold_a_third_of_the_rows(spark, near):
    draw = random.Random(30)
    copied = prose(draw, 120, 10**6)
    texts = [prose(draw, 120, 3000) for _ in range(200)]
    for i in range(0, 200, 3):
        texts[i] = copied + (f" slip{i}" if near else "")
    rows = documents(spark, texts)
    got = {r["doc_id"]: r for r in imatch.compare_edited(rows, imatch.lexicon(rows)).collect()}
    assert np.mean([got[i]["near_edited"] for i in range(0, 200, 3)]) > 0.3
    assert np.mean([got[i]["near_next"] for i in range(0, 200, 3)]) < 0.15


def test_fingerprints_of_odd_rows(spark):
    rows = documents(spark, odd_texts())
    terms = imatch.lexicon(rows)
    assert imatch.compare_edited(rows, terms).count() == rows.count()
    assert imatch.fingerprint(rows, terms).count() == rows.count()
    nothing = documents(spark, [])
    assert imatch.compare_edited(nothing, imatch.lexicon(nothing)).count() == 0


def classes_by_hand(texts, width, share):
    def shingles(text):
        w = words_of(text)
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())

    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def edited(draw, text, n):
    w = text.split()
    for _ in range(n):
        w[draw.randrange(len(w))] = f"e{draw.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("width, share", [(3, Fraction(9, 10)), (5, Fraction(4, 5))])
def test_classes_are_those_of_all_pairs(spark, width, share):
    draw = random.Random(7)
    texts = [None, "", " ", "One", "one", "a b", "A B", "b a"]
    for _ in range(12):
        base = prose(draw, draw.choice([4, 9, 12, 40, 150, 400]), 5000)
        texts += [base, base, *[edited(draw, base, draw.randrange(0, 1 + len(base.split()) // 25)) for _ in range(5)]]
    chain = prose(draw, 200, 5000)
    for _ in range(8):  # each like the one before, the ends unlike
        texts.append(chain)
        chain = edited(draw, chain, 3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity_join.jaccard_classes(documents(spark, texts), width, share).collect()}
    assert [got[i] for i in range(len(texts))] == classes_by_hand(texts, width, share)


def test_large_clusters_are_compared_in_blocks(spark, monkeypatch):
    draw = random.Random(8)
    base = prose(draw, 120, 5000)
    texts = [edited(draw, base, draw.randrange(0, 6)) for _ in range(60)]
    monkeypatch.setattr(parity_join, "BLOCK_SETS", 16)
    got = {r["doc_id"]: r["component_id"] for r in parity_join.jaccard_classes(documents(spark, texts), 3, Fraction(9, 10)).collect()}
    assert [got[i] for i in range(len(texts))] == [c for _, c in classes_by_hand(texts, 3, Fraction(9, 10))]


def test_sketches_bound_the_difference_of_sets():
    draw = np.random.RandomState(9)
    bands = parity_join.Bands(Fraction(4, 5))
    for _ in range(200):
        a = np.unique(draw.randint(0, 10**9, draw.randint(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate([a[draw.rand(len(a)) < 0.9], draw.randint(0, 10**9, 5).astype(np.uint64)]))
        apart = np.bitwise_count(parity_join.parity(a, 8, 1) ^ parity_join.parity(b, 8, 1)).sum()
        assert apart <= len(np.setxor1d(a, b))
        assert (parity_join.folded(a, 40, 1)[0] != parity_join.folded(b, 40, 1)[0]).sum() <= len(np.setxor1d(a, b))
        both = len(np.intersect1d(a, b))
        if both >= 0.8 * len(np.union1d(a, b)):
            shared = np.intersect1d(parity_join.join_keys(a, bands), parity_join.join_keys(b, bands))
            assert len(shared) or (len(a) == len(b) == both)


def test_odd_rows_have_classes_and_one_of_each_stays(spark):
    rows = documents(spark, odd_texts())
    assert parity_join.jaccard_classes(rows, 3, Fraction(9, 10)).count() == rows.count()
    kept = parity_join.one_of_each(rows)
    assert kept.columns == rows.columns
    texts = [r["text"] for r in kept.collect()]
    assert {t for t in texts if t and t.strip()} == {r["text"] for r in rows.collect() if r["text"] and r["text"].strip()}
    full = [t for t in texts if t and t.strip()]
    assert len(full) == len(set(full)) and sum(t is None for t in texts) == 2
    nothing = documents(spark, [])
    assert parity_join.jaccard_classes(nothing, 3, Fraction(9, 10)).count() == 0 and parity_join.one_of_each(nothing).count() == 0


def test_planted_passages_are_found_and_cut_from_later_documents(spark):
    draw = random.Random(10)
    passage, fuzzy = prose(draw, 70, 10**6), prose(draw, 90, 10**6)
    plain = [prose(draw, 150, 10**6) for _ in range(20)]
    texts = list(plain)
    for i in (2, 7, 11):
        texts[i] = " ".join([plain[i], passage, plain[i][::-1]])
    loose = fuzzy.split()
    loose[30] = "changed"
    del loose[60]
    texts[4] = plain[4] + "\n" + fuzzy
    texts[15] = " ".join(loose) + "\n" + plain[15]
    rows = documents(spark, [None, "", *texts, (None, plain[0])])
    found = chaining.repeated_passages(rows).collect()
    pairs = {(r["doc_id"], r["ref_id"]) for r in found if r["doc_id"] is not None and r["ref_id"] is not None}
    assert {(9, 4), (13, 4), (17, 6)} <= pairs
    assert {d for d, _ in pairs} <= {9, 13, 17}
    for r in found:
        if (r["doc_id"], r["ref_id"]) == (9, 4):
            assert r["end"] - r["begin"] == 70 == r["n_equal"]
    cut = chaining.cut_passages(documents(spark, texts))
    left = {r["doc_id"]: r for r in cut.collect()}
    assert passage in left[2]["text"] and fuzzy in left[4]["text"]
    assert passage not in left[7]["text"] and passage not in left[11]["text"] and "changed" not in left[15]["text"]
    assert left[7]["text"] == " ".join([plain[7], plain[7][::-1]]) and left[15]["text"] == plain[15]
    assert all(r["n_chars"] == len(r["text"]) for r in left.values())
    assert all(left[i]["text"] == plain[i] for i in range(20) if i not in (2, 4, 7, 11, 15))


def test_odd_rows_have_no_passages_but_copies(spark):
    rows = documents(spark, odd_texts())
    assert {(r["doc_id"], r["ref_id"]) for r in chaining.repeated_passages(rows).collect() if r["doc_id"] != 900} <= {(5, 4)} | {
        (r["doc_id"], r["ref_id"]) for r in chaining.repeated_passages(rows).collect() if r["ref_id"] is None or r["doc_id"] in (6, 12, 13, 14, 15) or r["ref_id"] in (6, 900)
    }
    cut = chaining.cut_passages(rows)
    assert cut.columns == rows.columns and cut.where("text is null").count() == 2
    assert chaining.cut_passages(documents(spark, [])).count() == 0


def test_passages_with_many_changed_words_are_found(spark):
    draw = random.Random(34)
    texts, planted = [], {}
    for every in (7, 10, 15):  # identity 0.86, 0.9, 0.93
        for _ in range(40):
            passage = prose(draw, 60, 10**6).split()
            changed = [f"x{draw.randrange(10**6)}" if i % every == every // 2 else w for i, w in enumerate(passage)]
            planted[len(texts) + 1] = every
            texts.append(prose(draw, 60, 10**6) + " " + " ".join(passage) + " " + prose(draw, 60, 10**6))
            texts.append(prose(draw, 60, 10**6) + " " + " ".join(changed) + " " + prose(draw, 60, 10**6))
    found = {r["doc_id"] for r in chaining.repeated_passages(documents(spark, texts, 5)).collect() if r["ref_id"] == r["doc_id"] - 1}
    assert found <= set(planted)
    recall = {every: sum(d in found for d, e in planted.items() if e == every) / 40 for every in (7, 10, 15)}
    assert min(recall.values()) > 0.95, recall


def test_lone_matches_are_aligned_alike_one_by_one_and_many_at_once():
    rng = np.random.default_rng(35)
    texts = [rng.integers(0, 2, rng.integers(5, 60)).astype(np.int32) for _ in range(400)]
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    pos = np.array([rng.integers(0, len(t) - chaining.SEED_WORDS + 1) for t in texts])
    a, b = np.arange(0, 400, 2), np.arange(1, 400, 2)
    got = chaining.align_lone(np.concatenate(texts), begins[a], ends[a], begins[b], ends[b], pos[a], pos[b])
    for k, (i, j) in enumerate(zip(a, b)):
        assert tuple(int(x[k]) for x in got) == chaining.align(texts[i], texts[j], pos[[i]], pos[[j]])


def _missed_words(texts, found, min_words=50):
    """Words of windows that an earlier text has exactly and that no passage covers, and words of all such windows."""
    first, missed, total = {}, 0, 0
    for i, text in enumerate(texts):
        tokens = words_of(text)
        windows = [" ".join(tokens[a : a + min_words]) for a in range(len(tokens) - min_words + 1)]
        repeated = {w for a, x in enumerate(windows) if first.setdefault(x, i) < i for w in range(a, a + min_words)}
        covered = {w for r in found if r["doc_id"] == i for w in range(r["begin"], r["end"])}
        total, missed = total + len(repeated), missed + len(repeated - covered)
    return missed, total


def test_every_exact_window_of_an_earlier_document_is_found(spark):
    draw = random.Random(33)
    texts = [prose(draw, 40, 10**6) for _ in range(4)]
    base = prose(draw, 55, 10**6).split()
    texts[0] += " " + " ".join(base)
    texts += [prose(draw, 30, 10**6) + " " + " ".join(base[a : a + 45]) + " " + prose(draw, 30, 10**6) for a in (0, 3, 6, 9)]
    texts.append(prose(draw, 30, 10**6) + " " + " ".join(base) + " " + prose(draw, 30, 10**6))
    phrases = [prose(draw, 26, 10**6) for _ in range(12)]  # passages are made of phrases that other documents have
    for _ in range(150):
        texts.append(" ".join(" ".join([prose(draw, draw.randrange(1, 9), 10**6), *draw.choices(phrases, k=draw.randrange(1, 4))]) for _ in range(3)))
    missed, total = _missed_words(texts, chaining.repeated_passages(documents(spark, texts, 13)).collect())
    assert total > 5000 and missed == 0


def test_texts_that_share_a_doc_id_are_documents_of_their_own(spark):
    draw = random.Random(32)
    passage = prose(draw, 80, 10**6)
    plain = [prose(draw, 120, 10**6) for _ in range(8)]
    texts = [plain[0] + " " + passage, (7, plain[1]), (7, passage + " " + plain[2]), (7, plain[3])]
    texts += [(None, plain[4]), (None, plain[5] + " " + plain[4]), (None, plain[6]), (9, plain[6] + " " + plain[7]), (7, plain[3])]
    rows = documents(spark, texts)
    found = {(r["doc_id"], r["begin"], r["end"], r["ref_id"]) for r in chaining.repeated_passages(rows).collect()}
    assert (7, 0, 80, 0) in found or (7, 0, 80, None) in found
    assert (9, 0, 120, None) in found
    assert {(r, e - b) for d, b, e, r in found if d is None} == {(None, 120)}  # one text without an id has that of another
    assert len(found) == 3
    left = [(r["doc_id"], r["text"]) for r in chaining.cut_passages(rows).collect()]
    assert left.count((7, plain[1])) == 1 and left.count((7, plain[2])) == 1 and left.count((7, plain[3])) == 2
    assert (9, plain[7]) in left and (None, plain[6]) in left
    assert sum(plain[4] in (t or "") for _, t in left) == 1


def test_chains_keep_both_orders_and_take_the_best():
    assert chaining.chains([0, 10, 20, 30], [100, 110, 120, 130]) == [[0, 1, 2, 3]]
    assert chaining.chains([0, 10, 20], [50, 20, 70]) == [[0, 2]]
    assert chaining.chains([0, 500], [0, 500]) == []  # too far apart
    draw = random.Random(11)
    for _ in range(50):  # the best score of a chain, by trying all predecessors
        points = sorted((draw.randrange(60), draw.randrange(60)) for _ in range(12))
        best = [7.0] * 12
        for i, (p, r) in enumerate(points):
            for j in range(i):
                if points[j][0] < p and points[j][1] < r:
                    gap = (p - points[j][0]) + (r - points[j][1])
                    near = abs((p - points[j][0]) - (r - points[j][1])) <= chaining.MOST_SHIFT
                    if near:
                        best[i] = max(best[i], best[j] + 7 - chaining.GAP_COST * gap)
        found = chaining.chains([p for p, _ in points], [r for _, r in points])
        for chain in found:
            assert all(points[a][0] < points[b][0] and points[a][1] < points[b][1] for a, b in zip(chain, chain[1:]))
        assert bool(found) == (max(best) > 7)


def _best_scores(points):
    """Score of the best chain that ends in each match, over all predecessors that MOST_GAP and MOST_SHIFT admit."""
    best = []
    for i, (p, r) in enumerate(points):
        best.append(float(chaining.GAIN))
        for j in range(i):
            gap, ref_gap = p - points[j][0], r - points[j][1]
            if 0 < gap <= chaining.MOST_GAP and 0 < ref_gap <= chaining.MOST_GAP and abs(gap - ref_gap) <= chaining.MOST_SHIFT:
                best[i] = max(best[i], best[j] + chaining.GAIN - chaining.GAP_COST * (gap + ref_gap))
    return best


def test_chains_behind_a_long_one_are_found():
    pos = [*range(0, 201, 10), 400, 410, 420]
    assert chaining.chains(pos, pos) == [list(range(21)), [21, 22, 23]]
    draw = random.Random(31)
    for _ in range(300):  # the score of the best chain, with far and near predecessors
        at, points = 0, set()
        for _ in range(draw.randrange(2, 40)):
            at += draw.choice([1, 5, 8, 10, 10, 40, 90, 200])
            points.add((at, max(0, at + draw.choice([0, 0, 0, 3, -20, 40]))))
        points = sorted(points)
        found = chaining.chains([p for p, _ in points], [r for _, r in points])
        best = max(_best_scores(points))
        assert bool(found) == (best > chaining.GAIN)
        if found:
            steps = [(points[a], points[b]) for a, b in zip(found[0], found[0][1:])]
            score = chaining.GAIN + sum(chaining.GAIN - chaining.GAP_COST * (q[0] - p[0] + q[1] - p[1]) for p, q in steps)
            assert score == pytest.approx(best)


def test_shards_are_even_whole_and_numbered(spark):
    draw = random.Random(12)
    texts = [prose(draw, draw.randrange(1, 60)) for _ in range(600)] + ["the same text " * 4] * 40
    rows = kd_shards.shard_documents(documents(spark, texts), shards=8).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    sizes = {s: sum(r["size"] for r in rows if r["shard"] == s) for s in range(8)}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 for r in rows)
    assert max(sizes.values()) < 1.06 * min(sizes.values())
    for s in range(8):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    by_target = kd_shards.shard_documents(documents(spark, texts), target_bytes=sum(sizes.values()) // 3 + 1)
    assert {r["shard"] for r in by_target.select("shard").distinct().collect()} == {0, 1, 2}


def test_a_heavy_text_is_cut_and_odd_rows_are_placed(spark):
    rows = kd_shards.shard_documents(documents(spark, ["same"] * 900 + ["other"] * 100), shards=4).collect()
    counts = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(4)]
    assert max(counts) < 1.15 * min(counts)
    odd = documents(spark, odd_texts())
    assert kd_shards.shard_documents(odd, shards=8).count() == odd.count()
    assert kd_shards.shard_documents(documents(spark, []), shards=8).count() == 0
    plan = kd_shards.shard_documents(odd, shards=2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_nodes_and_cuts_need_no_python_worker(spark):
    frame = kd_shards._as_frame(spark, [(1, 2), (3, -1)], "node long, axis int")
    assert [tuple(r) for r in frame.orderBy("node").collect()] == [(1, 2), (3, -1)]
    assert kd_shards._as_frame(spark, [], "node long, axis int").count() == 0
    # an RDD of Python objects would be a scan of an existing RDD
    assert "LocalTableScan" in frame._jdf.queryExecution().executedPlan().toString()


def test_nearest_vectors_are_exact(spark):
    draw = np.random.RandomState(13)
    vectors = [[float(x) for x in draw.standard_normal(12) * 0.3] for _ in range(700)]
    for i in range(0, 300, 3):
        vectors[i] = vectors[0]  # a very common vector: ties
    vectors += [None, [0.1, None] + [0.0] * 10, [float("nan")] * 12, [float("inf")] * 12, [0.0] * 12]
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = va_file.search(va_file.whole_vectors(rows), F.col("vec_id") % 100 == 0, 10)
    duck = duckdb.connect()
    duck.register("embeddings", rows.drop("score").toArrow())
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(duck.sql(OP9_SQL).fetchall())


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.5]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [1.0]), (None, [1.0, 1.0])], schema)
    got = va_file.search(va_file.whole_vectors(few), F.col("vec_id") % 100 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 1, 786432)]
    nothing = va_file.search(va_file.whole_vectors(spark.createDataFrame([], schema)), F.col("vec_id") % 100 == 0)
    assert nothing.count() == 0
    huge = va_file.exact_scores(np.array([2**40, 1]), np.array([[2**20, 3]]))
    assert huge == [2**60 + 3]


def test_every_row_is_a_candidate(spark):
    draw = np.random.RandomState(29)
    near = [(i, [float(x) for x in draw.standard_normal(6)]) for i in range(1, 300)]
    rows = [*near, *near[:40], *near[:40], (100, [0.5] * 6), (100, [0.5] * 6), (1, [9.0] * 6), (7, [4.0, -3.0]), (9, [2.0] * 9)]
    rows += [(200, [50.0 + i] * 6) for i in range(30)]  # more rows of a query's own id than results are asked for
    table = spark.createDataFrame([*rows, (None, [8.0] * 6), (400, [-1.0, 2.0])], "vec_id long, embedding array<float>").repartition(5)
    got = va_file.search(va_file.whole_vectors(table), F.col("vec_id") % 100 == 0, 10, every_row=True)
    duck = duckdb.connect()
    duck.register("embeddings", table.toArrow())
    assert sorted(map(tuple, got.collect())) == sorted(duck.sql(OP9_SQL).fetchall())


def test_own_vectors_take_no_place_in_the_bounds(spark):
    rows = [(0, [10.0 + i, 1.0]) for i in range(30)] + [(i, [0.5, float(i)]) for i in range(1, 15)]
    vectors = va_file.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = va_file.search(vectors, F.col("vec_id") == 0).groupBy("query_id").count().collect()
    assert [tuple(r) for r in got] == [(0, 300)]


def test_lone_matches_that_become_passages_are_never_left_out():
    draw = np.random.default_rng(4)
    reach = chaining._reach(50)
    for changed in (0.02, 0.1, 0.2, 0.3, 0.9):
        a = draw.integers(0, 2**64, 400, dtype=np.uint64)
        b = np.where(draw.random(400) < changed, draw.integers(0, 2**64, 400, dtype=np.uint64), a)
        a_words, b_words = a[:300], b[:300]
        same = np.lib.stride_tricks.sliding_window_view(a_words == b_words, chaining.SEED_WORDS).all(axis=1)
        pos = np.flatnonzero(same) if same.any() else np.arange(0, 295)
        begin, end = np.zeros(len(pos), np.int64), np.full(len(pos), 300)
        sides = [chaining.packed_sides(x, begin, end, pos, reach) for x in (a_words, b_words)]
        grows = chaining.may_grow(*sides, reach)
        both = np.concatenate([a_words, b_words])
        p, q, *_, equal = chaining.align_lone(both, begin, end, begin + 300, end + 300, pos, pos)
        accepted = (q - p >= 50) & (equal >= 0.8 * (q - p))
        assert not (accepted & ~grows).any() and (accepted.any() or changed > 0.1)
    pos = np.arange(0, 295)
    begin, end = np.zeros(len(pos), np.int64), np.full(len(pos), 300)
    unlike = draw.integers(0, 2**64, (2, 300), dtype=np.uint64)
    sides = [chaining.packed_sides(x, begin, end, pos, reach) for x in unlike]
    assert chaining.may_grow(*sides, reach).mean() < 0.02
