"""What operators do to stay within time and memory gives the same results."""

import numpy as np
import pyarrow as pa

from tidemark.llm import common


def test_distinct_numbers_are_those_of_numpy_and_strings_are_hashed_once():
    rng = np.random.default_rng(3)
    for n in (0, 1, 1000):
        values = rng.integers(0, 300, n)
        assert common.distinct(values).tolist() == np.unique(values).tolist()
    assert common.term_hashes(["a", "b", "Ä"]).tolist() == common.pd.util.hash_array(np.array(["a", "b", "Ä"], dtype=object)).tolist()
    assert len(common.term_hashes([])) == 0


def test_terms_of_texts_are_found_without_hashing_numbers(monkeypatch):
    from tidemark.llm import imatch

    monkeypatch.setattr(np, "unique", None)
    hashes, docs, terms = imatch.distinct_terms(pa.array(["b a B", None, "c a"]))
    assert docs.tolist() == [0, 0, 2, 2] and len(hashes) == 3
    assert len(imatch.Fingerprints(pa.array(["b a B", None, "c a"]), np.sort(hashes)).strings()) == 3


def test_only_pieces_are_remembered_and_ids_are_those_of_the_library():
    import public_tokenizers

    from tidemark.llm import encoding

    encoder = encoding.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["it's o'clock' we'll' 'tis a's's x''s, ab'' ab'S don't.", " 12ab! ab12.! é! É'. 文字, ．", "...word!? 'll,b ª! ①.", None, "", "a\tb!\n c'"]
    ids, begins = encoder.encode(pa.array(texts))
    want = [x.ids for x in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])] == want
    assert " don't." not in encoder.ids and " 文字," not in encoder.ids and " 文字" in encoder.ids


def test_a_process_asks_the_library_for_a_piece_once_and_remembers_it_in_few_bytes(monkeypatch):
    import public_tokenizers

    from tidemark.llm import encoding

    encoder = encoding.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(5)
    words = ["".join(w) for w in rng.choice(list("abcdefghé"), (20_000, 8))]
    texts = [" ".join(words[a : a + 500]) + ["", ".", " ", "  \n"][a % 4] for a in range(0, 20_000, 125)]
    want = [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encoded():
        ids, begins = encoder.encode(pa.array(texts))
        return [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])]

    assert encoded() == want and " " + words[7] in encoder.ids
    held = [*vars(encoder.ids).values()]
    assert sum(x.nbytes for x in held) < 60 * 20_000
    monkeypatch.setattr(encoder, "model", None)  # nothing is asked again
    assert encoded() == want
    monkeypatch.undo()
    monkeypatch.setattr(encoding, "REMEMBERED", 100)  # a full memory is emptied
    assert encoder.encode(pa.array(["never met before", *texts[:2]]))[0][-len(want[1]) :].tolist() == want[1]
    assert words[7] not in encoder.ids and encoded() == want


def test_rows_that_share_a_key_are_put_in_order():
    rng = np.random.default_rng(4)
    for n in (0, 1, 500):
        key, a, b = np.sort(rng.integers(-40, 40, n)), rng.integers(0, 4, n), rng.integers(0, 9, n)
        order = common.in_order(key, a, b)
        assert (key[order] == key).all()
        assert list(zip(key, a[order], b[order])) == sorted(zip(key, a, b))


def test_a_task_gives_back_memory_while_it_runs(spark, monkeypatch):
    given = []
    monkeypatch.setattr(common, "GIVEN_BACK_EVERY", -1)
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    held = {}

    class Rows:
        sparkSession = spark

        def mapInArrow(self, function, schema):
            held["run"] = function

    common.in_arrow(Rows(), lambda batches: batches, "n long")
    assert list(held["run"](iter([1, 2, 3]))) == [1, 2, 3] and len(given) == 4


def test_words_are_hashed_without_strings_and_equal_words_alike(monkeypatch):
    from fixtures import odd_texts, words_of

    from tidemark.llm import chaining

    texts = [t[1] if isinstance(t, tuple) else t for t in odd_texts()]
    texts += ["É é\x0bA a\x0c", "x" * 256 + " y", "end", " ".join("ab"[k % 2] * (k % 256 + 1) for k in range(2000))]
    long = ["Q" * 300 + " " + "q" * 300, "w" * 70_000 + "\tw Z", "z"]
    for some, strings in ((texts, False), (long, True), ([], False), ([None, ""], False)):
        with monkeypatch.context() as patched:
            if not strings:
                patched.setattr(chaining, "term_hashes", None)
                patched.setattr(common, "term_hashes", None)
            hashes, begins = chaining.word_hashes(pa.array([None, *some], pa.string()).slice(1))
        words = [words_of(t) for t in some]
        assert np.diff(begins).tolist() == list(map(len, words)) and begins[-1] == len(hashes)
        pairs = set(zip(hashes.tolist(), [w for text in words for w in text]))
        assert len(pairs) == len({h for h, _ in pairs}) == len({w for _, w in pairs})


def test_straight_chains_are_aligned_alike_one_by_one_and_many_at_once():
    from tidemark.llm import chaining

    rng = np.random.default_rng(36)
    texts = [rng.integers(0, 3, rng.integers(20, 90)).astype(np.int32) for _ in range(300)]
    texts += [np.where(rng.random(len(t)) < 0.1, 7, t).astype(np.int32) for t in texts]
    a, b = np.arange(300), np.arange(300, 600)
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    pos = np.array([rng.integers(0, len(t) - 10) for t in texts[:300]])
    size = np.array([rng.integers(chaining.SEED_WORDS, len(t) - p + 1) for t, p in zip(texts, pos)])
    got = chaining.align_straight(np.concatenate(texts), begins[a], ends[a], begins[b], ends[b], pos, pos, size)
    for k in range(300):
        both = np.array([pos[k], pos[k] + size[k] - chaining.SEED_WORDS])
        assert tuple(int(x[k]) for x in got) == chaining.align(texts[k], texts[300 + k], both, both)


def test_training_on_the_driver_holds_the_features_of_words_once():
    import tracemalloc

    from tidemark.llm import toxicity

    rng = np.random.default_rng(8)
    names = sorted({"".join(rng.choice(list("abcdefgh"), n)) for n in rng.integers(5, 17, 9000)})
    toxic = np.array(["abc" in w for w in names]) * rng.integers(1, 9, len(names))
    known = common.pd.DataFrame({"word": names, "toxic": toxic, "clean": np.where(toxic > 0, 0, rng.integers(1, 9, len(names)))})
    tracemalloc.start()
    model = toxicity.fit_words(known)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2 * 8 * len(names) * toxicity.LANDMARKS
    values = toxicity.margins(names, model.table, model.bias)
    assert ((values > 0) == (toxic > 0)).mean() > 0.95


def test_the_machine_is_the_same_in_blocks_and_on_some_rows(monkeypatch):
    from tidemark.llm import toxicity

    rng = np.random.default_rng(9)
    z, at = rng.normal(size=(500, 7)).astype(np.float32), rng.permutation(500)[:300]
    y, weight = np.where(z[at, 0] + 0.3 * rng.normal(size=300) > 0, 1.0, -1.0), rng.uniform(1, 3, 300)
    whole = toxicity._machine(z[at].astype(float), y, weight)
    for together in (1, 64, 299, 300):
        monkeypatch.setattr(toxicity, "ROWS_TOGETHER", together)
        assert np.allclose(toxicity._machine(z, y, weight, at=at), whole, rtol=0, atol=1e-9)
    x = np.hstack([z[at], np.ones((300, 1))]).astype(float)
    slack = np.maximum(1 - y * (x @ whole), 0)
    assert np.abs(0.1 * whole - x.T @ (weight * y * slack)).max() < 1e-6  # no slope is left


def test_rows_of_the_seed_shuffle_come_back_whole_and_take_half_the_bytes():
    from tidemark.llm import chaining

    rng = np.random.default_rng(11)
    n, parts = 100_000, 12
    seed = np.sort(rng.integers(-(2**63), 2**63, n))
    doc, places = rng.integers(0, 5_000, n), rng.integers(0, 2_000, n)
    spread = seed.view(np.uint64) ^ np.uint64(1 << 63)
    sent = pa.Table.from_batches(list(chaining.blocks(chaining._FIRST, spread, parts, seed, doc, places)))
    more = pa.Table.from_batches(list(chaining.blocks(chaining._FOUND, spread[:50], parts, seed[:50], doc[:50], doc[:50], places[:50])))
    got = []
    for part in range(parts):
        rows = pa.concat_tables([sent, more]).filter(common.pc.equal(pa.concat_tables([sent, more])["part"], part)).sort_by("bucket")
        for kinds in chaining.in_buckets(iter(rows.to_batches())):
            assert sum(len(x) for k, x in kinds.items() if k == chaining._FOUND) <= 50
            got.append(kinds[chaining._FIRST])
    assert np.array_equal(np.concatenate(got), np.stack([seed, doc, places], axis=1))
    assert not list(chaining.blocks(chaining._FIRST, spread[:0], parts, seed[:0], doc[:0], places[:0]))
    wide = np.stack([np.zeros(n, np.int64), seed, doc, common.mix(doc).view(np.int64), places], axis=1)[rng.permutation(n)]
    packed = sum(len(pa.compress(b.as_buffer(), "lz4")) for b in sent["data"].combine_chunks())
    assert packed < 0.55 * len(pa.compress(wide.tobytes(), "lz4"))


def test_lone_matches_are_judged_by_bits_of_words_in_place_of_texts(spark, monkeypatch):
    from tidemark.llm import chaining

    hashes, begins = chaining.word_hashes(pa.array(["a b c", "", "d", None, "e f g h"]))
    packed = chaining.packed_words(hashes, begins)
    bits, first = chaining.unpacked_words(packed)
    lengths = np.diff(begins)
    assert np.array_equal(bits[common.gather(first, lengths)], (hashes >> np.uint64(60)).astype(np.uint8))
    assert packed.nbytes < 40 and np.array_equal(chaining.unpacked_words(packed.slice(2))[1], first[2:] - first[2])
    texts = [" ".join(f"w{(i * k) % 97}" for k in range(1, 200)) for i in range(1, 30)]
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "doc long, row long, text string")
    lone = spark.createDataFrame([(7, 3, 1, 20, 20)], "chain long, row long, ref long, pos int, ref_pos int")
    plan = chaining.lone_survivors(rows, lone, 50)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Aggregate" in line and "first(" in line]
    assert joins and not any("first(text" in line for line in joins)


def test_documents_are_told_apart_by_their_ids_unless_those_repeat(spark):
    from tidemark.llm import chaining

    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(words), " ".join(words[100:] + ["x"] * 30), " ".join(words[:90] + ["y"] * 40)]
    once = spark.createDataFrame([(i + 5, t) for i, t in enumerate(texts)], "doc_id long, text string")
    again = spark.createDataFrame([*[(i + 5, t) for i, t in enumerate(texts)], (9, "z"), (9, "zz")], "doc_id long, text string")
    assert [r[0] for r in chaining.identified(once).select("row").orderBy("row").collect()] == [5, 6, 7]
    assert chaining.identified(again).where("doc = row").count() == 0
    found = [sorted(map(tuple, chaining.repeated_passages(x).collect())) for x in (once, again)]
    assert found[0] == found[1] and [r[:3] for r in found[0]] == [(6, 0, 200), (7, 0, 90)]
