"""Language model and toxicity: gradients, exact sums, probabilities that add up, held-out texts; and the pipeline."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import corpus_pipeline
import numpy as np
import pandas as pd
import pyarrow as pa
from fixtures import documents, odd_texts, prose, words_of
from pyspark.sql import functions as F

from tidemark.llm import gru, gru_lm, phrases, string_kernel, toxicity
from tidemark.llm.queries import toxic_training

def not_learned():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def test_gradients_are_those_of_the_loss():
    draw = np.random.RandomState(1)
    p = gru.initial(1088, 64, 32)
    symbols, classes = draw.randint(0, 1088, (5, 7)), draw.randint(0, 64, (5, 7))
    slots, live = np.where(classes < 32, draw.randint(0, 32, (5, 7)), -1), draw.rand(5, 7) < 0.8

    def loss(p):
        h, total = np.zeros((7, gru.HIDDEN), np.float32), 0.0
        for t in range(5):
            total += gru.log_likelihood(p, h, classes[t], slots[t])[live[t]].sum()
            h = gru.step(p, symbols[t], h)[0]
        return -total / live.sum()

    g, _, total = gru.gradient(p, symbols, classes, slots, live, np.zeros((7, gru.HIDDEN), np.float32))
    assert abs(loss(p) + total / live.sum()) < 1e-4
    for k in p:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
        up[k][at] += 0.01
        down[k][at] -= 0.01
        assert abs((loss(up) - loss(down)) / 0.02 - g[k][at]) < 2e-3 * abs(g[k][at]) + 1e-5


def vocabulary():
    words = np.arange(2, 3002, dtype=np.int64)
    frequent = pd.DataFrame({"word": np.append(1, words), "ending": np.append(-1, words % 32).astype(np.int16), "c": np.append(50, 4000 - words)})
    endings = frequent[frequent.ending >= 0].groupby("ending").c.agg(lambda c: (c + 1).sum()).rename("total").reset_index()
    return gru_lm.Vocabulary(frequent, endings, int(frequent.c.sum()), len(frequent)), frequent


def test_probabilities_of_all_words_add_up_to_one():
    vocab, frequent = vocabulary()
    p = gru.initial(vocab.n_symbols, vocab.n_classes, gru_lm.HEAD_CLASSES)
    h = np.random.RandomState(2).standard_normal((1, gru.HIDDEN)).astype(np.float32)
    count, head = vocab.look_up(frequent["word"].to_numpy().view(np.uint64))
    symbol = np.where(head >= 0, head, np.where(frequent.ending >= 0, gru_lm.HEAD + frequent.ending, 0))
    symbol, tail = np.append(symbol, gru_lm.HEAD + np.arange(32)), np.append((head < 0) & (frequent.ending >= 0), [True] * 32)
    inside = np.append(np.log10(count + 1.0), np.zeros(32)) - vocab.log_total[np.maximum(np.append(frequent.ending, np.arange(32)), 0)]
    found = gru.log_likelihood(p, np.repeat(h, len(symbol), 0), vocab.class_of[symbol], vocab.slot_of[symbol])
    total = (np.exp(found) * np.where(tail, 10.0**inside, 1)).sum()
    assert abs(total - 1) < 1e-4  # all known words, and a word not seen for each ending


def test_the_state_runs_through_whole_documents():
    vocab, _ = vocabulary()
    p = gru.initial(vocab.n_symbols, vocab.n_classes, gru_lm.HEAD_CLASSES)
    draw = np.random.RandomState(3)
    docs = [draw.randint(0, vocab.n_symbols, n) for n in (1, 900, 3, 40, 3)]
    begins = np.cumsum([0, *map(len, docs)])
    got = gru_lm.document_scores(p, np.concatenate(docs), begins, vocab)
    for d, found in zip(docs, got):
        h, total = np.zeros((1, gru.HIDDEN), np.float32), 0.0
        for s in d:
            total += gru.log_likelihood(p, h, vocab.class_of[[s]], vocab.slot_of[[s]])[0]
            h = gru.step(p, np.array([s]), h)[0]
        assert abs(total / math.log(10) - found) < 1e-3 * abs(found)


def test_scores_of_documents(spark):
    draw = random.Random(14)
    # two kinds of texts, each with words of its own: what a state can learn and a count cannot
    texts = [" ".join(draw.choice("ab"[i % 2]) + str(draw.randrange(30)) for _ in range(draw.randrange(20, 80))) for i in range(400)]
    texts += [None, "", (None, "a1 A2"), (7, texts[7])]
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = gru_lm.lm_scores(documents(spark, texts), not_learned()).collect()
    assert len(rows) == len(texts)
    counts = Counter(w for d, t in pairs if not held_out(d) for w in [*words_of(t), None])
    n, v = sum(counts.values()), len(counts)
    wanted = sorted((d or 0, len(w) + 1, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in [*w, None])) for d, t in pairs for w in [words_of(t)])
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["base_score"]) for r in rows)
    assert [g[:2] for g in got] == [w[:2] for w in wanted] and np.allclose([g[2] for g in got], [w[2] for w in wanted])
    assert {r["train_tokens"] for r in rows} == {n} and all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_rare_words_are_joined_and_empty_tables_scored(spark, monkeypatch):
    texts = [(i, t) for i, t in enumerate(["common common rare", "common other", None, "never seen"])]
    whole = {r["doc_id"]: r for r in gru_lm.lm_scores(documents(spark, texts), F.col("doc_id") == 3).collect()}
    monkeypatch.setattr(gru_lm, "FREQUENT", 4)  # only words with a quarter of all tokens count as frequent
    joined = {r["doc_id"]: r for r in gru_lm.lm_scores(documents(spark, texts), F.col("doc_id") == 3).collect()}
    assert all(abs(whole[i]["base_score"] - joined[i]["base_score"]) < 1e-9 and whole[i]["n_known"] == joined[i]["n_known"] for i in whole)
    assert joined[3]["n_known"] == 1 and joined[0]["n_known"] == 4
    assert gru_lm.lm_scores(documents(spark, []), not_learned()).count() == 0
    odd = documents(spark, odd_texts())
    assert gru_lm.lm_scores(odd, not_learned()).count() == odd.count()


INSULTS = ["idiot", "worthless", "moron", "scum"]


def labelled_texts(draw, n):
    texts, labels = [], []
    for i in range(n):
        words = prose(draw, draw.randrange(20, 60), 300).replace("w", "no").split()
        toxic = i % 5 == 0
        if toxic:
            words.insert(draw.randrange(len(words)), draw.choice(INSULTS))
        sentences = [" ".join(words[a : a + 8]) for a in range(0, len(words), 8)]
        texts.append(". ".join(sentences))
        labels.append((i, 1, int(toxic)))
    return texts, labels


def test_insults_are_found_also_with_gaps(spark):
    draw = random.Random(15)
    texts, labels = labelled_texts(draw, 500)
    rows = documents(spark, texts)
    table = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), (10**6, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(rows, table, toxic_training())
    got = {r["doc_id"]: r for r in toxicity.score(rows.select("doc_id", "text"), model).collect()}
    for i, _, toxic in labels:
        assert got[i]["predicted"] == toxic, texts[i]
    tried = ["no1 no2 idiiot no3", "no4 id-iot", "wor.thless no5", "i d i o t no6", "no7 no8", "", None, "?!"]
    scores = model.scores(pa.array(tried, pa.string()))
    assert (scores[:4] >= toxicity.THRESHOLD).all() and (scores[4:] < toxicity.THRESHOLD).all()


PHRASES = ["kill yourself", "nobody wants you here", "id iot"]


def phrase_texts(draw, n):
    """Toxic texts hold a phrase; its words stand apart in clean texts, and in toxic ones too."""
    texts, labels = [], []
    apart = " ".join(PHRASES).split()
    for i in range(n):
        words = prose(draw, draw.randrange(30, 80), 300).replace("w", "no").split()
        for word in draw.sample(apart, 4):
            at = draw.randrange(len(words))
            words[at:at] = [word, *prose(draw, 4, 300).replace("w", "no").split()]
        if i % 3 == 0:
            at = draw.randrange(len(words))
            words[at:at] = PHRASES[i // 3 % 3].split()
        texts.append(" ".join(words))
        labels.append((i, 1, int(i % 3 == 0)))
    return texts, labels


def test_insults_of_ordinary_words_are_learned_from_sentences(spark):
    draw = random.Random(17)
    texts, labels = phrase_texts(draw, 600)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = documents(spark, texts)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(rows, toxicity.fit(rows, table, toxic_training())).select("doc_id", "predicted").collect()}
    unseen = {r["doc_id"] for r in rows.where(~toxic_training()).select("doc_id").collect()}
    for phrase in range(3):
        ours = [i for i in range(0, 600, 3) if i // 3 % 3 == phrase]
        for part in (ours, [i for i in ours if i in unseen]):
            assert sum(got[i] for i in part) >= 0.9 * len(part), PHRASES[phrase]
    assert sum(got[i] for i in range(600) if i % 3) <= 4
    model = toxicity.fit(rows, table, toxic_training())
    tried = ["no1 kiill yourself", "no1 kill. no2 no3 yourself", "Kill, your-self!", "nobody no5 wants you here", "kill no7 no8 no9 no10 yourself", "yourself kill", "here you wants nobody", "iot no id"]
    scores = model.scores(pa.array(tried))
    wanted = [1, 0, 1, 1, 0, 0, 0, 0]
    assert [int(s >= toxicity.THRESHOLD) for s in scores] == wanted, scores


def test_the_kernel_of_sentences_is_the_best_of_their_pairs(monkeypatch):
    """Against its definition, word by word, also where pairs come in many chunks and texts have no end."""

    def k(a, b):
        if a == b:
            return 1.0
        table = np.zeros(64**3)
        np.add.at(table, *string_kernel.triples_of(b))
        value = string_kernel.margins([a], table, 0.0)[0] if len(a) >= 3 else 0.0
        return min(value, 1.0) if value >= phrases.LEAST_ALIKE else 0.0

    monkeypatch.setattr(phrases, "_CHUNK", 7)
    draw = random.Random(18)
    words = ["kill", "kiill", "yourself", "yourselves", "id", "iot", "go", "away", "...", "a-way", "x" * 60]
    texts = [None, "", "?!", "kill yourself", *(" ".join(draw.choice(words) + draw.choice(["", "", "", ",", "!"]) for _ in range(draw.randrange(1, 40))) for _ in range(40))]
    marks = [("kill", "yourself"), ("id", "iot"), ("go", "away"), ("x" * 60, "kill")]
    landmarks = phrases.Landmarks.of(marks)
    read = phrases.Sentences.of(pa.array(texts, pa.string()))
    got = {int(s): row for ids, value in landmarks.kernels(read) for s, row in zip(ids, value)}
    for text in range(len(texts)):
        sentences, now = [], []
        for token in (texts[text] or "").split():
            bare = token.strip(".,!?")
            now += [bare] if bare else []
            if set(token[len(token.rstrip(".,!?")) :]) & set(".!?"):
                sentences.append(now)
                now = []
        sentences = [s for s in [*sentences, now] if s]
        ours = [s for s in dict.fromkeys(read.sentence.tolist()) if read.text[s] == text]
        assert len(ours) == len(sentences)
        for number, said in zip(ours, sentences):
            for column, (a, b) in enumerate(marks):
                pairs = [(i, j) for i in range(len(said)) for j in range(i + 1, min(len(said), i + 2 + phrases.MOST_BETWEEN))]
                wanted = max((phrases.FADE ** (j - i - 1) * k(said[i], a) * k(said[j], b) for i, j in pairs), default=0.0)
                assert abs((got[number][column] if number in got else 0.0) - wanted) < 1e-9


def test_toxicity_of_odd_rows_and_without_labels(spark):
    odd = documents(spark, odd_texts())
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd, empty, toxic_training())
    scored = toxicity.score(odd, model)
    assert scored.count() == odd.count() and scored.where("predicted = 1").count() == 0
    assert scored.columns == [*[c for c in odd.columns if c != "score"], "score", "predicted"]
    assert toxicity.score(documents(spark, []), model).count() == 0


def test_the_kernel_counts_shared_subsequences():
    """The machine of one landmark is the kernel with it, by its definition."""

    def features(word):
        found, text = Counter(), [27 * 0 + 63, *[ord(c) - 96 for c in word], 63]
        for i in range(len(text)):
            for j in range(i + 1, len(text)):
                for k in range(j + 1, min(len(text), i + 3 + string_kernel.MOST_SKIPPED)):
                    found[text[i], text[j], text[k]] += string_kernel.DECAY ** (k - i - 2)
        return found

    def norm(word):
        n = len(word) + 2
        return math.sqrt(sum(string_kernel.DECAY ** (2 * (k - i - 2)) for i in range(n) for j in range(i + 1, n) for k in range(j + 1, min(n, i + 3 + string_kernel.MOST_SKIPPED))))

    table = np.zeros(64**3)
    triple, value = string_kernel.triples_of("idiot")
    np.add.at(table, triple, value)
    for word in ("idiot", "idiiot", "iodito", "scum", "abc"):
        a, b = features("idiot"), features(word)
        wanted = sum(a[u] * b[u] for u in a) / norm("idiot") / norm(word)
        assert abs(string_kernel.margins([word], table, 0.0)[0] - wanted) < 1e-9


def test_the_pipeline_catches_what_is_planted_and_keeps_clean_documents(spark, place, monkeypatch):
    draw = random.Random(16)
    texts, labels = labelled_texts(draw, 300)
    clean = [prose(draw, 120, 10**6) for _ in range(30)]
    labels += [(len(texts) + i, 1, 0) for i in range(25)]
    passage = prose(draw, 60, 10**6)
    texts = texts + clean
    near = clean[3].split()
    near[60] = "changed"
    plan = SimpleNamespace(near=len(texts), copy=len(texts) + 1, holder=len(texts) + 2, toxic=len(texts) + 3)
    texts += [" ".join(near), clean[4], f"{prose(draw, 100, 10**6)} {passage}", f"{clean[5]} idiot scum", f"{passage} {prose(draw, 80, 10**6)}"]
    documents(spark, texts).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    docs, kept = spark.read.parquet(f"{place}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, place)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
        kept[name] = docs.collect()
    ids = {name: {r["doc_id"] for r in rows} for name, rows in kept.items()}
    everything = set(range(len(texts)))
    toxic = {i for i, _, t in labels if t} | {plan.toxic}
    assert ids["toxicity"] == everything - toxic
    assert ids["near_copies"] == everything - toxic - {plan.near, plan.copy}
    assert ids["repeated_passages"] == ids["near_copies"]
    text = {r["doc_id"]: r["text"] for r in kept["repeated_passages"]}
    assert passage in text[plan.holder] and passage not in text[len(texts) - 1]
    changed = {i for i in text if text[i] != texts[i]}
    assert changed == {len(texts) - 1}
    assert ids["packing"] == ids["repeated_passages"]
    again = corpus_pipeline.run(spark, place)
    assert again.agg(F.sum("length")).first()[0] == sum(r["length"] for r in kept["packing"])
