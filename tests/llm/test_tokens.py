"""Token store, Viterbi encoding and packing against the libraries and against brute force."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from fixtures import documents, odd_texts
from tokenizers import Tokenizer

from tidemark.llm import lexical_packing, token_store, viterbi
from tidemark.llm.encoding import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    draw = random.Random(3)
    texts = ["", " ", "a ", "a  b", "a\n b", "a\n \nb", "it's  ' s", "x y　z", "a\x1cb \x85", "日本 テ, ok", "<|endoftext|> x", None]
    texts += ["".join(draw.choice(" \n\tab'sé1!日\x1c . ") for _ in range(draw.randrange(14))) for _ in range(2000)]
    ids, begins = encoder(PATH).encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[begins[i] : begins[i + 1]].tolist() == ids_of(tokenizer, text, 0)[:-1], text


def test_the_token_store_reads_back_in_order(spark, place, tokenizer):
    texts = odd_texts()
    token_store.write_tokens(documents(spark, texts), f"{place}/t", PATH, 2, files=3)
    rows = token_store.digests(token_store.read_tokens(spark, f"{place}/t")).collect()
    wanted = sorted(((t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(rows) == len(wanted)
    at = 0
    for row in sorted(rows, key=lambda r: r["start"]):
        assert row["start"] == at
        at += row["n_tokens"]
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == [d for d, _ in wanted]
    made = sorted((d or -1, len(x), crc(x)) for d, t in wanted for x in [ids_of(tokenizer, t, 2)])
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_crc32"]) for r in rows) == made


def test_lookups_are_pushed_into_the_token_store(spark, place):
    token_store.write_tokens(documents(spark, [f"text {i}" for i in range(40)]), f"{place}/t", PATH, 2, files=2)
    found = token_store.read_tokens(spark, f"{place}/t", [7, 31])
    assert sorted(r["doc_id"] for r in found.collect()) == [7, 31]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().executedPlan().toString()
    token_store.write_tokens(documents(spark, []), f"{place}/empty", PATH, 2, files=2)
    assert token_store.digests(token_store.read_tokens(spark, f"{place}/empty")).count() == 0


def best_segmentation(pieces, text):
    look = {pieces.names[i]: i for i in pieces.ids.tolist()}
    s = "▁" + text.replace(" ", "▁") if text else ""
    best, back = [0.0] + [-math.inf] * len(s), [None] * (len(s) + 1)
    for end in range(1, len(s) + 1):
        raw = s[end - 1].encode()
        best[end], back[end] = best[end - 1] + viterbi.BYTE * len(raw), (1, [int(pieces.byte[b]) for b in raw])
        for n in range(1, min(pieces.longest, end) + 1):
            i = look.get(s[end - n : end])
            if i is not None and best[end - n] + pieces.scores[i] >= best[end]:
                best[end], back[end] = best[end - n] + pieces.scores[i], (n, [i])
    out, end = [], len(s)
    while end:
        n, ids = back[end]
        out, end = ids + out, end - n
    return out


def test_viterbi_is_the_best_segmentation_and_decodes(spark):
    draw = random.Random(4)
    texts = ["", " ", "  ", "hello world", "the  quick ", "日本語 ok 🙂", "x" * 200, "\x00\x01", None]
    texts += ["".join(draw.choice("  abcdetheion\n日🙂é") for _ in range(draw.randrange(30))) for _ in range(200)]
    pieces = viterbi.pieces_of(MODEL)
    ids, begins = pieces.encode(pa.array([*texts, "▁ own ▁▁ sign"], pa.string()))
    for i, text in enumerate(texts):
        assert ids[begins[i] : begins[i + 1]].tolist() == best_segmentation(pieces, text or "")
    rows = documents(spark, [*odd_texts(), "▁ own ▁▁ sign"])
    checked = viterbi.round_trips(rows, MODEL).collect()
    assert len(checked) == rows.count() and all(r["round_trip"] for r in checked)
    back = viterbi.decode_documents(viterbi.encode_documents(rows, MODEL), MODEL)
    assert sorted((r["doc_id"] or -1, r["text"]) for r in back.collect()) == sorted((r["doc_id"] or -1, r["text"] or "") for r in rows.collect())
    assert viterbi.round_trips(documents(spark, []), MODEL).count() == 0


def test_every_id_is_packed_once(spark, tokenizer):
    texts = odd_texts()
    rows = documents(spark, texts)
    pieces = [r.asDict() for r in lexical_packing.pack(rows, PATH, 0, window=64).collect()]
    sequences: dict = {}
    for p in pieces:
        assert len(p["ids"]) == p["length"]
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        ends = [0, *[a + n for a, n in sorted(parts)]]
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 64
    short = [s for s in sequences.values() if sum(n for _, n in s) < 64]
    assert len(short) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    got: dict = {}
    for p in pieces:
        got.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], tuple(p["ids"])))
    made: dict = {}
    for i, t in enumerate(texts):
        d, t = t if isinstance(t, tuple) else (i, t)
        ids = ids_of(tokenizer, t, 0)
        made.setdefault((d, len(ids)), []).append(ids)
    assert got.keys() == made.keys()
    for k in made:
        if len(made[k]) == 1:
            assert [x for _, part in sorted(got[k]) for x in part] == made[k][0]
    assert sum(p["length"] for p in pieces) == sum(len(x) for v in made.values() for x in v)
    assert lexical_packing.pack(documents(spark, []), PATH, 0).count() == 0


def test_neighbours_are_those_of_bm25():
    draw = np.random.RandomState(5)
    docs = [draw.randint(0, 60, draw.randint(1, 40)) for _ in range(50)]
    begins = np.cumsum([0, *map(len, docs)])
    df = np.array([sum(t in d for d in docs) for t in range(60)])
    idf = np.log(1 + (50 - df + 0.5) / (df + 0.5))
    mean = begins[-1] / 50
    index = lexical_packing.Index(np.concatenate(docs), begins, idf, mean)

    def weight(t, d):
        tf = int((docs[d] == t).sum())
        k = lexical_packing.K1 * (1 - lexical_packing.B + lexical_packing.B * len(docs[d]) / mean)
        return idf[t] * tf * (lexical_packing.K1 + 1) / (tf + k) if tf else 0.0

    for q in range(50):
        terms = sorted(set(docs[q].tolist()), key=lambda t: -weight(t, q))[: lexical_packing.QUERY_TERMS]
        if len(set(docs[q].tolist())) > lexical_packing.QUERY_TERMS:
            continue
        scores = [sum(weight(t, d) for t in terms) if d != q else 0.0 for d in range(50)]
        found = index.neighbours(q, np.ones(50, np.float32))
        assert np.allclose([scores[d] for d in found], sorted((s for s in scores if s > 0), reverse=True)[: len(found)], rtol=1e-4)
        assert len(found) == min(lexical_packing.NEIGHBOURS, sum(s > 0 for s in scores))
