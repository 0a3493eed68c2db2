"""Token alignment against whole texts encoded by the libraries and compared byte by byte."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from fixtures import SCHEMA, documents, odd_texts
from tokenizers import Tokenizer

from tidemark.llm import alignment

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "  a b  ", "\n\na\tb ", "▁x", "a▁b", "日本語 テキスト", "é́ ß", "a\x00b", "<s> </s> <|endoftext|>", "x y 　", "😀😀 a", "<0x41>"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def by_hand(libraries, texts):
    """Per text the expected columns; bytes of tokens are compared one by one."""
    a, b = libraries
    letters = {c: i for i, c in enumerate(alignment.byte_letters())}
    found, holders = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        spelled_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        spelled_b = [bytes([int(p[3:5], 16)]) if p[:3] == "<0x" and p[-1] == ">" and len(p) == 6 else p.replace("▁", " ").encode() for p in pieces]
        wanted = (" " + (text or "")).encode()
        if not text or b"".join(spelled_a) != wanted or b"".join(spelled_b) != wanted:
            found.append((0, 0, 0, [], "", ""))
            continue
        owner_a = [k for k, x in enumerate(spelled_a) for _ in x]
        owner_b = [k for k, x in enumerate(spelled_b) for _ in x]
        links = sorted(set(zip(owner_a, owner_b)))
        ends_a = {end: k for k, end in enumerate(accumulate(map(len, spelled_a)))}
        ends_b = {end: k for k, end in enumerate(accumulate(map(len, spelled_b)))}
        groups, last_a, last_b = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append(",".join(map(str, ids_a[last_a : ends_a[end] + 1])) + "|" + ",".join(map(str, ids_b[last_b : ends_b[end] + 1])))
            last_a, last_b = ends_a[end] + 1, ends_b[end] + 1
        pairs = [(ids_a[i], ids_b[j]) for i, j in links]
        holders.update(set(pairs))
        found.append((len(ids_a), len(ids_b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest(), ""))
    highest: dict = {}
    for (i, _), n in holders.items():
        highest[i] = max(highest.get(i, 0), n)
    return [
        (n_a, n_b, n_groups, len(pairs), sum(holders[p] == highest[p[0]] for p in pairs), sum(holders[p] for p in pairs), made)
        for n_a, n_b, n_groups, pairs, made, _ in found
    ]


def test_words_give_the_pieces_of_whole_texts(libraries):
    draw = random.Random(5)
    texts = ODD + ["".join(draw.choice("  \nab'sé1!日▁\t") for _ in range(draw.randrange(1, 16))) for _ in range(2000)]
    ids, begins = alignment.tokens("pieces", PIECES).encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        if text:
            assert ids[begins[k] : begins[k + 1]].tolist() == libraries[1].encode(text), text


@pytest.mark.parametrize("heavy", [alignment.HEAVY, 20, 0])
def test_alignments_equal_those_by_hand(spark, libraries, heavy):
    draw = random.Random(2)
    texts = odd_texts() + ODD + ["".join(draw.choice(" \nabcthe'sé1!日▁") for _ in range(draw.randrange(60))) for _ in range(150)]
    frame = documents(spark, texts)
    rows = alignment.weigh(alignment.keep(alignment.align(frame, BYTES, PIECES), "aligned"), heavy)
    made = sorted(map(str, (tuple(r) for r in rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())))
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    wanted = by_hand(libraries, [t for _, t in pairs])
    assert made == sorted(str((d, *w)) for (d, _), w in zip(pairs, wanted))


def test_an_empty_table_has_no_rows(spark):
    assert alignment.alignments(spark.createDataFrame([], SCHEMA), BYTES, PIECES).collect() == []
