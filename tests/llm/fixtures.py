"""Small documents with everything that may go wrong in a row, and plain references."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: further columns whose names the operators use inside
EXTRA = ["doc", "key", "rest", "seed", "score", "ids", "row", "node", "size", "spans", "run", "_word", "component_id"]

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in EXTRA],
    ]
)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def prose(draw: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{draw.randrange(vocabulary):x}" for _ in range(n))


def documents(spark, texts: list, parts: int = 3):
    """Documents numbered from 0; a pair stands for (doc_id, text)."""
    rows = []
    for i, text in enumerate(texts):
        doc_id, text = text if isinstance(text, tuple) else (i, text)
        rows.append((doc_id, text, [None, "en", "de"][i % 3], [None, "s1"][i % 2], len(text or ""), *["x"] * len(EXTRA)))
    return spark.createDataFrame(rows, SCHEMA).repartition(parts) if rows else spark.createDataFrame([], SCHEMA)


def odd_texts(seed: int = 1) -> list:
    """Null, empty, blank, very long, repeated, without id, and plain texts."""
    draw = random.Random(seed)
    long = prose(draw, 6000, 3000)
    plain = [prose(draw, draw.randrange(1, 120)) for _ in range(25)]
    return [None, "", "  \t\n ", "a", long, long, plain[0], (900, plain[1]), (900, plain[1]), (900, plain[2]), (None, plain[3]), (None, None), *plain]
