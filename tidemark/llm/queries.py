"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import workspace
from tidemark.llm import alignment, chaining, gru_lm, imatch, kd_shards, lexical_packing, merkle, page_template, parity_join, token_store, toxicity, va_file, viterbi
from tidemark.llm.common import table

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace.new_folder(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(BYTE_BPE), end_id=2)
    return token_store.digests(token_store.read_tokens(spark, path))


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return imatch.compare_edited(documents, imatch.lexicon(documents))


def op3_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.jaccard_classes(table(spark, sf_dir, "documents"), width=3, share=Fraction(9, 10))


def op4_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op5_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(table(spark, sf_dir, "documents"))


def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kd_shards.shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return rows.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op7_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return gru_lm.lm_scores(table(spark, sf_dir, "documents"), held_out)


def op8_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return lexical_packing.pack(documents, public_tokenizers.path(BYTE_BPE), end_id=0, finish=lexical_packing.with_crc)


def op9_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = va_file.whole_vectors(table(spark, sf_dir, "embeddings"))
    return va_file.search(vectors, F.col("vec_id") % 100 == 0, k=10, every_row=True)


def toxic_training():
    """Rows whose labels may be learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"), toxic_training())
    scored = toxicity.score(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", (~toxic_training()).alias("held_out"), "score", "predicted")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES))


def op13_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_template.main_texts(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op9_va_file": OP9_SQL, "op11_merkle": merkle_sql()}


def merkle_sql(levels: int = 5) -> str:
    """The manifest in SQL, for trees of up to 16^levels nodes: every level is a table of its own."""
    field = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')".format
    fields = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
    bits += "lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
    bits += "lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, 3988292384 * (s & 1)) END)"
    steps = [
        f"""leaf AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, leaf,
    CASE WHEN xor({bits}, 4294967295) % 5 = 0 THEN sha256({" || ".join(fields)} || {field(lowered)}) ELSE leaf END AS changed
  FROM (SELECT *, sha256({" || ".join(fields)} || {field("text")}) AS leaf FROM documents)
)""",
        "a0 AS (SELECT source AS tree, place, leaf AS node FROM leaf)",
    ]
    for name in "ab":
        if name == "b":
            steps.append(f"b0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place, node, tree AS source FROM a{levels})")
        for k in range(levels):
            steps.append(
                f"""{name}{k + 1}r AS (
  SELECT tree, place // 16 AS place, list(node ORDER BY place) AS run, any_value(nodes) AS nodes
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS nodes FROM {name}{k}) GROUP BY tree, place // 16
), {name}{k + 1} AS (
  SELECT tree, place, CASE WHEN nodes = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS node FROM {name}{k + 1}r
)"""
            )
    steps.append("f0 AS (SELECT *, place AS pos, changed AS node, '' AS proof FROM leaf)")
    before, after = "array_to_string(r.run[:pos % 16], '')", "array_to_string(r.run[pos % 16 + 2:], '')"
    for k in range(2 * levels):
        rows, runs, tree = f"f{k}", f"a{k + 1}r", "f.source"
        if k == levels:
            steps.append(f"g AS (SELECT f.* EXCLUDE (pos), b.place AS pos FROM f{k} f JOIN b0 b ON f.source IS NOT DISTINCT FROM b.source)")
        if k >= levels:
            rows, runs, tree = "g" if k == levels else rows, f"b{k + 1 - levels}r", "0"
        steps.append(
            f"""f{k + 1} AS (
  SELECT f.* EXCLUDE (pos, node, proof), f.pos // 16 AS pos,
    CASE WHEN nodes = 1 THEN node ELSE sha256({before} || node || {after}) END AS node,
    CASE WHEN nodes = 1 THEN proof ELSE proof || {before} || {after} END AS proof
  FROM {rows} f JOIN {runs} r ON r.tree IS NOT DISTINCT FROM {tree} AND r.place = f.pos // 16
)"""
        )
    return f"""WITH {", ".join(steps)}
SELECT f.doc_id, f.leaf, s.node AS subroot, t.node AS root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = t.node AS verified
FROM f{2 * levels} f JOIN a{levels} s ON f.source IS NOT DISTINCT FROM s.tree CROSS JOIN b{levels} t"""


OP9_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
