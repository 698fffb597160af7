"""Registered queries of the operators: each applies one, with production settings, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm import ann, byte_bpe, chat, conversation_trie, html_text, neardup_vectors, packing, pieces, secret_scan, simhash, suffix_dedup, toxicity, vector_codes
from siftstone.llm.common import byte_pattern, table, vocabulary


def op1_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.segments(table(spark, sf_dir, "conversations"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "evidence")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "pos", "length", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "is_secret")


def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op10_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all embeddings by sixteen codebooks of 64 entries."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and of their decoding for every document."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), byte_pattern())


QUERIES = {f.__name__: f for f in (
    op1_perspective_rotation, op2_best_fit_packing, op3_toxicity, op4_sentencepiece, op5_simhash,
    op6_secret_scan, op7_nearest_vectors, op8_suffix_dedup, op9_main_text, op10_vector_duplicates,
    op11_conversation_trie, op12_vector_codes, op13_byte_bpe,
)}

ORACLE = {
    "op1_perspective_rotation": """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations WHERE conv_id IS NOT NULL),
w AS (SELECT DISTINCT conv_id, speaker AS participant FROM t WHERE speaker <> 'system'),
m AS (
  SELECT t.conv_id, participant, turn, speaker, body, speaker = participant AS own,
    '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = participant THEN 'assistant' ELSE 'user name=' || translate(replace(speaker, '<|', '< |'), chr(10) || chr(13), '  ') END || chr(10) AS head
  FROM t JOIN w ON t.conv_id = w.conv_id),
s AS (SELECT conv_id, participant, turn, speaker, own, body, length(head) AS h, head || body || '<|im_end|>' || chr(10) AS segment FROM m),
o AS (
  SELECT *, length(segment) AS n, coalesce(sum(length(segment)) OVER (
    PARTITION BY conv_id, participant ORDER BY turn NULLS LAST, speaker, body ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM s)
SELECT conv_id, participant, turn, speaker, segment, CAST(before AS BIGINT) AS start,
  CASE WHEN own THEN CAST(before + h AS BIGINT) END AS mask_start, CASE WHEN own THEN CAST(before + n - 1 AS BIGINT) END AS mask_end
FROM o""",
    # h is crc32 of the decimal id; ties of turn go by the digest of role and text.
    "op11_conversation_trie": r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS lead, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: xor(v // 2, 3988292384 * (v % 2)))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
b AS (
  SELECT c.conv_id, 0 AS part, pos, r, x FROM c JOIN t ON t.conv_id = c.lead WHERE c.conv_id <> c.lead AND pos < h
  UNION ALL SELECT c.conv_id, 1, pos, r, x FROM c JOIN t ON t.conv_id = c.conv_id WHERE c.conv_id = c.lead OR pos >= h),
p AS (
  SELECT c.conv_id, coalesce(list({'r': b.r, 'x': b.x} ORDER BY part, pos) FILTER (WHERE b.r IS NOT NULL), []) AS p
  FROM c LEFT JOIN b ON b.conv_id = c.conv_id GROUP BY c.conv_id),
n AS (
  SELECT p[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(p) = d), '') AS ends
  FROM (SELECT conv_id, p, unnest(range(0, len(p) + 1)) AS d FROM p) GROUP BY 1, 2),
k AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS children FROM n WHERE d > 0 GROUP BY 1, 2),
w AS (
  SELECT n.*, coalesce(children, 0) AS children, CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * len(regexp_extract_all(n.p[n.d].x, '[^\x20\x09-\x0D]+')) END AS saved
  FROM n LEFT JOIN k ON k.d = n.d AND k.p = n.p),
s AS (SELECT a.d, a.p, sum((u.children = 0)::INT) AS leaves, sum(u.saved) AS saved FROM w a JOIN w u ON u.d >= a.d AND u.p[1:a.d] = a.p GROUP BY 1, 2)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, w.n AS n_convs, CAST(w.children AS BIGINT) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM w JOIN s ON s.d = w.d AND s.p = w.p LEFT JOIN n up ON w.d > 0 AND up.d = w.d - 1 AND up.p = w.p[1:w.d - 1]""",
    "op12_vector_codes": """
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS i, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % 16 = 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS (SELECT i, (j - 1) // (len(v) // 16) AS part, (j - 1) % (len(v) // 16) AS k, floor(256 * v[j])::BIGINT AS x FROM (SELECT i, v, unnest(range(1, len(v) + 1)) AS j FROM kept)),
b0 AS (SELECT part, i - 1 AS e, k, x AS c FROM x WHERE i <= 64),
d0 AS (SELECT i, x.part, e, sum((x - c) * (x - c)) AS d FROM x JOIN b0 ON b0.part = x.part AND b0.k = x.k GROUP BY 1, 2, 3),
a0 AS (SELECT i, part, arg_min(e, d * 64 + e) AS e FROM d0 GROUP BY 1, 2),
m0 AS (SELECT x.part, e, k, CAST(floor(sum(x)::DOUBLE / count(*)) AS BIGINT) AS c FROM x JOIN a0 ON a0.i = x.i AND a0.part = x.part GROUP BY 1, 2, 3),
b1 AS (SELECT b0.part, b0.e, b0.k, coalesce(m0.c, b0.c) AS c FROM b0 LEFT JOIN m0 ON m0.part = b0.part AND m0.e = b0.e AND m0.k = b0.k),
d1 AS (SELECT i, x.part, e, sum((x - c) * (x - c)) AS d FROM x JOIN b1 ON b1.part = x.part AND b1.k = x.k GROUP BY 1, 2, 3),
a1 AS (SELECT i, part, arg_min(e, d * 64 + e) AS e FROM d1 GROUP BY 1, 2),
m1 AS (SELECT x.part, e, k, CAST(floor(sum(x)::DOUBLE / count(*)) AS BIGINT) AS c FROM x JOIN a1 ON a1.i = x.i AND a1.part = x.part GROUP BY 1, 2, 3),
b2 AS (SELECT b1.part, b1.e, b1.k, coalesce(m1.c, b1.c) AS c FROM b1 LEFT JOIN m1 ON m1.part = b1.part AND m1.e = b1.e AND m1.k = b1.k),
d2 AS (SELECT i, x.part, e, sum((x - c) * (x - c)) AS d FROM x JOIN b2 ON b2.part = x.part AND b2.k = x.k GROUP BY 1, 2, 3),
a2 AS (SELECT i, part, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM d2 GROUP BY 1, 2),
r AS (SELECT i, string_agg(printf('%02x', e), '' ORDER BY part) AS code, sum(d) AS error FROM a2 GROUP BY 1)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, e, k)) FROM b2) AS codebooks_sha256
FROM kept JOIN r USING (i)""",
}
