"""Registered queries of the corpus operators and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.llm import byte_bpe, fim, line_dedup, merkle, near_dup, packing, personal, quality, repeats, sharding, topk, toxicity, warc
from tabfold.llm.common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (quality.compression_quality(table(spark, sf_dir, "documents"))
            .select("row.doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
                    "quality.n_repeat_words", "quality.base_failed", "quality.kept", "quality.ratio", "quality.n_chunks",
                    "quality.n_bad_chunks", "quality.verdict"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), "doc_id",
                               public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.deduplicated_archives(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, strlen(body) AS payload_bytes, h, max(page_id) OVER (PARTITION BY body) AS original,
    array_to_string(list_transform(generate_series(0, 31), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             CAST(((CAST('0x' || substr(h, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to
FROM d
"""


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.without_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select("row.doc_id", "n_lines", "n_removed", F.octet_length("clean").cast("long").alias("clean_bytes"),
                          F.sha2(F.encode("clean", "UTF-8"), 256).alias("clean_sha256"))


OP6_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), l AS (
  SELECT rid, doc_id, source, unnest(string_split(t, chr(10))) AS line,
    unnest(generate_series(1, len(string_split(t, chr(10))))) AS pos
  FROM d
), k AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS key FROM l
), spread AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= 10
), marked AS (
  SELECT k.*, s.key IS NOT NULL AND row_number() OVER (PARTITION BY k.key ORDER BY doc_id, pos) > 1 AS gone
  FROM k LEFT JOIN spread s ON k.key = s.key
), docs AS (
  SELECT rid, doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS clean
  FROM marked GROUP BY rid, doc_id
)
SELECT doc_id, n_lines, n_removed, CAST(strlen(clean) AS BIGINT) AS clean_bytes, sha256(clean) AS clean_sha256 FROM docs
"""


def op7_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find_personal(table(spark, sf_dir, "documents"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5).drop("depth")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return fim.fill_in_middle(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(fim.restored()).alias("restored_sha256"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), u AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '(?s)[A-Za-z]+|[^A-Za-z]') AS units,
    list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(x, i, 8) AS BIGINT)) AS h FROM d
), c AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a,
    greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
         WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
    array_to_string(units[b + 1:], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id's checksum divides by 3 are tampered with: their proofs must fail where the text had an A-Z."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    held = merkle.leaf(*[F.when(tampered, F.translate(c, UPPER, LOWER)).otherwise(F.col(c)) if c == "text" else F.col(c) for c in FIELDS])
    rows = merkle.manifest(docs, FIELDS, "lang", "doc_id", carried={"held": held})
    rows = rows.select("*", merkle.fold(F.col("held"), F.col("path")).alias("folded"))
    return rows.select("doc_id", *[merkle.hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                       merkle.proof_digest(F.col("path")).alias("proof_sha256"), merkle.hexed(F.col("folded")).alias("folded_root"),
                       (F.col("folded") == F.col("root")).alias("verified"))


OP12_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, text, CAST(doc_id AS VARCHAR) AS id,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head FROM documents
), c AS (
  SELECT *, xor(4294967295, list_reduce(list_transform(range(CAST(strlen(id) AS BIGINT)), lambda i: CAST(ord(substr(id, i + 1, 1)) AS BIGINT)),
      lambda a, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
        lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(a, b)), 4294967295)) % 3 = 0 AS bent FROM d
), f AS (
  SELECT rid, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || CASE WHEN bent THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                            ELSE text END, '-')) AS held FROM c
), leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM f WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)
), tree AS (
  SELECT 0 AS level, g, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, g, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY level, g, pos // 8
), roots AS (SELECT g, h FROM tree WHERE n = 1
), upper AS (
  SELECT 0 AS level, g AS pos, (SELECT count(*) FROM roots) AS n, h FROM roots
  UNION ALL
  SELECT level + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY level, pos // 8
), steps AS (
  SELECT a.level, a.g, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM tree a JOIN tree b ON a.level = b.level AND a.g = b.g AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY ALL
), upper_steps AS (
  SELECT a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM upper a JOIN upper b ON a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY ALL
), walk AS (
  SELECT rid, g, 0 AS level, pos, held AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT rid, w.g, w.level + 1, w.pos // 8, sha256(l || h || r), proof || l || r
  FROM walk w JOIN steps s ON w.g = s.g AND w.level = s.level AND w.pos = s.pos
), climbed AS (SELECT rid, g, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM walk GROUP BY rid, g
), upward AS (
  SELECT rid, 0 AS level, g AS pos, h, proof FROM climbed
  UNION ALL
  SELECT rid, w.level + 1, w.pos // 8, sha256(l || h || r), proof || l || r
  FROM upward w JOIN upper_steps s ON w.level = s.level AND w.pos = s.pos
), top AS (SELECT rid, arg_max(h, level) AS folded_root, arg_max(proof, level) AS proof FROM upward GROUP BY rid
)
SELECT doc_id, leaf, roots.h AS subroot, upper.h AS root, sha256(proof) AS proof_sha256, folded_root, folded_root = upper.h AS verified
FROM leaves JOIN roots ON leaves.g = roots.g JOIN top ON leaves.rid = top.rid JOIN upper ON upper.n = 1
"""

def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from four fifths of the labels (by the id's checksum); every document is scored."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.train(docs, labels, ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "clauses", "directed_insults",
                                              "insults", "directed_threats", "threats", "negated", "reported")


OP9_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM t
), x AS (SELECT doc_id, len(g) AS n, unnest(g) AS h FROM s
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(r.b) AS component_id, min(r.b) = s.doc_id AS kept
FROM s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, g
"""

OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

QUERIES = {
    "op1_packing": op1_packing,
    "op2_sharding": op2_sharding,
    "op3_quality": op3_quality,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_warc": op5_warc,
    "op6_line_dedup": op6_line_dedup,
    "op7_personal": op7_personal,
    "op8_repeats": op8_repeats,
    "op9_near_dup": op9_near_dup,
    "op10_topk": op10_topk,
    "op11_fim": op11_fim,
    "op12_merkle": op12_merkle,
    "op13_toxicity": op13_toxicity,
}
ORACLES: dict[str, str] = {"op5_warc": OP5_SQL, "op6_line_dedup": OP6_SQL, "op9_near_dup": OP9_SQL, "op10_topk": OP10_SQL,
                           "op11_fim": OP11_SQL, "op12_merkle": OP12_SQL}
