"""The registered queries of these operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import ann, bit_sliced, html_text, jaccard_join, line_dedup, mixing, packing, quality, token_counts, url_filter
from loomgraph.llm.common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


def op2_co_trained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "p_text", "p_meta", "score", "keep")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_site_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("epochs", "spans")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


def op9_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_k(table(spark, sf_dir, "embeddings"))


def op10_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


OP1_SQL = f"""
WITH r(h, p, a) AS (VALUES {", ".join(map(str, RULES))}),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
v AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path,
  (SELECT arg_max(h || p, length(h || p)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
  coalesce((SELECT arg_max(a, length(h || p)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)), 'allow') AS verdict
FROM v"""

#: The shortest runs of 20 words from and up to each line, as texts; all but the first copy of each go.  Each row is a document,
#: in order of doc_id (none last) and of its content.
OP3_SQL = r"""
WITH d AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id NULLS LAST, md5(text)) AS k FROM documents),
s AS (SELECT k AS doc, string_split(text, chr(10)) AS ls FROM d WHERE text IS NOT NULL),
l AS (SELECT doc, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM s),
w AS (SELECT *, greatest(1, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS w FROM l),
c AS (SELECT doc, pos, line, w, sum(w) OVER (PARTITION BY doc ORDER BY pos) AS stop FROM w),
r AS (SELECT a.doc, a.pos, min(b.pos) AS last FROM c a JOIN c b ON a.doc = b.doc AND b.pos >= a.pos AND b.stop - a.stop + a.w >= 20 GROUP BY a.doc, a.pos
      UNION
      SELECT b.doc, max(a.pos) AS pos, b.pos AS last FROM c a JOIN c b ON a.doc = b.doc AND b.pos >= a.pos AND b.stop - a.stop + a.w >= 20 GROUP BY b.doc, b.pos),
t AS (SELECT r.doc, r.pos, r.last, string_agg(c.line, chr(10) ORDER BY c.pos) AS run FROM r JOIN c ON c.doc = r.doc AND c.pos BETWEEN r.pos AND r.last GROUP BY r.doc, r.pos, r.last),
k AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc, pos) AS copy FROM t),
g AS (SELECT DISTINCT c.doc, c.pos FROM k JOIN c ON c.doc = k.doc AND c.pos BETWEEN k.pos AND k.last WHERE copy > 1),
n AS (SELECT c.doc, coalesce(string_agg(c.line, chr(10) ORDER BY c.pos) FILTER (WHERE g.pos IS NULL), '') AS text, count(*)::INT AS n_lines, count(g.pos)::INT AS n_removed
      FROM c LEFT JOIN g ON g.doc = c.doc AND g.pos = c.pos GROUP BY c.doc)
SELECT doc_id, n.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed FROM d LEFT JOIN n ON n.doc = k"""

OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
n AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS "rank", vec_id, score FROM s)
SELECT * FROM n WHERE "rank" <= 10"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_co_trained_quality": op2_co_trained_quality,
        "op3_line_dedup": op3_line_dedup,
        "op4_site_text": op4_site_text,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_source_mix": op7_source_mix,
        "op8_token_counts": op8_token_counts,
        "op9_bit_sliced_top_k": op9_bit_sliced_top_k,
        "op10_projected_neighbours": op10_projected_neighbours,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": OP1_SQL, "op3_line_dedup": OP3_SQL, "op9_bit_sliced_top_k": OP9_SQL}
