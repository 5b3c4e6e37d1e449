"""Registered queries of the operators over their whole tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.centroid_clustering import SQL as OP11_SQL
from tidemark.llm.centroid_clustering import lloyd
from tidemark.llm.exact_dedup import exact_groups
from tidemark.llm.filter_audit import SQL as OP12_SQL
from tidemark.llm.filter_audit import filter_audit
from tidemark.llm.html_extract import extract
from tidemark.llm.language_id import identify
from tidemark.llm.line_dedup import remove_lines
from tidemark.llm.lm_scoring import score_documents
from tidemark.llm.mixing import mixture
from tidemark.llm.ngram_join import ngram_components
from tidemark.llm.sentencepiece_codec import round_trip
from tidemark.llm.storage import read_table
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.topk_search import top_k
from tidemark.llm.toxicity import score_toxicity

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


OP9_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\v\f\r]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""


OP2_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM e q JOIN e d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@register("op1_ngram_jaccard_join")
def q_ngram_join(spark, sf):
    return ngram_components(read_table(spark, sf, "documents"))


@register("op2_top_k_search", OP2_SQL)
def q_top_k(spark, sf):
    return top_k(read_table(spark, sf, "embeddings"))


@register("op3_html_extraction")
def q_html(spark, sf):
    return extract(read_table(spark, sf, "pages"))


@register("op4_temperature_mixing")
def q_mixing(spark, sf):
    return mixture(read_table(spark, sf, "documents"))


@register("op6_line_dedup")
def q_line_dedup(spark, sf):
    return remove_lines(read_table(spark, sf, "documents")).drop("kept_text")


@register("op7_ppm_scoring")
def q_ppm(spark, sf):
    return score_documents(read_table(spark, sf, "documents"))


@register("op5_sentencepiece_codec")
def q_sentencepiece(spark, sf):
    return round_trip(read_table(spark, sf, "documents"))


@register("op8_language_id")
def q_language_id(spark, sf):
    return identify(read_table(spark, sf, "documents"))


@register("op9_exact_dedup", OP9_SQL)
def q_exact_dedup(spark, sf):
    return exact_groups(read_table(spark, sf, "documents"))


@register("op10_substring_dedup")
def q_substring_dedup(spark, sf):
    return remove_repeats(read_table(spark, sf, "documents")).drop("kept_text")


@register("op11_centroid_clustering", OP11_SQL)
def q_centroids(spark, sf):
    return lloyd(read_table(spark, sf, "embeddings"))


@register("op12_filter_audit", OP12_SQL)
def q_filter_audit(spark, sf):
    return filter_audit(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


@register("op13_toxicity")
def q_toxicity(spark, sf):
    return score_toxicity(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


@register("pipeline")
def q_pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)
