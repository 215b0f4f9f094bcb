"""Benchmark passages as queries over documents, and vectors as queries over vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.operators import postings, search
from catalith.operators.relations import nearest
from catalith.plans.registry import query
from catalith.plans.relations import COS
from catalith.session import table
from catalith.sources import folders

TERMS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
BM25 = f"""q AS (SELECT item_id AS query, unnest(list_distinct({TERMS})) AS term FROM benchmark), d AS (SELECT doc_id AS id, {TERMS} AS t FROM documents), sized AS (SELECT id, len(t) AS dl FROM d), stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM sized),
  tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(t) AS term FROM d) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  s AS (SELECT query, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 9) AS score FROM q JOIN tf USING (term) JOIN df USING (term) JOIN sized USING (id), stats GROUP BY query, id),
  lex AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM s) WHERE rank <= 10)"""


def _bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query"), "text")
    return search.bm25(q, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), 10)


@query(f"WITH {BM25} SELECT query, id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM lex")
def bm25_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bm25(spark, sf_dir).select("query", "id", F.round("score", 6).alias("score"), "rank")


VECTOR = f"""corpus AS (SELECT vec_id AS id, embedding, CASE vec_id % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'audio' WHEN 2 THEN 'image' ELSE 'video' END AS modality FROM embeddings WHERE label <> 9), near AS (SELECT a.vec_id AS query, b.id, b.modality, round({COS.format(a='a.embedding', b='b.embedding')}, 12) AS similarity FROM embeddings a JOIN corpus b ON a.vec_id <> b.id WHERE a.vec_id % 50 = 0),
  vec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query, modality ORDER BY similarity DESC, id) AS rank FROM near) WHERE rank <= 5)"""


def _vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("vec_id") % 4
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", F.col("label").cast("string").alias("domain_label"), F.when(m == 0, "text").when(m == 1, "audio").when(m == 2, "image").otherwise("video").alias("modality"))
    return search.by_modality(e.filter("id % 50 = 0"), e, 5, excluded=("9",))


@query(f"WITH {VECTOR} SELECT query, id, modality, round(similarity, 6) AS similarity, CAST(rank AS INT) AS rank FROM vec")
def knn_by_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector(spark, sf_dir).select("query", "id", "modality", F.round("similarity", 6).alias("similarity"), "rank")


@query(f"""WITH {BM25}, near AS (SELECT a.vec_id AS query, b.vec_id AS id, round({COS.format(a='a.embedding', b='b.embedding')}, 12) AS similarity FROM embeddings a JOIN benchmark ON item_id = a.vec_id JOIN embeddings b ON a.vec_id <> b.vec_id),
  vecs AS (SELECT query, id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, id) AS rank FROM near) WHERE rank <= 10),
  l AS (SELECT query, id, coalesce((score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0), 1.0) AS x FROM lex WINDOW w AS (PARTITION BY query)), v AS (SELECT query, id, coalesce((similarity - min(similarity) OVER w) / nullif(max(similarity) OVER w - min(similarity) OVER w, 0), 1.0) AS x FROM vecs WINDOW w AS (PARTITION BY query)),
  f AS (SELECT coalesce(l.query, v.query) AS query, coalesce(l.id, v.id) AS id, round(least((0.6 * coalesce(l.x, 0) + 0.4 * coalesce(v.x, 0)) / 1.0, 1.0), 9) AS similarity FROM l FULL JOIN v ON l.query = v.query AND l.id = v.id),
  g AS (SELECT *, max(similarity) OVER (PARTITION BY query) AS m FROM f), r AS (SELECT query, id, similarity, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, id) AS rank FROM g WHERE m >= 0.5 AND similarity >= 0.2) SELECT query, id, round(similarity, 6) AS similarity, CAST(rank AS INT) AS rank FROM r WHERE rank <= 10""")
def fused_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best by terms fused with the ten nearest by vectors, which share their ids here; gated, merged, ranked."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    asked = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding").join(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id")), "id", "left_semi")
    fused = search.gate(search.fuse(_bm25(spark, sf_dir), nearest(asked, e, 10), (0.6, 0.4)), ["query"], 0.5, 0.2)
    return search.merge(fused, 10).select("query", "id", F.round("similarity", 6).alias("similarity"), "rank")


@query(f"""WITH {BM25}, rel AS (SELECT DISTINCT item_id AS query, doc_id AS id FROM benchmark b JOIN documents d ON contains(d.text, b.text)), n AS (SELECT query, count(*) AS n FROM rel GROUP BY query), h AS (SELECT lex.*, CAST(rel.id IS NOT NULL AS INT) AS hit FROM lex LEFT JOIN rel USING (query, id)),
  a AS (SELECT query, sum(CASE WHEN rank <= 5 THEN hit END) AS hits, min(CASE WHEN hit = 1 THEN rank END) AS first, sum(CASE WHEN rank <= 5 THEN hit / log2(rank + 1) END) AS dcg, avg(CASE WHEN hit = 0 THEN rank END) AS mean_rank, count(*) FILTER (rank <= 5 AND hit = 0) AS shown FROM h GROUP BY query)
  SELECT n.query, round(coalesce(hits / n, 0), 6) AS recall, round(coalesce(hits / 5, 0), 6) AS precision, round(coalesce(1 / first, 0), 6) AS mrr, round(coalesce(dcg / list_sum(list_transform(range(1, least(n, 5) + 1), lambda i: 1 / log2(i + 1))), 0), 6) AS ndcg, round(mean_rank, 6) AS nonrelevant_mean_rank, round(coalesce(shown / 5, 0), 6) AS nonrelevant_exposure FROM n LEFT JOIN a USING (query)""")
def search_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query"), "text")
    rel = search.containing_any(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), b)
    m = search.metrics(_bm25(spark, sf_dir), rel, 5)
    return m.select("query", *[F.round(c, 6).alias(c) for c in m.columns if c != "query"])


@query(f"WITH {BM25} SELECT query, id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM lex")
def index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same results from a kept index that two additions of documents made."""
    at = folders.fresh(spark, "index")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    for part in ("id % 3 < 2", "id % 3 = 2"):
        postings.add(docs.filter(part), at)
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query"), "text")
    return postings.search(q, at, 10).results.select("query", "id", F.round("score", 6).alias("score"), "rank")
