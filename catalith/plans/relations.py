"""Candidates, similarity, decisions and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions import scores
from catalith.operators import relations
from catalith.plans.registry import ASSET, assets, query
from catalith.session import table

EMB = "emb AS (SELECT vec_id // 4 AS asset_id, CAST(vec_id % 4 AS INT) AS chunk_index, CASE WHEN label < 5 THEN 'st' ELSE 'clip' END AS channel, embedding FROM embeddings)"
COS = "list_sum(list_transform(list_zip({a}, {b}), lambda x: CAST(x[1] AS DOUBLE) * CAST(x[2] AS DOUBLE))) / sqrt(list_sum(list_transform({a}, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) / sqrt(list_sum(list_transform({b}, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))"
PAIRS = f"{EMB}, ids AS (SELECT DISTINCT asset_id FROM emb), pair AS (SELECT a.asset_id AS src, a.asset_id + d AS dst FROM ids a, (VALUES (1), (2), (7)) t(d) WHERE a.asset_id + d IN (SELECT asset_id FROM ids)), best AS (SELECT src, dst, max({COS.format(a='x.embedding', b='y.embedding')}) AS score FROM pair JOIN emb x ON x.asset_id = src JOIN emb y ON y.asset_id = dst AND y.channel = x.channel GROUP BY src, dst), scored AS (SELECT src, dst, coalesce(score, 0.0) AS score FROM pair LEFT JOIN best USING (src, dst))"


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 4").alias("asset_id"), (F.col("vec_id") % 4).cast("int").alias("chunk_index"), F.when(F.col("label") < 5, "st").otherwise("clip").alias("channel"), "embedding")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _embeddings(spark, sf_dir)
    ids = e.select("asset_id").distinct()
    pairs = ids.select(F.col("asset_id").alias("src"), F.explode(F.array(*[F.col("asset_id") + d for d in (1, 2, 7)])).alias("dst")).join(ids.select(F.col("asset_id").alias("dst")), "dst", "left_semi")
    return relations.pair_scores(pairs, e)


@query(f"WITH {PAIRS} SELECT src, dst, round(score, 6) AS score FROM scored")
def pair_max_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("src", "dst", F.round("score", 6).alias("score"))


@query(f"WITH {PAIRS} SELECT src, count(*) FILTER (score >= 0.3) AS matches, count(*) AS candidates FROM scored GROUP BY src")
def match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four slots: candidate pairs, scores, decisions, and what is kept of them."""
    return relations.relation_pass(lambda: _scored(spark, sf_dir), lambda df: df, lambda df: relations.decide_by_score(df, 0.3), relations.match_count)


@query(f"WITH s AS (SELECT a.vec_id AS query, b.vec_id AS id, round({COS.format(a='a.embedding', b='b.embedding')}, 12) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, id) AS rank FROM s WHERE similarity >= 0.1) SELECT query, id, round(similarity, 6) AS similarity, CAST(rank AS INT) AS rank FROM r WHERE rank <= 10")
def topk_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return relations.nearest(e.filter("id % 50 = 0"), e, 10, least=0.1).select("query", "id", F.round("similarity", 6).alias("similarity"), "rank")


PATHS = f"{ASSET}, named AS (SELECT asset_id, '/in/' || source AS dir, lang || (asset_id // 100) AS stem FROM asset)"


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("lang", F.translate(F.expr("cast(asset_id div 100 as string)"), "0123456789", "abcdefghij"))
    return assets(spark, sf_dir).select("asset_id", F.concat(F.lit("/in/"), "source", F.lit("/"), name, F.lit("_"), F.col("asset_id").cast("string"), F.lit(".txt")).alias("fs_path"))


@query(f"WITH {PATHS} SELECT asset_id, min(asset_id) OVER (PARTITION BY dir, stem) AS class_id, count(*) OVER (PARTITION BY dir, stem) - 1 AS links FROM named")
def path_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and their members; any two of a class are candidates."""
    return relations.path_classes(_named(spark, sf_dir))


@query(f"WITH {PATHS}, c AS (SELECT *, row_number() OVER (PARTITION BY dir, stem ORDER BY asset_id) AS r FROM named) SELECT a.asset_id AS src, b.asset_id AS dst, CAST(0.0 AS DOUBLE) AS emb_score FROM c a JOIN c b ON a.dir = b.dir AND a.stem = b.stem AND b.r = CASE a.r WHEN 1 THEN 2 ELSE 1 END")
def path_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each asset's candidate by name: the first of its class, or the second for the first."""
    a = _named(spark, sf_dir)
    return relations.path_candidates(a, a)


@query(f"WITH {PAIRS}, p AS (SELECT src, dst, score AS emb_score FROM scored UNION ALL SELECT src, src + 1, 0.0 FROM scored) SELECT src, dst, round(max(emb_score), 6) AS emb_score FROM p GROUP BY src, dst")
def candidate_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir).select("src", "dst", F.col("score").alias("emb_score"))
    by_name = s.select("src", (F.col("src") + 1).alias("dst"), F.lit(0.0).alias("emb_score"))
    return relations.union_candidates(s, by_name).select("src", "dst", F.round("emb_score", 6).alias("emb_score"))


@query(f"WITH {ASSET}, c AS (SELECT s.asset_id AS src, d.asset_id AS dst, row_number() OVER (PARTITION BY s.asset_id ORDER BY d.asset_id) AS r FROM asset s JOIN asset d ON s.source = d.source AND s.asset_id <> d.asset_id WHERE s.asset_id % 50 = 0 AND d.status = 'registered') SELECT src, dst FROM c WHERE r <= 10")
def block_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assets(spark, sf_dir).select("asset_id", "source", "status")
    return relations.block_candidates(a.filter("asset_id % 50 = 0"), a, "source", 10)


RAW = f"""{PAIRS}, raw AS (SELECT src, CASE WHEN src % 17 = 0 THEN src ELSE dst END AS dst, CASE src % 4 WHEN 0 THEN 'same_event' WHEN 1 THEN 'part_of' WHEN 2 THEN 'same_domain' ELSE CASE WHEN src % 3 = 0 THEN '' ELSE 'nonsense' END END AS kind_code,
  CASE src % 5 WHEN 0 THEN '1.5' WHEN 1 THEN 'high' WHEN 2 THEN '0.8' WHEN 3 THEN '-0.3' END AS confidence, 'r' || src AS reason FROM scored)"""
KIND_ROWS = [("same_event", True), ("part_of", False), ("same_domain", True)]
KINDS = "kinds AS (SELECT * FROM (VALUES ('same_event', TRUE), ('part_of', FALSE), ('same_domain', TRUE)) t(kind_code, is_symmetric))"
SKIP = "CASE WHEN src = dst THEN 'self' WHEN kind_code = '' THEN 'no_kind' WHEN kind_code = 'nonsense' THEN 'unknown_kind' WHEN (src, dst) NOT IN (SELECT (src, dst) FROM scored) THEN 'not_allowed' END"
CONF = "CASE WHEN TRY_CAST(confidence AS DOUBLE) IS NULL THEN 0.0 ELSE greatest(0.0, least(1.0, TRY_CAST(confidence AS DOUBLE))) END"
DECIDED = f"{RAW}, {KINDS}, good AS (SELECT *, {CONF} AS c FROM raw WHERE {SKIP} IS NULL), decided AS (SELECT CASE WHEN is_symmetric THEN least(g.src, g.dst) ELSE g.src END AS src, CASE WHEN is_symmetric THEN greatest(g.src, g.dst) ELSE g.dst END AS dst, g.kind_code, c AS confidence, reason, CASE WHEN g.kind_code <> 'same_domain' AND c >= 0.7 AND s.score >= 0.1 THEN 'active' ELSE 'proposed' END AS status FROM good g JOIN kinds USING (kind_code) JOIN scored s ON s.src = g.src AND s.dst = g.dst)"


def _raw(scored: DataFrame) -> DataFrame:
    s, m4, m5 = F.col("src"), F.col("src") % 4, F.col("src") % 5
    kind = F.when(m4 == 0, "same_event").when(m4 == 1, "part_of").when(m4 == 2, "same_domain").when(s % 3 == 0, "").otherwise("nonsense")
    conf = F.when(m5 == 0, "1.5").when(m5 == 1, "high").when(m5 == 2, "0.8").when(m5 == 3, "-0.3")
    return scored.select("src", F.when(s % 17 == 0, s).otherwise(F.col("dst")).alias("dst"), kind.alias("kind_code"), conf.alias("confidence"), F.concat(F.lit("r"), s.cast("string")).alias("reason"))


def _decided(spark: SparkSession, scored: DataFrame) -> DataFrame:
    kinds = spark.createDataFrame(KIND_ROWS, "kind_code string, is_symmetric boolean")
    good = relations.checked_edges(_raw(scored), scored, kinds).filter("skipped is null").drop("skipped")
    return relations.decide_edges(good, scored.withColumnRenamed("score", "emb_score"), kinds, least=0.7, least_similarity=0.1, never_active=("same_domain",))


@query(f"WITH {RAW} SELECT coalesce({SKIP}, 'kept') AS outcome, count(*) AS n FROM raw GROUP BY 1")
def edge_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir)
    kinds = spark.createDataFrame(KIND_ROWS, "kind_code string, is_symmetric boolean")
    return relations.checked_edges(_raw(s), s, kinds).groupBy(F.coalesce("skipped", F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n"))


@query(f"WITH {DECIDED} SELECT src, dst, kind_code, CAST(confidence AS DOUBLE) AS confidence, reason, status FROM decided")
def edge_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(spark, _scored(spark, sf_dir)).select("src", "dst", "kind_code", "confidence", "reason", "status")


UPSERTED = f"""{DECIDED}, one AS (SELECT src, dst, kind_code, first(confidence ORDER BY confidence DESC, reason) AS c, first(reason ORDER BY confidence DESC, reason) AS r, first(status ORDER BY confidence DESC, reason) AS s FROM decided GROUP BY src, dst, kind_code),
  old AS (SELECT src, dst, 'same_event' AS kind_code, CAST(0.8 AS DOUBLE) AS confidence, 'old' AS reason, 'rejected' AS status FROM scored WHERE src % 2 = 0)"""


@query(f"WITH {UPSERTED} SELECT coalesce(o.src, n.src) AS src, coalesce(o.dst, n.dst) AS dst, coalesce(o.kind_code, n.kind_code) AS kind_code, CAST(coalesce(greatest(o.confidence, n.c), o.confidence, n.c) AS DOUBLE) AS confidence, CASE WHEN n.src IS NOT NULL AND (o.src IS NULL OR n.c > o.confidence) THEN n.r ELSE o.reason END AS reason, coalesce(o.status, n.s) AS status FROM old o FULL JOIN one n ON o.src = n.src AND o.dst = n.dst AND o.kind_code = n.kind_code")
def edge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir)
    old = s.filter("src % 2 = 0").select("src", "dst", F.lit("same_event").alias("kind_code"), F.lit(0.8).alias("confidence"), F.lit("old").alias("reason"), F.lit("rejected").alias("status"))
    return relations.upsert_edges(old, _decided(spark, s))


@query(f"WITH {DECIDED} SELECT src, array_to_string(list_transform(list_sort(list(dst)), lambda x: CAST(x AS VARCHAR)), ',') AS targets FROM decided GROUP BY src")
def edge_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = relations.edge_lineage(_decided(spark, _scored(spark, sf_dir)))
    return e.select("src", F.array_join(F.transform("targets", lambda t: t["dst"].cast("string")), ",").alias("targets"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN greatest(0.0, least(1.0, value / 100)) ELSE 0.0 END AS confidence FROM events")
def confidence_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("event_id") % 4
    raw = F.when(m == 0, (F.col("value") / 100).cast("string")).when(m == 1, "NaN").when(m == 2, "high")
    return table(spark, sf_dir, "events").select("event_id", scores.clamped(raw).alias("confidence"))


@query(f"WITH {EMB} SELECT DISTINCT a.asset_id FROM (SELECT doc_id AS asset_id FROM documents) a WHERE EXISTS (SELECT 1 FROM emb WHERE emb.asset_id = a.asset_id)")
def with_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id")).join(_embeddings(spark, sf_dir).select("asset_id").distinct(), "asset_id", "left_semi")
