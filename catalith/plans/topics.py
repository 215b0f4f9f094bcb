"""Topics: regions are top-level names, nations their children."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.operators import topics
from catalith.plans.registry import query
from catalith.session import table

REGISTRY = "registry AS (SELECT r_name AS name, CAST(NULL AS VARCHAR) AS parent FROM region UNION ALL SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"
#: Two answers for each customer: the first may be outside of the set.
SAID = """said AS (SELECT c_custkey AS asset_id, 1 AS attempt, CASE WHEN c_custkey % 3 = 0 THEN 'elsewhere' ELSE r_name END AS topic, n_name AS subtopic, c_acctbal AS confidence FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT c_custkey, 2, CASE WHEN c_custkey % 6 = 0 THEN 'nowhere' ELSE r_name END, CASE WHEN c_custkey % 2 = 0 THEN n_name ELSE 'nowhere' END, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
TOPIC = f"{REGISTRY}, {SAID}, top AS (SELECT name FROM registry WHERE parent IS NULL AND name <> 'ASIA'), pick AS (SELECT asset_id, arg_min(topic, attempt) AS topic, arg_min(confidence, attempt) AS confidence FROM said WHERE topic IN (SELECT name FROM top) GROUP BY asset_id), topic AS (SELECT c_custkey AS asset_id, CASE WHEN c_custkey % 11 <> 0 THEN coalesce(topic, 'unassigned') ELSE 'unassigned' END AS topic, CASE WHEN c_custkey % 11 <> 0 THEN confidence END AS confidence FROM customer LEFT JOIN pick ON asset_id = c_custkey)"
SUB = f"{TOPIC}, sub AS (SELECT t.asset_id, arg_min(s.subtopic, s.attempt) AS subtopic FROM topic t JOIN said s ON s.asset_id = t.asset_id WHERE (t.topic, s.subtopic) IN (SELECT (parent, name) FROM registry WHERE parent IS NOT NULL) GROUP BY t.asset_id), both_ AS (SELECT t.*, sub.subtopic FROM topic t LEFT JOIN sub USING (asset_id))"


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    return r.select(F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent")).unionByName(n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("name"), F.col("r_name").alias("parent")))


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf_dir, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("asset_id"), "r_name", "n_name", F.col("c_acctbal").alias("confidence"))
    i = F.col("asset_id")
    first = c.select("asset_id", F.lit(1).alias("attempt"), F.when(i % 3 == 0, "elsewhere").otherwise(F.col("r_name")).alias("topic"), F.col("n_name").alias("subtopic"), "confidence")
    return first.unionByName(c.select("asset_id", F.lit(2).alias("attempt"), F.when(i % 6 == 0, "nowhere").otherwise(F.col("r_name")).alias("topic"), F.when(i % 2 == 0, F.col("n_name")).otherwise("nowhere").alias("subtopic"), "confidence"))


def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("asset_id"), F.when(F.col("c_custkey") % 11 != 0, F.col("c_name")).otherwise(" ").alias("text"))
    return topics.closed_topic(texts, _said(spark, sf_dir).select("asset_id", "attempt", "topic", "confidence"), _registry(spark, sf_dir), catch_all="ASIA")


def _both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.closed_subtopic(_topics(spark, sf_dir), _said(spark, sf_dir).select("asset_id", "attempt", "subtopic"), _registry(spark, sf_dir))


@query(f"WITH {TOPIC} SELECT asset_id, topic, confidence FROM topic")
def closed_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _topics(spark, sf_dir)


@query(f"WITH {SUB} SELECT asset_id, topic, subtopic FROM both_")
def closed_subtopic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir).select("asset_id", "topic", "subtopic")


@query(f"WITH {SUB} SELECT f.topic, f.subtopic, f.assets, t.topic_assets FROM (SELECT topic, subtopic, count(DISTINCT asset_id) AS assets FROM both_ GROUP BY ALL) f JOIN (SELECT topic, count(DISTINCT asset_id) AS topic_assets FROM both_ GROUP BY ALL) t USING (topic)")
def topic_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.facets(_both(spark, sf_dir))


@query(f"WITH {SUB}, e AS (SELECT asset_id AS src, asset_id + 25 AS dst FROM both_ WHERE asset_id % 2 = 0) SELECT a.asset_id AS src, b.asset_id AS dst, EXISTS (SELECT 1 FROM e WHERE (e.src = a.asset_id AND e.dst = b.asset_id) OR (e.src = b.asset_id AND e.dst = a.asset_id)) AS already_linked FROM both_ a JOIN both_ b ON a.topic = b.topic AND a.subtopic = b.subtopic AND a.asset_id <> b.asset_id WHERE a.asset_id % 50 = 0")
def same_topic_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _both(spark, sf_dir)
    e = b.filter("asset_id % 2 = 0").select(F.col("asset_id").alias("src"), (F.col("asset_id") + 25).alias("dst"), F.lit("active").alias("status"))
    return topics.same_topic(b, b.filter("asset_id % 50 = 0"), e)


@query(f"WITH {SUB}, c AS (SELECT asset_id, CASE topic WHEN 'EUROPE' THEN 'AMERICA' ELSE topic END AS topic, subtopic FROM both_) SELECT asset_id, topic, CASE WHEN subtopic = 'FRANCE' AND topic = 'AMERICA' THEN 'CANADA' ELSE subtopic END AS subtopic FROM c")
def canonical_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    al = spark.createDataFrame([("EUROPE", "AMERICA", None), ("FRANCE", "CANADA", "AMERICA"), ("FRANCE", "CHINA", "ASIA")], "raw string, canonical string, parent string")
    return topics.canonical_topics(_both(spark, sf_dir), al).select("asset_id", "topic", "subtopic")


@query(f"WITH {TOPIC} SELECT asset_id, (SELECT count(*) FROM topic WHERE topic = 'AFRICA') AS total FROM topic WHERE topic = 'AFRICA' ORDER BY asset_id LIMIT 20 OFFSET 10")
def topic_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _topics(spark, sf_dir)
    rows, total = topics.page(t, "AFRICA", 10, 20)
    return rows.select("asset_id").join(F.broadcast(t.agg(total.alias("total"))))


@query("SELECT DISTINCT p_brand AS skill_code FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 40 AND p_partkey % 9 = 0)")
def unknown_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "skill_code")
    return topics.unknown(p, p.filter("p_size > 40 and p_partkey % 9 = 0"), "skill_code")
