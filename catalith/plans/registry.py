"""Names of queries, and the tables that stand in for a catalog's own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


#: One asset a document; modality, status and time follow from its id.
ASSET = """asset AS (SELECT doc_id AS asset_id, '/inbox/' || source || '/' || doc_id || '.txt' AS fs_path,
  CASE doc_id % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'audio' WHEN 2 THEN 'image' ELSE 'video' END AS modality,
  sha256(text) AS file_hash, CAST(strlen(text) AS BIGINT) AS file_size, doc_id AS created_at,
  CASE WHEN doc_id % 10 = 0 THEN 'registered' WHEN doc_id % 10 = 1 THEN 'failed' WHEN doc_id % 10 = 2 THEN 'deferred' ELSE 'received' END AS status,
  text, lang, source FROM documents)"""


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalith.sources.inputs import content_identity

    d = table(spark, sf_dir, "documents")
    h, n = content_identity(F.col("text"))
    m, s = F.col("doc_id") % 4, F.col("doc_id") % 10
    return d.select(
        F.col("doc_id").alias("asset_id"), F.concat(F.lit("/inbox/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("fs_path"),
        F.when(m == 0, "text").when(m == 1, "audio").when(m == 2, "image").otherwise("video").alias("modality"), h.alias("file_hash"), n.alias("file_size"), F.col("doc_id").alias("created_at"),
        F.when(s == 0, "registered").when(s == 1, "failed").when(s == 2, "deferred").otherwise("received").alias("status"), "text", "lang", "source",
    )


#: Events as lineage of assets (one a user).
LINEAGE = """lineage AS (SELECT user_id AS asset_id, event_id, ts, CASE event_type WHEN 'signup' THEN 'received' WHEN 'click' THEN 'routing'
  WHEN 'view' THEN 'classifying' WHEN 'purchase' THEN 'registered' ELSE 'failed' END AS state FROM events)"""


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_lineage(table(spark, sf_dir, "events"))


def as_lineage(events: DataFrame) -> DataFrame:
    t = F.col("event_type")
    state = F.when(t == "signup", "received").when(t == "click", "routing").when(t == "view", "classifying").when(t == "purchase", "registered").otherwise("failed")
    return events.select(F.col("user_id").alias("asset_id"), "event_id", "ts", state.alias("state"))


#: Orders as assets that belong to entities (a part and its type); returned lines are rejected edges.
EDGE = """edge AS (SELECT p_type AS entity_type, l_partkey AS entity_uid, l_orderkey AS asset_id, CASE l_returnflag WHEN 'R' THEN 'rejected' ELSE 'active' END AS status
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_returnflag")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_type").alias("entity_type"), F.col("l_partkey").alias("entity_uid"), F.col("l_orderkey").alias("asset_id"), F.when(F.col("l_returnflag") == "R", "rejected").otherwise("active").alias("status"))


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("asset_id"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("summary"))
