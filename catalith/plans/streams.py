"""Streams over the given tables, run until nothing is left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.operators import classify
from catalith.plans.ingest import LABELLED, LEXICONS
from catalith.plans.lifecycle import RESET_SQL
from catalith.plans.registry import LINEAGE, as_lineage, assets, lineage, query
from catalith.session import table
from catalith.sources import folders, versions
from catalith.streaming import late, lifecycle, snapshots, timers


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{sf_dir}/{name}.parquet*")


def _read(spark: SparkSession, stream: DataFrame) -> DataFrame:
    at = folders.fresh(spark, "stream")
    lifecycle.drain(stream, f"{at}/out", f"{at}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


@query()
def lifecycle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, lifecycle.follow(as_lineage(_stream(spark, sf_dir, "events"))))


@query("SELECT DISTINCT sha256(text) AS file_hash FROM documents")
def inbox_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, lifecycle.inbox(_stream(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("fs_path"), "text"))).select("file_hash")


def _in_turn(spark: SparkSession, rows: DataFrame, number: str, turns: int, at: str, name: str, steps: Callable[[DataFrame, int], None]) -> None:
    """Rows come into an inbox by their number, turn after turn; after each the stream runs on what is new."""
    schema = rows.drop(number).schema
    for i in range(turns):
        rows.filter(F.col(number) == i).drop(number).write.mode("append").parquet(f"{at}/inbox")
        snapshots.follow(spark.readStream.schema(schema).parquet(f"{at}/inbox"), f"{at}/checkpoint", name, steps)


@query(RESET_SQL)
def stuck_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timers of a stream reset what the scan of the table resets."""
    with timers.timed_state(spark):
        rows = _read(spark, timers.resets(as_lineage(_stream(spark, sf_dir, "events")), 60, 12))
    return rows.select("asset_id", "attempts", "status", "status_reason", "reset_event")


@query(f"WITH {LINEAGE} SELECT asset_id, arg_max(state, (ts, event_id)) AS state, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM lineage GROUP BY asset_id")
def merged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of each asset, though events come in out of order over four micro-batches."""
    at = folders.fresh(spark, "merged")
    rows = lineage(spark, sf_dir).withColumn("turn", F.col("event_id") % 4)
    _in_turn(spark, rows, "turn", 4, at, "state", lambda df, n: snapshots.merge(df.select("asset_id", "state", "ts", "event_id"), f"{at}/state", ["asset_id"], order=["ts", "event_id"], stream="state", batch=n))
    return versions.load(spark, f"{at}/state")


@query(f"WITH {LABELLED} SELECT asset_id, label AS domain_label, CAST(confidence AS DOUBLE) AS domain_confidence, stage, 'v1' AS policy_version, fs_path FROM decided")
def recorded_classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifications of two micro-batches in their snapshot, mirrored onto assets."""
    at = folders.fresh(spark, "classified")
    known = assets(spark, sf_dir).select("asset_id", "fs_path", F.lit("general").alias("domain_label"), F.lit(None).cast("double").alias("domain_confidence"))
    snapshots.merge(known, f"{at}/assets", ["asset_id"])

    def steps(df: DataFrame, number: int) -> None:
        made = classify.cascade(df, LEXICONS, policy="v1").select("asset_id", "label", "confidence", "stage", "policy_version", "stage1_scores", "stage2_scores")
        snapshots.record_classifications(made, f"{at}/classified", f"{at}/assets", stream="classify", batch=number)

    rows = assets(spark, sf_dir).select("asset_id", "text", (F.col("asset_id") % 2).alias("turn"))
    _in_turn(spark, rows, "turn", 2, at, "classify", steps)
    return versions.load(spark, f"{at}/assets").join(versions.load(spark, f"{at}/classified").select("asset_id", "stage", "policy_version"), "asset_id")


@query("""SELECT doc_id AS asset_id, CASE WHEN lang = 'en' THEN 'english' ELSE source END AS topic, 'hybrid' AS decided_by, CASE WHEN lang = 'en' THEN 'v2' ELSE 'v1' END AS policy_version,
  CASE WHEN lang = 'en' THEN TIMESTAMP '2026-01-02' ELSE TIMESTAMP '2026-01-01' END AS updated_at FROM documents""")
def recorded_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic an asset: a later decision takes the place of the first, with its stamps."""
    at = folders.fresh(spark, "topics")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id"), "lang", "source")
    first = snapshots.stamped(d.select("asset_id", F.col("source").alias("topic")), "v1", F.lit("2026-01-01"))
    then = snapshots.stamped(d.filter("lang = 'en'").select("asset_id", F.lit("english").alias("topic")), "v2", F.lit("2026-01-02"))
    for number, rows in enumerate((first, then, then)):
        snapshots.merge(rows, f"{at}/topics", ["asset_id"], stream="topics", batch=min(number, 1))
    return versions.load(spark, f"{at}/topics")


#: Events in four turns by their time; each tenth comes a turn late, each fifth comes once more a turn later.
DELIVERED = """span AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events), own AS (SELECT event_id, epoch_us(ts) AS us, 4 * (epoch_us(ts) - low) // (high - low + 1) + CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END AS turn FROM events, span),
  delivered AS (SELECT * FROM own UNION ALL SELECT event_id, us, turn + 1 FROM own WHERE event_id % 5 = 0), tops AS (SELECT turn, max(us) // 1000 * 1000 - 259200000000 AS mark FROM delivered GROUP BY turn),
  marks AS (SELECT turn, max(mark) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM tops), told AS (SELECT event_id, coalesce(us <= mark, false) AS late FROM delivered JOIN marks USING (turn))"""


@query(f"WITH {DELIVERED} SELECT event_id, 'late' AS outcome, count(*) AS n FROM told WHERE late GROUP BY event_id UNION ALL SELECT DISTINCT event_id, 'taken', CAST(1 AS BIGINT) FROM told WHERE NOT late")
def late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event taken once, three days of delay allowed; what comes later is kept apart."""
    at = folders.fresh(spark, "late")
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = e.agg(F.min(us), F.max(us)).first()
    low, high = low or 0, high or 0
    turn = F.expr(f"4 * (unix_micros(cast(ts as timestamp)) - {low}) div {high - low + 1}") + F.when(F.col("event_id") % 10 == 3, 1).otherwise(0)
    own = e.withColumn("turn", turn)
    rows = own.union(own.filter("event_id % 5 = 0").withColumn("turn", F.col("turn") + 1))
    _in_turn(spark, rows, "turn", 6, at, "once", lambda df, n: late.take_once(df, n, at, key="event_id", delay_s=3 * 86400))
    taken, behind = (spark.read.schema(e.schema).parquet(f"{at}/{x}/*") for x in ("taken", "late"))
    return behind.groupBy("event_id").agg(F.count("*").alias("n")).select("event_id", F.lit("late").alias("outcome"), "n").union(taken.select("event_id", F.lit("taken"), F.lit(1).cast("long")))
