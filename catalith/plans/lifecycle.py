"""Status, failures and retries, as batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.operators import classify, dedup, reports, state
from catalith.plans.registry import ASSET, LINEAGE, assets, lineage, query
from catalith.session import table
from catalith.sources import folders
from catalith.streaming import passes

LEGAL = "(" + " OR ".join(f"(previous = '{a}' AND state = '{b}')" for a, b in state.MOVES) + ")"


@query(f"WITH {LINEAGE} SELECT asset_id, count(*) FILTER (state = 'failed') AS failures, count(*) FILTER (state IN ('failed', 'reset')) AS attempts FROM lineage GROUP BY asset_id")
def failure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.failure_counts(lineage(spark, sf_dir))


@query(f"WITH {LINEAGE}, p AS (SELECT *, lag(state) OVER (PARTITION BY asset_id ORDER BY ts, event_id) AS previous FROM lineage) SELECT event_id, asset_id, previous, state FROM p WHERE NOT CASE WHEN previous IS NULL THEN state = 'received' ELSE {LEGAL} END")
def illegal_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.transitions(lineage(spark, sf_dir)).filter("not legal").select("event_id", "asset_id", "previous", "state")


@query(f"WITH {LINEAGE}, p AS (SELECT *, lag(state) OVER (PARTITION BY asset_id ORDER BY ts, event_id) AS previous FROM lineage) SELECT event_id, row_number() OVER (PARTITION BY asset_id, previous ORDER BY ts, event_id) = 1 AS won FROM p")
def first_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.claims(state.transitions(lineage(spark, sf_dir))).select("event_id", "won")


@query(f"WITH {LINEAGE} SELECT state, 'ingest.' || state || '.v1' AS activity, count(*) AS n FROM lineage GROUP BY state")
def lineage_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage(spark, sf_dir).groupBy("state").agg(F.count("*").alias("n")).withColumn("activity", state.activity(F.col("state")))


@query(f"WITH {LINEAGE}, f AS (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY ts, event_id) AS n FROM lineage WHERE state = 'failed') SELECT event_id, asset_id, n, CASE WHEN n >= 3 THEN 'failed' ELSE 'retry' END AS action FROM f")
def capped_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.capped_failures(lineage(spark, sf_dir), 3).select("event_id", "asset_id", "n", "action")


@query(f"WITH {ASSET} SELECT asset_id FROM asset WHERE status = 'received' ORDER BY created_at, asset_id LIMIT 50")
def fifo_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.received_batch(assets(spark, sf_dir).select("asset_id", "status", "created_at"), 50).select("asset_id")


STUCK = f"{LINEAGE}, last AS (SELECT asset_id, max(ts) AS updated_at, arg_max(state, (ts, event_id)) AS status FROM lineage GROUP BY asset_id), moment AS (SELECT max(ts) AS now FROM lineage), stuck AS (SELECT asset_id, updated_at FROM last, moment WHERE status IN ('routing', 'classifying', 'extracting') AND updated_at < now - INTERVAL 60 SECOND)"


def _stuck(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = lineage(spark, sf_dir)
    last = e.groupBy("asset_id").agg(F.max("ts").alias("updated_at"), F.max_by("state", F.struct("ts", "event_id")).alias("status"))
    now = e.agg(F.max("ts").alias("now"))
    return state.stuck(last.join(F.broadcast(now)), F.col("now"), 60)


@query(f"WITH {STUCK} SELECT asset_id, updated_at FROM stuck")
def stuck_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stuck(spark, sf_dir).select("asset_id", "updated_at")


RESET_SQL = f"WITH {STUCK}, n AS (SELECT asset_id, count(*) FILTER (state IN ('failed', 'reset')) AS attempts FROM lineage GROUP BY asset_id) SELECT s.asset_id, coalesce(attempts, 0) AS attempts, CASE WHEN coalesce(attempts, 0) >= 12 THEN 'failed' ELSE 'received' END AS status, CASE WHEN coalesce(attempts, 0) >= 12 THEN 'reset_cap_exceeded' END AS status_reason, coalesce(attempts, 0) < 12 AS reset_event FROM stuck s LEFT JOIN n USING (asset_id)"


@query(RESET_SQL)
def reset_stuck(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.reset_stuck(_stuck(spark, sf_dir), lineage(spark, sf_dir), 12)


@query(f"""WITH {STUCK}, n AS (SELECT asset_id, count(*) FILTER (state IN ('failed', 'reset')) AS attempts, count(*) FILTER (state = 'failed') AS failures, min(ts) AS created_at FROM lineage GROUP BY asset_id),
  r AS (SELECT asset_id, CASE WHEN attempts >= 12 THEN 'reset_isolated' ELSE 'reset' END AS outcome FROM stuck JOIN n USING (asset_id)), picked AS (SELECT l.asset_id FROM last l JOIN n USING (asset_id) LEFT JOIN r USING (asset_id) WHERE coalesce(CASE r.outcome WHEN 'reset' THEN 'received' WHEN 'reset_isolated' THEN 'failed' END, l.status) = 'received' ORDER BY created_at, l.asset_id LIMIT 40),
  p AS (SELECT asset_id, CASE WHEN asset_id % 11 = 0 THEN 'skipped' WHEN asset_id % 3 = 0 THEN CASE WHEN failures + 1 >= 12 THEN 'failed_terminal' ELSE 'failed_retry' END WHEN asset_id % 5 = 0 THEN 'deferred' ELSE 'registered' END AS outcome FROM picked JOIN n USING (asset_id)) SELECT * FROM r UNION ALL SELECT * FROM p""")
def batch_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of assets in a pass: resets first, then the forty oldest received ones."""
    e = lineage(spark, sf_dir)
    last = e.groupBy("asset_id").agg(F.max("ts").alias("updated_at"), F.min("ts").alias("created_at"), F.max_by("state", F.struct("ts", "event_id")).alias("status"))
    now = F.lit(e.agg(F.max("ts")).first()[0]).cast("timestamp")
    i = F.col("asset_id")
    outcome = F.when(i % 3 == 0, "failed").when(i % 5 == 0, "deferred").otherwise("registered")
    return passes.run(last, e, lambda picked: picked.filter(i % 11 != 0).select("asset_id", outcome.alias("outcome"), F.lit("x").alias("reason")), now, limit=40, cap=12, older_than_s=60).told


@query(f"WITH {ASSET} SELECT count(*) FILTER (status = 'registered') AS registered, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'deferred') AS deferred, count(*) FILTER (status = 'received') AS received, CAST(0 AS BIGINT) AS lost_race FROM asset")
def outcome_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.outcome_report(assets(spark, sf_dir).select("status"), ["registered", "failed", "deferred", "received", "lost_race"], "status")


RESOLUTION = f"{ASSET}, res AS (SELECT asset_id, CASE asset_id % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'resolved' ELSE 'isolated' END AS status, CAST(asset_id % 3 AS INT) AS attempts, 'x' AS last_reason FROM asset WHERE asset_id % 3 <> 0)"


def _resolution(a: DataFrame) -> DataFrame:
    m = F.col("asset_id") % 4
    return a.filter("asset_id % 3 <> 0").select("asset_id", F.when(m == 0, "pending").when(m == 1, "resolved").otherwise("isolated").alias("status"), (F.col("asset_id") % 3).cast("int").alias("attempts"), F.lit("x").alias("last_reason"))


@query(f"WITH {RESOLUTION} SELECT a.asset_id, coalesce(r.attempts, 0) AS attempts FROM asset a LEFT JOIN res r USING (asset_id) WHERE a.status = 'registered' AND (r.status IS NULL OR r.status = 'pending')")
def retry_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assets(spark, sf_dir).select("asset_id", "status", "created_at")
    return state.unresolved(a, _resolution(a)).select("asset_id", "attempts")


@query(f"""WITH {RESOLUTION}, out AS (SELECT asset_id, CAST(asset_id % 2 AS INT) AS edges, CASE WHEN asset_id % 7 = 0 THEN 'TimeoutError' END AS error FROM asset WHERE asset_id % 5 = 0)
  SELECT coalesce(r.asset_id, o.asset_id) AS asset_id, CASE WHEN o.asset_id IS NULL THEN r.status WHEN error IS NOT NULL THEN CASE WHEN coalesce(attempts, 0) + 1 >= 3 THEN 'failed' ELSE 'pending' END WHEN edges > 0 THEN 'resolved' ELSE 'isolated' END AS status,
  coalesce(attempts, 0) + CASE WHEN error IS NOT NULL THEN 1 ELSE 0 END AS attempts, CASE WHEN o.asset_id IS NULL THEN last_reason WHEN error IS NOT NULL THEN error WHEN edges > 0 THEN NULL ELSE 'no_edges' END AS last_reason FROM res r FULL JOIN out o ON r.asset_id = o.asset_id""")
def resolution_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assets(spark, sf_dir).select("asset_id", "status")
    out = a.filter("asset_id % 5 = 0").select("asset_id", (F.col("asset_id") % 2).cast("int").alias("edges"), F.when(F.col("asset_id") % 7 == 0, "TimeoutError").alias("error"))
    return state.resolve(_resolution(a), out, 3)


@query("SELECT CASE o_orderstatus WHEN 'F' THEN 'ValueError' ELSE 'TimeoutError' END AS reason, count(*) AS n FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1")
def failure_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    error = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("ValueError: order "), F.col("o_orderkey").cast("string"))).when(F.col("o_orderstatus") != "O", "TimeoutError")
    return classify.failure_histogram(o.select(error.alias("error")))


@query("""WITH t AS (SELECT doc_id AS asset_id, lang, doc_id % 4 AS m FROM documents), u AS (SELECT asset_id, CASE WHEN asset_id % 9 = 0 THEN 'failed' WHEN asset_id % 9 = 1 THEN 'skipped' ELSE 'ok' END AS outcome FROM t WHERE asset_id % 2 = 0)
  SELECT t.asset_id, CASE WHEN outcome = 'ok' THEN 'new' ELSE lang END AS summary, CASE WHEN outcome = 'ok' THEN NULL ELSE 'yes' END AS title_only FROM t LEFT JOIN u USING (asset_id)""")
def reprocess_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id"), F.create_map(F.lit("summary"), "lang", F.lit("title_only"), F.lit("yes")).alias("ext_meta"))
    m = F.col("asset_id") % 9
    u = d.filter("asset_id % 2 = 0").select("asset_id", F.create_map(F.lit("summary"), F.when(m == 1, " ").otherwise("new")).alias("ext_meta"), F.when(m == 0, "ValueError").alias("error"))
    out, _ = reports.reprocess(d, u)
    return out.select("asset_id", F.try_element_at("ext_meta", F.lit("summary")).alias("summary"), F.try_element_at("ext_meta", F.lit("title_only")).alias("title_only"))


OUTCOMES = """u AS (SELECT doc_id AS asset_id, lang AS title_match, source AS modality, CASE WHEN doc_id % 9 = 0 THEN 'failed' WHEN doc_id % 9 = 1 THEN 'skipped' WHEN n_chars > 3000 THEN 'index_failed' ELSE 'ok' END AS outcome FROM documents)"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index takes no document of over 3000 characters here."""
    m = F.col("doc_id") % 9
    d = table(spark, sf_dir, "documents")
    rows = d.select(F.col("doc_id").alias("asset_id"), F.when(m == 0, "failed").when(m == 1, "skipped").otherwise("ok").alias("outcome"), F.col("lang").alias("title_match"), F.col("source").alias("modality"))
    return reports.with_index(rows, d.filter("n_chars > 3000").select(F.col("doc_id").alias("asset_id")))


@query(f"WITH {OUTCOMES} SELECT asset_id, outcome, title_match, modality, count(*) OVER (PARTITION BY outcome, title_match, modality) AS n FROM u")
def reprocess_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.reprocess_report(_outcomes(spark, sf_dir))


@query(f"WITH {OUTCOMES} SELECT CAST(asset_id AS VARCHAR) AS value FROM u WHERE outcome IN ('failed', 'index_failed')")
def failed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as lines and read again, as the next run does."""
    at = folders.fresh(spark, "failed")
    reports.failed_ids(_outcomes(spark, sf_dir)).write.text(at)
    return spark.read.text(at)


@query("SELECT doc_id AS asset_id FROM documents WHERE doc_id % 4 IN (0, 2) AND doc_id % 10 = 0 AND source <> 'src3' AND doc_id % 3 <> 0")
def reprocess_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assets(spark, sf_dir).select("asset_id", "status", "modality", F.col("lang").alias("title"), F.col("source").alias("name"), F.when(F.col("asset_id") % 3 == 0, F.create_map(F.lit("about"), F.lit("[]"))).otherwise(F.create_map().cast("map<string,string>")).alias("ext_meta"))
    names = spark.createDataFrame([("src3",)], "name string")
    return reports.reprocess_targets(a, modalities=("text", "image"), resume_key="about", excluded_names=names).select("asset_id")


@query("SELECT lang, count(*) AS n, min(n_chars) AS least, max(n_chars) AS greatest, list_sort(list(n_chars))[CAST(count(*) // 2 AS INT) + 1] AS median FROM documents GROUP BY lang")
def material_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.upper_median(table(spark, sf_dir, "documents"), "n_chars", ["lang"])


@query("SELECT count(*) AS n, min(value) AS least, max(value) AS greatest, list_sort(list(value))[CAST(count(*) // 2 AS INT) + 1] AS median FROM events WHERE value IS NOT NULL")
def overall_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.upper_median(table(spark, sf_dir, "events"), "value")


BITS = "xor(CAST(CAST('0x' || substring(md5(lang || (doc_id % 50)), 1, 8) AS UBIGINT) AS BIGINT), CAST(doc_id % 4 AS BIGINT))"


@query(f"WITH f AS (SELECT doc_id, {BITS} AS bits FROM documents), r AS (SELECT bits, min(doc_id) AS doc_id FROM f GROUP BY bits) SELECT a.doc_id AS a, b.doc_id AS b, CAST(bit_count(xor(a.bits, b.bits)) AS INT) AS distance FROM r a JOIN r b ON a.doc_id < b.doc_id AND bit_count(xor(a.bits, b.bits)) <= 2")
def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.close_pairs(_frames(spark, sf_dir), key="doc_id", bits="bits", most=2)


@query(f"WITH f AS (SELECT doc_id, {BITS} AS bits FROM documents) SELECT doc_id, min(doc_id) OVER (PARTITION BY bits) AS representative FROM f")
def hamming_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.fingerprint_classes(_frames(spark, sf_dir), key="doc_id", bits="bits")


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.conv(F.substring(F.md5(F.concat("lang", (F.col("doc_id") % 50).cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", "source", h.bitwiseXOR((F.col("doc_id") % 4).cast("long")).alias("bits"))


@query()
def sequence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of neighbouring ids stand for the frames of a scene; fingerprints compare neighbouring components."""
    from catalith.functions.scores import difference_bits

    e = table(spark, sf_dir, "embeddings").select((F.col("vec_id") / 40).cast("int").alias("scene"), "vec_id", F.col("embedding").alias("vector"), F.slice("embedding", 1, 16).alias("third"), difference_bits(F.col("embedding")).alias("bits"))
    return dedup.suppress_sequence(e, group="scene", order="vec_id", bits="bits", vector="vector", third="third", hash_max=24, near=0.4, grey=0.2, third_near=0.5).select("scene", "vec_id", "kept", "reason")
