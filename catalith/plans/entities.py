"""Entities and what is made of their members."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions import meta
from catalith.operators import entities, reports, state
from catalith.plans.registry import EDGE, membership, query, summaries
from catalith.session import table

SUMMARY = "summary AS (SELECT o_orderkey AS asset_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS summary FROM orders)"
MEMBER = f"{EDGE}, {SUMMARY}, member AS (SELECT DISTINCT entity_type, entity_uid, asset_id, summary FROM edge JOIN summary USING (asset_id) WHERE status = 'active')"
FIRST3 = f"{MEMBER}, ranked AS (SELECT *, row_number() OVER (PARTITION BY entity_type, entity_uid ORDER BY asset_id) AS r FROM member WHERE summary IS NOT NULL), lines AS (SELECT entity_type, entity_uid, list(summary ORDER BY r) AS summaries FROM ranked WHERE r <= 3 GROUP BY ALL)"
BUNDLE = f"{MEMBER}, bundle AS (SELECT entity_type, entity_uid, count(*) AS members FROM (SELECT DISTINCT entity_type, entity_uid, asset_id FROM edge WHERE status = 'active') GROUP BY ALL)"
ENTITY = "entity AS (SELECT p_type AS entity_type, p_partkey AS entity_uid, p_name AS name, CASE WHEN p_size > 25 THEN p_brand END AS description, CASE WHEN p_size % 2 = 0 THEN 'manual' ELSE 'auto' END AS source FROM part)"


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_type").alias("entity_type"), F.col("p_partkey").alias("entity_uid"), F.col("p_name").alias("name"), F.when(F.col("p_size") > 25, F.col("p_brand")).alias("description"), F.when(F.col("p_size") % 2 == 0, "manual").otherwise("auto").alias("source"))


@query(f"WITH {FIRST3} SELECT entity_type, entity_uid, array_to_string(summaries, '|') AS summaries FROM lines")
def member_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.member_summaries(membership(spark, sf_dir), summaries(spark, sf_dir)).select("entity_type", "entity_uid", F.array_join("summaries", "|").alias("summaries"))


@query(f"WITH {FIRST3} SELECT entity_type, entity_uid, array_to_string(summaries, '|') AS summaries FROM lines JOIN part ON p_partkey = entity_uid AND p_type = entity_type WHERE p_size > 25")
def wanted_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of pairs of type and uid; the uid of a wanted pair under another type isn't wanted."""
    named = _entities(spark, sf_dir).filter("description is not null").select("entity_type", "entity_uid")
    wanted = named.union(named.select(F.concat("entity_type", F.lit(" other")), (F.col("entity_uid") + 1)))
    return entities.member_summaries(membership(spark, sf_dir), summaries(spark, sf_dir), wanted).select("entity_type", "entity_uid", F.array_join("summaries", "|").alias("summaries"))


@query(f"WITH {BUNDLE} SELECT entity_type, entity_uid, members FROM bundle ORDER BY members DESC, entity_type, entity_uid LIMIT 10")
def bundle_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.top_bundles(membership(spark, sf_dir))


@query(f"WITH {BUNDLE} SELECT entity_type, entity_uid, members FROM bundle WHERE members >= 25")
def visible_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.bundles(membership(spark, sf_dir), 25)


@query(f"WITH {EDGE}, {ENTITY}, shown AS (SELECT DISTINCT entity_type, entity_uid FROM edge WHERE status = 'active') SELECT entity_type, entity_uid, CASE WHEN source = 'manual' THEN 'manual' ELSE 'automatic' END AS origin FROM entity e WHERE NOT EXISTS (SELECT 1 FROM shown s WHERE s.entity_type = e.entity_type AND s.entity_uid = e.entity_uid)")
def orphan_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.orphans(_entities(spark, sf_dir), membership(spark, sf_dir)).select("entity_type", "entity_uid", "origin")


@query("SELECT url, page_id FROM pages WHERE page_id % 3 <> 0")
def orphan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select(F.lit("page").alias("entity_type"), F.col("page_id").alias("entity_uid"), "url")
    return entities.orphan_documents(p, p.filter("entity_uid % 3 = 0")).select("url", F.col("entity_uid").alias("page_id"))


JUDGED = "judged AS (SELECT p_partkey AS asset_id, p_type AS entity_type, p_name AS name, p_brand AS keyword FROM part)"


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("asset_id"), F.col("p_type").alias("entity_type"), F.col("p_name").alias("name"), F.col("p_brand").alias("keyword"))


@query(f"WITH {JUDGED}, r AS (SELECT * FROM judged WHERE asset_id % 20 <> 0 AND NOT regexp_matches(keyword, '1$')) SELECT asset_id, entity_type, CASE WHEN asset_id % 2 = 0 THEN 'canon ' || name ELSE name END AS name, keyword FROM r")
def resolved_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exclusions, stop patterns, official names and aliases, one after another."""
    j = _judged(spark, sf_dir)
    short = j.select("entity_type", "name", "asset_id")
    # Names repeat in the given table, so each carries its id to stand for a name of its own.
    own = j.withColumn("name", F.concat("name", F.lit("#"), F.col("asset_id").cast("string")))
    key = F.concat("name", F.lit("#"), F.col("asset_id").cast("string"))
    excluded = short.filter("asset_id % 20 = 0").select("entity_type", key.alias("name"))
    official = short.select("entity_type", key.alias("short"), F.concat(F.lit("full "), key).alias("official"))
    alias = short.select("entity_type", F.concat(F.lit("full "), key).alias("alias"), F.when(F.col("asset_id") % 2 == 0, F.concat(F.lit("canon "), "name")).otherwise(F.col("name")).alias("canonical"))
    return entities.resolve_names(entities.apply_rules(own, excluded, ["1$"], official), alias).select("asset_id", "entity_type", "name", "keyword")


WORDS = "words AS (SELECT DISTINCT p_type AS entity_type, split_part(p_name, ' ', 1) AS to_name FROM part)"


@query(f"WITH {JUDGED}, {WORDS} SELECT DISTINCT asset_id, j.entity_type, name AS from_name, to_name FROM judged j JOIN words w ON j.entity_type = w.entity_type AND (' ' || lower(name) || ' ') LIKE ('% ' || lower(to_name) || ' %') AND lower(name) <> lower(to_name)")
def contained_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_type").alias("entity_type"), F.substring_index("p_name", " ", 1).alias("name")).distinct()
    return entities.contained(_judged(spark, sf_dir), p)


@query(f"WITH {JUDGED}, {WORDS}, c AS (SELECT DISTINCT asset_id, j.entity_type, name AS from_name, to_name FROM judged j JOIN words w ON j.entity_type = w.entity_type AND (' ' || lower(name) || ' ') LIKE ('% ' || lower(to_name) || ' %') AND lower(name) <> lower(to_name)) SELECT entity_type, from_name, to_name, count(*) AS assets, min(asset_id) AS sample FROM c GROUP BY ALL")
def contained_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.contained_report(contained_links(spark, sf_dir))


@query("SELECT p_type AS entity_type, p_partkey AS entity_uid, p_partkey % 3 = 0 AS registered FROM part")
def split_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _entities(spark, sf_dir)
    return entities.split_registered(e, e.filter("entity_uid % 3 = 0")).select("entity_type", "entity_uid", "registered")


@query(f"""WITH c AS (SELECT l_orderkey AS asset_id, p_type AS entity_type, p_brand AS name, l_shipmode AS keyword, l_orderkey * 10 + l_linenumber AS ord, p_name || p_type AS example FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode FROM lineitem) JOIN part ON p_partkey = l_partkey),
  t AS (SELECT entity_type, name, count(DISTINCT asset_id) AS assets, substring(arg_min(example, ord), 1, 60) AS example FROM c GROUP BY ALL),
  k AS (SELECT entity_type, name, keyword, min(ord) AS o FROM c GROUP BY ALL), kr AS (SELECT *, row_number() OVER (PARTITION BY entity_type, name ORDER BY o, keyword) AS r FROM k), kw AS (SELECT entity_type, name, string_agg(keyword, ',' ORDER BY r) AS keywords FROM kr WHERE r <= 3 GROUP BY ALL),
  i AS (SELECT entity_type, name, asset_id, min(ord) AS o FROM c GROUP BY ALL), ir AS (SELECT *, row_number() OVER (PARTITION BY entity_type, name ORDER BY o, asset_id) AS r FROM i), ids AS (SELECT entity_type, name, string_agg(CAST(asset_id AS VARCHAR), ',' ORDER BY r) AS asset_ids FROM ir WHERE r <= 3 GROUP BY ALL)
  SELECT t.entity_type, t.name, assets, example, keywords, asset_ids, (SELECT count(*) FROM t) AS total FROM t JOIN kw USING (entity_type, name) JOIN ids USING (entity_type, name) ORDER BY assets DESC, t.entity_type, t.name LIMIT 200""")
def candidate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_name")
    c = table(spark, sf_dir, "lineitem").join(part, F.col("p_partkey") == F.col("l_partkey")).select(F.col("l_orderkey").alias("asset_id"), F.col("p_type").alias("entity_type"), F.col("p_brand").alias("name"), F.concat("l_returnflag", "l_linestatus").alias("keyword"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.concat("p_name", "p_type").alias("example"))
    r = entities.candidate_report(c)
    return r.select("entity_type", "name", "assets", "example", F.array_join("keywords", ",").alias("keywords"), F.array_join(F.col("asset_ids").cast("array<string>"), ",").alias("asset_ids"), "total")


HASHED = f"{FIRST3}, {ENTITY}, hashed AS (SELECT e.entity_type, e.entity_uid, sha256(name || chr(10) || entity_type || coalesce(chr(10) || description, '') || coalesce(chr(10) || array_to_string(summaries, chr(10)), '')) AS material_hash FROM entity e LEFT JOIN lines USING (entity_type, entity_uid))"


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.with_fingerprint(_entities(spark, sf_dir), entities.member_summaries(membership(spark, sf_dir), summaries(spark, sf_dir)))


@query(f"WITH {HASHED} SELECT * FROM hashed")
def material_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(spark, sf_dir).select("entity_type", "entity_uid", "material_hash")


WORK = f"""{HASHED}, sized AS (SELECT entity_type, entity_uid, count(DISTINCT asset_id) AS members FROM edge WHERE status = 'active' GROUP BY ALL), cand AS (SELECT * FROM hashed JOIN sized USING (entity_type, entity_uid)), skills AS (SELECT * FROM (VALUES ('a', 2), ('b', 1)) t(skill_code, skill_version)),
  st AS (SELECT entity_type, entity_uid, 'a' AS skill_code, CASE entity_uid % 6 WHEN 1 THEN NULL WHEN 2 THEN 'x' WHEN 3 THEN 'x' ELSE material_hash END AS h, CASE WHEN entity_uid % 6 IN (3, 4) THEN 1 ELSE 2 END AS v, CASE WHEN entity_uid % 6 = 5 THEN 'p0' ELSE 'p1' END AS p FROM hashed WHERE entity_uid % 5 <> 0),
  due AS (SELECT c.*, k.skill_code, CASE WHEN s.entity_uid IS NULL THEN 'new' WHEN h IS NULL THEN 'hash_null' WHEN CAST(h <> material_hash AS INT) + CAST(v <> skill_version AS INT) + CAST(p <> 'p1' AS INT) > 1 THEN 'mixed' WHEN h <> material_hash THEN 'hash_changed' WHEN v <> skill_version THEN 'skill_version' WHEN p <> 'p1' THEN 'prompt_version' END AS reason
  FROM cand c CROSS JOIN skills k LEFT JOIN st s ON s.entity_type = c.entity_type AND s.entity_uid = c.entity_uid AND s.skill_code = k.skill_code), chosen AS (SELECT DISTINCT entity_type, entity_uid, members FROM due WHERE reason IS NOT NULL ORDER BY members DESC, entity_type, entity_uid LIMIT 100)"""


def _work(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hashed(spark, sf_dir).select("entity_type", "entity_uid", "material_hash")
    cand = h.join(entities.bundles(membership(spark, sf_dir)), ["entity_type", "entity_uid"])
    m = F.col("entity_uid") % 6
    st = h.filter("entity_uid % 5 <> 0").select("entity_type", "entity_uid", F.lit("a").alias("skill_code"), F.when(m == 1, F.lit(None)).when(m.isin(2, 3), "x").otherwise(F.col("material_hash")).alias("material_hash"), F.when(m.isin(3, 4), 1).otherwise(2).alias("skill_version"), F.when(m == 5, "p0").otherwise("p1").alias("prompt_version"))
    skills = spark.createDataFrame([("a", 2), ("b", 1)], "skill_code string, skill_version int")
    return entities.label_work(cand, skills, st, "p1", 100)


@query(f"WITH {WORK} SELECT d.entity_type, d.entity_uid, d.skill_code, d.reason FROM due d JOIN chosen USING (entity_type, entity_uid) WHERE reason IS NOT NULL")
def label_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _work(spark, sf_dir)


@query(f"WITH {WORK} SELECT skill_code, reason, count(*) AS due, count(*) FILTER (entity_uid % 4 <> 0) AS judged, count(*) FILTER (entity_uid % 4 IN (1, 3)) AS labelled, count(*) FILTER (entity_uid % 4 = 2) AS unassigned FROM (SELECT d.* FROM due d JOIN chosen USING (entity_type, entity_uid) WHERE reason IS NOT NULL) GROUP BY skill_code, reason")
def entity_label_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _work(spark, sf_dir)
    judged = w.filter("entity_uid % 4 <> 0").select("entity_type", "entity_uid", "skill_code", F.when(F.col("entity_uid") % 4 == 2, "unassigned").otherwise("x").alias("label_code"))
    return reports.entity_label_report(w, judged)


@query(f"WITH {HASHED}, n AS (SELECT entity_uid, CASE WHEN entity_uid % 10 = 0 THEN 'created' WHEN entity_uid % 10 = 1 THEN 'updated' ELSE 'reused' END AS action FROM hashed) SELECT count(*) FILTER (action = 'created') AS created, count(*) FILTER (action = 'updated') AS updated, count(*) FILTER (action = 'reused') AS reused, CAST(1 AS BIGINT) AS purged, round(count(*) FILTER (action = 'reused') / count(*), 6) AS reuse_rate FROM n")
def embedding_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hashed(spark, sf_dir).select("entity_type", "entity_uid", "material_hash")
    stored = h.filter("entity_uid % 10 <> 0").withColumn("material_hash", F.when(F.col("entity_uid") % 10 == 1, "x").otherwise(F.col("material_hash")))
    gone = spark.createDataFrame([("gone", -1, "x")], "entity_type string, entity_uid long, material_hash string")
    return entities.reuse_rate(entities.embedding_upkeep(h, stored.unionByName(gone)))


KEYWORDS = f"{EDGE}, kw AS (SELECT entity_type, entity_uid, o_orderpriority AS keyword, count(*) AS n FROM edge JOIN orders ON o_orderkey = asset_id WHERE status = 'active' GROUP BY ALL), kr AS (SELECT *, row_number() OVER (PARTITION BY entity_type, entity_uid ORDER BY n DESC, keyword) AS r FROM kw), kws AS (SELECT entity_type, entity_uid, string_agg(keyword, ',' ORDER BY r) AS keywords FROM kr WHERE r <= 2 GROUP BY ALL)"


def _keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("asset_id"), F.col("o_orderpriority").alias("keyword"))
    return entities.member_keywords(membership(spark, sf_dir).filter("status = 'active'").join(o, "asset_id"), 2)


@query(f"WITH {KEYWORDS} SELECT * FROM kws")
def member_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keywords(spark, sf_dir).select("entity_type", "entity_uid", F.array_join("keywords", ",").alias("keywords"))


@query(f"WITH {FIRST3}, {ENTITY}, {KEYWORDS.replace(EDGE + ', ', '')} SELECT e.entity_type, e.entity_uid, name, coalesce(array_to_string(summaries, '|'), '') AS summaries, coalesce(keywords, '') AS keywords FROM entity e LEFT JOIN lines USING (entity_type, entity_uid) LEFT JOIN kws USING (entity_type, entity_uid) WHERE e.entity_uid % 4 <> 0")
def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _entities(spark, sf_dir)
    docs, _ = entities.index_documents(e, e.filter("entity_uid % 4 <> 0").select("entity_type", "entity_uid", F.array(F.lit(1.0)).alias("vector")), entities.member_summaries(membership(spark, sf_dir), summaries(spark, sf_dir)), _keywords(spark, sf_dir))
    return docs.select("entity_type", "entity_uid", "name", F.array_join("summaries", "|").alias("summaries"), F.array_join("keywords", ",").alias("keywords"))


@query(f"WITH {BUNDLE} SELECT entity_type, entity_uid, members, CASE WHEN entity_uid % 3 = 0 THEN 'missing' ELSE 'members_changed' END AS reason FROM bundle WHERE entity_uid % 3 <= 1")
def describe_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = entities.bundles(membership(spark, sf_dir))
    m = F.col("entity_uid") % 3
    stored = b.select("entity_type", "entity_uid", F.when(m == 0, " ").otherwise("d").alias("description"), F.when(m == 1, F.col("members") + 1).otherwise(F.col("members")).alias("member_count"))
    return reports.describe_targets(b, stored)


def _due(spark: SparkSession, sf_dir: str, most: int | None = None) -> DataFrame:
    b = entities.bundles(membership(spark, sf_dir))
    m = F.col("entity_uid") % 3
    stored = b.select("entity_type", "entity_uid", F.when(m == 0, " ").otherwise("d").alias("description"), F.when(m == 1, F.col("members") + 1).otherwise(F.col("members")).alias("member_count"))
    return reports.describe_targets(b, stored, most)


DUE = f"{FIRST3}, bundle AS (SELECT entity_type, entity_uid, count(DISTINCT asset_id) AS members FROM edge WHERE status = 'active' GROUP BY ALL), due AS (SELECT entity_type, entity_uid, members, CASE WHEN entity_uid % 3 = 0 THEN 'missing' ELSE 'members_changed' END AS reason FROM bundle WHERE entity_uid % 3 <= 1)"


@query(f"WITH {DUE} SELECT * FROM due ORDER BY members DESC, entity_type, entity_uid LIMIT 100")
def describe_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred largest entities whose description is due."""
    return _due(spark, sf_dir, 100)


@query(f"WITH {DUE}, d AS (SELECT entity_type, entity_uid, length(CAST(entity_uid AS VARCHAR) || ': ' || array_to_string(summaries, '; ')) AS n FROM due JOIN lines USING (entity_type, entity_uid)) SELECT reason, count(*) AS targets, count(n) AS described, count(*) FILTER (n > 60) AS over_length FROM due LEFT JOIN d USING (entity_type, entity_uid) GROUP BY reason")
def describe_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = _due(spark, sf_dir)
    return reports.describe_report(due, reports.described(due, entities.member_summaries(membership(spark, sf_dir), summaries(spark, sf_dir))))


@query(f"WITH {EDGE}, e AS (SELECT DISTINCT asset_id, entity_type, entity_uid FROM edge) SELECT asset_id, count(*) AS n FROM (SELECT * FROM e WHERE asset_id % 4 <> 0 UNION ALL SELECT DISTINCT asset_id, 'one', CAST(1 AS BIGINT) FROM e WHERE asset_id % 4 = 0) GROUP BY asset_id")
def edge_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = membership(spark, sf_dir).select("asset_id", "entity_type", "entity_uid").distinct()
    new = e.filter("asset_id % 4 = 0").select("asset_id", F.lit("one").alias("entity_type"), F.lit(1).cast("long").alias("entity_uid")).distinct()
    return state.replace_partition(e, new, ["asset_id"]).groupBy("asset_id").agg(F.count("*").alias("n"))


@query(f"WITH {EDGE}, o AS (SELECT DISTINCT asset_id, entity_type, entity_uid FROM edge WHERE status = 'active'), n AS (SELECT * FROM o WHERE entity_uid % 2 = 0), j AS (SELECT DISTINCT o_orderkey AS asset_id FROM orders), p AS (SELECT j.asset_id, (SELECT count(*) FROM o WHERE o.asset_id = j.asset_id) AS a, (SELECT count(*) FROM n WHERE n.asset_id = j.asset_id) AS b FROM j) SELECT CAST(0 AS BIGINT) AS added, CAST(sum(a - b) AS BIGINT) AS removed, count(*) FILTER (b > 0) AS bound, count(*) FILTER (b = 0) AS empty, count(*) FILTER (b < a AND b > 0) AS shrunk FROM p")
def binding_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = membership(spark, sf_dir).filter("status = 'active'").select("asset_id", "entity_type", "entity_uid").distinct()
    return entities.binding_report(o, o.filter("entity_uid % 2 = 0"), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("asset_id")))


@query(f"WITH {EDGE}, a AS (SELECT DISTINCT asset_id, entity_type, entity_uid, o_orderpriority < '2' AS early FROM edge JOIN orders ON o_orderkey = asset_id WHERE status = 'active' AND o_orderstatus = 'P'), o AS (SELECT DISTINCT entity_type, entity_uid FROM a WHERE early) SELECT entity_type, entity_uid, count(*) AS assets FROM a ANTI JOIN o USING (entity_type, entity_uid) WHERE NOT early GROUP BY entity_type, entity_uid")
def new_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders under way were bound before; the others' parts that none of these has are new."""
    under_way = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("asset_id"), (F.col("o_orderpriority") < "2").alias("early"))
    m = membership(spark, sf_dir).filter("status = 'active'").join(under_way, "asset_id")
    return entities.new_entities(m.filter("early"), m.filter("not early"))


@query("SELECT p_partkey AS entity_uid, p_brand || '+' || p_type AS prompt_version, p_partkey % 2 <> 0 AS malformed FROM part")
def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.when(F.col("p_partkey") % 2 == 0, "0123abcd-0000-7000-8000-0123456789ab").otherwise("not-an-id")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entity_uid"), meta.composite_version(F.col("p_brand"), F.col("p_type")).alias("prompt_version"), meta.malformed(u).alias("malformed"))
