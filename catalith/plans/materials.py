"""Metadata, texts and vectors that the later steps are made from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions import meta, scores, text, tokens, variants
from catalith.operators import dedup, entities, relations, reports, state
from catalith.plans.registry import query
from catalith.session import table
from catalith.sources import folders, versions

#: Metadata as JSON of several shapes: whole, kinds mixed up, broken, absent, sparse.
GIVEN = """given AS (SELECT doc_id AS asset_id, CASE doc_id % 5 WHEN 0 THEN '{"summary": "' || lang || '", "keywords": ["' || source || '", "k", 7], "n": ' || n_chars || '}' WHEN 1 THEN '{"summary": ["a"], "keywords": "' || lang || '", "n": "' || n_chars || '"}'
  WHEN 2 THEN '{"summary": "' || lang WHEN 3 THEN NULL ELSE '{"keywords": [], "n": null, "deep": {"a": [1, 2]}}' END AS json FROM documents), valid AS (SELECT asset_id, CASE WHEN json_valid(json) THEN json END AS json FROM given)"""


def _given(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, said = F.col("doc_id") % 5, F.col("n_chars").cast("string")
    whole = F.concat(F.lit('{"summary": "'), "lang", F.lit('", "keywords": ["'), "source", F.lit('", "k", 7], "n": '), said, F.lit("}"))
    mixed = F.concat(F.lit('{"summary": ["a"], "keywords": "'), "lang", F.lit('", "n": "'), said, F.lit('"}'))
    json = F.when(i == 0, whole).when(i == 1, mixed).when(i == 2, F.concat(F.lit('{"summary": "'), "lang")).when(i == 4, '{"keywords": [], "n": null, "deep": {"a": [1, 2]}}')
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id"), json.alias("json"))


@query(f"""WITH {GIVEN} SELECT asset_id, CASE WHEN json_type(json, '$.summary') = 'VARCHAR' THEN json_extract_string(json, '$.summary') END AS summary, CASE WHEN json_type(json, '$.keywords') = 'ARRAY' THEN array_to_string(json_extract_string(json, '$.keywords[*]'), ',') END AS keywords,
  CASE WHEN json_type(json, '$.keywords') = 'ARRAY' THEN CAST(json_array_length(json, '$.keywords') AS INT) END AS n_keywords, CASE WHEN regexp_full_match(json_extract_string(json, '$.n'), '\\d+') THEN CAST(json_extract_string(json, '$.n') AS INT) ELSE -1 END AS n FROM valid""")
def self_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of an asset's metadata in one row, whatever shape it came in."""
    rows = _given(spark, sf_dir).withColumn("meta", variants.parsed(F.col("json")))
    m = F.col("meta")
    own = rows.select("asset_id", *variants.row(m, ["summary"], ["keywords"]), variants.length(m, "keywords").alias("n_keywords"), variants.whole(m, "n").alias("n"))
    return own.withColumn("keywords", F.array_join("keywords", ","))


@query(f"""WITH {GIVEN}, o AS (SELECT asset_id, CASE WHEN json_type(json) = 'OBJECT' THEN json END AS json FROM valid) SELECT asset_id, 1 AS about, json_array_length(json, '$.keywords') IS NOT NULL AND json_type(json, '$.keywords') = 'ARRAY' AS listed, json_type(json, '$.deep') IS NOT NULL AS deep, FALSE AS summary FROM o""")
def merged_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key set, a key removed; lists and objects keep their kinds."""
    rows = _given(spark, sf_dir).withColumn("meta", variants.merged(variants.parsed(F.col("json")), F.parse_json(F.lit('{"about": []}')), ("summary",)))
    m = F.col("meta")
    has = lambda k, what: F.coalesce(variants.kind(m, k) == what, F.lit(False))
    return rows.select("asset_id", has("about", "array").cast("int").alias("about"), has("keywords", "array").alias("listed"), has("deep", "object").alias("deep"), variants.kind(m, "summary").isNotNull().alias("summary"))


@query("SELECT doc_id AS asset_id, concat_ws(chr(10), CASE WHEN doc_id % 2 = 0 THEN source || '.txt' END, CASE WHEN trim(substring(text, 1, 40)) <> '' THEN substring(text, 1, 40) END) AS scanned FROM documents")
def scan_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("doc_id") % 2 == 0, F.concat("source", F.lit(".txt"))).otherwise(" ")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id"), text.scan_text(name, F.substring("text", 1, 40)).alias("scanned"))


@query("""SELECT doc_id AS asset_id, CASE doc_id % 3 WHEN 0 THEN lang || '|' || source || '|x' WHEN 1 THEN '' ELSE lang END AS about FROM documents""")
def about_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three entries of lists; what is no list has none."""
    i = F.col("doc_id") % 3
    json = F.when(i == 0, F.to_json(F.array("lang", F.lit(" "), "source", F.lit(" x "), F.lit("more")))).when(i == 1, '{"a": 1}').otherwise(F.to_json(F.array("lang")))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id"), F.array_join(meta.about(json), "|").alias("about"))


@query("SELECT vec_id AS asset_id, 80 AS width, CAST(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS DOUBLE) AS total FROM embeddings")
def padded_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = scores.padded(F.col("embedding"), 80)
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("asset_id"), F.size(v).alias("width"), F.round(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double")), 9).alias("total"))


@query("SELECT doc_id AS asset_id, doc_id % 3 = 0 AS described, CAST(CASE WHEN doc_id % 3 = 0 THEN doc_id % 4 ELSE 0 END AS BIGINT) AS n_embeddings FROM documents")
def finalized_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that are extracting give a metadata row and a row for each embedding, which may be none."""
    i = F.col("doc_id")
    one = F.transform(F.filter(F.sequence(F.lit(0), F.lit(2)), lambda k: k < i % 4), lambda k: F.struct(F.lit("st").alias("channel"), k.alias("chunk_index"), F.array(k.cast("float")).alias("embedding")))
    records = table(spark, sf_dir, "documents").select(i.alias("asset_id"), F.when(i % 3 == 0, "extracting").otherwise("routing").alias("status"), F.create_map(F.lit("lang"), "lang").alias("core_meta"), F.create_map(F.lit("source"), "source").alias("ext_meta"), F.array("lang").alias("tags"), one.alias("embeddings"))
    described, vectors = state.finalize(records)
    n = vectors.groupBy("asset_id").agg(F.count("*").alias("n_embeddings"))
    return records.select("asset_id").join(described.select("asset_id", F.lit(True).alias("described")), "asset_id", "left").join(n, "asset_id", "left").select("asset_id", F.coalesce("described", F.lit(False)).alias("described"), F.coalesce("n_embeddings", F.lit(0)).alias("n_embeddings"))


@query("WITH c AS (SELECT doc_id AS asset_id, unnest(range(0, length(text), 1000)) // 1000 AS chunk_index FROM documents) SELECT asset_id, CAST(chunk_index AS INT) AS chunk_index, 'st' AS channel, 64 AS width, 1.0::DOUBLE AS norm FROM c")
def chunk_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with the default embedder: vectors of length 1."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id"), "text")
    made = reports.chunk_and_embed(rows, 1000)
    return made.select("asset_id", "chunk_index", "channel", F.size("embedding").alias("width"), F.round(scores.norm(F.col("embedding")), 4).alias("norm"))


@query("SELECT vec_id AS asset_id, label AS chunk_index, 'st' AS channel FROM embeddings UNION ALL SELECT vec_id, label, 'clip' FROM embeddings WHERE vec_id % 3 <> 0")
def channel_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row in the text channel for each frame, and one in the visual channel for those that have a vector."""
    e = table(spark, sf_dir, "embeddings")
    frames = e.select(F.col("vec_id").alias("asset_id"), F.col("label").alias("chunk_index"), F.lit(" ").alias("summary"), F.array(F.col("label").cast("string")).alias("keywords"), F.array().cast("array<string>").alias("labels"), F.when(F.col("vec_id") % 3 != 0, F.col("embedding")).alias("vector"))
    return reports.paired_channels(frames).select("asset_id", "chunk_index", "channel")


@query("WITH j AS (SELECT o_orderkey AS asset_id, o_orderpriority AS name FROM orders), r AS (SELECT DISTINCT o_orderpriority AS name FROM orders WHERE o_orderpriority < '3') SELECT 'propose' AS mode, name, count(*) FILTER (name IN (SELECT name FROM r)) AS stored, count(*) FILTER (name NOT IN (SELECT name FROM r)) AS proposed FROM j GROUP BY name UNION ALL SELECT 'auto', name, count(*), 0 FROM j GROUP BY name")
def binding_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each mode stores and proposes."""
    judged = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("asset_id"), F.lit("priority").alias("entity_type"), F.col("o_orderpriority").alias("name"), F.col("o_orderpriority").alias("entity_uid"), F.col("o_orderpriority").alias("keyword"))
    registered = judged.filter("name < '3'").select("entity_type", "name", "entity_uid").distinct()
    out = []
    for mode in ("propose", "auto"):
        for what, rows in zip(("stored", "proposed"), entities.bind(judged, registered, mode), strict=True):
            out.append(rows.select(F.lit(mode).alias("mode"), F.col("name"), F.lit(what).alias("what")))
    every = out[0].union(out[1]).union(out[2]).union(out[3])
    return every.groupBy("mode", "name").agg(F.count_if(F.col("what") == "stored").alias("stored"), F.count_if(F.col("what") == "proposed").alias("proposed"))


@query("""WITH a AS (SELECT vec_id AS src, CASE WHEN label IN (1, 2) THEN 'd' || label ELSE 'general' END AS domain, (vec_id * 37) % 100 / 100.0 AS score FROM embeddings)
  SELECT src, domain, CASE WHEN score >= CASE domain WHEN 'd1' THEN 0.2 WHEN 'd2' THEN 0.8 ELSE 0.5 END THEN 'match' ELSE 'no_match' END AS verdict FROM a""")
def domain_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each domain's assets through a pass of its own: candidates, scores, decisions, edges kept."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("src"), F.concat(F.lit("d"), F.col("label").cast("string")).alias("domain_label"), ((F.col("vec_id") * 37) % 100 / 100.0).alias("score"))

    def wired(name: str, threshold: float):
        return lambda own: relations.relation_pass(lambda: own, lambda c: c, lambda s: relations.decide_by_score(s, threshold), lambda d: d.select("src", F.lit(name).alias("domain"), "verdict"))

    return relations.by_domain(e, {"general": wired("general", 0.5), "d1": wired("d1", 0.2), "d2": wired("d2", 0.8)})


@query("""WITH e AS (SELECT vec_id AS asset_id, vec_id // 4 AS doc, embedding FROM embeddings), v AS (SELECT doc, count(*) AS chunk_count, arg_min(embedding, asset_id) AS first FROM e GROUP BY doc)
  SELECT doc_id AS asset_id, chunk_count, CAST(list_sum(list_transform(first, lambda x: CAST(x AS DOUBLE))) AS DOUBLE) AS total, 'topic/' || lang AS labels FROM documents JOIN v ON v.doc = doc_id WHERE doc_id % 10 <> 1""")
def resync_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of assets with vectors: published whole, then those of a second part beside them."""
    d = table(spark, sf_dir, "documents")
    a = d.select(F.col("doc_id").alias("asset_id"), F.when(F.col("doc_id") % 10 == 1, "failed").otherwise("registered").alias("status"))
    labels = d.select(F.col("doc_id").alias("asset_id"), F.lit("topic").alias("skill_code"), F.col("lang").alias("label_code"))
    e = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 4).alias("asset_id"), F.col("vec_id").alias("chunk_index"), "embedding")
    docs, _ = entities.asset_documents(a, labels, e)
    at = folders.fresh(spark, "documents")
    entities.resync(docs.filter("asset_id % 2 = 0"), at)
    entities.resync(docs.filter("asset_id % 2 = 1"), at, append=True)
    total = F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double")), 9)
    return versions.load(spark, at).select("asset_id", "chunk_count", total.alias("total"), F.array_join("labels", ",").alias("labels"))


@query("SELECT doc_id AS asset_id, CAST(len(regexp_extract_all(text, '[^ ]+')) AS INT) AS words, CAST(ceil(length(text) / 3) AS INT) AS threes FROM documents")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokenizers over the same texts."""
    words = tokens.counted(lambda: lambda t: sum(1 for w in t.split(" ") if w))
    threes = tokens.counted(lambda: lambda t: -(-len(t) // 3))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id"), words(F.col("text")).alias("words"), threes(F.col("text")).alias("threes"))


@query()
def long_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a label as one sequence that several tasks walk, at most 40 of which are kept."""
    e = table(spark, sf_dir, "embeddings").select(F.col("label").alias("scene"), "vec_id", F.col("embedding").alias("vector"), F.slice("embedding", 1, 16).alias("third"), scores.difference_bits(F.col("embedding")).alias("bits"))
    return dedup.suppress_long(e, group="scene", order="vec_id", bits="bits", vector="vector", third="third", hash_max=24, near=0.4, grey=0.2, third_near=0.5, cap=40, block_rows=64).select("scene", "vec_id", "kept", "reason")
