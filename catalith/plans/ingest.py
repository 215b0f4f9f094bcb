"""Inputs, duplicates, text and classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions import meta, text
from catalith.operators import classify, dedup, reports, state, topics
from catalith.plans.registry import ASSET, assets, query
from catalith.session import table
from catalith.sources import folders, inputs

#: Terms that occur in the given texts, for two labels; some stand within others.
LEXICONS = {
    "en": ["the", "and", "of", "that", "of the", "and the", "in the", "to", "in", "is", "it", "was", "for", "with", "this", "be", "are", "on", "the of", "that the"],
    "fr": ["le", "la", "des", "une", "de", "de la", "que", "qui", "dans", "pour", "les", "est", "sur", "pas", "avec", "la que", "le de", "et", "un", "du"],
}


def _n(terms: list[str]) -> str:
    # Every character between words is doubled, so a hit that takes one leaves one for the next.
    every = "|".join(t.replace(" ", "  ") for t in sorted(terms, key=lambda t: (-len(t), t)))
    return f"CAST(len(list_distinct(regexp_extract_all(low, '(?:^|[^\\p{{L}}\\p{{N}}_])({every})(?:$|[^\\p{{L}}\\p{{N}}_])', 1))) AS INT)"


COUNTED = f"{ASSET}, counted AS (SELECT *, {_n(LEXICONS['en'])} AS n_en, {_n(LEXICONS['fr'])} AS n_fr FROM (SELECT *, regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_]', '\\0\\0', 'g') AS low FROM asset))"
LABELLED = COUNTED + """, labelled AS (SELECT *, greatest(n_en, n_fr) AS top, least(n_en, n_fr) AS second FROM counted),
  decided AS (SELECT *, CASE WHEN top = 0 THEN 'general' WHEN top >= 2 AND top - second >= 1 THEN CASE WHEN n_en >= n_fr THEN 'en' ELSE 'fr' END ELSE 'review' END AS label,
  CASE WHEN top = 0 THEN 0.7 WHEN top >= 2 AND top - second >= 1 THEN 0.9 ELSE 0.0 END AS confidence, CASE WHEN top = 0 OR (top >= 2 AND top - second >= 1) THEN 2 ELSE 3 END AS stage FROM labelled)"""


@query(f"WITH {ASSET}, u AS (SELECT fs_path AS path, 0 AS source, asset_id AS pos FROM asset WHERE lang = 'en' UNION ALL SELECT fs_path, 1, asset_id FROM asset WHERE source = 'src0' UNION ALL SELECT fs_path, 2, asset_id FROM asset WHERE asset_id % 10 = 0) SELECT path, CAST(min(source) AS INT) AS source, arg_min(pos, source) AS pos FROM u GROUP BY path")
def collect_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assets(spark, sf_dir).select(F.col("fs_path").alias("path"), F.col("asset_id").alias("pos"), "lang", F.col("source").alias("src"))
    return inputs.collect_inputs(a.filter("lang = 'en'"), a.filter("src = 'src0'"), a.filter("pos % 10 = 0"))


ROUTED = f"""{ASSET}, f AS (SELECT asset_id, file_hash, CASE asset_id % 7 WHEN 0 THEN '/in/' || asset_id || '.PDF' WHEN 1 THEN '/in/' || asset_id || '.mp3' WHEN 2 THEN '/in/' || asset_id || '/Manifest.JSON'
  WHEN 3 THEN '/in/' || asset_id || '_manifest.json' WHEN 4 THEN '/in/' || asset_id || '.xyz' WHEN 5 THEN '/in/' || asset_id || '.docx' ELSE '/in/' || asset_id || '.png' END AS path, asset_id % 11 <> 0 AS present FROM asset),
  k AS (SELECT *, CASE asset_id % 7 WHEN 0 THEN 'pdf' WHEN 1 THEN 'audio' WHEN 2 THEN 'json' WHEN 3 THEN 'json' WHEN 4 THEN 'unknown' WHEN 5 THEN 'word' ELSE 'image' END AS kind FROM f),
  r AS (SELECT *, CASE kind WHEN 'audio' THEN 'audio' WHEN 'image' THEN 'image' WHEN 'unknown' THEN 'unknown' ELSE 'text' END AS modality,
  CASE WHEN NOT present THEN 'missing' WHEN asset_id % 7 = 2 THEN 'ledger_file' WHEN kind = 'unknown' THEN 'unknown_modality' END AS reason FROM k)"""


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("asset_id").cast("string")
    m = F.col("asset_id") % 7
    ends = {0: ".PDF", 1: ".mp3", 2: "/Manifest.JSON", 3: "_manifest.json", 4: ".xyz", 5: ".docx", 6: ".png"}
    path = F.concat(F.lit("/in/"), i, F.element_at(F.create_map(*[F.lit(x) for kv in ends.items() for x in kv]), m.cast("int")))
    return inputs.route(assets(spark, sf_dir).select("asset_id", "file_hash", path.alias("path"), (F.col("asset_id") % 11 != 0).alias("present")))


@query(f"WITH {ROUTED} SELECT path, kind, modality, reason, reason IS NULL AS routable FROM r")
def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).select("path", "kind", "modality", "reason", "routable")


@query(f"WITH {ROUTED}, held AS (SELECT file_hash, min(asset_id) AS of FROM asset WHERE status IN ('registered', 'deferred') GROUP BY file_hash) SELECT path, CASE WHEN reason IN ('missing', 'ledger_file') THEN reason WHEN of IS NOT NULL THEN 'duplicate:' || of ELSE 'collected' END AS outcome FROM r LEFT JOIN held USING (file_hash)")
def collect_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.collect_outcome(_routed(spark, sf_dir), assets(spark, sf_dir)).select("path", "outcome")


@query(f"WITH {ASSET} SELECT a.asset_id, a.fs_path FROM asset a WHERE NOT EXISTS (SELECT 1 FROM asset b WHERE b.fs_path = a.fs_path AND b.status = 'received')")
def same_path_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assets(spark, sf_dir).select("asset_id", "fs_path", "status")
    return inputs.in_flight(a.select("asset_id", "fs_path"), a).select("asset_id", "fs_path")


@query(f"WITH {ASSET} SELECT sha256(fs_path || chr(31) || file_hash) AS asset_id, modality, fs_path, file_hash, file_size, 'general' AS domain_label, 'received' AS status FROM asset")
def create_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.create_assets(assets(spark, sf_dir))


@query(f"WITH {ASSET} SELECT asset_id, fs_path AS src, '/archive/' || strftime(DATE '2026-01-01' + CAST(asset_id % 28 AS INT), '%Y%m%d') || '/' || asset_id || '__' || asset_id || '.txt' AS dest FROM asset WHERE fs_path LIKE '/inbox/src1/%'")
def archive_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assets(spark, sf_dir).withColumn("created_at", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("asset_id") % 28).cast("int")))
    return inputs.archive_plan(a, "/inbox/src1/", "/archive")


@query(f"""WITH {ASSET}, f AS (SELECT asset_id, source AS folder, CASE WHEN asset_id % 7 = 0 THEN lang || '_' || (asset_id % 5 + 1) ELSE lang END AS stem FROM asset),
  taken AS (SELECT DISTINCT folder, unnest(['en', 'en_2', 'fr_3']) AS stem FROM f), ranked AS (SELECT *, row_number() OVER (PARTITION BY folder, stem ORDER BY asset_id) AS r FROM f),
  kept AS (SELECT * FROM ranked WHERE r = 1 AND (folder, stem) NOT IN (SELECT (folder, stem) FROM taken)),
  rest AS (SELECT *, row_number() OVER (PARTITION BY folder, stem ORDER BY asset_id) AS k FROM f WHERE asset_id NOT IN (SELECT asset_id FROM kept)),
  used AS (SELECT folder, regexp_extract(stem, '^(.*)_([1-9][0-9]*)$', 1) AS stem, CAST(regexp_extract(stem, '^(.*)_([1-9][0-9]*)$', 2) AS BIGINT) AS n FROM (SELECT folder, stem FROM f UNION SELECT * FROM taken) WHERE regexp_matches(stem, '_[1-9][0-9]*$')),
  free AS (SELECT g.folder, g.stem, t.n, row_number() OVER (PARTITION BY g.folder, g.stem ORDER BY t.n) AS k FROM (SELECT folder, stem, max(k) AS most FROM rest GROUP BY ALL) g, LATERAL (SELECT unnest(range(1, g.most + 20)) AS n) t ANTI JOIN used u ON u.folder = g.folder AND u.stem = g.stem AND u.n = t.n)
  SELECT asset_id, folder, stem || '.txt' AS dest_name FROM kept UNION ALL SELECT r.asset_id, r.folder, r.stem || '_' || free.n || '.txt' FROM rest r JOIN free ON free.folder = r.folder AND free.stem = r.stem AND free.k = r.k""")
def collision_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of which some are numbered already, and three that every folder has."""
    i = F.col("asset_id")
    stem = F.when(i % 7 == 0, F.concat("lang", F.lit("_"), (i % 5 + 1).cast("string"))).otherwise(F.col("lang"))
    a = assets(spark, sf_dir).select("asset_id", F.col("source").alias("folder"), F.concat(stem, F.lit(".txt")).alias("name"))
    taken = a.select("folder").distinct().select("folder", F.explode(F.array(F.lit("en.txt"), F.lit("en_2.txt"), F.lit("fr_3.txt"))).alias("name"))
    return inputs.numbered(a, taken).select("asset_id", "folder", "dest_name")


@query(f"WITH {ASSET} SELECT fs_path AS path, row_number() OVER (ORDER BY asset_id, fs_path) - 1 AS pos FROM asset")
def listed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths written as a list of several files come back in the order they stand in."""
    at = folders.fresh(spark, "list")
    a = assets(spark, sf_dir).select("asset_id", "fs_path")
    a.repartitionByRange("asset_id", "fs_path").sortWithinPartitions("asset_id", "fs_path").select(F.concat(F.lit(" "), "fs_path")).write.text(at)
    return inputs.read_path_list(spark, at)


@query("SELECT conv_id, turn, role AS fact, text AS signal, 2 AS n_keys FROM conversations")
def split_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.create_map(F.lit("role"), "role", F.lit("summary"), "text")
    core, ext = meta.file_facts(m), meta.content_signals(m)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.try_element_at(core, F.lit("role")).alias("fact"), F.try_element_at(ext, F.lit("summary")).alias("signal"), (F.size(core) + F.size(ext)).alias("n_keys"))


@query("WITH d AS (SELECT DISTINCT source FROM documents), r AS (SELECT DISTINCT lang AS key FROM documents), g AS (SELECT DISTINCT source, lang AS key FROM documents WHERE n_chars < 300) SELECT g2.source AS domain, r.key FROM (SELECT DISTINCT source FROM g) g2, r WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.source = g2.source AND g.key = r.key)")
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return topics.missing_keys(d.select(F.col("lang").alias("key")).distinct(), d.filter("n_chars < 300").select(F.col("source").alias("domain"), F.col("lang").alias("key")).distinct())


LEADER = """l AS (SELECT a.*, coalesce((SELECT arg_min(b.asset_id, (b.created_at, b.asset_id)) FROM asset b WHERE b.file_hash = a.file_hash AND b.status IN ('registered', 'deferred')),
  (SELECT arg_min(b.asset_id, (b.created_at, b.asset_id)) FROM asset b WHERE b.file_hash = a.file_hash AND b.status = 'received')) AS leader FROM asset a)"""


@query(f"WITH {ASSET}, {LEADER} SELECT asset_id, leader, leader IS NOT NULL AND leader <> asset_id AND status = 'received' AS copy FROM l")
def dup_leader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.with_leader(assets(spark, sf_dir)).select("asset_id", "leader", "copy")


@query(f"WITH {ASSET} SELECT asset_id FROM asset a WHERE status = 'received' AND NOT EXISTS (SELECT 1 FROM asset b WHERE b.file_hash = a.file_hash AND b.status IN ('registered', 'deferred'))")
def dup_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assets(spark, sf_dir).select("asset_id", "file_hash", "status")
    held = a.filter(F.col("status").isin("registered", "deferred")).select("file_hash")
    return a.filter("status = 'received'").join(held, "file_hash", "left_anti").select("asset_id")


@query(f"""WITH {LABELLED}, {LEADER}, e AS (SELECT d.status, label, leader IS NOT NULL AND leader <> d.asset_id AND d.status = 'received' AS copy FROM decided d JOIN l ON l.asset_id = d.asset_id)
  SELECT CASE WHEN copy THEN 'deferred' ELSE status END AS status, CASE WHEN copy THEN 'copy' WHEN status = 'received' THEN label ELSE 'settled' END AS label, count(*) AS assets FROM e GROUP BY 1, 2""")
def ingest_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = dedup.defer_copies(assets(spark, sf_dir))
    led = classify.cascade(a.filter("status = 'received'"), LEXICONS).select("status", "label")
    done = a.filter("status <> 'received'").select("status", F.when(F.col("status_reason").isNotNull(), "copy").otherwise("settled").alias("label"))
    return led.unionByName(done).groupBy("status", "label").agg(F.count("*").alias("assets"))


@query(f"WITH {COUNTED} SELECT asset_id, n_en, n_fr FROM counted")
def lexicon_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets(spark, sf_dir).select("asset_id", *[text.hit_count(text.lexicon_hits(F.col("text"), terms)).alias(f"n_{name}") for name, terms in LEXICONS.items()])


@query(f"WITH {LABELLED} SELECT asset_id, label, CAST(confidence AS DOUBLE) AS confidence, stage FROM decided")
def cascade_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.cascade(assets(spark, sf_dir), LEXICONS).select("asset_id", "label", "confidence", "stage")


@query("""WITH c AS (SELECT doc_id, unnest(range(0, length(text), 500)) AS i, text FROM documents), p AS (SELECT doc_id, substring(text, i + 1, 500) AS t FROM c)
  SELECT doc_id AS asset_id, CAST(sum(length(t)) AS BIGINT) AS chars, CAST(sum(len(list_filter(regexp_split_to_array(t, '[.!?]+|\\n+'), lambda x: trim(x) <> ''))) AS BIGINT) AS sentences,
  CAST(sum(len(regexp_extract_all(t, '[^\\s]+'))) AS BIGINT) AS tokens, CAST(sum(len(regexp_extract_all(t, '[A-Za-z]'))) AS BIGINT) AS latin FROM p GROUP BY doc_id""")
def doc_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.document_stats(assets(spark, sf_dir), 500).select("asset_id", "chars", "sentences", "tokens", "latin")


@query("WITH c AS (SELECT doc_id, len(regexp_extract_all(text, '[가-힣]')) AS h, len(regexp_extract_all(text, '[A-Za-z]')) AS a FROM documents) SELECT doc_id AS asset_id, CASE WHEN h + a = 0 THEN 'unknown' WHEN h / (h + a) >= 0.3 THEN 'ko' WHEN a / (h + a) >= 0.5 THEN 'en' ELSE 'unknown' END AS language FROM c")
def language_by_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return assets(spark, sf_dir).select("asset_id", text.language(text.hangul(t), text.latin(t)).alias("language"))


@query("""WITH t AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'MSH|' || text WHEN 1 THEN ' {"resourceType": "Patient"}' WHEN 2 THEN '{"resourceType": "Other"}' WHEN 3 THEN repeat('x', 128) || 'DICM' || text ELSE text END AS c FROM documents)
  SELECT doc_id AS asset_id, CASE doc_id % 5 WHEN 0 THEN 'hl7v2' WHEN 1 THEN 'fhir' WHEN 3 THEN 'dicom' END AS signature FROM t""")
def sniff_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, t = F.col("asset_id") % 5, F.col("text")
    c = F.when(m == 0, F.concat(F.lit("MSH|"), t)).when(m == 1, ' {"resourceType": "Patient"}').when(m == 2, '{"resourceType": "Other"}').when(m == 3, F.concat(F.repeat(F.lit("x"), 128), F.lit("DICM"), t)).otherwise(t)
    return assets(spark, sf_dir).select("asset_id", text.signature(c.cast("binary")).alias("signature"))


@query("WITH c AS (SELECT doc_id, unnest(range(0, length(text), 1000)) AS i, text FROM documents) SELECT doc_id AS asset_id, 'st' AS channel, CAST(i // 1000 AS INT) AS chunk_index, substring(text, i + 1, 1000) AS text FROM c")
def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.chunk_rows(assets(spark, sf_dir), 1000)


@query("SELECT doc_id AS asset_id, CASE WHEN length(trim(text)) >= 15 THEN lang END AS guarded FROM documents")
def content_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets(spark, sf_dir).select("asset_id", text.guarded(F.col("text"), F.col("lang")).alias("guarded"))


TWO_DOMAINS = """t AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '{"resourceType": "Patient"} ' || text WHEN 1 THEN '{' || text ELSE 'MSH|' || text END AS c FROM documents)"""


@query(f"WITH {TWO_DOMAINS} SELECT doc_id AS asset_id, CASE doc_id % 3 WHEN 0 THEN 2 ELSE 1 END AS n_signed, CASE doc_id % 3 WHEN 1 THEN 'data' WHEN 2 THEN 'medical' END AS signed, CASE doc_id % 3 WHEN 1 THEN 'json' WHEN 2 THEN 'hl7v2' END AS signature, CASE doc_id % 3 WHEN 0 THEN FALSE ELSE TRUE END AS first_stage, 'p7' AS policy_version FROM t")
def signature_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures of two labels in one document decide nothing; the next stage does."""
    m, t = F.col("asset_id") % 3, F.col("text")
    given = assets(spark, sf_dir).select("asset_id", F.when(m == 0, F.concat(F.lit('{"resourceType": "Patient"} '), t)).when(m == 1, F.concat(F.lit("{"), t)).otherwise(F.concat(F.lit("MSH|"), t)).alias("text"))
    rules = {"medical": [text.signature_of_text], "data": [lambda c: F.when(c.startswith("{"), "json")]}
    out = classify.cascade(given, LEXICONS, rules=rules, policy="p7")
    return out.select("asset_id", F.size("stage1_scores").alias("n_signed"), F.when(F.col("stage") == 1, F.col("label")).alias("signed"), "signature", (F.col("stage") == 1).alias("first_stage"), "policy_version")


CLASSIFIED = f"{LABELLED}, target AS (SELECT asset_id, 'old' AS final_label, CAST(0.1 AS DOUBLE) AS confidence, 1 AS decided_stage, 'v0' AS policy_version FROM asset WHERE asset_id % 2 = 0), delta AS (SELECT asset_id, label AS final_label, CAST(confidence AS DOUBLE) AS confidence, stage AS decided_stage FROM decided WHERE asset_id % 3 = 0)"


@query(f"WITH {CLASSIFIED} SELECT coalesce(t.asset_id, d.asset_id) AS asset_id, coalesce(d.final_label, t.final_label) AS final_label, coalesce(d.confidence, t.confidence) AS confidence, coalesce(d.decided_stage, t.decided_stage) AS decided_stage, t.policy_version FROM target t FULL JOIN delta d ON t.asset_id = d.asset_id")
def upsert_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assets(spark, sf_dir)
    target = a.filter("asset_id % 2 = 0").select("asset_id", F.lit("old").alias("final_label"), F.lit(0.1).alias("confidence"), F.lit(1).alias("decided_stage"), F.lit("v0").alias("policy_version"))
    delta = classify.cascade(a.filter("asset_id % 3 = 0"), LEXICONS).select("asset_id", F.col("label").alias("final_label"), "confidence", F.col("stage").alias("decided_stage"))
    return state.upsert(target, delta, ["asset_id"])


@query("SELECT doc_id AS asset_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE lang END AS summary, CASE WHEN doc_id % 3 = 0 THEN '[]' END AS about, CASE WHEN doc_id % 3 <> 0 THEN 'yes' END AS title_only FROM documents")
def merge_ext_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    old = d.select(F.col("doc_id").alias("asset_id"), F.create_map(F.lit("summary"), "lang", F.lit("title_only"), F.lit("yes")).alias("ext_meta"))
    new = d.filter("doc_id % 3 = 0").select(F.col("doc_id").alias("asset_id"), F.create_map(F.lit("summary"), "source", F.lit("about"), F.lit("[]")).alias("ext_meta"))
    out = state.merge_meta(old, new, "asset_id", "ext_meta", ["title_only"])
    return out.select("asset_id", *[F.try_element_at("ext_meta", F.lit(k)).alias(k) for k in ("summary", "about", "title_only")])


JUDGE = {"axis_en": {"article": ["the"], "join": ["and", "of"]}, "axis_fr": {"article": ["le", "la"]}}


@query(f"WITH {COUNTED}, m AS (SELECT asset_id, regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}_])the($|[^\\p{{L}}\\p{{N}}_])') AS t, regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}_])(and|of)($|[^\\p{{L}}\\p{{N}}_])') AS j, regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}_])(le|la)($|[^\\p{{L}}\\p{{N}}_])') AS f FROM (SELECT asset_id, lower(text) AS low FROM asset)) SELECT asset_id, array_to_string(list_filter([CASE WHEN t THEN 'axis_en/article' END, CASE WHEN j THEN 'axis_en/join' END, CASE WHEN f THEN 'axis_fr/article' END], lambda x: x IS NOT NULL), ',') AS facets FROM m")
def facet_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assets(spark, sf_dir)
    out = state.facet_keys(a, classify.lexicon_judge(JUDGE)(a, "text"))
    return out.select("asset_id", F.array_join("facets", ",").alias("facets"))


@query(f"""WITH {COUNTED}, m AS (SELECT asset_id, regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}_])the($|[^\\p{{L}}\\p{{N}}_])') AS t, regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}_])(and|of)($|[^\\p{{L}}\\p{{N}}_])') AS j, regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}_])(le|la)($|[^\\p{{L}}\\p{{N}}_])') AS f FROM (SELECT asset_id, lower(text) AS low FROM asset)),
  p AS (SELECT asset_id, 'axis_en' AS skill_code, CAST(t AS INT) + CAST(j AS INT) AS n FROM m WHERE asset_id % 5 <> 0 UNION ALL SELECT asset_id, 'axis_fr', CAST(f AS INT) FROM m), d AS (SELECT *, asset_id % 7 <> 0 AS done, asset_id % 2 = 0 AND skill_code = 'axis_fr' AS had FROM p)
  SELECT skill_code, count(*) AS targets, count(*) FILTER (done) AS judged, count(*) FILTER (NOT done) AS failed, count(*) FILTER (done AND NOT had) AS created, count(*) FILTER (done AND had) AS updated, CAST(coalesce(sum(n) FILTER (done), 0) AS BIGINT) AS labels,
  round(count(*) FILTER (done AND n = 0) / count(*) FILTER (done), 4) AS unassigned_ratio FROM d GROUP BY skill_code""")
def axis_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assets(spark, sf_dir)
    skills = spark.createDataFrame([("axis_en", 2), ("axis_fr", 3)], "skill_code string, skill_version int")
    had = a.filter("asset_id % 5 = 0").select("asset_id", F.lit("axis_en").alias("skill_code"), F.lit(2).alias("skill_version")).unionByName(a.filter("asset_id % 2 = 0").select("asset_id", F.lit("axis_fr").alias("skill_code"), F.lit(1).alias("skill_version")))
    due = classify.pending(a, skills, had)
    judged = classify.lexicon_judge(JUDGE)(a.filter("asset_id % 7 <> 0"), "text")
    return classify.axis_report(due, judged.join(due.select("asset_id", "skill_code"), ["asset_id", "skill_code"], "left_semi"), had)


@query("""WITH r AS (SELECT conv_id, turn, CASE (conv_id + turn) % 4 WHEN 0 THEN ' En ' WHEN 1 THEN 'fr' WHEN 2 THEN 'other' END AS label FROM conversations) SELECT conv_id, turn, CASE WHEN lower(trim(label)) IN ('en', 'fr', 'general') THEN lower(trim(label)) ELSE 'review' END AS label FROM r""")
def valid_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    m = (F.col("conv_id") + F.col("turn")) % 4
    json = F.when(m == 0, '{"label": " En "}').when(m == 1, '{"label": "fr", "why": "x"}').when(m == 2, '{"label": "other"}').otherwise("no json")
    return c.select("conv_id", "turn", classify.valid_verdict(json, ["en", "fr", "general"]).alias("label"))


@query("WITH t AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'fhir' WHEN 1 THEN 'dicom' END AS s FROM documents) SELECT doc_id AS asset_id, CASE WHEN s = 'dicom' THEN 'deferred' ELSE 'classifying' END AS status, CASE WHEN s = 'dicom' THEN 'medical_format:dicom' END AS status_reason FROM t")
def planned_deferral(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("doc_id") % 3
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id"), F.when(m == 0, "fhir").when(m == 1, "dicom").alias("signature"), F.when(m < 2, 1).otherwise(2).alias("stage"), F.lit("medical").alias("label"), F.lit("classifying").alias("status"))
    return classify.planned_deferral(rows, ["fhir"]).select("asset_id", "status", "status_reason")


@query("SELECT doc_id AS asset_id, n_chars AS before, CASE WHEN doc_id % 4 = 0 THEN n_chars + 1 ELSE n_chars END AS after, doc_id % 4 = 0 AS changed FROM documents")
def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id"), "n_chars")
    return inputs.before_after(d, d.withColumn("n_chars", F.when(F.col("asset_id") % 4 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))), "asset_id", "n_chars")


@query("SELECT doc_id AS asset_id, trim(lang) || ' ' || source || ' x' AS self_text, '제목: ' || source || chr(10) || trim(lang) || ' ' || source || ' x' AS titled, lang || chr(10) || source || chr(10) || 'x' AS embedding_text FROM documents")
def material_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, labels = F.array("source", F.lit(" ")), F.array(F.lit("x"))
    own = meta.self_text(F.col("lang"), k, labels)
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asset_id"), own.alias("self_text"), meta.with_title(own, F.col("source")).alias("titled"), meta.embedding_text(F.col("lang"), k, labels).alias("embedding_text"))


@query(f"WITH {ASSET} SELECT asset_id, modality, CASE modality WHEN 'text' THEN CAST(len(regexp_extract_all(text, '[^\\s]+')) AS INT) WHEN 'image' THEN CAST(file_size AS INT) END AS facts, modality IN ('text', 'image') AS handled FROM asset")
def dispatch_modalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each modality through its own handler; what none takes comes back as it was."""
    handlers = {"text": lambda a: a.select("asset_id", "modality", text.tokens(F.col("text")).alias("facts")), "image": lambda a: a.select("asset_id", "modality", F.col("file_size").cast("int").alias("facts"))}
    done, rest = classify.dispatch(assets(spark, sf_dir), handlers)
    return done.withColumn("handled", F.lit(True)).unionByName(rest.select("asset_id", "modality", F.lit(None).cast("int").alias("facts"), F.lit(False).alias("handled")))


@query("SELECT doc_id AS asset_id, CASE WHEN doc_id % 3 = 0 THEN nullif(trim(CASE WHEN doc_id % 2 = 0 THEN ' ' ELSE source END), '') END AS title, CASE WHEN doc_id % 3 <> 1 THEN lang END AS hint FROM documents")
def title_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that were judged to fit, and file names where the judgement wasn't no."""
    i = F.col("doc_id")
    match, title = F.when(i % 3 == 0, "yes").when(i % 3 == 1, "no"), F.when(i % 2 == 0, " ").otherwise(F.col("source"))
    return table(spark, sf_dir, "documents").select(i.alias("asset_id"), meta.confirmed_title(title, match).alias("title"), meta.name_hint(F.col("lang"), match).alias("hint"))


@query("SELECT vec_id AS asset_id, array_to_string(list_transform(list_filter(list_transform(range(1, len(embedding) + 1), lambda i: {'i': i, 's': CAST(embedding[i] AS DOUBLE)}), lambda x: x.s >= CAST(0.1 AS DOUBLE))[1:3], lambda x: CAST(x.i AS VARCHAR)), ',') AS labels FROM embeddings")
def label_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components stand for the scores of labels; the first three from 0.1 on stay."""
    scored = F.transform("embedding", lambda x, i: F.struct((i + 1).alias("label"), x.cast("double").alias("score")))
    best = meta.best_labels(scored, 0.1, 3)
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("asset_id"), F.array_join(F.transform(best, lambda x: x["label"].cast("string")), ",").alias("labels"))


@query("SELECT doc_id AS asset_id, concat_ws(chr(10), lang, source, nullif(CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END, ''), source || ' x', CASE WHEN doc_id % 5 <> 0 THEN lang END) AS material FROM documents")
def search_material(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity's text for search: blank parts are left out."""
    i = F.col("doc_id")
    described = F.when(i % 2 == 0, "  ").otherwise(F.concat(F.lit(" "), "lang"))
    members = F.when(i % 5 == 0, F.array(F.lit(" "))).otherwise(F.array("lang", F.lit("")))
    return table(spark, sf_dir, "documents").select(i.alias("asset_id"), meta.search_material(F.col("lang"), F.col("source"), described, F.array("source", F.lit(" x ")), members).alias("material"))
