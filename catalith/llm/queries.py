"""One query for each operator of this subpackage, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm import bpe, decontaminate, fingerprint, hard_negatives, html_extract, ngram_join, packing, phrases, quality, sharding, suffix_dedup, toxicity, url_filter
from catalith.session import table

TOXIC_FOLDS, TOXIC_HELD, QUALITY_FOLDS, QUALITY_HELD = 5, 0, 4, 2
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = toxicity.hashed_remainder("doc_id", TOXIC_FOLDS)
    lexicon = toxicity.fit(docs, labels, train=fold != TOXIC_HELD)
    rows = toxicity.score(docs.select("doc_id", "text"), lexicon)
    return rows.select("doc_id", (fold == TOXIC_HELD).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = toxicity.hashed_remainder("doc_id", QUALITY_FOLDS)
    net = quality.fit(docs, labels, keep=fold != QUALITY_HELD)
    rows = quality.score(docs.select("doc_id", "text"), net)
    return rows.select("doc_id", (fold == QUALITY_HELD).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.shard(rows, 8, ties=("text_crc32", "size"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id")


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(table(spark, sf_dir, "documents"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    weights = html_extract.fit(pages)
    return html_extract.extract(pages, weights).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(F.col("_key").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), added=True)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bpe.encode(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), columns=["doc_id"])
    n = F.floor(F.length("ids") / 4).cast("long").alias("n_tokens")
    return made.select("doc_id", n, F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_toxicity, op3_quality, op4_sharding, op5_url_rules, op6_ngram_join, op7_fingerprint, op8_html_extract, op9_suffix_dedup, op10_packing, op11_hard_negatives, op12_phrases, op13_bpe, pipeline)}
_RULES = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in RULES)
#: The other operators have no twin in SQL (learned weights, tokenizers, iterations, hash permutations); their tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op5_url_rules": f"""WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
  r AS (SELECT * FROM (VALUES {_RULES}) t(verdict, h, pre)), m AS (SELECT page_id, arg_max(h || pre, (length(h), length(pre))) AS rule, arg_max(verdict, (length(h), length(pre))) AS verdict FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY page_id)
  SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
    "op12_phrases": r"""WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
  piece AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
  g AS (SELECT lang, s.size, unnest(list_transform(range(1, len(w) - s.size + 2), lambda i: array_to_string(list_slice(w, i, i + s.size - 1), ' '))) AS phrase FROM w, (SELECT unnest(range(1, 6)) AS size) s WHERE len(w) >= s.size),
  n AS (SELECT lang, count(*) AS n FROM g WHERE size = 1 GROUP BY lang),
  f AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
  cut AS (SELECT lang, phrase, size, f AS a, w, unnest(range(1, size)) AS k FROM f WHERE size > 1),
  s AS (SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, n.n, CAST(1000 * CAST(c.a AS HUGEINT) * n.n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score FROM cut c
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.w, 1, c.k), ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.w, c.k + 1, c.size), ' ') JOIN n ON n.lang = c.lang),
  b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
  i AS (SELECT lang, w, size, f, unnest(range(2, size)) AS m FROM f WHERE size > 2), j AS (SELECT lang, f, m, w, unnest(range(1, size - m + 2)) AS p FROM i),
  longer AS (SELECT lang, array_to_string(list_slice(w, p, p + m - 1), ' ') AS phrase, max(f) AS longer FROM j GROUP BY ALL),
  k AS (SELECT b.lang, b.phrase, a, l, r, n, score FROM b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 100 * a)
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM k QUALIFY rank <= 2000""",
}
