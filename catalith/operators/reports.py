"""Reprocessing, descriptions, chunked embedding, and reports over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.meta import embedding_text, key_missing, nfc
from catalith.functions.text import chunks
from catalith.operators.state import merge_meta
from catalith.sources.numbering import by_rank


def reprocess_targets(assets: DataFrame, *, modalities: tuple[str, ...], ids: list | None = None, resume_key: str | None = None, excluded_names: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Registered assets of the modalities, of the given ids, without resume_key in ext_meta, with a title, by id. The limit is
    taken before names are excluded, as the names are looked at last; names are compared in Unicode's composed form."""
    rows = assets.filter((F.col("status") == "registered") & F.col("modality").isin(*modalities) & (F.trim(F.coalesce("title", F.lit(""))) != ""))
    if ids is not None:
        rows = rows.filter(F.col("asset_id").isin(*ids))
    if resume_key:
        rows = rows.filter(key_missing(F.col("ext_meta"), resume_key))
    rows = rows.orderBy("asset_id")
    if limit is not None:
        rows = rows.limit(limit)
    if excluded_names is not None:
        names = excluded_names.select(nfc(F.col("name")).alias("_nfc")).distinct()
        rows = rows.withColumn("_nfc", nfc(F.col("name"))).join(names, "_nfc", "left_anti").drop("_nfc")
    return rows


def reprocess(assets: DataFrame, updates: DataFrame, removed: tuple[str, ...] = ("title_only",)) -> tuple[DataFrame, DataFrame]:
    """(assets after the pass, outcome a target). updates: (asset_id, ext_meta, error). An error or an empty new summary changes
    nothing; title_only goes unless it is set again."""
    said = updates.withColumn("outcome", F.when(F.col("error").isNotNull(), "failed").when(F.trim(F.coalesce(F.try_element_at("ext_meta", F.lit("summary")), F.lit(""))) == "", "skipped").otherwise("ok"))
    good = said.filter("outcome = 'ok'").select("asset_id", "ext_meta")
    old = assets.join(good.select("asset_id").withColumn("_hit", F.lit(True)), "asset_id", "left")
    old = old.withColumn("ext_meta", F.when(F.col("_hit"), F.map_filter("ext_meta", lambda k, _: ~k.isin(*removed))).otherwise(F.col("ext_meta"))).drop("_hit")
    return merge_meta(old, good, "asset_id", "ext_meta"), said.select("asset_id", "outcome")


def with_index(outcomes: DataFrame, index: DataFrame) -> DataFrame:
    """outcomes (asset_id, outcome, ...) in which an asset that went well but whose document the index didn't take (asset_id in index) is
    index_failed: its row is right, only its document is old."""
    bad = index.select("asset_id").distinct().withColumn("_bad", F.lit(True))
    rows = outcomes.join(bad, "asset_id", "left")
    return rows.withColumn("outcome", F.when(F.col("_bad") & (F.col("outcome") == "ok"), "index_failed").otherwise(F.col("outcome"))).drop("_bad")


def failed_ids(outcomes: DataFrame) -> DataFrame:
    """(value): ids of assets that failed, one a line when written with write.text, for a run on these alone."""
    return outcomes.filter(F.col("outcome").isin("failed", "index_failed")).select(F.col("asset_id").cast("string").alias("value")).distinct()


def reprocess_report(outcomes: DataFrame) -> DataFrame:
    """One row a target: its outcome, title_match and modality where outcomes has them, and how many share these (n)."""
    by = [c for c in ("outcome", "title_match", "modality") if c in outcomes.columns]
    return outcomes.select("asset_id", *by).join(outcomes.groupBy(*by).agg(F.count("*").alias("n")), by)


def upper_median(rows: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """n, least, greatest and the upper median (the element at n div 2 of the sorted values) of each group, or of all rows. No task
    holds a group's values, see by_rank."""
    return by_rank(rows, value, F.expr("n div 2"), group).withColumnRenamed("chosen", "median")


def describe_targets(bundles: DataFrame, stored: DataFrame, most: int | None = None) -> DataFrame:
    """(type, uid, members, reason): entities without a description (missing), or with one made for another number of members.
    most: the largest ones only, ties by type and uid."""
    rows = bundles.join(stored.select("entity_type", "entity_uid", "description", "member_count"), ["entity_type", "entity_uid"], "left")
    reason = F.when(F.trim(F.coalesce("description", F.lit(""))) == "", "missing").when(F.col("member_count") != F.col("members"), "members_changed")
    due = rows.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select("entity_type", "entity_uid", "members", "reason")
    return due.orderBy(F.desc("members"), "entity_type", "entity_uid").limit(most) if most is not None else due


def described(targets: DataFrame, summaries: DataFrame, template: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(type, uid, description, member_count, over_length): texts made from the members' summaries; blank ones aren't kept. The
    stored count is the bundle's size, not the number of summaries."""
    make = template or (lambda uid, lines: F.concat(uid.cast("string"), F.lit(": "), F.array_join(lines, "; ")))
    rows = targets.join(summaries, ["entity_type", "entity_uid"], "left").withColumn("description", F.when(F.size(F.coalesce("summaries", F.array().cast("array<string>"))) > 0, make(F.col("entity_uid"), F.col("summaries"))))
    return rows.filter(F.trim("description") != "").select("entity_type", "entity_uid", "description", F.col("members").alias("member_count"), (F.length("description") > 60).alias("over_length"))


def describe_report(targets: DataFrame, done: DataFrame) -> DataFrame:
    """One row a reason: targets, how many of them are described, and how many descriptions are over the length."""
    rows = targets.join(done.select("entity_type", "entity_uid", "over_length"), ["entity_type", "entity_uid"], "left")
    return rows.groupBy("reason").agg(F.count("*").alias("targets"), F.count("over_length").alias("described"), F.count_if("over_length").alias("over_length"))


def chunk_rows(rows: DataFrame, width: int, *, key: str = "asset_id", text: str = "text", channel: str = "st", overlap: int = 0) -> DataFrame:
    """(key, channel, chunk_index, text): one row a chunk, numbered from 0."""
    return rows.select(key, F.lit(channel).alias("channel"), F.posexplode(chunks(F.col(text), width, overlap)).alias("chunk_index", "text"))


def document_stats(rows: DataFrame, width: int, *, key: str = "asset_id", text: str = "text") -> DataFrame:
    """chars, sentences, tokens, Hangul and Latin letters, letters and language of each document, summed over its chunks."""
    from catalith.functions import text as T

    cut = rows.select(key, F.explode_outer(T.chunks(F.col(text), width)).alias("_c"))
    per = cut.groupBy(key).agg(F.coalesce(F.sum(F.length("_c")), F.lit(0)).alias("chars"), F.coalesce(F.sum(T.sentences(F.col("_c"))), F.lit(0)).alias("sentences"), F.coalesce(F.sum(T.tokens(F.col("_c"))), F.lit(0)).alias("tokens"), F.coalesce(F.sum(T.hangul(F.col("_c"))), F.lit(0)).alias("hangul"), F.coalesce(F.sum(T.latin(F.col("_c"))), F.lit(0)).alias("latin"), F.coalesce(F.sum(F.regexp_count("_c", F.lit(r"\p{L}"))), F.lit(0)).alias("letters"))
    return per.withColumn("language", T.language(F.col("hangul"), F.col("latin")))


def hashing_embedder(width: int = 64) -> Callable[[DataFrame, str], DataFrame]:
    """The default embedder: hashed words, scaled to length 1; it stands in for a model."""

    def embed(rows: DataFrame, text: str) -> DataFrame:
        from pyspark.ml.feature import HashingTF, Normalizer
        from pyspark.ml.functions import vector_to_array

        words = rows.withColumn("_w", F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"))
        out = Normalizer(inputCol="_tf", outputCol="_v").transform(HashingTF(inputCol="_w", outputCol="_tf", numFeatures=width).transform(words))
        return out.withColumn("embedding", vector_to_array("_v", "float32")).drop("_w", "_tf", "_v")

    return embed


def chunk_and_embed(rows: DataFrame, width: int, embed: Callable[[DataFrame, str], DataFrame] | None = None, **options) -> DataFrame:
    return (embed or hashing_embedder())(chunk_rows(rows, width, **options), "text").drop("text")


def paired_channels(frames: DataFrame, embed: Callable[[DataFrame, str], DataFrame] | None = None, visual: bool = True) -> DataFrame:
    """For each image or frame (asset_id, chunk_index, summary, keywords, labels, vector) a row in the text channel and, when
    visual, one with its vector in the visual channel, under the same chunk_index."""
    texts = frames.select("asset_id", F.lit("st").alias("channel"), "chunk_index", embedding_text(F.col("summary"), F.col("keywords"), F.col("labels")).alias("text"))
    out = (embed or hashing_embedder())(texts, "text").drop("text")
    if not visual:
        return out
    return out.unionByName(frames.filter(F.col("vector").isNotNull()).select("asset_id", F.lit("clip").alias("channel"), "chunk_index", F.col("vector").cast("array<float>").alias("embedding")))


def entity_label_report(work: DataFrame, judged: DataFrame) -> DataFrame:
    """One row a skill and reason: pairs due, judged, labelled and unassigned."""
    k = ["entity_type", "entity_uid", "skill_code"]
    done = judged.groupBy(*k).agg(F.count_if(F.col("label_code") != "unassigned").alias("_n"))
    rows = work.join(done, k, "left")
    return rows.groupBy("skill_code", "reason").agg(F.count("*").alias("due"), F.count("_n").alias("judged"), F.count_if(F.col("_n") > 0).alias("labelled"), F.count_if(F.col("_n") == 0).alias("unassigned"))
