"""Closed-set topics and subtopics, their canonical names, facets and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.sources.numbering import short, written

UNASSIGNED = "unassigned"
#: Pairs of a topic that a task makes, about; links up to which a source brings its own along; shares of work at most.
PAIRS, FEW, MOST_TASKS = 20_000_000, 32, 20_000


def closed_topic(texts: DataFrame, responses: DataFrame, registry: DataFrame, catch_all: str = "etc") -> DataFrame:
    """(asset_id, topic, confidence) for each text: of its responses (asset_id, attempt, topic, confidence) the first two are
    looked at, and the first one in the top-level names (parent null, not the catch-all) wins; else unassigned. An empty text
    has no attempt."""
    names = registry.filter(F.col("parent").isNull() & (F.col("name") != catch_all)).select(F.col("name").alias("topic")).distinct()
    tried = responses.filter("attempt <= 2").join(names, "topic", "left_semi").groupBy("asset_id").agg(F.min_by(F.struct("topic", "confidence"), "attempt").alias("t"))
    rows = texts.select("asset_id", (F.trim(F.coalesce("text", F.lit(""))) != "").alias("_some")).join(tried, "asset_id", "left")
    return rows.select("asset_id", F.when(F.col("_some"), F.coalesce("t.topic", F.lit(UNASSIGNED))).otherwise(UNASSIGNED).alias("topic"), F.when(F.col("_some"), F.col("t.confidence")).alias("confidence"))


def closed_subtopic(topics: DataFrame, responses: DataFrame, registry: DataFrame) -> DataFrame:
    """topics with subtopic: the first response (asset_id, attempt, subtopic) that is a child of the topic; null without one."""
    seeds = registry.filter(F.col("parent").isNotNull()).select(F.col("parent").alias("topic"), F.col("name").alias("subtopic")).distinct()
    said = topics.select("asset_id", "topic").join(responses, "asset_id").join(seeds, ["topic", "subtopic"], "left_semi")
    return topics.join(said.groupBy("asset_id").agg(F.min_by("subtopic", "attempt").alias("subtopic")), "asset_id", "left")


def canonical_topics(rows: DataFrame, aliases: DataFrame, *, modalities: tuple[str, ...] = ("text", "image", "video", "audio"), on: bool = True) -> DataFrame:
    """topic by its alias (parent null), subtopic by its alias under that topic; a subtopic that is a modality's name or its
    topic's is blank. Off: as it came."""
    if not on:
        return rows
    top = aliases.filter(F.col("parent").isNull()).select(F.col("raw").alias("topic"), F.col("canonical").alias("_top"))
    out = rows.join(top, "topic", "left").withColumn("topic", F.coalesce("_top", "topic")).drop("_top")
    sub = aliases.filter(F.col("parent").isNotNull()).select(F.col("parent").alias("topic"), F.col("raw").alias("subtopic"), F.col("canonical").alias("_sub"))
    out = out.join(sub, ["topic", "subtopic"], "left").withColumn("subtopic", F.coalesce("_sub", "subtopic")).drop("_sub")
    return out.withColumn("subtopic", F.when(F.lower("subtopic").isin(*modalities) | (F.col("subtopic") == F.col("topic")), F.lit(None)).otherwise(F.col("subtopic")))


def facets(rows: DataFrame) -> DataFrame:
    """(topic, subtopic, assets, topic_assets): distinct assets of each pair and of each topic."""
    pairs = rows.groupBy("topic", "subtopic").agg(F.countDistinct("asset_id").alias("assets"))
    return pairs.join(rows.groupBy("topic").agg(F.countDistinct("asset_id").alias("topic_assets")), "topic")


def same_topic(rows: DataFrame, sources: DataFrame, edges: DataFrame, by_subtopic: bool = True, pairs_a_task: int = PAIRS) -> DataFrame:
    """(src, dst, already_linked) for the given sources: peers of the same topic (and subtopic), not itself, and whether an active
    edge joins them in either direction.

    A topic's peers are dealt into shares, as many as its pairs need for about pairs_a_task each, and its sources meet every share, so a large
    topic is many tasks' work. A source brings along whom it is linked with where these are few, and its pairs are told at once; only pairs of
    sources with more links are looked up among the links."""
    keys = ["topic", "subtopic"] if by_subtopic else ["topic"]
    at = F.struct(*keys)
    known = lambda df, name: df.filter(" and ".join(f"{k} is not null" for k in keys)).select(F.col("asset_id").alias(name), at.alias("_k"))
    peers, asked = written(known(rows, "dst"), "peers"), written(known(sources, "src"), "sources")
    active = edges.filter("status = 'active'").select("src", "dst")
    links = active.unionByName(active.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    # Pairs of a topic and shares of its peers.
    sizes = peers.groupBy("_k").agg(F.count("*").alias("_p")).join(asked.groupBy("_k").agg(F.count("*").alias("_s")), "_k")
    shares = written(sizes.select("_k", F.ceil(F.col("_p") * F.col("_s") / pairs_a_task).cast("int").alias("_n")), "shares")
    tasks = shares.agg(F.coalesce(F.sum("_n"), F.lit(1))).first()[0]
    n = max(1, min(tasks, MOST_TASKS))
    few = links.join(asked.select("src").distinct(), "src", "left_semi").groupBy("src").agg(F.count("*").alias("_c"))
    own = links.join(few.filter(F.col("_c") <= FEW), "src", "left_semi").groupBy("src").agg(F.collect_list("dst").alias("_own"))
    told = asked.join(own, "src", "left").join(few, "src", "left").select("src", "_k", F.coalesce("_own", F.array().cast(own.schema["_own"].dataType)).alias("_own"), (F.coalesce("_c", F.lit(0)) > FEW).alias("_many"))
    told = written(told, "told")
    left = told.join(shares, "_k").withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n").repartition(n, "_k", "_i")
    right = peers.join(shares, "_k").withColumn("_i", F.pmod(F.xxhash64("dst"), F.col("_n")).cast("int")).drop("_n").repartition(n, "_k", "_i")
    pairs = left.join(right.hint("merge"), ["_k", "_i"]).filter("src <> dst")
    out = pairs.filter("not _many").select("src", "dst", F.array_contains("_own", F.col("dst")).alias("already_linked"))
    if not told.filter("_many").limit(1).count():
        return out
    hubs = pairs.filter("_many").select("src", "dst").join(links.withColumn("_l", F.lit(True)), ["src", "dst"], "left")
    return out.unionByName(hubs.select("src", "dst", F.coalesce("_l", F.lit(False)).alias("already_linked")))


def page(rows: DataFrame, topic: str, offset: int, limit: int) -> tuple[DataFrame, Column]:
    """A page of a topic's assets by id, and the true total as a column to select from rows."""
    own = rows.filter(F.col("topic") == topic)
    return own.orderBy("asset_id").offset(offset).limit(limit), F.count_if(F.col("topic") == topic)


def unknown(requested: DataFrame, active: DataFrame, column: str) -> DataFrame:
    """What is asked for but isn't there: an error's text names all of it."""
    return requested.select(column).subtract(active.select(column))


def missing_keys(required: DataFrame, registered: DataFrame) -> DataFrame:
    """(domain, key) that are required but not registered, of domains that have a registry at all."""
    domains = registered.select("domain").distinct()
    return domains.crossJoin(short(required.select("key"))).join(registered.select("domain", "key"), ["domain", "key"], "left_anti")
