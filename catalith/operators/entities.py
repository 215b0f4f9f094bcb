"""Entities: bundles of assets, their names, labels, materials and index documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalith.functions.meta import drift, material
from catalith.sources import versions
from catalith.sources.numbering import short

KEY = ["entity_type", "entity_uid"]


def first_of(rows: DataFrame, keys: list[str], order: list, n: int, value: str, out: str) -> DataFrame:
    """(keys, out): the first n values of each key in order; nulls are left out before they are ranked."""
    ranked = rows.filter(F.col(value).isNotNull()).withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") <= n)
    return ranked.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", value))), lambda x: x[value]).alias(out))


def members(edges: DataFrame, assets: DataFrame, visible: tuple[str, ...] = ("active",)) -> DataFrame:
    """(entity_type, entity_uid, asset_id, asset columns): members by edges of a visible status."""
    return edges.filter(F.col("status").isin(*visible)).select(*KEY, "asset_id").distinct().join(assets, "asset_id")


def member_summaries(edges: DataFrame, assets: DataFrame, wanted: DataFrame | None = None, n: int = 3) -> DataFrame:
    """The first n summaries of each entity by asset. wanted: (type, uid) pairs; a uid alone would mix namesakes."""
    rows = members(edges, assets)
    if wanted is not None:
        rows = rows.join(wanted.select(*KEY).distinct(), KEY, "left_semi")
    return first_of(rows, KEY, ["asset_id"], n, "summary", "summaries")


def bundles(edges: DataFrame, least: int = 1, visible: tuple[str, ...] = ("active",)) -> DataFrame:
    """(type, uid, members) of entities with least members on. An asset counts once; pairs are united before the count."""
    return edges.filter(F.col("status").isin(*visible)).select(*KEY, "asset_id").distinct().groupBy(*KEY).agg(F.count("*").alias("members")).filter(F.col("members") >= least)


def top_bundles(edges: DataFrame, n: int = 10) -> DataFrame:
    return bundles(edges).orderBy(F.desc("members"), *KEY).limit(n)


def orphans(entities: DataFrame, edges: DataFrame, visible: tuple[str, ...] = ("active",)) -> DataFrame:
    """Entities that no visible edge names, with where they come from: manual or automatic."""
    gone = entities.join(edges.filter(F.col("status").isin(*visible)).select(*KEY).distinct(), KEY, "left_anti")
    return gone.withColumn("origin", F.when(F.col("source") == "manual", "manual").otherwise("automatic"))


def orphan_documents(index: DataFrame, entities: DataFrame) -> DataFrame:
    return index.join(entities.select(*KEY).distinct(), KEY, "left_anti")


def resolve_names(judged: DataFrame, aliases: DataFrame) -> DataFrame:
    """judged (entity_type, name, keyword, ...) with the canonical name where (type, name) has one; the keyword stays. Of an alias's
    canonical names the smallest counts, so no row becomes two."""
    al = aliases.groupBy("entity_type", F.col("alias").alias("name")).agg(F.min("canonical").alias("canonical"))
    return judged.join(al, ["entity_type", "name"], "left").withColumn("name", F.coalesce("canonical", "name")).drop("canonical")


def apply_rules(judged: DataFrame, excluded: DataFrame, stop_patterns: list[str], official: DataFrame) -> DataFrame:
    """judged without excluded (type, name) and without keywords that a stop pattern fits; short names become official ones."""
    rows = judged.join(excluded.select("entity_type", "name"), ["entity_type", "name"], "left_anti")
    for pattern in stop_patterns:
        rows = rows.filter(~F.coalesce(F.col("keyword").rlike(pattern), F.lit(False)))
    names = official.groupBy("entity_type", F.col("short").alias("name")).agg(F.min("official").alias("official"))
    return rows.join(names, ["entity_type", "name"], "left").withColumn("name", F.coalesce("official", "name")).drop("official")


def contained(judged: DataFrame, registered: DataFrame, words: int = 4) -> DataFrame:
    """(asset_id, entity_type, from_name, to_name): registered names of the same type that stand in a judged name as whole words.
    Names are cut into runs of up to `words` words and joined on them; names of more words are found by their first ones. Judged rows
    are dealt by asset first, so rows that repeat meet in one of many tasks, each of a share that doesn't grow with the table."""
    gram = lambda c, n: F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: F.array_join(F.slice(c, i + 1, n), " "))
    parts = F.split(F.lower(F.trim("name")), r"\s+")
    rows = judged.select("asset_id", "entity_type", "name").repartition("asset_id").select("asset_id", "entity_type", "name", parts.alias("_w"))
    grams = F.flatten(F.array(*[F.when(F.size("_w") >= n, gram(F.col("_w"), n)).otherwise(F.array().cast("array<string>")) for n in range(1, words + 1)]))
    flat = rows.select("asset_id", "entity_type", F.col("name").alias("from_name"), F.array_join("_w", " ").alias("_text"), F.explode(F.array_distinct(grams)).alias("_gram"))
    names = registered.select("entity_type", F.col("name").alias("to_name"), F.array_join(F.split(F.lower(F.trim("name")), r"\s+"), " ").alias("_full")).filter("_full <> ''")
    names = names.withColumn("_gram", F.array_join(F.slice(F.split("_full", " "), 1, words), " "))
    # The runs are many more than their file's size says: they are never the side that is broadcast.
    hit = flat.hint("merge").join(short(names), ["entity_type", "_gram"]).filter(F.concat(F.lit(" "), "_text", F.lit(" ")).contains(F.concat(F.lit(" "), F.col("_full"), F.lit(" "))) & (F.col("_full") != F.col("_text")))
    return hit.select("asset_id", "entity_type", "from_name", "to_name").distinct()


def contained_report(links: DataFrame) -> DataFrame:
    """One row a type and pair of names: how many assets it links, and the first of them as a sample."""
    return links.groupBy("entity_type", "from_name", "to_name").agg(F.countDistinct("asset_id").alias("assets"), F.min("asset_id").alias("sample"))


def split_registered(judged: DataFrame, registered: DataFrame) -> DataFrame:
    """judged with registered: whether (type, uid) is known; the others are withheld as candidates."""
    return judged.join(registered.select(*KEY).distinct().withColumn("_k", F.lit(True)), KEY, "left").withColumn("registered", F.col("_k").isNotNull()).drop("_k")


def candidate_report(candidates: DataFrame, cap: int = 200, sample: int = 3, chars: int = 60) -> DataFrame:
    """One row a candidate (type, name): assets, the first distinct keywords, the first assets, the first example cut short, and
    how many candidates there are in all. ord: the order of arrival."""
    keys = ["entity_type", "name"]
    words = first_of(candidates.filter(F.col("keyword").isNotNull()).groupBy(*keys, "keyword").agg(F.min("ord").alias("ord")), keys, ["ord", "keyword"], sample, "keyword", "keywords")
    ids = first_of(candidates.groupBy(*keys, "asset_id").agg(F.min("ord").alias("ord")), keys, ["ord", "asset_id"], sample, "asset_id", "asset_ids")
    rows = candidates.groupBy(*keys).agg(F.countDistinct("asset_id").alias("assets"), F.substring(F.min_by("example", "ord"), 1, chars).alias("example"))
    total = rows.groupBy().agg(F.count("*").alias("total"))
    shown = rows.orderBy(F.desc("assets"), *keys).limit(cap)
    return shown.join(words, keys, "left").join(ids, keys, "left").join(F.broadcast(total))


def with_fingerprint(entities: DataFrame, summaries: DataFrame) -> DataFrame:
    """entities (type, uid, name, description) with material and its SHA-256; null for those without a name or type."""
    rows = entities.join(summaries, KEY, "left").withColumn("material", material(F.col("name"), F.col("entity_type"), F.col("description"), F.col("summaries")))
    return rows.withColumn("material_hash", F.sha2("material", 256))


def label_work(candidates: DataFrame, skills: DataFrame, state: DataFrame, prompt: str, limit: int) -> DataFrame:
    """(type, uid, skill_code, reason) of pairs that are due. The limit counts entities, after unchanged pairs are left out, most
    members first, so repeated runs reach everything."""
    have = state.groupBy(*KEY, "skill_code").agg(F.max("material_hash").alias("_hash"), F.max("skill_version").alias("_v"), F.max("prompt_version").alias("_p")).withColumn("_k", F.lit(True))
    every = candidates.filter(F.col("material_hash").isNotNull()).crossJoin(short(skills.select("skill_code", "skill_version"))).join(have, [*KEY, "skill_code"], "left")
    why = drift(F.col("material_hash"), F.col("_hash"), F.coalesce("_k", F.lit(False)), F.col("skill_version"), F.col("_v"), F.lit(prompt), F.col("_p"))
    due = every.withColumn("reason", why).filter(F.col("reason").isNotNull())
    chosen = due.select(*KEY, "members").distinct().orderBy(F.desc("members"), *KEY).limit(limit).select(*KEY)
    return due.join(F.broadcast(chosen), KEY, "left_semi").select(*KEY, "skill_code", "reason")


def embedding_upkeep(now: DataFrame, stored: DataFrame) -> DataFrame:
    """(type, uid, action): reused where the material is the same, updated, created, or purged where the entity is gone. Only
    created and updated ones need a vector."""
    old = stored.select(*KEY, F.col("material_hash").alias("_old"), F.lit(True).alias("_o"))
    both = now.select(*KEY, "material_hash", F.lit(True).alias("_n")).join(old, KEY, "full")
    return both.select(*KEY, F.when(F.col("_n").isNull(), "purged").when(F.col("_o").isNull(), "created").when(F.col("material_hash").eqNullSafe(F.col("_old")), "reused").otherwise("updated").alias("action"))


def reuse_rate(actions: DataFrame) -> DataFrame:
    n = lambda a: F.count_if(F.col("action") == a)
    return actions.agg(n("created").alias("created"), n("updated").alias("updated"), n("reused").alias("reused"), n("purged").alias("purged"), F.round(F.try_divide(n("reused"), n("created") + n("updated") + n("reused")), 6).alias("reuse_rate"))


def member_keywords(rows: DataFrame, n: int = 10) -> DataFrame:
    """(type, uid, keywords): each entity's most frequent member keywords, ties by name. rows: (type, uid, keyword)."""
    counts = rows.filter(F.trim("keyword") != "").groupBy(*KEY, "keyword").agg(F.count("*").alias("_n"))
    return first_of(counts, KEY, [F.desc("_n"), "keyword"], n, "keyword", "keywords")


def index_documents(entities: DataFrame, vectors: DataFrame, summaries: DataFrame, keywords: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of entities that have a vector, and the entities that are left out for want of one."""
    docs = entities.join(vectors, KEY).join(summaries, KEY, "left").join(keywords, KEY, "left")
    empty = F.array().cast("array<string>")
    return docs.withColumns({"summaries": F.coalesce("summaries", empty), "keywords": F.coalesce("keywords", empty)}), entities.join(vectors, KEY, "left_anti")


def new_entities(old: DataFrame, new: DataFrame) -> DataFrame:
    """(type, uid, assets): entities that edges of the pass bring in and no edge before it had, with how many assets each."""
    return new.select("asset_id", *KEY).distinct().groupBy(*KEY).agg(F.count("*").alias("assets")).join(old.select(*KEY).distinct(), KEY, "left_anti")


def asset_documents(assets: DataFrame, labels: DataFrame, vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Search documents of registered assets that have a vector: their columns with labels (sorted skill/label keys, maybe none), the vector of
    their first chunk and how many chunks they have; and the assets that are left out for want of one."""
    own = assets.filter(F.col("status") == "registered")
    first = vectors.groupBy("asset_id").agg(F.min_by("embedding", "chunk_index").alias("embedding"), F.count("*").alias("chunk_count"))
    named = labels.groupBy("asset_id").agg(F.array_sort(F.collect_set(F.concat_ws("/", "skill_code", "label_code"))).alias("labels"))
    docs = own.join(first, "asset_id").join(named, "asset_id", "left").withColumn("labels", F.coalesce("labels", F.array().cast("array<string>")))
    return docs, own.join(first, "asset_id", "left_anti")


def resync(docs: DataFrame, path: str, *, append: bool = False, least: int = 0) -> dict:
    """Publishes documents as the next version of the table at path, all of them or beside those there; fewer than least rows aren't
    accepted, and the version before stays. Sources are only read."""
    return versions.publish(docs, path, append=append, accept=lambda _, n: n >= least)


def bind(judged: DataFrame, registered: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """(edges to store, candidates to propose): in auto mode all judged names are stored, in propose mode the registered ones."""
    if mode not in ("propose", "auto"):
        raise ValueError("mode must be propose or auto")
    rows = split_registered(judged, registered)
    stored = F.lit(mode == "auto") | F.col("registered")
    return rows.filter(stored), rows.filter(~stored)


def binding_report(old: DataFrame, new: DataFrame, judged_assets: DataFrame) -> DataFrame:
    """Edges added and removed for the judged assets; assets bound, empty, and with fewer edges than before. See also new_entities."""
    k = ["asset_id", *KEY]
    before = old.join(judged_assets.select("asset_id").distinct(), "asset_id", "left_semi").select(*k).distinct().withColumn("_o", F.lit(1))
    both = before.join(new.select(*k).distinct().withColumn("_n", F.lit(1)), k, "full")
    per = both.groupBy("asset_id").agg(F.count("_o").alias("o"), F.count("_n").alias("n"), F.count_if(F.col("_o").isNull()).alias("a"), F.count_if(F.col("_n").isNull()).alias("r"))
    per = judged_assets.select("asset_id").distinct().join(per, "asset_id", "left").na.fill(0)
    return per.agg(F.sum("a").alias("added"), F.sum("r").alias("removed"), F.count_if(F.col("n") > 0).alias("bound"), F.count_if(F.col("n") == 0).alias("empty"), F.count_if((F.col("n") < F.col("o")) & (F.col("n") > 0)).alias("shrunk"))
