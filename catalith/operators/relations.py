"""Relations between assets: candidates, scores, decisions, edges."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalith.functions.meta import base_name, malformed
from catalith.functions.scores import canonical, clamped, cosine, edge_status, finite, norm, verdict


def pair_scores(pairs: DataFrame, embeddings: DataFrame) -> DataFrame:
    """pairs (src, dst) with score: the best cosine of two chunks in the same channel; 0.0 where there is none."""
    e = embeddings.select("asset_id", "channel", "chunk_index", "embedding")
    a = e.toDF("src", "channel", "_i", "_a")
    b = e.toDF("dst", "channel", "_j", "_b")
    scored = pairs.select("src", "dst").distinct().join(a, "src").join(b, ["dst", "channel"]).withColumn("score", cosine(F.col("_a"), F.col("_b")))
    best = scored.groupBy("src", "dst").agg(F.max("score").alias("score"))
    return pairs.join(best, ["src", "dst"], "left").withColumn("score", finite(F.col("score")))


def nearest(queries: DataFrame, corpus: DataFrame, k: int, *, least: float = -1.0, within: str | None = None, block_rows: int = 4096, key: str = "id", vector: str = "embedding") -> DataFrame:
    """(query, id, similarity[, within]) of the k nearest corpus rows of each query, exactly: similarity from least on, ties by
    the smaller id; vectors of length 0 take no part, nor does a row answer itself.

    Queries and corpus are dealt into blocks of about block_rows, by their counts; each two of them meet in one task as a
    product of two matrices that keeps k rows a query, and the block winners are ranked again. A task holds two blocks,
    whatever the tables' sizes; with few queries, which are one block, the corpus moves once.
    within: a column whose values are ranked each by itself (pre-filtered, so a rare one isn't crowded out)."""
    group = within or "_all"
    side = lambda df, name: df.select(F.col(key).alias(name), (F.col(within).cast("string") if within else F.lit("")).alias(group), F.col(vector)).filter(norm(F.col(vector)) > 0)
    asked, held = (max(1, -(-df.count() // block_rows)) for df in (queries, corpus))
    q = side(queries, "query").drop(group).withColumn("_q", F.pmod(F.xxhash64("query"), F.lit(asked)).cast("int"))
    q = q.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(held - 1))))
    c = side(corpus, "id").withColumn("_c", F.pmod(F.xxhash64("id"), F.lit(held)).cast("int"))  # keys of both sides have one type, or they hash apart
    c = c.withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(asked - 1))))

    def unit(x: pd.Series) -> np.ndarray:
        m = np.stack([np.asarray(v, float) for v in x])
        return m / np.linalg.norm(m, axis=1, keepdims=True)

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(left) and len(right):
            a = unit(left[vector])
            for value, part in right.groupby(group, sort=False):
                part = part.sort_values("id")
                b, ids = unit(part[vector]), part["id"].to_numpy()
                for i in range(0, len(a), 1024):
                    sims = np.round(a[i : i + 1024] @ b.T, 12)
                    sims[left["query"].to_numpy()[i : i + 1024, None] == ids[None]] = -np.inf
                    top = np.argsort(-sims, axis=1, kind="stable")[:, :k]
                    for row, cols in zip(range(len(sims)), top, strict=True):
                        s = sims[row, cols]
                        ok = np.isfinite(s) & (s >= least)
                        found += [(left["query"].iloc[i + row], x, value, y) for x, y in zip(ids[cols[ok]], s[ok], strict=True)]
        return pd.DataFrame(found, columns=["query", "id", group, "similarity"])

    kind = queries.schema[key].dataType.simpleString()
    local = q.groupBy("_q", "_c").cogroup(c.groupBy("_q", "_c")).applyInPandas(best, f"query {kind}, id {corpus.schema[key].dataType.simpleString()}, {group} string, similarity double")
    rank = F.row_number().over(Window.partitionBy("query", group).orderBy(F.desc("similarity"), "id"))
    out = local.withColumn("rank", rank).filter(F.col("rank") <= k)
    return out if within else out.drop(group)


def stem(path) -> F.Column:
    """A file's name in lower case without its extension, trailing number or copy mark."""
    return F.regexp_replace(F.regexp_replace(F.lower(base_name(path)), r"\.[^.]*$", ""), r"(?:[ _-]*(?:copy|\(\d+\)|\d+))+$", "")


def path_classes(assets: DataFrame) -> DataFrame:
    """(asset_id, class_id, links): each asset with the smallest id among those in its folder whose names have the same stem, and
    how many others these are. Any two assets of a class are candidates (with the score 0.0); a class stays a column of its
    members, as its pairs would grow with the square of a folder. An asset whose name has no stem is a class by itself."""
    where = [F.regexp_extract("fs_path", r"^(.*)/", 1).alias("_dir"), stem(F.col("fs_path")).alias("_stem")]
    keyed = assets.select("asset_id", *where)
    of = keyed.filter("_stem <> ''").groupBy("_dir", "_stem").agg(F.min("asset_id").alias("_first"), (F.count("*") - 1).alias("_n"))
    return keyed.join(of, ["_dir", "_stem"], "left").select("asset_id", F.coalesce("_first", "asset_id").alias("class_id"), F.coalesce("_n", F.lit(0)).alias("links"))


def path_candidates(sources: DataFrame, assets: DataFrame) -> DataFrame:
    """(src, dst, emb_score 0.0) of each source with its class's first asset, and with the first but one where it is that itself:
    one row a source at most. checked_edges takes the classes to allow the others."""
    classes = path_classes(assets)
    second = classes.filter("asset_id <> class_id").groupBy("class_id").agg(F.min("asset_id").alias("_second"))
    own = sources.select(F.col("asset_id").alias("src")).join(classes.filter("links > 0"), F.col("src") == F.col("asset_id")).join(second, "class_id")
    return own.select("src", F.when(F.col("src") == F.col("class_id"), F.col("_second")).otherwise(F.col("class_id")).alias("dst"), F.lit(0.0).alias("emb_score"))


def union_candidates(*candidates: DataFrame) -> DataFrame:
    """One row a pair; a measured score wins over the 0.0 that stands for none."""
    every = candidates[0]
    for c in candidates[1:]:
        every = every.unionByName(c)
    return every.groupBy("src", "dst").agg(F.max("emb_score").alias("emb_score"))


def block_candidates(sources: DataFrame, assets: DataFrame, block: str, limit: int = 10) -> DataFrame:
    """(src, dst) within the same block, registered, not the source itself, the first so many by id. Only the first limit + 1
    of a block can be among them, so a hot block stays short on its side of the join."""
    heads = assets.filter(F.col("status") == "registered").select(F.col("asset_id").alias("dst"), block)
    heads = heads.withColumn("_r", F.row_number().over(Window.partitionBy(block).orderBy("dst"))).filter(F.col("_r") <= limit + 1)
    pairs = sources.select(F.col("asset_id").alias("src"), block).join(heads, block).filter("src <> dst")
    return pairs.withColumn("_r", F.row_number().over(Window.partitionBy("src").orderBy("dst"))).filter(F.col("_r") <= limit).select("src", "dst")


def checked_edges(edges: DataFrame, allowed: DataFrame, kinds: DataFrame, uuid: bool = False, classes: DataFrame | None = None) -> DataFrame:
    """edges (src, dst, kind_code, ...) with skipped: malformed, self, no_kind, unknown_kind, not_allowed, or null for good ones.
    classes: (asset_id, class_id); an edge within a class is allowed too."""
    rows = edges.join(allowed.select("src", "dst").distinct().withColumn("_ok", F.lit(True)), ["src", "dst"], "left").join(kinds.select("kind_code").distinct().withColumn("_kind", F.lit(True)), "kind_code", "left")
    if classes is not None:
        one = classes.groupBy("asset_id").agg(F.min("class_id").alias("_class"))
        rows = rows.join(one.toDF("src", "_a"), "src", "left").join(one.toDF("dst", "_b"), "dst", "left")
        rows = rows.withColumn("_ok", F.when(F.col("_a") == F.col("_b"), True).otherwise(F.col("_ok"))).drop("_a", "_b")
    bad = malformed(F.col("dst").cast("string")) if uuid else F.col("dst").isNull()
    no_kind = F.trim(F.coalesce("kind_code", F.lit(""))) == ""
    reason = F.when(bad, "malformed").when(F.col("src") == F.col("dst"), "self").when(no_kind, "no_kind").when(F.col("_kind").isNull(), "unknown_kind").when(F.col("_ok").isNull(), "not_allowed")
    return rows.withColumn("skipped", reason).drop("_ok", "_kind")


def decide_edges(edges: DataFrame, scores: DataFrame, kinds: DataFrame, *, least: float = 0.7, least_similarity: float = 0.0, floor: float | None = None, never_active: tuple[str, ...] = ()) -> DataFrame:
    """edges in canonical direction with confidence clamped and status active or proposed. floor: similarities under it aren't
    kept; never_active: kinds that always stay proposed."""
    rows = edges.join(scores.select("src", "dst", "emb_score"), ["src", "dst"], "left").join(kinds.select("kind_code", "is_symmetric"), "kind_code")
    if floor is not None:
        rows = rows.filter(F.coalesce("emb_score", F.lit(0.0)) >= floor)
    a, b = canonical(F.col("src"), F.col("dst"), F.col("is_symmetric"))
    conf = clamped(F.col("confidence"))
    status = F.when(F.col("kind_code").isin(*never_active), "proposed").otherwise(edge_status(conf, F.col("emb_score"), least, least_similarity)) if never_active else edge_status(conf, F.col("emb_score"), least, least_similarity)
    return rows.select(a.alias("src"), b.alias("dst"), "kind_code", conf.alias("confidence"), "reason", "emb_score", status.alias("status"))


def upsert_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    """Edges (src, dst, kind_code, confidence, reason, status) after an upsert: a status that is there stays, confidence is the
    greater, the reason changes with a strictly greater confidence only. Among new rows of one edge the greatest confidence
    counts, then the smallest reason."""
    one = new.groupBy("src", "dst", "kind_code").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "reason", "status")).alias("n"))
    both = old.join(one, ["src", "dst", "kind_code"], "full")
    c = -F.col("n.c")
    wins = F.col("confidence").isNull() | (c > F.col("confidence"))
    return both.select("src", "dst", "kind_code", F.coalesce(F.greatest("confidence", c), "confidence").alias("confidence"), F.when(F.col("n").isNotNull() & wins, F.col("n.reason")).otherwise(F.col("reason")).alias("reason"), F.coalesce("status", F.col("n.status")).alias("status"))


def edge_lineage(edges: DataFrame, kind: str = "relation.resolved.v1") -> DataFrame:
    """One event a source with its targets in order."""
    return edges.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("dst", "kind_code"))).alias("targets")).withColumn("activity", F.lit(kind))


def relation_pass(candidates: Callable[[], DataFrame], score: Callable[[DataFrame], DataFrame], decide: Callable[[DataFrame], DataFrame], persist: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Four slots, each from frames to a frame; deciding is pure."""
    return candidates().transform(score).transform(decide).transform(persist)


def decide_by_score(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    return scored.withColumn("verdict", verdict(F.col("score"), threshold))


def match_count(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("src").agg(F.count_if(F.col("verdict") == "match").alias("matches"), F.count("*").alias("candidates"))


def by_domain(assets: DataFrame, wirings: dict[str, Callable[[DataFrame], DataFrame]], default: str = "general") -> DataFrame:
    """Assets through the pass of their domain; labels without one take the default's. One branch a wiring, not one an asset."""
    label = F.coalesce(F.when(F.col("domain_label").isin(*wirings), F.col("domain_label")), F.lit(default))
    outs = [wiring(assets.filter(label == name)) for name, wiring in wirings.items()]
    every = outs[0]
    for out in outs[1:]:
        every = every.unionByName(out)
    return every
