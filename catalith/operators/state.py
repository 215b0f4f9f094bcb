"""Keyed tables: upserts and replacements return new rows; the caller writes them to a new place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.functions.meta import merged

#: States that end an asset, those in which it is worked on, the reason of one that got stuck too often, the moves
#: allowed, and the names of lineage events.
TERMINAL = ("registered", "failed", "deferred")
UNDER_WAY = ("routing", "classifying", "extracting")
RESET_CAP = "reset_cap_exceeded"
MOVES = (
    ("received", "routing"), ("received", "failed"), ("routing", "classifying"), ("routing", "failed"), ("classifying", "extracting"), ("classifying", "deferred"),
    ("classifying", "failed"), ("extracting", "registered"), ("extracting", "failed"),
)
ACTIVITIES = ("received", "routing", "classifying", "classified", "deferred", "extracting", "registered", "failed", "reset")


def activity(state: Column) -> Column:
    return F.concat(F.lit("ingest."), state, F.lit(".v1"))


def ordered(name: str, kind: T.DataType) -> Column:
    """The column as something that has an order: a map as its sorted entries, a variant as JSON."""
    return F.array_sort(F.map_entries(name)) if isinstance(kind, T.MapType) else F.to_json(name) if isinstance(kind, T.VariantType) else F.col(name)


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key: the greatest in the order, of equal ones the greatest in all columns, so that the choice is the same in every run.
    Rows with a null in a key are left out; they can't be found again."""
    rest = [c for c in rows.columns if c not in keys]
    by = F.struct(*[F.col(c) for c in order], *[ordered(f.name, f.dataType).alias(f.name) for f in rows.schema if f.name in rest and f.name not in order])
    known = rows.filter(" and ".join(f"`{k}` is not null" for k in keys))
    return known.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_last")).select(*keys, "_last.*") if rest else known.select(*keys).distinct()


def upsert(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of delta in place of target's with the same keys, and new ones added; columns that delta lacks stay. Of rows of delta that share
    their keys the greatest in all columns counts; rows with a null in a key are passed over."""
    new = latest(delta, keys, []).select(*keys, *[F.col(c).alias(f"_new_{c}") for c in delta.columns if c not in keys], F.lit(True).alias("_hit"))
    both = target.join(new, keys, "full")
    return both.select(*[c if c in keys or c not in delta.columns else F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in target.columns])


def replace_partition(target: DataFrame, new: DataFrame, keys: list[str], of: DataFrame | None = None) -> DataFrame:
    """All of target's rows with keys in `of` (default: in new) give way to new's."""
    return target.join((of if of is not None else new).select(*keys).distinct(), keys, "left_anti").unionByName(new)


def merge_meta(target: DataFrame, updates: DataFrame, key: str, column: str, removed: list[str] | None = None) -> DataFrame:
    """The map column of rows that have updates: keys overwritten, removed ones gone, the rest kept. Of updates that share a key the
    greatest in all columns counts."""
    new = latest(updates, [key], []).select(key, F.col(column).alias("_new"))
    return target.join(new, key, "left").withColumn(column, F.when(F.col("_new").isNotNull(), merged(F.col(column), F.col("_new"), removed)).otherwise(F.col(column))).drop("_new")


def finalize(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metadata rows and embedding rows of the records that are extracting: (asset_id, core_meta, ext_meta, tags) and
    (asset_id, channel, chunk_index, embedding). A record without embeddings has metadata only."""
    ready = records.filter(F.col("status") == "extracting")
    rows = ready.select("asset_id", F.explode("embeddings").alias("e"))
    return ready.select("asset_id", "core_meta", "ext_meta", "tags"), rows.select("asset_id", "e.channel", "e.chunk_index", "e.embedding")


def facet_keys(assets: DataFrame, labels: DataFrame, unassigned: str = "unassigned") -> DataFrame:
    """(asset_id, facets): sorted skill/label keys of all skills; unassigned isn't one, and none is an empty list."""
    own = labels.filter(F.col("label_code") != unassigned).groupBy("asset_id").agg(F.sort_array(F.collect_set(F.concat_ws("/", "skill_code", "label_code"))).alias("facets"))
    return assets.select("asset_id").distinct().join(own, "asset_id", "left").select("asset_id", F.coalesce("facets", F.array().cast("array<string>")).alias("facets"))


def moves(spark) -> DataFrame:
    return spark.createDataFrame(MOVES, "state string, next string")


def transitions(events: DataFrame, *, key: str = "asset_id", state: str = "state", order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """events with previous and legal: whether the move is allowed. A first event must be received."""
    w = Window.partitionBy(key).orderBy(*order)
    rows = events.withColumn("previous", F.lag(state).over(w))
    allowed = F.array(*[F.lit(f"{a}>{b}") for a, b in MOVES])
    return rows.withColumn("legal", F.when(F.col("previous").isNull(), F.col(state) == "received").otherwise(F.array_contains(allowed, F.concat_ws(">", "previous", state))))


def claims(events: DataFrame, *, key: str = "asset_id", before: str = "previous", order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """events with won: of those that leave the same state of the same asset, the first one wins; the others lost the race."""
    return events.withColumn("won", F.row_number().over(Window.partitionBy(key, before).orderBy(*order)) == 1)


def failure_counts(events: DataFrame, key: str = "asset_id") -> DataFrame:
    """failures, and attempts at recovery: failures and resets."""
    return events.groupBy(key).agg(F.count_if(F.col("state") == "failed").alias("failures"), F.count_if(F.col("state").isin("failed", "reset")).alias("attempts"))


def received_batch(assets: DataFrame, limit: int) -> DataFrame:
    """The next received assets, first in first out."""
    return assets.filter(F.col("status") == "received").orderBy("created_at", "asset_id").limit(limit)


def stuck(assets: DataFrame, now: Column, older_than_s: int, limit: int | None = None) -> DataFrame:
    """Assets that are under way since more than so many seconds without a change, oldest first. One that is received waits for its turn
    and isn't stuck."""
    rows = assets.filter(F.col("status").isin(*UNDER_WAY) & (F.col("updated_at") < now - F.make_dt_interval(secs=F.lit(older_than_s)))).orderBy("updated_at", "asset_id")
    return rows.limit(limit) if limit is not None else rows


def reset_stuck(rows: DataFrame, events: DataFrame, cap: int) -> DataFrame:
    """What becomes of stuck assets: with cap attempts before, failed with reset_cap_exceeded; else received again with a reset event."""
    attempts = failure_counts(events).select("asset_id", "attempts")
    over = F.coalesce("attempts", F.lit(0)) >= cap
    return rows.join(attempts, "asset_id", "left").select("asset_id", F.coalesce("attempts", F.lit(0)).cast("long").alias("attempts"), F.when(over, "failed").otherwise("received").alias("status"), F.when(over, RESET_CAP).alias("status_reason"), (~over).alias("reset_event"))


def capped_failures(events: DataFrame, cap: int) -> DataFrame:
    """Failures with their number so far, counted after they are recorded, and what follows: failed from the cap on, else retry."""
    w = Window.partitionBy("asset_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = events.filter(F.col("state") == "failed").withColumn("n", F.count("*").over(w))
    return rows.withColumn("action", F.when(F.col("n") >= cap, "failed").otherwise("retry"))


def outcome_report(assets: DataFrame, outcomes: list[str], column: str = "outcome") -> DataFrame:
    """One row with a count for each outcome, 0 where there is none."""
    return assets.agg(*[F.count_if(F.col(column) == o).alias(o) for o in outcomes])


def unresolved(assets: DataFrame, resolution: DataFrame) -> DataFrame:
    """Registered assets whose resolution is pending or was never tried, fewest attempts first, then oldest."""
    rows = assets.filter(F.col("status") == "registered").join(resolution.select("asset_id", F.col("status").alias("resolution"), "attempts"), "asset_id", "left")
    return rows.filter(F.col("resolution").isNull() | (F.col("resolution") == "pending")).withColumn("attempts", F.coalesce("attempts", F.lit(0))).orderBy("attempts", "created_at", "asset_id")


def resolve(state: DataFrame, results: DataFrame, most: int) -> DataFrame:
    """State after a pass. results: (asset_id, edges, error). Edges: resolved; none: isolated, attempts kept; an error: one
    attempt more, failed at the most, else pending. Others stay."""
    both = state.join(results.withColumn("_hit", F.lit(True)), "asset_id", "full")
    had = F.coalesce(F.col("attempts"), F.lit(0))
    bad = F.col("error").isNotNull()
    status = F.when(F.col("_hit").isNull(), F.col("status")).when(bad, F.when(had + 1 >= most, "failed").otherwise("pending")).when(F.col("edges") > 0, "resolved").otherwise("isolated")
    reason = F.when(F.col("_hit").isNull(), F.col("last_reason")).when(bad, F.col("error")).when(F.col("edges") > 0, F.lit(None).cast("string")).otherwise("no_edges")
    return both.select("asset_id", status.alias("status"), (had + F.when(bad & F.col("_hit").isNotNull(), 1).otherwise(0)).alias("attempts"), reason.alias("last_reason"))
