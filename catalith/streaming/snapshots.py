"""Micro-batches merged into a bucketed snapshot: a batch that is run again changes nothing, untouched buckets aren't written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.operators.state import latest, ordered
from catalith.sources import versions
from catalith.sources.numbering import written

BUCKET = "_bucket"


def _place(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def reached(rows: DataFrame, path: str, keys: list[str]) -> DataFrame | None:
    """The snapshot's rows in the buckets that the keys of rows fall into; nothing where there is no snapshot yet."""
    now = versions.manifest(rows.sparkSession, path)
    if now is None:
        return None
    places = [str(r[0]) for r in rows.select(_place(keys, now["buckets"])).distinct().collect()]  # as many as there are buckets, at most
    schema = T.StructType.fromJson(now["schema"])
    return versions.of_folders(rows.sparkSession, path, schema, [now["folders"][p] for p in places if p in now["folders"]])


def merge(
    delta: DataFrame, path: str, keys: list[str], *, order: list[str] | None = None, insert: bool = True, schema: T.StructType | None = None, gone: Column | None = None,
    buckets: int = 16, files: int = 1, stream: str | None = None, batch: int | None = None, notes: dict | None = None,
) -> dict:
    """Rows of delta in place of the snapshot's with the same keys, and new ones added (insert=False: none is added); returns the manifest.

    Columns that delta lacks keep their value (null in a new row). With an order, a row gives way only to one that is greater in it, so late and
    repeated deliveries change nothing; of rows of delta that share a key the latest counts. A snapshot is kept in buckets by a hash of the keys: only buckets
    that the delta's keys fall into are read, and only those in which a row really changes are written, to new folders; all others stay
    as they are. The manifest, made last, carries the last batch of each stream: a batch at or before it is passed over, so
    running a batch again, in whole or after a crash half way, changes nothing. files: parts a bucket is written in. gone: rows of which this
    holds are left out of the buckets that are written.
    """
    spark = delta.sparkSession
    now = versions.manifest(spark, path)
    if now and stream is not None and now["batches"].get(stream, -1) >= batch:
        return now
    schema = T.StructType.fromJson(now["schema"]) if now else schema or delta.schema
    buckets = now["buckets"] if now else buckets
    names = schema.fieldNames()
    given = [c for c in names if c in delta.columns and c not in keys]
    place = _place(keys, buckets)
    types = {f.name: f.dataType for f in schema}
    new = latest(delta.select(*[F.col(c).cast(types[c]) for c in names if c in delta.columns]), keys, order or [])
    new = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in given], place.alias(BUCKET)).persist()
    try:
        reached = [r[0] for r in new.select(BUCKET).distinct().collect()]  # as many as there are buckets, at most
        folders = now["folders"] if now else {}
        held = versions.of_folders(spark, path, schema, [folders[str(b)] for b in reached if str(b) in folders])
        both = held.withColumn("_old", F.lit(True)).join(new.withColumn("_hit", F.lit(True)), keys, "full" if insert else "left")
        differs = F.lit(False)
        for c in given:
            differs = differs | ~ordered(c, types[c]).eqNullSafe(ordered(f"_new_{c}", types[c]))
        if order:
            differs = differs & (F.struct(*[f"_new_{c}" for c in order]) > F.struct(*order))
        takes = F.col("_hit").isNotNull() & (F.col("_old").isNull() | differs)
        both = both.select(*keys, *[c for c in names if c not in keys], *[f"_new_{c}" for c in given], F.coalesce(takes, F.lit(False)).alias("_takes"), place.alias(BUCKET)).persist()
        changed = sorted(r[0] for r in both.filter("_takes").select(BUCKET).distinct().collect())
        made = dict(now) if now else {"schema": schema.jsonValue(), "buckets": buckets, "keys": keys, "folders": {}, "rows": {}, "batches": {}}
        if changed:
            out = both.filter(F.col(BUCKET).isin(changed)).select(BUCKET, *[F.when(F.col("_takes"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c) for c in names])
            if gone is not None:
                out = out.filter(~F.coalesce(gone, F.lit(False)))
            name = f"data/{uuid.uuid4().hex}"
            out.repartition(len(changed) * files, BUCKET, F.pmod(F.xxhash64(*keys), F.lit(files * 31)) % files).write.partitionBy(BUCKET).parquet(f"{path}/{name}")
            left = {r[0] for r in out.select(BUCKET).distinct().collect()} if gone is not None else changed
            made["folders"] = {b: f for b, f in made["folders"].items() if int(b) not in changed} | {str(b): f"{name}/{BUCKET}={b}" for b in changed if b in left}
        both.unpersist()
    finally:
        new.unpersist()
    made["written"] = changed
    if stream is not None:
        made["batches"] = made["batches"] | {stream: batch}
    if notes:
        made["notes"] = made.get("notes", {}) | notes
    if now and not changed and stream is None and not notes:
        return now
    return versions.commit(spark, path, made, now)


def follow(stream: DataFrame, checkpoint: str, name: str, steps: Callable[[DataFrame, int], None]) -> None:
    """Runs steps (frame, number of the batch) on what is there now, batch after batch, until nothing is left; name is the stream's in ledgers."""

    def one(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            steps(df, number)
        finally:
            df.unpersist()

    stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(one).start().awaitTermination()


def record_classifications(results: DataFrame, classified: str, assets: str, *, stream: str | None = None, batch: int | None = None) -> None:
    """Results (asset_id, label, confidence and what else) merged by asset into the snapshot of classifications, and label and confidence mirrored onto
    assets that are known. Both snapshots have the batch in their ledgers; after a crash between the two the first is passed over.
    Results are made once and written, not again for each of the two."""
    results = written(results, "results")
    merge(results, classified, ["asset_id"], stream=stream, batch=batch)
    mirror = results.select("asset_id", F.col("label").alias("domain_label"), F.col("confidence").alias("domain_confidence"))
    merge(mirror, assets, ["asset_id"], insert=False, stream=stream, batch=batch)


def stamped(topics: DataFrame, policy: str, now: Column, by: str = "hybrid") -> DataFrame:
    """Topics with who decided them, by which policy and when; the values of a row that had them give way."""
    return topics.withColumns({"decided_by": F.lit(by), "policy_version": F.lit(policy), "updated_at": now.cast("timestamp")})
