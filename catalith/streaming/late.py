"""Each key once within a delay by event time; rows that come too late go to a table of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.sources import versions
from catalith.streaming import snapshots


def mark_of(seen: dict | None) -> int | None:
    """The watermark in microseconds that a batch finds: the greatest event time of batches before it less the delay."""
    return (seen or {}).get("notes", {}).get("mark")


def take_once(df: DataFrame, number: int, at: str, *, key: str, ts: str = "ts", delay_s: int, name: str = "once", buckets: int = 16) -> None:
    """One micro-batch, for follow: rows whose key hasn't been taken go to at/taken, those at or behind the watermark to at/late.

    The watermark is the greatest event time of the batches before less the delay, as in a stream's own watermark; it stands in the
    manifest of the keys seen, so a batch that is run again finds the one it had. Of rows of a new key in a batch the earliest counts, of equal
    times the least in all columns. A key is remembered until the watermark is delay_s behind its row's time or later, so a row on time always meets
    its copies. Rows with a null time or key go to at/late. Outputs are folders by batch, overwritten when a batch is run again.
    """
    spark = df.sparkSession
    before = versions.manifest(spark, f"{at}/seen")
    if before and before["batches"].get(name, -1) >= number:
        return
    mark = mark_of(before)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    on_time = known if mark is None else known & (micros > mark)
    df.filter(~F.coalesce(on_time, F.lit(False))).write.mode("overwrite").parquet(f"{at}/late/batch={number}")
    rest = [c for c in df.columns if c != key]
    first = df.filter(on_time).groupBy(key).agg(F.min(F.struct(ts, *[c for c in rest if c != ts])).alias("_row")).select(key, "_row.*").select(*df.columns)
    until = (F.unix_micros(F.col(ts).cast("timestamp")) + delay_s * 1_000_000).alias("until")
    old = F.col("until") <= F.lit(-(1 << 62) if mark is None else mark)
    held = snapshots.reached(first, f"{at}/seen", [key])
    fresh = first if held is None else first.join(held.filter(~old).select(key), key, "left_anti").select(*df.columns)
    fresh.write.mode("overwrite").parquet(f"{at}/taken/batch={number}")
    taken = spark.read.schema(df.schema).parquet(f"{at}/taken/batch={number}")
    top = df.agg(F.max(micros)).first()[0]
    new = max(x for x in (mark, None if top is None else top // 1000 * 1000 - delay_s * 1_000_000) if x is not None) if (mark, top) != (None, None) else None
    snapshots.merge(taken.select(key, until), f"{at}/seen", [key], order=["until"], gone=old, buckets=buckets, stream=name, batch=number, notes={"mark": new})
