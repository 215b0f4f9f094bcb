"""Positions of rows in an order, and values by their rank, without a sort of all rows in one task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.sources.folders import fresh

#: Ranges a span of values is cut into in each round of a selection.
RANGES = 1024


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read from a table in the shared folder: what comes after doesn't compute them again."""
    at = fresh(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def short(rows: DataFrame, most: int = 10_000) -> DataFrame:
    """rows, marked for a broadcast where they are at most so many; a longer list takes what Spark chooses."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def in_order(df: DataFrame, order: list[Column], out: str = "pos") -> DataFrame:
    """df with out: the row's number from 0. Ranges of rows are sorted each by itself; a range starts where the counts of those
    before it end. Rows that are equal in the order are numbered in any order."""
    dealt = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ordered")
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a range
    starts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", before.alias("_start"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)).cast("long") - 1
    return dealt.withColumn(out, within).join(starts, "_part").withColumn(out, F.col(out) + F.col("_start")).drop("_part", "_start")


def by_rank(rows: DataFrame, value: str, rank: Column, groups: list[str] | None = None) -> DataFrame:
    """(groups, n, least, greatest, chosen): the element of the sorted values of each group at rank, an expression over n, from 0.

    Equal values are counted first. Then each group's span is cut into RANGES ranges, counts of ranges say which of them holds the
    rank, and the span becomes the least and greatest value in it; after a few rounds it is one value. A task never holds a group's values,
    only counts of ranges. For numbers; nulls and NaN don't count; a group without values gives no row.
    """
    keys = list(groups or [])
    v = F.col(value)
    counts = rows.filter(v.isNotNull() & ~F.isnan(v.cast("double"))).groupBy(*keys, v.alias("_v")).agg(F.count("*").alias("_c"))
    counts = written(counts.withColumn("_g", F.struct(*keys) if keys else F.struct(F.lit(0).alias("one"))), "counted")
    spans = counts.groupBy("_g").agg(F.sum("_c").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("greatest"))
    state = written(spans.withColumns({"_k": rank.cast("long"), "_low": F.col("least"), "_high": F.col("greatest")}), "span")
    while state.filter("_low < _high").limit(1).count():
        # Halves keep differences of doubles finite; the order of values is kept by each step.
        x, low, high = (F.greatest(F.least(F.col(c).cast("double"), F.lit(1.7e308)), F.lit(-1.7e308)) / 2 for c in ("_v", "_low", "_high"))
        open_ = counts.join(state.filter("_low < _high"), "_g").filter((F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))
        # The ends of a span are in ranges of their own, so every round leaves less, also where doubles can't tell long integers apart.
        place = F.when(F.col("_v") == F.col("_low"), -1).when(F.col("_v") == F.col("_high"), RANGES).otherwise(F.least(F.floor(F.coalesce(F.try_divide(x - low, high - low), F.lit(0.0)) * RANGES), F.lit(RANGES - 1)))
        cut = open_.groupBy("_g", "_k", place.alias("_p")).agg(F.sum("_c").alias("_c"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        w = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        run = cut.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
        hit = run.filter((F.col("_k") >= F.col("_before")) & (F.col("_k") < F.col("_before") + F.col("_c")))
        hit = hit.select("_g", (F.col("_k") - F.col("_before")).alias("_k2"), "_a", "_b")
        new = state.join(hit, "_g", "left")
        state = written(new.select("_g", "n", "least", "greatest", F.coalesce("_k2", "_k").alias("_k"), F.coalesce("_a", "_low").alias("_low"), F.coalesce("_b", "_high").alias("_high")), "span")
    return state.select(*[F.col(f"_g.{k}").alias(k) for k in keys], "n", "least", "greatest", F.col("_low").alias("chosen"))


def spread(ones: np.ndarray, n: int, parts: int) -> list[int]:
    """parts masks over the bits that vary (ones of n rows have each bit set), with about the same entropy: bits are dealt, the most
    varying first, to the mask that has least so far. No two masks share a bit; a mask may be empty."""
    p = np.clip(np.asarray(ones, float) / max(n, 1), 0, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = np.nan_to_num(-p * np.log2(p) - (1 - p) * np.log2(1 - p))
    masks, held = [0] * parts, [0.0] * parts
    for bit in np.argsort(-entropy, kind="stable").tolist():
        if entropy[bit] > 0:
            least = min(range(parts), key=held.__getitem__)
            masks[least] |= 1 << bit
            held[least] += float(entropy[bit])
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def masks_of(parts: int, most: int) -> Column:
    """A column function of (n, ones): masks for a cell of more than most rows of which enough bits vary, else none."""

    @F.pandas_udf("array<long>")
    def made(n: pd.Series, ones: pd.Series) -> pd.Series:
        out = [spread(o, int(k), parts) if k > most else [] for k, o in zip(n, ones, strict=True)]
        return pd.Series([m if m and all(m) else [] for m in out])

    return made
