"""Duplicates: leaders by content hash, and near duplicates along a sequence."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.sources.numbering import in_order, masks_of, written

#: States at whose end an asset's content is kept.
SETTLED = ("registered", "deferred")

#: Fingerprints that meet each other in one cell, at most, unless they can't be told apart by more bits.
HOT = 256


def with_leader(assets: DataFrame, *, order: tuple[str, ...] = ("created_at", "asset_id")) -> DataFrame:
    """assets with leader (of the assets with the same hash the earliest that is registered or deferred, else the earliest that
    is in flight) and copy (whether another one leads). What is registered, deferred or failed is at its end and never a copy; failed assets lead
    nothing, so the next copy takes their place; a null hash has no copies. One grouped minimum and a join: a hot hash is
    united before it is shuffled."""
    flies = ~F.col("status").isin(*SETTLED)
    lead = assets.filter(F.col("file_hash").isNotNull() & (F.col("status") != "failed")).groupBy("file_hash").agg(F.min(F.struct(flies.alias("_flies"), *order)).alias("_lead"))
    out = assets.join(lead.select("file_hash", F.col(f"_lead.{order[-1]}").alias("leader")), "file_hash", "left")
    return out.withColumn("copy", F.col("leader").isNotNull() & (F.col("leader") != F.col(order[-1])) & ~F.col("status").isin(*SETTLED, "failed"))


def defer_copies(assets: DataFrame) -> DataFrame:
    """Copies become deferred with reason duplicate_content:<leader> and lose their hash; all else stays."""
    rows = with_leader(assets)
    return rows.select(
        *[c for c in assets.columns if c not in ("status", "file_hash", "status_reason")],
        F.when(F.col("copy"), "deferred").otherwise(F.col("status")).alias("status"),
        F.when(F.col("copy"), F.concat(F.lit("duplicate_content:"), F.col("leader").cast("string"))).otherwise(F.col("status_reason") if "status_reason" in assets.columns else F.lit(None).cast("string")).alias("status_reason"),
        F.when(~F.col("copy"), F.col("file_hash")).alias("file_hash"),
    )


def suppress_sequence(frames: DataFrame, *, group: str, order: str, bits: str, vector: str, third: str, mode: str = "recent", window: int = 4, hash_max: int = 7, near: float = 0.94, grey: float = 0.90, third_near: float = 0.97, cap: int | None = None, cap_first: bool = False) -> DataFrame:
    """frames with kept and reason (similar, third, cap or null), frame by frame in order within each group.

    A frame is compared with the kept ones: the last, the last window (recent), or all (global). Those within hash_max bits
    are candidates. The best cosine of vectors from near on drops the frame; from grey on, the best cosine of third from
    third_near on drops it too. The first frame always stays. cap: so many frames a group at most, applied before the
    comparison (cap_first) or to what it kept. A frame depends on all kept ones before it, so a group is one task's work.
    """
    rule = _rule(mode, window, hash_max, near, grey, third_near)

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable").reset_index(drop=True)
        kept, reason = np.ones(len(rows), bool), np.full(len(rows), None, object)
        if cap is not None and cap_first:
            kept[cap:], reason[cap:] = False, "cap"
        rule(rows[bits], rows[vector], rows[third], [], kept, reason)
        if cap is not None and not cap_first:
            over = np.flatnonzero(kept)[cap:]
            kept[over], reason[over] = False, "cap"
        return rows.assign(kept=kept, reason=reason)

    return frames.groupBy(group).applyInPandas(walk, T.StructType([*frames.schema.fields, T.StructField("kept", T.BooleanType()), T.StructField("reason", T.StringType())]))


def _unit(x) -> np.ndarray:
    a = np.asarray(x, float)
    n = np.sqrt(a @ a)
    return a / n if n > 0 and np.isfinite(n) else np.zeros_like(a)


def _rule(mode: str, window: int, hash_max: int, near: float, grey: float, third_near: float):
    """A walk over frames in order that goes on from held frames (bits, unit vector, unit third), sets kept and reason of the frames that
    kept has, and gives the frames held at its end."""
    if mode not in ("recent", "last", "global"):
        raise ValueError("mode must be recent, last or global")
    if hash_max < 0 or window < 1 or not 0 <= grey <= near <= 1 or not 0 <= third_near <= 1:
        raise ValueError("thresholds out of range")
    span = {"last": 1, "recent": window, "global": None}[mode]

    def walk(bits, vectors, thirds, held: list, kept: np.ndarray, reason: np.ndarray) -> list:
        for i in np.flatnonzero(kept):
            own = int(bits[i]), _unit(vectors[i]), _unit(thirds[i])
            against = held if span is None else held[-span:]
            found = [x for x in against if ((own[0] ^ x[0]) & 0xFFFFFFFFFFFFFFFF).bit_count() <= hash_max]
            best = max((float(own[1] @ x[1]) for x in found), default=-1.0)
            if found and best >= near:
                kept[i], reason[i] = False, "similar"
            elif found and best >= grey and max(float(own[2] @ x[2]) for x in found) >= third_near:
                kept[i], reason[i] = False, "third"
            else:
                held.append(own)
        return held if span is None else held[-span:]

    return walk


HELD = "array<struct<bits:bigint,vector:array<double>,third:array<double>>>"


def suppress_long(frames: DataFrame, *, group: str, order: str, bits: str, vector: str, third: str, mode: str = "recent", window: int = 4, hash_max: int = 7, near: float = 0.94, grey: float = 0.90, third_near: float = 0.97, cap: int | None = None, cap_first: bool = False, block_rows: int = 10_000) -> DataFrame:
    """The same as suppress_sequence for modes last and recent, but a long sequence is many tasks' work. For orders without ties.

    Frames are numbered in their order and dealt into blocks of neighbours. A block's walk depends on what came before only by the frames
    held at its start, one or window of them. In the first round all blocks start from none; then each starts from what the
    block before it held at its end, and blocks whose start has changed are walked again until no start changes. The first n
    blocks of a sequence are right after n rounds; as a block of unlike frames forgets its start, it mostly takes two. Caps count the
    frames, or the kept ones, of the blocks before. A null group is a group.
    """
    if mode == "global":
        raise ValueError("a walk against all kept frames has no bounded start; use suppress_sequence")
    rule = _rule(mode, window, hash_max, near, grey, third_near)
    whole = F.struct(*[F.col(f"`{c}`") for c in frames.columns])
    own = frames.select(whole.alias("_row"), F.col(group).alias("_g"), F.col(order).alias("_o"), F.col(bits).cast("long").alias("_b"), F.col(vector).cast("array<double>").alias("_v"), F.col(third).cast("array<double>").alias("_t"))
    own = in_order(own, [F.col("_g").asc_nulls_first(), F.col("_o").asc_nulls_first()], "_pos").withColumn("_block", F.floor(F.col("_pos") / block_rows))
    own = own.withColumn("_block", F.concat_ws(" ", F.col("_block").cast("string"), F.to_json(F.struct("_g"))))  # groups that meet in a block are apart
    starts = written(own.groupBy("_g").agg(F.min("_pos").alias("_first")), "starts")
    own = own.join(starts.withColumnRenamed("_g", "_of"), F.col("_g").eqNullSafe(F.col("_of"))).withColumn("_in", F.col("_pos") - F.col("_first")).drop("_of", "_first")
    if cap is not None and cap_first:
        own = own.withColumn("_open", F.col("_in") < cap)
    else:
        own = own.withColumn("_open", F.lit(True))
    own = written(own, "frames")
    blocks = own.groupBy("_block", "_g").agg(F.min("_pos").alias("_at"))
    blocks = written(blocks.withColumn("_before", F.lag("_block").over(Window.partitionBy("_g").orderBy("_at"))), "blocks")

    def walked(rows: pd.DataFrame, start: pd.DataFrame) -> tuple[pd.DataFrame, list]:
        rows = rows.sort_values("_pos", kind="stable").reset_index(drop=True)
        kept, reason = rows["_open"].to_numpy(bool).copy(), np.where(rows["_open"], None, "cap").astype(object)
        first = start["_start"].iloc[0] if len(start) else None
        held = [(x["bits"], np.asarray(x["vector"], float), np.asarray(x["third"], float)) for x in (first if first is not None else [])]
        held = rule(rows["_b"], rows["_v"], rows["_t"], held, kept, reason)
        return rows.assign(kept=kept, reason=reason), held

    def ends(rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(start):
            return pd.DataFrame({"_block": [], "_end": []})
        _, held = walked(rows, start)
        return pd.DataFrame({"_block": [rows["_block"].iloc[0]], "_end": [[{"bits": b, "vector": v.tolist(), "third": t.tolist()} for b, v, t in held]]})

    def flagged(rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        return walked(rows, start)[0][["_row", "_block", "_in", "_pos", "kept", "reason"]]

    now = written(blocks.select("_block", F.array().cast(HELD).alias("_start")), "starts")
    end = None
    while True:
        due = now if end is None else changed
        made = own.join(due.select("_block"), "_block", "left_semi").groupBy("_block").cogroup(due.groupBy("_block")).applyInPandas(ends, f"_block string, _end {HELD}")
        end = written(made if end is None else end.join(due.select("_block"), "_block", "left_anti").unionByName(made), "ends")
        new = blocks.join(end.withColumnRenamed("_block", "_before"), "_before", "left").select("_block", F.coalesce("_end", F.array().cast(HELD)).alias("_new"))
        both = written(now.join(new, "_block").withColumn("_moved", ~F.col("_start").eqNullSafe(F.col("_new"))), "moved")
        changed = both.filter("_moved").select("_block", F.col("_new").alias("_start"))
        now = both.select("_block", F.col("_new").alias("_start"))
        if not changed.limit(1).count():
            break
    fields = [own.schema[c] for c in ("_row", "_block", "_in", "_pos")] + [T.StructField("kept", T.BooleanType()), T.StructField("reason", T.StringType())]
    out = own.groupBy("_block").cogroup(now.groupBy("_block")).applyInPandas(flagged, T.StructType(fields))
    if cap is not None and not cap_first:
        out = written(out, "kept")
        counts = out.groupBy("_block").agg(F.count_if("kept").alias("_n"))
        w = Window.partitionBy("_g").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        before = blocks.join(counts, "_block").select("_block", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_had"))
        number = F.count_if("kept").over(Window.partitionBy("_block").orderBy("_pos")) + F.col("_had")
        over = F.col("kept") & (F.col("_number") > cap)
        out = out.join(before, "_block").withColumn("_number", number).withColumns({"reason": F.when(over, "cap").otherwise(F.col("reason")), "kept": F.col("kept") & ~over})
    return out.select("_row.*", "kept", "reason")


def fingerprint_classes(rows: DataFrame, *, key: str, bits: str) -> DataFrame:
    """(key, representative): rows with equal fingerprints are a class, which the smallest key stands for."""
    return rows.select(key, bits).join(rows.groupBy(bits).agg(F.min(key).alias("representative")), bits).select(key, "representative")


def cells_of(rows: DataFrame, *, key: str, bits: str, most: int, hot: int = HOT) -> DataFrame:
    """(cell, key, bits): cells such that any two rows at most `most` bits apart are in a cell together. A cell of over hot rows is cut: of
    most + 1 sets of bits that vary in it, with about the same entropy each, two such rows agree in one at least. Bits on
    which all rows of a cell agree tell nothing and are in no set, so a common prefix makes no large cell. Cells are cut until they are
    small or fewer bits vary than there are sets; then they have 2 ** most rows at most, as no two rows are equal."""
    ones = F.array(*[F.sum(F.shiftrightunsigned("_bits", i).bitwiseAND(1)) for i in range(64)])
    cut, now, done = masks_of(most + 1, hot), rows.select(F.lit(0).cast("long").alias("cell"), F.col(key).alias("_key"), F.col(bits).cast("long").alias("_bits")), []
    while True:
        masks = written(now.groupBy("cell").agg(F.count("*").alias("_n"), ones.alias("_ones")).select("cell", cut("_n", "_ones").alias("_masks")), "masks")
        both = now.join(masks, "cell")
        done.append(both.filter("size(_masks) = 0").select("cell", "_key", "_bits"))
        if not masks.filter("size(_masks) > 0").limit(1).count():
            break
        parts = both.filter("size(_masks) > 0").select("cell", "_key", "_bits", F.posexplode("_masks").alias("_i", "_mask"))
        now = written(parts.select(F.xxhash64("cell", "_i", F.col("_bits").bitwiseAND(F.col("_mask"))).alias("cell"), "_key", "_bits"), "cells")
    return reduce(DataFrame.unionByName, done)


def close_pairs(rows: DataFrame, *, key: str, bits: str, most: int, hot: int = HOT) -> DataFrame:
    """(a, b, distance) of classes of equal fingerprints of 64 bits (see fingerprint_classes) at most `most` bits apart: pairs of the
    rows of a cell (see cells_of), each counted once. Rows with equal fingerprints are one row before they meet."""
    own = written(rows.filter(F.col(bits).isNotNull()).groupBy(bits).agg(F.min(key).alias(key)), "classes")
    cells = written(cells_of(own, key=key, bits=bits, most=most, hot=hot), "cells")
    x, y = cells.alias("x"), cells.alias("y")
    met = x.join(y, (F.col("x.cell") == F.col("y.cell")) & (F.col("x._key") < F.col("y._key")))
    distance = F.bit_count(F.col("x._bits").bitwiseXOR(F.col("y._bits")))
    return met.select(F.col("x._key").alias("a"), F.col("y._key").alias("b"), distance.alias("distance")).filter(F.col("distance") <= most).distinct()
