"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import global_rank, mix

ROUNDS = 4


def permute(x: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """A permutation of 0 .. n - 1, computed for each number by itself.

    A balanced Feistel network permutes the smallest power of four that holds n; a number that leaves the range walks
    on through the network until it is back (under four steps on average).
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = [mix(np.array([seed * 0x9E3779B97F4A7C15 + r + 1 & 0xFFFFFFFFFFFFFFFF], np.uint64))[0] for r in range(ROUNDS)]
    x = np.array(x, np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> np.uint64(half), x[todo] & low
        for key in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ (mix(left ^ key) & low), left
            else:
                left, right = right, left ^ (mix(right ^ key) & low)
        x[todo] = (left << np.uint64(half)) | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def shard(df: DataFrame, shards: int, *, key: str = "doc_id", ties: tuple[str, ...] = (), seed: int = 20) -> DataFrame:
    """df with shard and slot.

    The row with number i in the order (key, ties) takes place permute(i): shard is that place modulo shards, slot its
    quotient. Row counts of shards differ by one at most, slots have no gaps, and the row at (shard, slot) is found by
    the inverse. Rows alike in key and ties take neighbouring numbers in any order. Null keys come first; an empty
    table stays empty. Columns named shard or slot are replaced.

    Only df's own columns move: pass narrow rows and join wide ones to the result.
    """
    n = df.count()
    df = df.drop("shard", "slot")

    @F.pandas_udf("long")
    def place(i: pd.Series) -> pd.Series:
        return pd.Series(permute(i.to_numpy(), n, seed))

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    ranked = global_rank(rows.withColumn("_of", F.col(f"_row.`{key}`")), "_of", [F.col(f"_row.`{c}`").asc_nulls_first() for c in ties]).withColumn("_place", place("_rank"))
    return ranked.select("_row.*", (F.col("_place") % shards).cast("int").alias("shard"), F.expr(f"_place div {int(shards)}").alias("slot"))
