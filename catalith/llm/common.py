"""What several operators of this subpackage share: cut lineage, byte columns, hashes, global order."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text is worked on in runs of documents of about so many bytes; a longer document is a run by itself.
RUN_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only where it is unset and all runs on one machine, an own one."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="catalith-"))
        at = spark.sparkContext.getCheckpointDir()
    return at


def materialize(df: DataFrame) -> DataFrame:
    """The same rows, read from a table written to the shared folder: lineage ends here, and lost executors cost a read. An
    application's tables lie in one folder, which can go when it has ended."""
    at = f"{shared_dir(df.sparkSession)}/catalith-{df.sparkSession.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


#: Rows of narrow ids that are broadcast, at most (16 MB of longs); more are joined by a shuffle.
MOST_IDS = 1_000_000


def few(ids: DataFrame) -> DataFrame:
    """ids written to the shared folder, and marked for a broadcast where they are at most MOST_IDS rows."""
    ids = materialize(ids)
    return F.broadcast(ids) if ids.count() <= MOST_IDS else ids


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and its len + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def runs(at: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about limit bytes."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit of x counts (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: A random-looking 64-bit value for each byte, and the odd base of the rolling hash with its inverse modulo 2 ** 64.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the next call."""
    if base not in _powers or len(_powers[base]) < n:
        x = np.full(max(n, RUN_BYTES + (1 << 17)), base, np.uint64)
        x[0] = 1
        _powers[base] = np.cumprod(x, dtype=np.uint64)
    return _powers[base][:n]


class Rolling:
    """Hashes of any substrings of data, from sums over its prefixes."""

    def __init__(self, data: np.ndarray, values: np.ndarray | None = None):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.multiply(BYTE[data] if values is None else values, powers(BASE, n), out=self.sums[1:])
        np.cumsum(self.sums[1:], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * powers(INVERSE, len(self.sums))[start])

    def every(self, k: int) -> np.ndarray:
        """Of data[i : i + k] for each i."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * powers(INVERSE, n))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: Bits of a key that each level of the tree of blocks takes away: a block holds at most 8192 distinct keys, the levels
#: above at most 16384 blocks each, the top at most 512.
LEVELS = (13, 27, 41, 55)


def _sub(level: int) -> str:
    return f"_b{level}"


def global_rank(df: DataFrame, key: str, ties: list[Column], out: str = "_rank") -> DataFrame:
    """out: the row's number from 0 in the order (key, ties), without a sort of all rows in one task.

    Rows are numbered inside blocks of neighbouring keys; the counts of blocks are summed up a tree of blocks, each of
    whose nodes has a bounded number of children. Nulls of key come first.
    """
    k = F.coalesce(F.col(key), F.lit(-(1 << 63)))
    df = df.withColumn(_sub(0), F.shiftright(k, LEVELS[0]))
    inner = Window.partitionBy(_sub(0)).orderBy(F.col(key).asc_nulls_first(), *ties)
    rows = df.withColumn(out, F.row_number().over(inner).cast("long") - 1)
    counts = df.groupBy(_sub(0)).agg(F.count("*").alias("_n"))
    starts = _starts(counts, 0)
    return rows.join(starts, _sub(0)).withColumn(out, F.col(out) + F.col("_start")).drop(_sub(0), "_start", "_n")


def _starts(counts: DataFrame, level: int) -> DataFrame:
    """For each block of a level, the number of rows before it."""
    name = _sub(level)
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*([_sub(level + 1)] if level + 1 < len(LEVELS) else [])).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if level + 1 == len(LEVELS):
        return counts.select(name, before.alias("_start"))
    up = _sub(level + 1)
    counts = counts.withColumn(up, F.shiftright(name, LEVELS[level + 1] - LEVELS[level]))
    own = counts.select(name, up, before.alias("_own"))
    above = _starts(counts.groupBy(up).agg(F.sum("_n").alias("_n")), level + 1)
    return own.join(above, up).select(name, (F.col("_own") + F.col("_start")).alias("_start"))


def ordinals(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """out: the row's number from 0 in any order of any columns. Ranges of rows are sorted by themselves and written; a range
    starts where the counts of those before it end."""
    dealt = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a range
    starts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", before.alias("_start"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)).cast("long") - 1
    return dealt.withColumn(out, within).join(starts, "_part").withColumn(out, F.col(out) + F.col("_start")).drop("_part", "_start")


def unique_ids(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "_rid") -> DataFrame:
    """out: a unique long in the order of key. It is key itself where that is an integer, unique and has no null; otherwise the
    rank in the order (key, text), so rows that share an id stay apart and the smaller text counts as the earlier document."""
    if not isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return ordinals(df, [F.col(key).asc_nulls_first(), F.col(text).asc_nulls_first()], out)
    again = df.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1)).limit(1)
    if not again.take(1):
        return df.withColumn(out, F.col(key))
    return global_rank(df, key, [F.col(text).asc_nulls_first()], out)


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_row, _of, _text, _rid): each row whole as a struct, so that no name of its columns can clash, with its unique id."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return unique_ids(docs.select(whole.alias("_row"), F.col(key).alias("_of"), F.col(text).alias("_text")), "_of", "_text", "_rid")
