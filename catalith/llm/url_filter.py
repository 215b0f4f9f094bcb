"""Exact URL rules by a cascade of Bloom filters over the corpus's complete universe of keys."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import Rolling, materialize, mix, numbered, text_buffer

#: Bytes of all levels up to which a cascade travels with the tasks; a larger one gives way to a join.
MOST_BYTES = 64 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased. Path: from there up to ? or #. Both empty without ://."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def key_hashes(column: pa.Array) -> np.ndarray:
    data, at = text_buffer(column)
    base = at[0] if len(at) else 0
    return Rolling(data[base : at[-1]]).of(at[:-1] - base, at[1:] - base) ^ mix((at[1:] - at[:-1]).astype(np.uint64))


@dataclass
class Bloom:
    bits: np.ndarray
    probes: int
    seed: int

    def slots(self, h: np.ndarray) -> np.ndarray:
        a, b = mix(h ^ np.uint64(self.seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)), mix(h + np.uint64(self.seed + 1)) | np.uint64(1)
        return (a[:, None] + b[:, None] * np.arange(self.probes, dtype=np.uint64)) % np.uint64(len(self.bits) * 8)

    def holds(self, h: np.ndarray) -> np.ndarray:
        s = self.slots(h)
        return ((self.bits[s >> np.uint64(3)] >> (s & np.uint64(7)).astype(np.uint8)) & 1).all(1)


class Cascade:
    """Levels of filters; a key's first level that doesn't hold it tells whether it is listed."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Of keys of the universe: exactly whether they are listed."""
        listed, todo = np.zeros(len(h), bool), np.arange(len(h))
        for depth, level in enumerate(self.levels):
            todo = todo[level.holds(h[todo])]
            listed[todo] = depth % 2 == 0
        return listed


def _filter(keys: DataFrame, n: int, rate: float, seed: int) -> Bloom:
    """Set bits are found by tasks and united by a grouped bit_or; the driver gets the filter's words alone."""
    size = max(8, math.ceil(-n * math.log(rate) / math.log(2) ** 2 / 8))
    empty = Bloom(np.zeros(size, np.uint8), max(1, round(-math.log2(rate))), seed)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.unique(empty.slots(key_hashes(batch.column(0))))
            yield pa.RecordBatch.from_pydict({"word": (s >> np.uint64(3)).astype(np.int64), "bit": np.left_shift(1, (s & np.uint64(7)).astype(np.int32), dtype=np.int32)})

    for r in keys.mapInArrow(work, "word long, bit int").groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).collect():
        empty.bits[r["word"]] = r["bits"]
    return empty


def _kept(keys: DataFrame, level: Bloom) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(level.holds(key_hashes(batch.column(0)))))

    return keys.mapInArrow(work, keys.schema)


def build(listed: DataFrame, universe: DataFrame, rate: float = 0.01, depth: int = 40) -> Cascade | None:
    """A cascade that is exact for every key of universe (one string column each, without repeats; listed within it).

    The first level encodes the listed keys, the next the keys of the universe that the first holds by mistake, and so
    on in turn until a level makes no mistake. None when its size would pass MOST_BYTES: then join instead.
    """
    levels: list[Bloom] = []
    yes, no = listed, universe.join(listed, universe.columns, "left_anti")
    n, total = yes.count(), 0
    while n and len(levels) < depth:
        total += -n * math.log(rate) / math.log(2) ** 2 / 8
        if total > MOST_BYTES:
            return None
        levels.append(_filter(yes, n, rate, len(levels)))
        no = materialize(_kept(no, levels[-1]))
        yes, no, n = no, yes, no.count()
    return Cascade(levels)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], *, url: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict. rules: (verdict, host, path prefix).

    A rule fits its host and every subdomain when the url's path starts with its path; the longest host wins, then the
    longest path. A url's possible keys are its host's suffixes with its path's prefixes of the lengths that occur in
    rules. The cascade, made for exactly the keys that the corpus has, names the ones that are listed. Without a listed
    key the rule is null and the verdict is default: the url is not on the list. Null urls and urls without :// have
    empty host and path. Columns named like the results are replaced.
    """
    spark = pages.sparkSession
    verdicts = {f"{host}{path}": verdict for verdict, host, path in rules}
    lengths = sorted({len(path) for _, _, path in rules}, reverse=True)
    host, path = host_and_path(F.col(url))
    others = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"), host.alias("host"), path.alias("path")).withColumn("_keys", keys_of("host", "path", lengths))
    universe = rows.select("host", F.substring("path", 1, max(lengths, default=0)).alias("path")).distinct()
    universe = materialize(universe.select(F.explode(keys_of("host", "path", lengths)).alias("key")).distinct())
    named = spark.createDataFrame([(k,) for k in verdicts], "key string")
    cascade = build(universe.join(F.broadcast(named), "key", "left_semi"), universe)
    if cascade is None:
        raise ValueError("the rules need a cascade larger than MOST_BYTES; use judge_by_join")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index("_keys")
            keys = batch.column(at)
            flat = keys.flatten()
            hit = np.flatnonzero(cascade.holds(key_hashes(flat)))
            ends = np.cumsum(pa.compute.list_value_length(keys).to_numpy(zero_copy_only=False))
            to = np.searchsorted(hit, np.append(0, ends[:-1]) if len(ends) else ends)
            found = [flat[int(hit[i])].as_py() if i < len(hit) and hit[i] < end else None for i, end in zip(to, ends, strict=True)]
            yield batch.remove_column(at).append_column("rule", pa.array(found, pa.string())).append_column("verdict", pa.array([verdicts.get(x, default) for x in found], pa.string()))

    schema = rows.drop("_keys").schema.add("rule", "string").add("verdict", "string")
    return rows.mapInArrow(judged, schema).select("_row.*", "host", "path", "rule", "verdict")


def judge_by_join(pages: DataFrame, rules: DataFrame, *, page_id: str, url: str = "url", default: str = "allow") -> DataFrame:
    """The same for rules (verdict, host, path) too many for a cascade: the keys that are listed, by an equi-join. Each row is judged by
    itself, also where rows share an id or have none; of rules with the same key the least verdict counts."""
    lengths = sorted((r[0] for r in rules.select(F.length("path")).distinct().collect()), reverse=True)
    others = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col("_text"))
    rows = numbered(pages.select(*[F.col(f"`{c}`") for c in others]), page_id, url).select("_rid", "_row", host.alias("host"), path.alias("path"))
    keys = rows.select("_rid", F.posexplode(keys_of("host", "path", lengths)).alias("_at", "rule"))
    listed = rules.groupBy(F.concat("host", "path").alias("rule")).agg(F.min("verdict").alias("verdict"))
    hit = keys.join(listed, "rule").groupBy("_rid").agg(F.min_by(F.struct("rule", "verdict"), "_at").alias("_hit"))
    told = rows.join(hit, "_rid", "left")
    return told.select("_row.*", "host", "path", F.col("_hit.rule").alias("rule"), F.coalesce("_hit.verdict", F.lit(default)).alias("verdict"))


def keys_of(host: str, path: str, lengths: list[int]) -> Column:
    """Host suffixes, longest first, each with the path's prefixes, longest first."""
    labels = F.split(F.col(host), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    heads = F.array_distinct(F.array(*[F.substring(F.col(path), 1, n) for n in lengths])) if lengths else F.array().cast("array<string>")
    return F.flatten(F.transform(suffixes, lambda s: F.transform(heads, lambda p: F.concat(s, p))))
