"""Tables in versions: data goes to new folders, a manifest says which of them a version has, readers see the last whole one."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer has made this version."""


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    jvm, fs = _store(spark, path)
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/manifests")
    if not fs.exists(at):
        return []
    return sorted(int(f.getPath().getName()[:-5]) for f in fs.listStatus(at) if f.getPath().getName().endswith(".json"))


def _load(spark: SparkSession, path: str, number: int) -> dict | None:
    """A manifest, or nothing where its writer died before it was whole."""
    jvm, fs = _store(spark, path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{path}/manifests/{number:012d}.json"))
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The manifest of a version, by default of the last whole one; nothing where there is none."""
    for n in reversed(_numbers(spark, path)):
        if (version is None or n == version) and (found := _load(spark, path, n)):
            return found
    return None


def commit(spark: SparkSession, path: str, made: dict, after: dict | None) -> dict:
    """Makes `made` the next version after `after`. A version that someone else has made meanwhile stops this one with Conflict, and
    nothing that readers see has changed."""
    seen = _numbers(spark, path)
    last = manifest(spark, path)
    if (last or {}).get("version") != (after or {}).get("version"):
        raise Conflict(f"{path}: version {(last or {}).get('version')} was made meanwhile")
    made = made | {"version": (seen[-1] if seen else 0) + 1}
    jvm, fs = _store(spark, path)
    try:
        out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/manifests/{made['version']:012d}.json"), False)
    except Exception as e:
        raise Conflict(f"{path}: version {made['version']} is being made by another writer") from e
    try:
        out.write(bytearray(json.dumps(made).encode()))
    finally:
        out.close()
    return made


def load(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version, by default the last one."""
    found = manifest(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"{path} has no {'version' if version is None else f'version {version}'}")
    return of_folders(spark, path, T.StructType.fromJson(found["schema"]), found["folders"].values())


def of_folders(spark: SparkSession, path: str, schema: T.StructType, folders) -> DataFrame:
    places = [f"{path}/{f}" for f in folders]
    return spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)


def publish(df: DataFrame, path: str, *, append: bool = False, accept: Callable[[DataFrame, int], bool] | None = None) -> dict:
    """Writes df as the next version of the table at path, in place of its rows or beside them, and returns its manifest.

    The rows are written first and read back: accept (frame, number of rows) says if they will do; without it any do.
    Readers go on with the last version until the manifest of the new one stands; a write that fails or isn't accepted leaves
    folders that no version names (see clean) and nothing else. Appended rows must have the table's columns.
    """
    spark = df.sparkSession
    before = manifest(spark, path)
    name = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    written = spark.read.schema(df.schema).parquet(f"{path}/{name}")
    n = written.count()
    if accept is not None and not accept(written, n):
        raise ValueError(f"{path}: {n} rows were not accepted")
    held = before if append and before else {"folders": {}, "rows": {}}
    if held["folders"] and T.StructType.fromJson(held["schema"]).fieldNames() != df.columns:
        raise ValueError(f"{path}: appended rows have other columns")
    made = {"schema": df.schema.jsonValue(), "folders": held["folders"] | {name: name}, "rows": held["rows"] | {name: n}, "batches": (before or {}).get("batches", {})}
    return commit(spark, path, made, before)


def clean(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes folders that none of the last `keep` versions names, and older manifests; the number of folders. For a time without writers."""
    numbers = [n for n in _numbers(spark, path) if _load(spark, path, n)]
    kept = {f for n in numbers[-keep:] for f in _load(spark, path, n)["folders"].values()}
    tops = {f.split("/")[1] for f in kept}
    jvm, fs = _store(spark, path)
    gone = 0
    data = jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    for status in fs.listStatus(data) if fs.exists(data) else []:
        name = status.getPath().getName()
        if name not in tops:
            gone += fs.delete(status.getPath(), True)
            continue
        inner = [f for f in fs.listStatus(status.getPath()) if f.isDirectory()]
        for one in inner:
            if f"data/{name}/{one.getPath().getName()}" not in kept and f"data/{name}" not in kept:
                gone += fs.delete(one.getPath(), True)
    for n in numbers[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/manifests/{n:012d}.json"), False)
    return gone
