"""Inputs: path lists, folders, routing, duplicates, archive plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalith.functions.meta import base_name, under
from catalith.sources.numbering import in_order

#: Names of ledger files, and kinds by extension with the modality each narrows to.
LEDGERS = ("manifest.json", "_manifest.json")
KINDS = {
    "txt": "txt", "md": "txt", "pdf": "pdf", "json": "json", "doc": "word", "docx": "word", "xls": "excel", "xlsx": "excel", "ppt": "powerpoint", "pptx": "powerpoint",
    "png": "image", "jpg": "image", "jpeg": "image", "gif": "image", "webp": "image", "mp4": "video", "mov": "video", "mkv": "video", "mp3": "audio", "wav": "audio", "flac": "audio",
}
MODALITIES = {"txt": "text", "pdf": "text", "json": "text", "word": "text", "excel": "text", "powerpoint": "text", "image": "image", "video": "video", "audio": "audio"}


def mapped(values: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def read_path_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos): one path a line, trimmed, without blank lines; pos numbers the lines of all files, files by their name, as they stand.
    Files are read in splits; a line's number is its place in its split and the lines of the splits before."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = spark.read.text(path).select("value", at.alias("_at"), F.monotonically_increasing_id().alias("_i"))
    counts = lines.groupBy("_at").agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a split
    starts = counts.select("_at", (before - F.col("_first")).alias("_shift"))
    out = lines.join(starts, "_at").select(F.trim("value").alias("path"), (F.col("_i") + F.col("_shift")).alias("pos"))
    return out.filter(F.length("path") > 0)


def read_folder(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, pos): the files in a folder, numbered in the order of their paths' bytes; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return in_order(files.select("path"), [F.col("path")])


def collect_inputs(*sources: DataFrame | None) -> DataFrame:
    """(path, source, pos) of all sources (path, pos), in that order: of equal paths the first one stays. All absent: an error."""
    given = [s.select("path", F.lit(i).alias("source"), F.col("pos").cast("long").alias("pos")) for i, s in enumerate(sources) if s is not None]
    if not given:
        raise ValueError("give a file list, a folder or paths")
    every = given[0]
    for s in given[1:]:
        every = every.unionByName(s)
    return every.groupBy("path").agg(F.min(F.struct("source", "pos")).alias("at")).select("path", "at.source", "at.pos")


def route(files: DataFrame, *, path: str = "path", exists: str = "present") -> DataFrame:
    """files with kind, modality, routable and reason. Missing ones first, then ledger files by their exact name in any case,
    then kinds that nothing is known of; never an error."""
    name = F.lower(base_name(F.col(path)))
    kind = F.coalesce(mapped(KINDS, F.regexp_extract(name, r"\.([a-z0-9]+)$", 1)), F.lit("unknown"))
    reason = F.when(~F.coalesce(F.col(exists), F.lit(False)), "missing").when(name.isin(*LEDGERS), "ledger_file").when(F.col("kind") == "unknown", "unknown_modality")
    return files.withColumn("kind", kind).withColumn("modality", F.coalesce(mapped(MODALITIES, F.col("kind")), F.lit("unknown"))).withColumn("reason", reason).withColumn("routable", F.col("reason").isNull())


def content_identity(content: Column) -> tuple[Column, Column]:
    """SHA-256 and size in bytes of a binary or text column."""
    data = content.cast("binary")
    return F.sha2(data, 256), F.length(data).cast("long")


def in_flight(files: DataFrame, assets: DataFrame, *, path: str = "fs_path", done: tuple[str, ...] = ("registered", "failed", "deferred")) -> DataFrame:
    """Files whose path no asset that is still under way has."""
    return files.join(assets.filter(~F.col("status").isin(*done)).select(path), path, "left_anti")


def collect_outcome(files: DataFrame, assets: DataFrame) -> DataFrame:
    """Routed files (path, file_hash, reason) with outcome: collected, or why they are skipped: missing, ledger_file,
    duplicate:<asset>. A duplicate has the hash of a registered or deferred asset, the one with the smallest id; failed ones
    may come again, and an unknown modality is collected, so that it leaves a record."""
    held = assets.filter(F.col("status").isin("registered", "deferred") & F.col("file_hash").isNotNull()).groupBy("file_hash").agg(F.min("asset_id").alias("_of"))
    found = files.join(held, "file_hash", "left")
    skipped = F.when(F.col("reason").isin("missing", "ledger_file"), F.col("reason")).when(F.col("_of").isNotNull(), F.concat(F.lit("duplicate:"), F.col("_of").cast("string")))
    return found.withColumn("outcome", F.coalesce(skipped, F.lit("collected"))).drop("_of")


def create_assets(files: DataFrame, domain: str = "general") -> DataFrame:
    """New rows in received; the id is made from path and hash, so a rerun makes the same one."""
    return files.select(F.sha2(F.concat_ws("\x1f", "fs_path", "file_hash"), 256).alias("asset_id"), "modality", "fs_path", "file_hash", "file_size", F.lit(domain).alias("domain_label"), F.lit("received").alias("status"))


def archive_plan(assets: DataFrame, inbox: str, archive: str) -> DataFrame:
    """(asset_id, src, dest) of assets below the inbox: archive/YYYYMMDD of creation/<id>__<name>."""
    rows = assets.filter(under(F.col("fs_path"), inbox))
    dest = F.concat(F.lit(archive.rstrip("/") + "/"), F.date_format("created_at", "yyyyMMdd"), F.lit("/"), F.col("asset_id").cast("string"), F.lit("__"), base_name(F.col("fs_path")))
    return rows.select("asset_id", F.col("fs_path").alias("src"), dest.alias("dest"))


def numbered(files: DataFrame, taken: DataFrame, *, folder: str = "folder", name: str = "name", order: str = "asset_id") -> DataFrame:
    """files with dest_name, no two the same in a folder and none that is taken (folder, name): of files that give a name which
    is free the first keeps it; the others get stem_n.ext with the smallest numbers from 1 on that no taken and no given name has.

    Free numbers are found by a running count: the r-th free one is r and how many used ones have at most r - 1 free ones before
    them. So a name that is given n times costs n log n; its rows are one window's."""
    cut = r"^(.*?)(\.[^.]*)?$"
    keyed = files.withColumns({"_stem": F.regexp_extract(F.col(name), cut, 1), "_ext": F.regexp_extract(F.col(name), cut, 2)})
    held = taken.select(F.col(folder).alias("_f"), F.col(name).alias("_held")).distinct()
    first = F.row_number().over(Window.partitionBy(folder, name).orderBy(order)) == 1
    same = keyed[folder].eqNullSafe(F.col("_f")) & (keyed[name] == F.col("_held"))
    known = keyed.join(held.withColumn("_is", F.lit(True)), same, "left").withColumn("_keeps", first & F.col("_is").isNull()).drop("_f", "_held", "_is")
    number = r"^(.*)_([1-9][0-9]*)(\.[^.]*)?$"
    every = files.select(F.col(folder).alias("_f"), F.col(name).alias("_held")).union(held).distinct()
    used = every.select("_f", F.regexp_extract("_held", number, 1).alias("_s"), F.regexp_extract("_held", number, 3).alias("_e"), F.regexp_extract("_held", number, 2).try_cast("long").alias("_u"))
    used = used.filter(F.col("_u").isNotNull()).distinct()
    before = (F.col("_u") - F.row_number().over(Window.partitionBy("_f", "_s", "_e").orderBy("_u"))).alias("_r")  # free numbers before it
    rest = known.filter(~F.col("_keeps"))
    rank = F.row_number().over(Window.partitionBy(folder, "_stem", "_ext").orderBy(order))
    whole = F.struct(*[F.col(f"`{c}`") for c in files.columns])
    asks = rest.select(F.col(folder).alias("_f"), F.col("_stem").alias("_s"), F.col("_ext").alias("_e"), (rank - 1).cast("long").alias("_r"), F.lit(1).alias("_asks"), whole.alias("_row"))
    both = used.select("_f", "_s", "_e", before, F.lit(0).alias("_asks"), F.lit(None).cast(asks.schema["_row"].dataType).alias("_row")).unionByName(asks)
    w = Window.partitionBy("_f", "_s", "_e").orderBy("_r", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    n = F.col("_r") + 1 + F.count_if(F.col("_asks") == 0).over(w)
    given = both.withColumn("_n", n).filter("_asks = 1").select("_row.*", F.concat("_s", F.lit("_"), F.col("_n").cast("string"), "_e").alias("dest_name"))
    return known.filter("_keeps").select(*files.columns, F.col(name).alias("dest_name")).unionByName(given)


def before_after(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(key, before, after, changed) as one JSON line each when written with write.json."""
    both = old.select(key, F.col(value).alias("before")).join(new.select(key, F.col(value).alias("after")), key, "full")
    return both.withColumn("changed", ~F.col("before").eqNullSafe(F.col("after")))
