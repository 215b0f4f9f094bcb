"""Best-fit packing by a plan over the histogram of lengths."""

from __future__ import annotations

import bisect
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalith.llm.common import materialize

#: The split of byte-level BPE into pieces, and the id that ends a document. Fixed values of the vocabulary's format.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 2


def encoder(path: str):
    """An encoder of the vocabulary in a tokenizers JSON file: the same ids, by the faster of the two public libraries."""
    import tiktoken

    # Printable stand-ins for bytes in such files: the printable Latin-1 characters stand for themselves, the rest in order from 256.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stands = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    special = {x["content"]: x["id"] for x in read["added_tokens"]}
    ranks = {bytes(stands[c] for c in token): i for token, i in read["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


_encoders: dict[str, object] = {}


def pieces(docs: DataFrame, path: str, size: int, *, key: str = "doc_id", text: str = "text", added: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each document's ids and its end; documents longer than size are cut
    from the end into pieces of size, so that only the first may be shorter. A null text counts as empty: its end alone.
    added: the added tokens of the vocabulary's file are single ids in texts, as for tokenizers by default; else plain text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = encoder(path)
        own = _encoders[path]
        encode = (lambda value: own.encode(value, allowed_special="all", disallowed_special=())) if added else own.encode_ordinary
        end = END.to_bytes(4, "little")
        for batch in batches:
            out: list[tuple] = []
            for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
                ids = memoryview(np.array(encode(value.as_py() or ""), "<u4").tobytes() + end)
                n = len(ids) // 4
                cuts = [0, *range(n % size or size, n + 1, size)]
                out += [(doc_id.as_py(), i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out, strict=True), strict=True)) if out else {c: [] for c in schema.names}, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], size: int) -> np.ndarray:
    """Where pieces go: rows (length, first rank, last rank + 1, first sequence, offset, pieces of it in one sequence).

    Best fit, longest first, over counts: sequences with the same room stand in groups, and a group takes as many pieces
    of a length as it has sequences. New sequences take as many of the length as fit. The work is bounded by size, not by
    the number of pieces.
    """
    rooms: list[int] = []  # of the groups that stand open, ascending
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, count)
    out, fresh = [], 0

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in groups:
                bisect.insort(rooms, room)
                groups[room] = []
            groups[room].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (i := bisect.bisect_left(rooms, length)) < len(rooms):
            room = rooms[i]
            first, count = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[i]
            took = min(left, count)
            out.append((length, rank, rank + took, first, size - room, 1))
            put(room - length, first, took)
            put(room, first + took, count - took)
            rank, left = rank + took, left - took
        if left:
            each = size // length
            for per, count in ((each, left // each), (left % each, 1)):
                if per and count:
                    out.append((length, rank, rank + per * count, fresh, 0, per))
                    put(size - per * length, fresh, count)
                    rank, fresh = rank + per * count, fresh + count
    return np.array(out, np.int64).reshape(-1, 6)


def ranked_within(df: DataFrame, group: str, order: list[str], salts: int = 64) -> DataFrame:
    """_rank: a number from 0 without gaps within each group, though a group may hold most rows: each is dealt over
    salts by its order columns, numbered there, and moved on by the counts of the salts before."""
    df = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    counts = df.groupBy(group, "_salt").agg(F.count("*").alias("_n"))
    before = counts.select(group, "_salt", F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rows = df.withColumn("_rank", F.row_number().over(Window.partitionBy(group, "_salt").orderBy(*order)).cast("long") - 1)
    return rows.join(before, [group, "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_salt", "_before")


def pack(docs: DataFrame, path: str, size: int = 1024, *, key: str = "doc_id", text: str = "text", added: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence and the offset that the plan gives them.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty texts are documents of one id;
    documents that share an id are packed each by itself; an empty table gives no rows. Only the histogram (at most size
    rows) comes to the driver; pieces find their places by their rank among those of the same length.
    """
    cut = materialize(pieces(docs, path, size, key=key, text=text, added=added))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = plan(counts, size)
    places = places[np.lexsort((places[:, 1], places[:, 0]))]
    most = int(places[:, 2].max()) + 1 if len(places) else 1
    marks = places[:, 0] * most + places[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        a, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        _, first, _, sequence, offset, per = places[np.searchsorted(marks, a * most + r, "right") - 1].T
        return pd.DataFrame({"sequence_id": sequence + (r - first) // per, "offset": offset + (r - first) % per * a})

    rows = ranked_within(cut, "length", ["doc_id", "piece", "ids_crc32"])
    return rows.withColumn("_at", place("length", "_rank")).select("doc_id", "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset")
