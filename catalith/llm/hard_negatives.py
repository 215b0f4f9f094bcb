"""Hard negatives for contrastive training: rotated one-bit codes bound every score, surviving intervals are scored exactly."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.llm.common import materialize

#: Bits of a row's code: as many random rotations as fit, one at least. Planes of an anchor's rotated components.
BITS, PLANES = 1024, 6
#: Rows that meet in one task: so many anchors and so many others, about.
ANCHORS, ROWS = 1024, 8192
#: Anchors that are held against a block of rows at once.
AT_ONCE = 32

_rotations: dict[tuple[int, int], np.ndarray] = {}


def rotations(size: int, bits: int = BITS) -> np.ndarray:
    """Random orthogonal matrices of the next multiple of 64, one below the other, cut to size columns; the same everywhere."""
    if (size, bits) not in _rotations:
        wide = -(-size // 64) * 64
        rng = np.random.default_rng(wide)
        parts = [np.linalg.qr(rng.standard_normal((wide, wide)))[0][:, :size] for _ in range(max(1, bits // wide))]
        _rotations[size, bits] = np.concatenate(parts)
    return _rotations[size, bits]


def encode(rows: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, reach, along, rest) of integer rows. A code has the signs s of the rotated components; s turned back has the
    length reach; along is the row's component in that direction, rest the length of what is left of it."""
    x = rows.astype(float)
    y = x @ turned.T
    bits = y >= 0
    codes = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    reach = np.linalg.norm(np.where(bits, 1.0, -1.0) @ turned, axis=1)
    reach = np.where(reach > 0, reach, 1.0)
    along = np.abs(y).sum(axis=1) / reach
    return codes, reach, along, np.sqrt(np.maximum((x * x).sum(axis=1) - along * along, 0.0))


def planes(anchors: np.ndarray, turned: np.ndarray, bits: int = PLANES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bit planes, least, step, sum, error) of anchors' rotated components, rounded to 2 ** bits levels between the least and the
    greatest of each anchor; error is the sum of what rounding changed, so no choice of signs is further off."""
    y = anchors.astype(float) @ turned.T
    least = y.min(axis=1)
    step = np.maximum((y.max(axis=1) - least) / ((1 << bits) - 1), 1e-12)
    level = np.rint((y - least[:, None]) / step[:, None]).astype(np.int64)
    near = least[:, None] + step[:, None] * level
    out = [np.packbits((level >> p) & 1, axis=1, bitorder="little").view("<u8") for p in range(bits)]
    return np.stack(out), least, step, near.sum(axis=1), np.abs(y - near).sum(axis=1)


def bounds(asked: tuple, length: np.ndarray, coded: tuple, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) of the inner products of anchors and rows: popcounts of planes and codes give an anchor's component in
    the direction of a row's code up to the rounding, and by Cauchy and Schwarz what is left of both adds their lengths' product at most."""
    (plane, least, step, total, error), (codes, reach, along, rest) = asked, coded
    counts = np.zeros((plane.shape[1], len(codes)), np.int64)
    for p, words in enumerate(plane):
        here = np.zeros(counts.shape, np.int32)
        for w in range(codes.shape[1]):
            here += np.bitwise_count(words[:, w, None] & codes[None, :, w])
        counts += here.astype(np.int64) << p
    signed = 2 * (least[:, None] * ones[None] + step[:, None] * counts) - total[:, None]
    t, off = signed / reach, error[:, None] / reach
    left = np.sqrt(np.maximum(length[:, None] ** 2 - np.maximum(np.abs(t) - off, 0.0) ** 2, 0.0))
    span = along * off + rest * left
    span += 1e-9 * length[:, None] * np.hypot(along, rest) + 1e-3  # what floating point may lose
    return along * t - span, along * t + span


def greatest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th greatest of each row, as a column; less than all where there are fewer."""
    if values.shape[1] < k:
        return np.full((len(values), 1), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, [values.shape[1] - k]]


def firsts(group: np.ndarray, order: tuple[np.ndarray, ...], k: int) -> np.ndarray:
    """Places of the first k of each group in an order (most significant key first)."""
    at = np.lexsort((*reversed(order), group))
    g = group[at]
    new = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    within = np.arange(len(g)) - np.repeat(new, np.diff(np.r_[new, len(g)]))
    return at[within < k]


class Side:
    """A block's rows of one side: numbers, labels (codes shared with the other side), integer vectors and their codes."""

    def __init__(self, table: pa.Table, size: int):
        table = table.combine_chunks()
        self.table, self.rows = table, table["_row"].to_numpy()
        data = b"".join(table["_ints"].to_pylist())
        self.x = np.frombuffer(data, "<i4").reshape(-1, size).astype(np.int64)

    def coded(self) -> tuple:
        codes = np.frombuffer(b"".join(self.table["_code"].to_pylist()), "<u8").reshape(len(self.rows), -1)
        return codes, *(self.table[c].to_numpy() for c in ("_reach", "_along", "_rest"))


def _same_label(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    both = np.array(a["_label"].to_pylist() + b["_label"].to_pylist(), dtype=object)
    codes = np.unique(both.astype(str), return_inverse=True)[1]
    return codes[: a.num_rows], codes[a.num_rows :]


def _meet(anchors: DataFrame, index: DataFrame, counts: tuple[int, int], size: int, choose: Callable, out: str) -> DataFrame:
    """Each block of anchors with each block of rows, in one task; choose gives (anchor, row, p, score) arrays."""
    asked, held = max(1, -(-counts[0] // ANCHORS)), max(1, -(-counts[1] // ROWS))
    own = [F.col(c).alias(c) for c in anchors.columns]  # new attributes, as both sides come from one table
    a = anchors.select(*own, F.pmod(F.xxhash64("_row"), F.lit(asked)).cast("int").alias("_q"), F.explode(F.sequence(F.lit(0), F.lit(held - 1))).alias("_c"))
    c = index.withColumn("_c", F.pmod(F.xxhash64("_row"), F.lit(held)).cast("int")).withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(asked - 1))))
    names = [x.split(" ")[0] for x in out.split(", ")]

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        kind = right.schema.field("_key").type
        if left.num_rows and right.num_rows:
            a, c, turned = Side(left, size), Side(right, size), rotations(size)
            own, other = _same_label(a.table, c.table)
            order = pc.rank(c.table["_key"].combine_chunks(), "ascending", null_placement="at_end", tiebreaker="dense").to_numpy()
            coded = c.coded()
            ones = np.bitwise_count(coded[0]).sum(axis=1, dtype=np.int64)
            length = np.sqrt((a.x.astype(float) ** 2).sum(axis=1))
            for i in range(0, len(a.rows), AT_ONCE):
                s = slice(i, i + AT_ONCE)
                low, high = bounds(planes(a.x[s], turned), length[s], coded, ones)
                same = own[s, None] == other[None]
                for at, row, p, score in choose(a, s, c, same, low, high, order):
                    found.append((a.rows[s][at], c.rows[row], c.table["_key"].combine_chunks().take(pa.array(row)), p, score))
        if not found:
            return pa.table({n: pa.array([], kind if n == "_key" else pa.int32() if n == "_p" else pa.int64()) for n in names})
        at, row, keys, p, score = zip(*found, strict=True)
        columns = {"_anchor": np.concatenate(at), "_other": np.concatenate(row), "_key": pa.chunked_array(keys), "_p": np.concatenate(p).astype(np.int32), "_score": np.concatenate(score)}
        return pa.table({n: columns[n] for n in names})

    return a.groupBy("_q", "_c").cogroup(c.groupBy("_q", "_c")).applyInArrow(block, out)


def _scores(a: Side, s: slice, c: Side, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, exact integer score) of the pairs that are kept."""
    at, row = np.nonzero(keep)
    score = np.zeros(len(at), np.int64)
    for i in range(0, len(at), 1 << 16):
        part = slice(i, i + (1 << 16))
        score[part] = np.einsum("ij,ij->i", a.x[s][at[part]], c.x[row[part]])
    return at, row, score


def mine(
    rows: DataFrame, anchors: Column, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its positives (the
    best rows of its label, but for itself) the best rows of other labels whose score is low to high percent of the positive's.

    Components become floor(scale * x); a score is the integer inner product with the anchor; higher scores come first, ties
    by the smaller key, a null key last. rows are dealt into blocks by their counts and each block of anchors meets each
    block of rows in one task: nothing is held that grows with the table. There, codes give an interval for each score; pairs
    whose interval can't be among the first are dropped, the others are scored as integers, so the result is exact.

    Rows with a null label, a null vector or a component that is null or not finite take no part, nor do rows whose squared
    length doesn't fit 62 bits after the percentages are taken. Shorter vectors count as filled up with zeros. Rows
    that share a key are rows by themselves. A positive score below zero has no negatives. An empty table gives no rows.
    """
    v = F.col(f"`{vector}`")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    known = rows.filter(F.col(f"`{label}`").isNotNull() & v.isNotNull() & fine)
    kept = known.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").cast("string").alias("_label"), v.cast("array<double>").alias("_vector"), F.coalesce(anchors, F.lit(False)).alias("_is"))
    size = max(1, kept.agg(F.max(F.size("_vector"))).first()[0] or 1)
    ratios = [(x // math.gcd(x, 100), 100 // math.gcd(x, 100)) for x in (low, high)]
    most = float((1 << 62) // max(x for pair in ratios for x in pair))

    def coded(batches):
        turned = rotations(size)
        for batch in batches:
            values = batch.column(batch.schema.get_field_index("_vector"))
            n = np.diff(values.offsets.to_numpy()) if len(values) else np.zeros(0, np.int64)
            x = np.zeros((len(n), size))
            x[np.arange(size)[None] < n[:, None]] = values.flatten().to_numpy()
            x = np.floor(x * float(scale))
            ok = (x * x).sum(axis=1) < most
            ints = x[ok].astype("<i4")
            codes, reach, along, rest = encode(ints, turned)
            own = batch.filter(pa.array(ok))
            packed = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (ints, codes)]
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), own.column(3), *packed, pa.array(reach), pa.array(along), pa.array(rest)], ["_key", "_label", "_is", "_ints", "_code", "_reach", "_along", "_rest"])

    kind = kept.schema["_key"].dataType.simpleString()
    index = kept.mapInArrow(coded, f"_key {kind}, _label string, _is boolean, _ints binary, _code binary, _reach double, _along double, _rest double")
    index = materialize(index.withColumn("_row", F.monotonically_increasing_id()))
    asked = index.filter("_is").select("_row", F.col("_key").alias("_own"), "_label", "_ints")
    held = index.drop("_is")
    counts = tuple(index.agg(F.count_if("_is"), F.count("*")).first())

    def best_of_label(a: Side, s: slice, c: Side, same: np.ndarray, least: np.ndarray, most: np.ndarray, order: np.ndarray):
        same = same & (a.rows[s, None] != c.rows[None])
        keep = same & (most >= greatest(np.where(same, least, -np.inf), positives))
        at, row, score = _scores(a, s, c, keep)
        first = firsts(at, (-score, order[row], c.rows[row]), positives)
        yield at[first], row[first], np.zeros(len(first)), score[first]

    def best_in_band(a: Side, s: slice, c: Side, same: np.ndarray, least: np.ndarray, most: np.ndarray, order: np.ndarray):
        wanted = [[f["_score"] for f in sorted(x, key=lambda f: f["_p"])] for x in a.table["_found"].to_pylist()[s]]
        score_of = np.full((len(wanted), positives), -1, np.int64)
        for i, x in enumerate(wanted):
            score_of[i, : len(x)] = x
        keep = np.zeros(same.shape, bool)
        for p in range(positives):
            goal = score_of[:, [p]]
            a0, a1 = goal * (low / 100) - 1e-3, goal * (high / 100) + 1e-3
            can = ~same & (goal >= 0) & (most >= a0) & (least <= a1)
            sure = can & (least >= a0 + 2e-3) & (most <= a1 - 2e-3)
            keep |= can & (most >= greatest(np.where(sure, least, -np.inf), negatives))
        at, row, score = _scores(a, s, c, keep)
        for p in range(positives):
            goal = score_of[at, p]
            (n0, d0), (n1, d1) = ratios
            here = np.flatnonzero((goal >= 0) & (n0 * goal <= d0 * score) & (d1 * score <= n1 * goal))
            first = here[firsts(at[here], (-score[here], order[row[here]], c.rows[row[here]]), negatives)]
            yield at[first], row[first], np.full(len(first), p), score[first]

    def ranked(found: DataFrame, of: list[str], k: int) -> DataFrame:
        w = Window.partitionBy(*of).orderBy(F.desc("_score"), F.col("_key").asc_nulls_last(), "_other")
        return found.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k)

    out = f"_anchor long, _other long, _key {kind}, _p int, _score long"
    pairs = materialize(ranked(_meet(asked.drop("_own"), held, counts, size, best_of_label, out), ["_anchor"], positives).withColumn("_p", F.col("_rank") - 1))
    lists = pairs.groupBy(F.col("_anchor").alias("_row")).agg(F.collect_list(F.struct("_p", "_score")).alias("_found"))
    anchored = asked.join(lists, "_row")
    hard = ranked(_meet(anchored.drop("_own"), held, counts, size, best_in_band, out), ["_anchor", "_p"], negatives)
    named = asked.select(F.col("_row").alias("_anchor"), F.col("_own").alias("anchor_id"))
    positive = pairs.select("_anchor", "_p", F.col("_key").alias("positive_id"), F.col("_score").alias("positive_score"))
    hard = hard.select("_anchor", "_p", F.col("_rank").cast("int").alias("rank"), F.col("_key").alias("negative_id"), F.col("_score").alias("negative_score"))
    return hard.join(positive, ["_anchor", "_p"]).join(named, "_anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
