"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix with itself."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.llm.common import BASE, RUN_BYTES, Rolling, few, materialize, mix, numbered, runs, signed, text_buffer, unique_ids
from catalith.llm.components import components

#: Words of a shingle, and the least similarity as a fraction: documents link from NUM / DEN on.
WORDS, NUM, DEN = 5, 3, 4
#: Columns of at most so many sets give pairs; longer ones are multiplied in blocks of two parts.
SMALL = 24
#: The most frequent shingles, put last in the order of columns; at most so many come to the driver. They change the work, never the result.
FREQUENT, FREQUENT_FROM = 40_000, 24
#: A part of a block: about so many sets, or so many entries of the matrix; and so many columns are multiplied at once.
PART, CAP, COLS = 1024, 400_000, 2048
#: Turns in which long columns' sets meet in parts, before all that are still in different components meet. They change the work, never the result.
TURNS = 2
#: Rows of postings handled at once.
BLOCK = 60_000


def shingles(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles of documents that lie end to end, in that order. Words are lower-cased (A-Z)
    runs of bytes other than space and 0x09-0x0D; under WORDS words the whole sequence is the one shingle."""
    at = at - at[0]
    n, docs = len(data), len(at) - 1
    low = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    start, end = word & edge[:n], word & edge[1:]
    start[1:] |= word[1:] & ~word[:-1]
    end[:-1] |= word[:-1] & ~word[1:]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    doc = np.searchsorted(at, s, "right") - 1
    h = Rolling(low).of(s, e)
    base = np.uint64(BASE)
    found_doc, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    if len(h) >= WORDS:
        m = len(h) - WORDS + 1
        acc = h[:m].copy()
        for j in range(1, WORDS):
            acc = acc * base + h[j : j + m]
        whole = doc[:m] == doc[WORDS - 1 :]
        found_doc.append(doc[:m][whole])
        found.append(mix(acc[whole]))
    counts = np.bincount(doc, minlength=docs)
    firsts = np.cumsum(counts) - counts
    for k in range(1, WORDS):
        few = np.flatnonzero(counts == k)
        if len(few):
            acc = h[firsts[few]].copy()
            for j in range(1, k):
                acc = acc * base + h[firsts[few] + j]
            found_doc.append(few)
            found.append(mix(acc + np.uint64(k)))
    d, x = np.concatenate(found_doc), np.concatenate(found)
    order = np.lexsort((x, d))
    d, x = d[order], x[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    return d[new], x[new]


def _class(d: np.ndarray, x: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of each document's set, and a 64-bit name of the set."""
    n = np.bincount(d, minlength=docs)
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(mix(x + np.uint64(1)), dtype=np.uint64, out=sums[1:])
    ends = np.cumsum(n)
    return n, mix(sums[ends] - sums[ends - n] + n.astype(np.uint64) * np.uint64(BASE))


def _text_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, at = text_buffer(batch.column(1))
        for i, j in runs(at):
            yield ids[i:j], data[at[i] : at[j]], at[i : j + 1]


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: (id, set size, set name) of each document. Kind 1: (shingle, documents) of those that stand out in this task."""
    often: dict[int, int] = {}
    for ids, data, at in _text_runs(batches):
        d, x = shingles(data, at)
        n, name = _class(d, x, len(ids))
        yield pa.RecordBatch.from_pydict({"kind": np.zeros(len(ids), np.int32), "x": ids.astype(np.int64), "n": n, "y": signed(name)})
        value, count = np.unique(x, return_counts=True)
        for v, c in zip(value[count > 1].tolist(), count[count > 1].tolist(), strict=True):
            often[v] = often.get(v, 0) + c
        if len(often) > 8 * FREQUENT:
            often = dict(sorted(often.items(), key=lambda kv: -kv[1])[:FREQUENT])
    top = sorted(often.items(), key=lambda kv: -kv[1])[:FREQUENT]
    yield pa.RecordBatch.from_pydict({"kind": np.ones(len(top), np.int32), "x": signed(np.array([v for v, _ in top], np.uint64)), "n": np.array([c for _, c in top], np.int64), "y": np.zeros(len(top), np.int64)})


def prefix(n):
    """So many first columns of a set of n hold one that it shares with any set that links with it."""
    return n - (NUM * n + DEN - 1) // DEN + 1


def _postings(frequent: np.ndarray):
    """(column, set name, set size, frequent) of the first columns of each set in the order (frequent, hash), about once a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for ids, data, at in _text_runs(batches):
            d, x = shingles(data, at)
            n, name = _class(d, x, len(ids))
            if len(seen) > BLOCK:  # equal sets are united again where columns meet
                seen.clear()
            fresh = np.zeros(len(ids), bool)
            for i, key in enumerate(name.tolist()):
                if n[i] and key not in seen:
                    seen.add(key)
                    fresh[i] = True
            keep = fresh[d]
            d, x = d[keep], x[keep]
            late = np.zeros(len(x), bool)
            if len(frequent):
                late = frequent[np.minimum(np.searchsorted(frequent, x), len(frequent) - 1)] == x
            order = np.lexsort((x, late, d))
            d, x = d[order], x[order]
            own = np.bincount(d, minlength=len(ids))
            place = np.arange(len(d)) - (np.cumsum(own) - own)[d]
            first = place < prefix(n)[d]
            d, x, late = d[first], x[first], late[order][first]
            yield pa.RecordBatch.from_pydict({"h": signed(x), "k": signed(name)[d], "n": n[d].astype(np.int32), "late": late})

    return work


def needed(na, nb):
    """Least overlap of two sets that link."""
    return -(-NUM * (na + nb) // (NUM + DEN))


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of columns, which come sorted by (frequent, column, size, name). Kind 0: (set, set, sizes, shared columns, the least of
    these); kind 1: (column, set, size) of frequent columns and of those with over SMALL sets, which aren't multiplied here."""
    names = ("kind", "a", "b", "na", "nb", "c", "h")
    column = None  # the one that was cut last

    def out(kind, a, b, na, nb, c, h):
        return pa.RecordBatch.from_pydict(dict(zip(names, (np.full(len(a), kind, np.int32), a, b, na.astype(np.int32), nb.astype(np.int32), c.astype(np.int32), h), strict=True)))

    def multiply(h, k, n, late, part: bool):
        nonlocal column
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (k[1:] == k[:-1])
        h, k, n, late = h[~again], k[~again], n[~again], late[~again]
        edge = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        size = np.diff(np.append(edge, len(h)))
        cut = (size > SMALL) | late[edge] | part
        if column is not None and len(h) and h[0] == column:
            cut[0] = True
        if len(cut) and cut[-1]:
            column = h[-1]
        of = np.repeat(np.arange(len(edge)), size)
        wide = cut[of] if len(of) else np.zeros(0, bool)
        if wide.any():
            yield out(1, h[wide], k[wide], n[wide], n[wide], np.zeros(int(wide.sum())), h[wide])
        few = np.flatnonzero(~wide)
        pairs = []
        for step in range(1, SMALL):
            x = few[few + step < len(h)]
            x = x[of[x] == of[x + step]]
            if not len(x):
                break
            x = x[DEN * n[x].astype(np.int64) >= NUM * n[x + step].astype(np.int64)]
            pairs.append((k[x], k[x + step], n[x], n[x + step], h[x]))
        if pairs:
            a, b, na, nb, g = (np.concatenate(x) for x in zip(*pairs, strict=True))
            swap = a > b
            a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
            order = np.lexsort((g, b, a))
            a, b, na, nb, g = a[order], b[order], na[order], nb[order], g[order]
            new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, np.int64)
            yield out(0, a[new], b[new], na[new], nb[new], np.diff(np.append(new, len(a))), g[new])

    held: list[tuple] = []
    rows = 0
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)))
        rows += batch.num_rows
        if rows >= BLOCK:
            h, k, n, late = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int(np.flatnonzero(h != h[-1])[-1]) + 1 if (h != h[-1]).any() else 0
            part = last == 0
            last = last or len(h)
            yield from multiply(h[:last], k[:last], n[:last], late[:last], part)
            held, rows = [(h[last:], k[last:], n[last:], late[last:])], len(h) - last
    if rows:
        yield from multiply(*(np.concatenate(x) for x in zip(*held, strict=True)), False)


def product(x: np.ndarray, of: np.ndarray, n: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of sets that link: one of the left and one of the right, or any two where none is right.

    x, of: the entries of the incidence matrix, a column's hash and its set; n: sizes of the sets. Columns that only one
    set has add nothing. The others are multiplied in slices of COLS; overlaps add up over the slices, and sets go as
    soon as none of their pairs can reach the overlap that its sizes need with what is left of both.
    """
    rows, cols = (np.flatnonzero(~right), np.flatnonzero(right)) if right.any() else (np.arange(len(n)), np.arange(len(n)))
    n = n.astype(np.int32)
    order = np.argsort(x, kind="stable")
    x, of = x[order], of[order]
    new = np.append(True, x[1:] != x[:-1]) if len(x) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    held = np.bincount(column)[column] > 1
    of, column = of[held], (np.cumsum(new[held]) - 1)
    rest = np.bincount(of, minlength=len(n)).astype(np.int32)
    need = needed(n[rows][:, None], n[cols][None, :])
    fits = DEN * np.minimum(n[rows][:, None], n[cols][None, :]) >= NUM * np.maximum(n[rows][:, None], n[cols][None, :])
    shared = np.zeros((len(rows), len(cols)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLS):
        i, j = np.searchsorted(column, [first, first + COLS])
        width = min(COLS, int(column[-1]) + 1 - first)
        place = np.full(len(n), -1)
        left, down = np.zeros((len(rows), width), np.float32), np.zeros((len(cols), width), np.float32)
        for matrix, sets in ((left, rows), (down, cols)):
            place[:] = -1
            place[sets] = np.arange(len(sets))
            here = place[of[i:j]] >= 0
            matrix[place[of[i:j][here]], column[i:j][here] - first] = 1
        shared += left @ down.T
        rest -= np.bincount(of[i:j], minlength=len(n)).astype(np.int32)
        can = fits & (shared + np.minimum(rest[rows][:, None], rest[cols][None, :]) >= need)
        up, down_ = can.any(1), can.any(0)
        rows, cols, shared, need, fits = rows[up], cols[down_], shared[up][:, down_], need[up][:, down_], fits[up][:, down_]
        if not len(rows):
            break
    a, b = np.nonzero(fits & (shared >= need))
    a, b = rows[a], cols[b]
    return (a, b) if right.any() else (a[a < b], b[a < b])


def spanned(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least one that the edges (a, b) connect it with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, c, right, text), sorted by block: whole texts of sets with their components. Gives edges (a, b) that connect
    the components that links of a block connect: one for each component less than there are, never one for each link."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        block, c, right = (rows[x].to_numpy() for x in ("block", "c", "right"))
        data, at = text_buffer(rows["text"])
        found = [shingles(data[at[i] : at[j]], at[i : j + 1]) for i, j in runs(at)]
        firsts = np.cumsum([0, *[j - i for i, j in runs(at)]])
        of = np.concatenate([d + f for (d, _), f in zip(found, firsts, strict=False)] or [np.zeros(0, np.int64)])
        x = np.concatenate([v for _, v in found] or [np.zeros(0, np.uint64)])
        n = np.bincount(of, minlength=len(c))
        edge = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        entry = np.concatenate([[0], np.cumsum(n)])
        ends = []
        for i, j in zip(edge, np.append(edge[1:], len(c)), strict=True):
            i_, j_ = entry[i], entry[j]
            a, b = product(x[i_:j_], of[i_:j_] - i, n[i:j], right[i:j])
            names, own = np.unique(c[i:j], return_inverse=True)
            top = spanned(own[a], own[b], len(names))
            moved = np.flatnonzero(top != np.arange(len(names)))
            ends.append((names[top[moved]], names[moved]))
        a, b = (np.concatenate([e[k] for e in ends]) for k in range(2))
        return pa.RecordBatch.from_pydict({"a": a, "b": b})

    for rows in _whole_blocks(batches, lambda b: b.nbytes, RUN_BYTES):
        yield work(rows)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: key, n_shingles, component_id (the smallest key reachable by links, its own included), first
    (whether it stands for its component: the smallest key, and the smallest text of those that share it).

    Documents with equal sets are one row of the matrix. Its columns are ordered, frequent ones last; of each set only its
    first columns can hold the first one that it shares with a set that links with it. Their product gives blocks of rows
    that can link: sets of a short column whose shared columns, and what sizes leave open, reach the least overlap that the
    sizes need. Sets of long columns are dealt into blocks of two parts of bounded size (see _blocks). In a block the rows of
    the whole matrix are multiplied, overlaps add up over all columns, and pairs below the bounds go. A block gives out only which
    components its links connect; components are contracted after each turn, so copies stay linear in number, and pairs
    of components that stay apart meet exactly.

    Null, empty and blank texts have no set, link with nothing and are their own component. Repeated rows are equal sets.
    Keys may be of any type that has an order; a null key is the smallest. Extra columns are ignored, an empty table gives
    no rows. 64-bit hashes stand for shingles.
    """
    rows = unique_ids(docs.select(key, text), key, text).select(F.col("_rid").cast("long"), F.col(text).cast("string").alias("_text"), F.col(key).alias("_key"))
    plain = rows.select("_rid", "_text")
    members = materialize(plain.mapInArrow(_members, "kind int, x long, n long, y long"))
    frequent = members.filter("kind = 1").groupBy("x").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "x").limit(FREQUENT).collect()
    late = np.sort(np.array([r["x"] for r in frequent], np.int64).view(np.uint64))
    sets = members.filter("kind = 0").select(F.col("x").alias("_rid"), F.col("n").alias("n_shingles"), F.col("y").alias("_k"))
    reps = materialize(sets.filter("n_shingles > 0").groupBy("_k").agg(F.min("_rid").alias("_rep")))

    # A frequent column's sets are spread over all tasks; only others have to come together.
    postings = plain.mapInArrow(_postings(late), "h long, k long, n int, late boolean").repartition(F.when(F.col("late"), F.xxhash64("h", "k")).otherwise(F.col("h")))
    made = materialize(postings.sortWithinPartitions("late", "h", "n", "k").mapInArrow(_products, "kind int, a long, b long, na int, nb int, c int, h long"))
    wide = materialize(made.filter("kind = 1").select(F.col("a").alias("h"), F.col("b").alias("k"), F.col("na").alias("n")).distinct())
    open_ = wide.groupBy("k").agg(F.count("*").cast("int").alias("w"))
    pairs = made.filter("kind = 0").groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c"), F.min("h").alias("h"))

    need, rest = f"ceil({NUM} * (na + nb) / {NUM + DEN}.0)", f"ceil({NUM} * greatest(na, nb) / {DEN}.0) - 1"
    counted = pairs.join(open_.toDF("a", "wa"), "a", "left").join(open_.toDF("b", "wb"), "b", "left")
    close = counted.filter(f"c + least(coalesce(wa, 0), coalesce(wb, 0)) + {rest} >= {need}")
    short = close.select(F.col("h").alias("block"), F.explode(F.array("a", "b")).alias("k")).distinct()
    label = _contracted(reps.select(F.col("_k").alias("k"), F.col("_k").alias("c")), _links(short.select("block", "k", F.col("k").alias("c"), F.lit(False).alias("right")), rows, reps))
    for turn in range(TURNS + 1):
        mixed = _mixed(wide, label)
        if not mixed.take(1):
            break
        blocks = _parts(mixed, turn) if turn < TURNS else _blocks(mixed)
        label = _contracted(label, _links(blocks, rows, reps))

    firsts = reps.join(label, F.col("_k") == F.col("k")).groupBy("c").agg(F.min("_rep").alias("_c"))
    top = label.join(firsts, "c").select(F.col("k").alias("_k"), "_c")
    keys = rows.select("_rid", "_key")
    joined = sets.join(top, "_k", "left").withColumn("_c", F.when(F.col("n_shingles") > 0, F.col("_c")).otherwise(F.col("_rid"))).drop("_k")
    joined = joined.join(keys, "_rid").join(keys.toDF("_c", "component_id"), "_c")
    return joined.select(F.col("_key").alias(key), "n_shingles", "component_id", (F.col("_rid") == F.col("_c")).alias("first"))


def _contracted(label: DataFrame, edges: DataFrame) -> DataFrame:
    """label (k, c) after edges (a, b) between components have united these."""
    found = components(edges)
    return materialize(label.join(found.toDF("c", "_top"), "c", "left").select("k", F.coalesce("_top", "c").alias("c")))


def _mixed(wide: DataFrame, label: DataFrame) -> DataFrame:
    """(h, k, n, c, m, r): columns whose m sets are in several components. r: so many of the set's columns of this kind come
    from this one on, in the order (m, h); a pair that meets here first shares no more than the lesser of its two r."""
    spread = wide.join(label, "k")
    mixed = spread.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("m")).filter("lo < hi").select("h", "m")
    r = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("m"), F.desc("h")))
    return materialize(spread.join(few(mixed), "h").select("h", "k", "n", "c", "m").withColumn("r", r))


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, right, k, n, c, r, g), sorted by block. Gives (k, n, c, g, to): sets that can link with one of group to.

    Sets of different components share no short column any more, or were found not to link there. So their overlap is at
    most the lesser r and what lies beyond the first columns of the larger set.
    """
    names = ("right", "k", "n", "c", "r", "g")

    def judge(right, k, n, c, r, g):
        x, y = (np.flatnonzero(~right), np.flatnonzero(right)) if right.any() else (np.arange(len(k)),) * 2
        large, small = np.maximum(n[x][:, None], n[y][None, :]), np.minimum(n[x][:, None], n[y][None, :])
        can = (DEN * small >= NUM * large) & (c[x][:, None] != c[y][None, :])
        can &= np.minimum(r[x][:, None], r[y][None, :]) + -(-NUM * large // DEN) - 1 >= needed(small, large)
        for one, two, seen in ((x, y, can), *([(y, x, can.T)] if right.any() else [])):
            order = np.argsort(g[two], kind="stable")
            if len(order):
                first = np.flatnonzero(np.append(True, g[two][order][1:] != g[two][order][:-1]))
                i, j = np.nonzero(np.logical_or.reduceat(seen[:, order], first, axis=1))
                yield one[i], g[two][order][first][j]

    def work(rows: pa.Table) -> pa.RecordBatch:
        columns = {x: rows[x].to_numpy() for x in names} | {"n": rows["n"].to_numpy().astype(np.int64)}
        block = rows["block"].to_numpy()
        edge = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        found = [(i + one, to) for i, j in zip(edge, np.append(edge[1:], len(block)), strict=True) for one, to in judge(*(columns[x][i:j] for x in names))]
        at, to = (np.concatenate([f[q] for f in found]) for q in range(2)) if found else (np.zeros(0, np.int64),) * 2
        return pa.RecordBatch.from_pydict({**{x: columns[x][at] for x in ("k", "n", "c", "g")}, "to": to.astype(np.int64)})

    for rows in _whole_blocks(batches, lambda b: b.num_rows, BLOCK):
        yield work(rows)


def _whole_blocks(batches: Iterator[pa.RecordBatch], weight, limit: int) -> Iterator[pa.Table]:
    """Batches sorted by block in tables of about limit in weight that end where a block ends."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += weight(batch)
        if size > limit:
            rows = pa.Table.from_batches(held).combine_chunks()
            block = rows["block"].to_numpy()
            cut = int(np.searchsorted(block, block[-1]))
            if cut:
                yield rows[:cut]
                held = rows[cut:].to_batches()
            size = sum(weight(x) for x in held) if cut else 0  # an unfinished block waits for as much again
    if held:
        yield pa.Table.from_batches(held)


def _paired(sets: DataFrame, by: Column, parts: str, others: str, right: Column | None) -> DataFrame:
    """sets with block and right: each set's part of its group (of parts) meets all parts of the other group (of others); a
    group meets itself where right is null, each two parts once."""
    part = F.pmod(F.xxhash64("k"), F.col(parts)).cast("int")
    rows = sets.withColumn("_i", part).withColumn("_j", F.explode(F.sequence(F.lit(0), F.col(others) - 1)))
    right = F.coalesce(right, F.col("_j") < F.col("_i")) if right is not None else F.col("_j") < F.col("_i")
    return rows.withColumn("right", right).withColumn("block", F.xxhash64(by, F.when(F.col("right"), F.col("_j")).otherwise(F.col("_i")), F.when(F.col("right"), F.col("_i")).otherwise(F.col("_j"))))


def _visits(met: DataFrame) -> DataFrame:
    columns = ("block", "right", "k", "n", "c", "r", "g")
    return met.select(*columns).repartition("block").sortWithinPartitions("block").mapInArrow(_open, "k long, n long, c long, g long, to long").distinct()


def _pieces(n: Column, entries: Column | None = None) -> Column:
    return (F.ceil(n / PART) if entries is None else F.greatest(F.ceil(n / PART), F.ceil(entries / CAP))).cast("int")


def _parts(mixed: DataFrame, turn: int) -> DataFrame:
    """A turn: sets that can link within a part of a column meet the others of a part of one such column, another part and column each turn."""
    dealt = mixed.withColumn("g", F.col("h")).withColumn("_part", F.pmod(F.xxhash64("k", F.lit(turn)), _pieces(F.col("m"))))
    visits = _visits(dealt.withColumn("block", F.xxhash64("h", "_part")).withColumn("right", F.lit(False)))
    sets = materialize(visits.groupBy("k").agg(F.min_by("to", F.xxhash64("to", F.lit(turn))).alias("g"), F.max("n").alias("n"), F.max("c").alias("c")))
    sizes = sets.groupBy("g").agg(_pieces(F.count("*"), F.sum("n")).alias("parts"))
    part = F.pmod(F.xxhash64("k", F.lit(turn + TURNS)), F.col("parts"))
    blocks = materialize(sets.join(few(sizes), "g").select(F.xxhash64("g", part).alias("block"), "k", "c", F.lit(False).alias("right")))
    several = blocks.groupBy("block").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("block")
    return blocks.join(several, "block", "left_semi")


def _blocks(mixed: DataFrame) -> DataFrame:
    """All pairs of sets of different components that share a long column and can link, each in one block of two parts.

    A set's home is its longest column; a home's sets are grouped by size band, and large components are groups by
    themselves. Columns give which sets can link with which groups; then two groups meet with these sets alone, so two
    sets meet once, whatever the number of columns that they share.
    """
    sets = materialize(mixed.groupBy("k").agg(F.max_by("h", F.struct("m", "h")).alias("home"), F.max("n").alias("n"), F.max("c").alias("c")).withColumn("band", F.floor(F.ln("n") / math.log(DEN / NUM))))
    large = sets.groupBy("home", "band", "c").agg(F.count("*").alias("m")).filter(F.col("m") >= PART // 8).select("home", "band", "c", F.col("c").alias("z"))
    groups = sets.join(few(large), ["home", "band", "c"], "left").select("k", F.xxhash64("home", "band", F.coalesce("z", F.lit(0).cast("long"))).alias("g"))
    met = _paired(mixed.join(materialize(groups), "k").withColumn("_n", _pieces(F.col("m"))), F.col("h"), "_n", "_n", None)
    visits = materialize(_visits(met))
    sizes = visits.groupBy("g", "to").agg(_pieces(F.count("*"), F.sum("n")).alias("parts"))
    both = sizes.join(sizes.toDF("to", "g", "others"), ["g", "to"])
    right = F.when(F.col("g") != F.col("to"), F.col("g") > F.col("to"))
    return _paired(visits.join(few(both), ["g", "to"]), F.struct(F.least("g", "to"), F.greatest("g", "to")), "parts", "others", right).select("block", "k", "c", "right")


def _links(blocks: DataFrame, rows: DataFrame, reps: DataFrame) -> DataFrame:
    """Edges (a, b) between components: the products of blocks (block, k, c, right) of whole sets. The texts that take part, one
    document's for each set, are picked by a broadcast of their ids while these are few, else by a join."""
    ends = blocks.join(reps, F.col("k") == F.col("_k")).select("block", "c", "right", F.col("_rep").alias("_rid"))
    texts = rows.select("_rid", "_text").join(few(ends), "_rid").select("block", "c", "right", F.col("_text").alias("text"))
    return materialize(texts.repartition("block").sortWithinPartitions("block").mapInArrow(_linked, "a long, b long"))


def deduplicate(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one document of each component: the one with the smallest key (of rows that share it, the smallest text; of
    rows alike in both, one). All columns stay as they are, whatever their names; null and blank texts all stay."""
    rows = numbered(docs, key, text)
    kept = near_duplicates(rows.select("_rid", "_text"), key="_rid", text="_text").filter("first").select("_rid")
    return rows.join(few(kept), "_rid", "left_semi").select("_row.*")
