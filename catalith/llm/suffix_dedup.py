"""Removal of repeated byte strings, by deep-shallow sorting of the suffixes that can repeat."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.llm.common import Rolling, mix, runs, signed, text_buffer, unique_ids

#: Bytes of a string whose repetition counts, and of the gram that picks its anchor.
LENGTH, GRAM = 100, 24
SPAN = LENGTH - GRAM + 1
#: Anchors with more occurrences are dealt by the text around them, in blocks of neighbouring strings.
HOT, STEP = 1000, 26
#: An anchor that one run of texts has so many times is very frequent as well, wherever else it stands.
HEAVY = 32
#: Bytes to which multikey quicksort goes; what still ties goes to blind tries.
SHALLOW = 16
#: Strings sorted at once.
BLOCK = 60_000


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, hash, place, first, last) of the anchors of documents that lie end to end.

    A string of LENGTH bytes has as its anchor the gram with the least hash within it, the first of equal ones: equal
    strings have equal anchors at the same distance. first and last: where the strings with this anchor start.
    """
    at = at - at[0]
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none.astype(np.uint64), none, none, none
    g = Rolling(data).every(GRAM)
    m = (g & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < SPAN:
        rest = SPAN - width
        m = np.minimum(m[:-rest], m[rest:])
    starts = np.maximum(0, at[1:] - at[:-1] - LENGTH + 1)
    doc = np.repeat(np.arange(len(starts)), starts)
    s = np.arange(len(doc)) - np.repeat(np.cumsum(starts) - starts, starts) + at[doc]
    place = (m[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]))) if len(s) else none
    last = np.append(new[1:], len(s)) - 1
    p = place[new]
    return doc[new], g[p], p, s[new], s[last] if len(new) else none


def _words(buffer: np.ndarray, start: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes of each string from depth on, as numbers that sort like them. The buffer goes on for long enough."""
    return np.lib.stride_tricks.sliding_window_view(buffer, 8)[start + depth].view(">u8")[:, 0].astype(np.uint64)


def deep_shallow(buffer: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of strings of one length (a multiple of 8), and whether each equals the one before it in that order.

    Shallow: multikey quicksort, eight characters a key, on ties only, to SHALLOW bytes. Deep: each group of strings that
    still tie becomes a blind trie. Its strings are compared with the group's first one; where one leaves it (skip) and
    with which byte (branch) puts it under a node, and strings of the same node go on as a group of their own. All groups
    take a step at a time, and ties keep their order.
    """
    order = np.arange(len(start))
    group = np.zeros(len(start), np.int64)  # of each place in the order; members of a group stand together
    open_ = np.arange(len(start))
    for depth in range(0, min(SHALLOW, length), 8):
        key = _words(buffer, start[order[open_]], depth)
        by = np.lexsort((key, group[open_]))
        order[open_] = order[open_][by]
        key = key[by]
        differs = np.append(True, (group[open_][1:] != group[open_][:-1]) | (key[1:] != key[:-1])) if len(open_) else np.zeros(0, bool)
        group[open_] = open_[np.flatnonzero(differs)][np.cumsum(differs) - 1] if len(open_) else 0
        size = np.bincount(group, minlength=len(start))
        open_ = np.flatnonzero(size[group] > 1)
    if length <= SHALLOW:
        return order, np.append(False, group[1:] == group[:-1])[: len(start)]
    done = np.zeros(len(start), bool)  # the group's strings are equal
    while len(open_):
        member = order[open_]
        first = order[group[open_]]
        skip = np.full(len(open_), length)
        todo = np.flatnonzero(member != first)
        for depth in range(SHALLOW, length, 8):
            if not len(todo):
                break
            x = _words(buffer, start[member[todo]], depth) ^ _words(buffer, start[first[todo]], depth)
            off = x != 0
            if off.any():
                at = (x[off].astype(">u8").view(np.uint8).reshape(-1, 8) != 0)
                skip[todo[off]] = depth + at.argmax(1)
                todo = todo[~off]
        same = skip == length
        at = np.minimum(skip, length - 1)
        branch = np.where(same, 0, buffer[start[member] + at].astype(np.int64))
        side = np.where(same, 0, np.where(branch < buffer[start[first] + at], -1, 1))
        by = np.lexsort((branch, -side * skip * (side != 0), side, group[open_]))
        order[open_] = member[by]
        key = np.stack([group[open_], side[by], skip[by], branch[by]])
        differs = np.append(True, (key[:, 1:] != key[:, :-1]).any(0))
        group[open_] = open_[np.flatnonzero(differs)][np.cumsum(differs) - 1]
        done[open_] = same[by]
        size = np.bincount(group, minlength=len(start))
        open_ = np.flatnonzero((size[group] > 1) & ~done)
    return order, np.append(False, group[1:] == group[:-1])[: len(start)]


def _earliest(order: np.ndarray, same: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of each string, the one with the least rank among those equal to it."""
    heads = np.flatnonzero(~same)
    if not len(heads):
        return order
    of = np.cumsum(~same) - 1
    by = np.lexsort((rank[order], of))
    out = np.empty_like(order)
    out[order] = order[by[heads]][of]
    return out


CONTEXT = 2 * SPAN + GRAM - 2 + 2  # header of two bytes, then the bytes of all strings of an anchor
ROOM = -(-CONTEXT // 8) * 8
SCHEMA = "h long, d long, lo int, off int, n int, text binary"
NAMES = ("h", "d", "lo", "off", "n", "text")


def _rows(h, d, lo, off, n, text) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"h": np.asarray(h, np.int64), "d": np.asarray(d, np.int64), "lo": np.asarray(lo, np.int32), "off": np.asarray(off, np.int32), "n": np.asarray(n, np.int32), "text": text})


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, d, p, told) of all anchors. Those that a run has HEAVY times are known to repeat: their places are told already and
    needn't come together, and one row a run (d -1) says so where the others of this hash meet."""
    for batch in batches:
        batch = batch.filter(pa.compute.invert(batch.column(2)))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, at = text_buffer(batch.column(1))
        for i, j in runs(at):
            doc, h, p, _, _ = anchors(data[at[i] : at[j]], at[i : j + 1])
            values, of, count = np.unique(h, return_inverse=True, return_counts=True)
            heavy = values[count >= HEAVY]
            none = np.full(len(heavy), -1)
            d = np.append(ids[i:j].astype(np.int64)[doc], none)
            told = np.append(count[of] >= HEAVY, np.zeros(len(heavy), bool))
            yield pa.RecordBatch.from_pydict({"h": signed(np.append(h, heavy)), "d": d, "p": np.append(p - (at[i:j] - at[i])[doc], none).astype(np.int32), "told": told})


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of anchors sorted by (told, hash), (d, p, hot) of those that occur again; hot: over HOT times, or HEAVY times in one run
    of texts. At most HOT occurrences of one anchor wait for that to be known."""
    held: list[tuple] = []
    rows, hottest = 0, None

    def judge(h, d, p, whole: bool):
        """Tells of all runs but, unless whole, the last one; returns what waits."""
        nonlocal hottest
        edge = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        size = np.diff(np.append(edge, len(h)))
        hot = (size > HOT) | np.logical_or.reduceat(d < 0, edge)
        if h[0] == hottest:
            hot[0] = True
        stay = 0 if whole or hot[-1] else size[-1]
        n = np.repeat(size, size)
        hot_row = np.repeat(hot, size)
        keep = ((n > 1) | hot_row) & (d >= 0)
        keep[len(h) - stay :] = False
        hottest = h[-1] if hot[-1] else None
        return pa.RecordBatch.from_pydict({"d": d[keep], "p": p[keep], "hot": hot_row[keep]}), (h[len(h) - stay :], d[len(h) - stay :], p[len(h) - stay :])

    for batch in batches:
        h, d, p, told = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
        if told.any():
            yield pa.RecordBatch.from_pydict({"d": d[told], "p": p[told], "hot": np.ones(int(told.sum()), bool)})
        held.append((h[~told], d[~told], p[~told]))
        rows += len(held[-1][0])
        if rows >= 4 * BLOCK:
            out, wait = judge(*(np.concatenate(x) for x in zip(*held, strict=True)), False)
            yield out
            held, rows = [wait], len(wait[0])
    if rows:
        yield judge(*(np.concatenate(x) for x in zip(*held, strict=True)), True)[0]


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each repeated anchor, the bytes of the strings that have it: n strings from lo on, the first off bytes before the
    anchor. Of contexts that are equal within the task's run only the earliest goes on; the others' strings are known to
    repeat and go on as ranges (off -1), spread over all tasks."""
    for batch in batches:
        batch = batch.filter(batch.column(5).is_valid())
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        data, at = text_buffer(batch.column(1))
        marks = batch.column(5)
        flat = marks.flatten()
        to = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(marks).to_numpy(zero_copy_only=False))])
        marked, hot = flat.field("p").to_numpy(zero_copy_only=False).astype(np.int64), flat.field("hot").to_numpy(zero_copy_only=False)
        for i, j in runs(at):
            part, base = data[at[i] : at[j]], at[i:j] - at[i]
            doc, h, p, lo, hi = anchors(part, at[i : j + 1])
            own = np.repeat(np.arange(j - i), to[i + 1 : j + 1] - to[i:j])
            where = base[own] + marked[to[i] : to[j]]
            key = np.zeros(len(part) + 1, np.int8)
            key[where] = 1 + hot[to[i] : to[j]].astype(np.int8)
            keep = key[p] > 0
            doc, h, p, lo, hi = doc[keep], h[keep], p[keep], lo[keep], hi[keep]
            warm = key[p] == 2
            if warm.any():
                found = [(doc[~warm], h[~warm], p[~warm], lo[~warm], hi[~warm])]
                sums = Rolling(part)
                d2, p2, lo2, hi2 = doc[warm], p[warm], lo[warm], hi[warm]
                for b in range(-(-SPAN // STEP)):
                    a, z = np.maximum(lo2, p2 - STEP * b - STEP + 1), np.minimum(hi2, p2 - STEP * b)
                    ok = a <= z
                    core = p2[ok] - STEP * b
                    found.append((d2[ok], mix(sums.of(core, core + LENGTH - STEP + 1) + np.uint64(b)), p2[ok], a[ok], z[ok]))
                doc, h, p, lo, hi = (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(doc):
                continue
            sums = Rolling(part)
            whole = sums.of(lo, hi + LENGTH) ^ mix(h + (p - lo).astype(np.uint64))
            by = np.lexsort((lo, ids[i:j][doc], whole))
            first = np.append(True, whole[by][1:] != whole[by][:-1])
            one, more = by[first], by[~first]
            lengths = hi[one] - lo[one] + LENGTH
            ends = np.concatenate([[0], np.cumsum(lengths)])
            spot = np.arange(ends[-1]) + np.repeat(lo[one] - ends[:-1], lengths)
            text = pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(part[spot].tobytes())])
            yield _rows(signed(h[one]), ids[i:j][doc[one]], lo[one] - base[doc[one]], p[one] - lo[one], hi[one] - lo[one] + 1, text)
            if len(more):
                spread = mix(ids[i:j][doc[more]].view(np.uint64) ^ lo[more].astype(np.uint64))
                yield _rows(signed(spread), ids[i:j][doc[more]], lo[more] - base[doc[more]], np.full(len(more), -1), hi[more] - lo[more] + 1, pa.array([b""] * len(more), pa.binary()))


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, a, z): bytes a to z of document d are covered by strings that also start earlier. Contexts come sorted by
    (anchor, document, place); those of one anchor are compared with each other only."""
    carry: list[tuple] = []

    def flagged(d, a, z):
        return pa.RecordBatch.from_pydict({"d": d.astype(np.int64), "a": a.astype(np.int32), "z": z.astype(np.int32)})

    def judge(h, d, lo, off, n, text: tuple[np.ndarray, np.ndarray]):
        known = off < 0
        if known.any():
            yield flagged(d[known], lo[known], lo[known] + n[known] - 1 + LENGTH)
        x = np.flatnonzero(~known)
        if len(x) < 2:
            return
        alone = np.ones(len(x), bool)
        near = h[x][1:] == h[x][:-1]
        alone[1:] &= ~near
        alone[:-1] &= ~near
        x = x[~alone]
        if not len(x):
            return
        h, d, lo, off, n = h[x], d[x], lo[x], off[x], n[x]
        data, at = text
        size = at[x + 1] - at[x]
        buffer = np.zeros(len(x) * ROOM + 16, np.uint8)
        start = np.arange(len(x)) * ROOM
        buffer[start], buffer[start + 1] = off, n
        spot = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        buffer[np.repeat(start + 2, size) + spot] = data[np.repeat(at[x], size) + spot]
        rank = np.lexsort((lo, d))
        rank[rank] = np.arange(len(x))
        column = np.cumsum(np.append(False, h[1:] != h[:-1]))
        order, same = deep_shallow(buffer, start, ROOM)
        same &= np.append(False, column[order][1:] == column[order][:-1])
        first = _earliest(order, same, rank)
        later = first != np.arange(len(x))
        yield flagged(d[later], lo[later], lo[later] + n[later] - 1 + LENGTH)
        one = np.flatnonzero(~later)
        several = np.bincount(column[one], minlength=column[-1] + 1)[column[one]] > 1
        one = one[several]
        if not len(one):
            return
        room = -(-LENGTH // 8) * 8
        for i, j in _parts(column[one], n[one]):
            part = one[i:j]
            of = np.repeat(part, n[part])
            r = np.arange(len(of)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
            begin = start[of] + 2 + r
            if room != LENGTH:
                strings = np.zeros(len(of) * room + 16, np.uint8)
                strings[:-16].reshape(-1, room)[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(buffer, LENGTH)[begin]
                begin = np.arange(len(of)) * room
            else:
                strings = buffer
            order, same = deep_shallow(strings, begin, room)
            rank_here = np.lexsort((lo[of] + r, d[of]))
            rank_here[rank_here] = np.arange(len(of))
            again = _earliest(order, same, rank_here) != np.arange(len(of))
            edge = np.append(True, of[1:] != of[:-1])
            begins = np.flatnonzero(again & (edge | ~np.append(False, again[:-1])))
            ends = np.flatnonzero(again & np.append(edge[1:] | ~again[1:], True))
            yield flagged(d[of[begins]], lo[of[begins]] + r[begins], lo[of[ends]] + r[ends] + LENGTH)

    def _parts(column, n):
        i = 0
        while i < len(n):
            total = np.cumsum(n[i : i + BLOCK * 2])
            j = i + max(1, int(np.searchsorted(total, 2 * BLOCK)))
            while j < len(n) and column[j] == column[j - 1]:
                j += 1
            yield i, j
            i = j

    def joined():
        h, d, lo, off, n = (np.concatenate([c[k] for c in carry]) for k in range(5))
        text = pa.chunked_array([c[5] for c in carry]).combine_chunks()
        return h, d, lo, off, n, text

    rows = 0
    for batch in batches:
        carry.append((*(batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)), batch.column(5)))
        rows += batch.num_rows
        if rows >= BLOCK:
            h, d, lo, off, n, text = joined()
            cut = int(np.searchsorted(h, h[-1]))
            if cut:
                yield from judge(h[:cut], d[:cut], lo[:cut], off[:cut], n[:cut], text_buffer(text[:cut]))
                carry, rows = [(h[cut:], d[cut:], lo[cut:], off[cut:], n[cut:], text[cut:])], len(h) - cut
    if carry:
        h, d, lo, off, n, text = joined()
        yield from judge(h, d, lo, off, n, text_buffer(text))


def _removed(characters: bool):
    """What is left of each text; if characters, without the bytes of characters that are cut in two."""

    def rest_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, copy, keys, carried, spans = batch.column(0), batch.column(2).to_pylist(), batch.column(3), batch.column(4), batch.column(5)
        data, at = text_buffer(batch.column(1))
        flat = spans.flatten()
        to = np.concatenate([[0], np.cumsum(np.nan_to_num(pa.compute.list_value_length(spans).to_numpy(zero_copy_only=False)).astype(np.int64))])
        a, z = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("a", "z"))
        kept, n_removed, n_spans = [], [], []
        for i in range(batch.num_rows):
            whole = data[at[i] : at[i + 1]]
            if copy[i]:
                kept.append(b"")
                n_removed.append(len(whole))
                n_spans.append(1)
            elif to[i] == to[i + 1]:
                kept.append(whole.tobytes())
                n_removed.append(0)
                n_spans.append(0)
            else:
                cover = np.zeros(len(whole) + 1, np.int32)
                np.add.at(cover, a[to[i] : to[i + 1]], 1)
                np.add.at(cover, z[to[i] : to[i + 1]], -1)
                gone = np.cumsum(cover[:-1]) > 0
                rest = whole[~gone].tobytes()
                kept.append(rest.decode("utf-8", "ignore").encode() if characters else rest)
                n_removed.append(int(gone.sum()))
                n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
        sizes = at[1:] - at[:-1]
        return pa.RecordBatch.from_pydict({"_rid": ids, "_key": keys, "n_bytes": sizes, "n_removed": np.array(n_removed, np.int64), "n_spans": np.array(n_spans, np.int64), "kept": pa.array(kept, pa.binary()), "_carried": carried})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in runs(text_buffer(batch.column(1))[1]):
                yield rest_of(batch.slice(i, j - i))

    return work


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), characters: bool = False) -> DataFrame:
    """One row a document: _rid (its unique key in the order of key and text), _key (its key, an integer), n_bytes, n_removed,
    n_spans, kept (binary), _carried (a struct of the columns carry; they move with the text).

    Each byte of a text's UTF-8 form goes that a string of 100 bytes covers which also starts earlier: in a document with
    a smaller key, or earlier in the same one. Strings are judged on the input; matches never cross documents. If characters,
    kept lacks the bytes of characters that are cut in two as well, which n_removed doesn't count.

    A whole copy of an earlier text of at least 100 bytes goes as such. In the others each string has an anchor (see
    anchors); a string whose anchor is nowhere else repeats nowhere. Around anchors that occur again, the strings that have
    them come together by the anchor's hash and are sorted, equal ones next to each other, and all but the earliest go. Very
    frequent anchors are dealt by the text around them, so tasks share them, and within a task equal contexts are united
    before they move.

    Null and empty texts and those under 100 bytes stay as they are. Documents that share a key follow by their text.
    """
    given = F.struct(F.lit(0).alias("_none"), *[F.col(c) for c in carry]).alias("_carried")
    rows = unique_ids(docs.select(*dict.fromkeys((key, text, *carry))), key, text).select(F.col("_rid").cast("long"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_bytes"), F.col(key).cast("long").alias("_key"), given)
    hashed = rows.select("_rid", F.when(F.length("_bytes") >= LENGTH, F.sha2("_bytes", 256)).alias("_h")).filter("_h is not null")
    first = hashed.groupBy("_h").agg(F.min("_rid").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").select("_h", "_first")
    copies = hashed.join(first, "_h").filter("_rid > _first").select("_rid", F.lit(True).alias("_copy"))
    dealt = rows.repartition("_rid").join(copies.hint("shuffle_hash"), "_rid", "left").select("_rid", "_bytes", F.coalesce("_copy", F.lit(False)).alias("_copy"), "_key", "_carried")

    # Sorted, so that runs of texts are the same when a task is made again.
    found = dealt.sortWithinPartitions("_rid").mapInArrow(_find_anchors, "h long, d long, p int, told boolean")
    found = found.repartition(F.when(F.col("told"), F.xxhash64("h", "d")).otherwise(F.col("h"))).sortWithinPartitions("told", "h")
    marks = found.mapInArrow(_again, "d long, p int, hot boolean").groupBy("d").agg(F.collect_list(F.struct("p", "hot")).alias("_marks")).withColumnRenamed("d", "_rid")
    # The same columns of dealt each time, so that its shuffle is made once.
    contexts = dealt.join(marks.hint("shuffle_hash"), "_rid", "left").select(*dealt.columns, "_marks").mapInArrow(_contexts, SCHEMA)
    spans = contexts.repartition("h").sortWithinPartitions("h", "d", "lo").mapInArrow(_repeats, "d long, a int, z int")
    spans = spans.groupBy("d").agg(F.collect_list(F.struct("a", "z")).alias("_spans")).withColumnRenamed("d", "_rid")
    out = T.StructType([*[T.StructField(c, T.LongType()) for c in ("_rid", "_key", "n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType()), dealt.schema["_carried"]])
    return dealt.join(spans.hint("shuffle_hash"), "_rid", "left").select(*dealt.columns, "_spans").mapInArrow(_removed(characters), out)


def deduplicate(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with text less its repeats. Bytes of a character that is cut in two go too; all rows stay, and null texts stay
    null. Columns other than text stay as they are, whatever their names; an empty table gives no rows."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    kept = remove_repeats(docs.select(F.col(key).alias("_of"), F.col(text).alias("_text"), F.col(text).isNull().alias("_null"), F.struct(F.lit(0).alias("_none"), *others).alias("_row")), key="_of", text="_text", carry=("_null", "_row"), characters=True)
    new = F.when(~F.col("_carried._null"), F.col("kept").cast("string")).alias(text)
    return kept.select(*[new if c == text else F.col(f"_carried._row.`{c}`").alias(c) for c in docs.columns])
