"""Phrase mining: Misra-Gries summaries per hash partition keep every frequent n-gram, a second pass counts those exactly."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalith.llm.common import RUN_BYTES, Rolling, few, materialize, mix, runs, signed, text_buffer

#: Different n-grams a task holds before it sends their counts on.
HELD = 1 << 21
#: Different phrases with their texts a task holds in the second pass.
HELD_TEXTS = 1 << 18
#: Entries of a summary in one row, at most.
ROW = 1 << 16
#: Bits of a filter of n-grams (8 MB, whatever the data), and the rows it is made in. A full one passes more n-grams on, no fewer.
BITS, SLICES = 26, 10

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Run:
    """Words of some texts: places in data, the piece each stands in, its hash w, and its hash together with the text's language."""

    def __init__(self, data: np.ndarray, at: np.ndarray, seeds: np.ndarray):
        self.data = _LOWER[data]
        kind = _KIND[data]
        word = np.zeros(len(data) + 2, bool)
        word[1:-1] = kind == 0
        first = word[1:-1] & ~word[:-2]
        last = word[1:-1] & ~word[2:]
        inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
        first[inner] = word[1:-1][inner]
        last[inner - 1] = word[1:-1][inner - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(at, self.starts, "right") - 1
        self.piece = np.cumsum(kind == 2, dtype=np.int64)[self.starts] + self.doc if len(data) else self.doc
        self.w = Rolling(self.data).of(self.starts, self.ends)
        self.h1 = mix(self.w ^ seeds[self.doc])

    def phrase(self, i: int, n: int) -> str:
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[i : i + n], self.ends[i : i + n], strict=True)).decode("utf-8", "replace")


def cut(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, text) with texts over RUN_BYTES cut at ends of pieces, over which no phrase reaches."""
    out, of = [at[:1]], []
    for i in np.flatnonzero(np.diff(at) > RUN_BYTES):
        a, b = int(at[i]), int(at[i + 1])
        breaks = np.flatnonzero(_KIND[data[a:b]] == 2)
        marks = breaks[np.unique(np.minimum(np.searchsorted(breaks, np.arange(RUN_BYTES, b - a, RUN_BYTES)), len(breaks) - 1))] if len(breaks) else breaks
        out.append(a + marks[(marks > 0) & (marks < b - a)])
    edges = np.unique(np.concatenate([at, *out])) if len(out) > 1 else at
    of = np.maximum(np.searchsorted(at, edges[:-1], "right") - 1, 0) if len(out) > 1 else np.arange(len(at) - 1)
    return edges, of


def seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def read(batch: pa.RecordBatch) -> Iterator[tuple[Run, list[str], np.ndarray]]:
    """(run, languages, language of each of the run's texts) over a batch of (lang, text)."""
    data, at = text_buffer(batch.column(1))
    langs = batch.column(0).dictionary_encode()
    names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy()
    seeds = np.array([seed(x) for x in names], np.uint64)
    at, of = cut(data, at)
    for i, j in runs(at):
        own = code[of[i:j]]
        yield Run(data[at[i] : at[j]], at[i : j + 1] - at[i], seeds[own]), names, own


class Filter:
    """n-grams by BITS bits of their hashes: none that was put in is missing."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> np.uint64(64 - BITS)
        return (self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def chains(run: Run, filters: dict[int, Filter], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, places, hashes) of a run's n-grams of up to longest words, of which all words and pairs of words are in the filters that
    there are. Filters: 1 words, 2 pairs, 3 all longer ones."""
    ok = filters[1].has(run.h1) if 1 in filters else np.ones(len(run.h1), bool)
    at = np.flatnonzero(ok)
    yield 1, at, run.h1[at]
    if longest < 2 or len(run.h1) < 2:
        return
    at = np.flatnonzero(ok[:-1] & ok[1:] & (run.piece[:-1] == run.piece[1:]))
    keys = mix(run.h1[at] * _STEP + run.w[at + 1])
    if 2 in filters:
        fits = filters[2].has(keys)
        at, keys = at[fits], keys[fits]
    yield 2, at, keys
    pair = np.zeros(len(run.h1) + longest, bool)
    pair[at] = True
    for n in range(3, longest + 1):
        fits = pair[at + n - 2]
        at = at[fits]
        keys = mix(keys[fits] * _STEP + run.w[at + n - 1])
        if 3 in filters:
            kept = filters[3].has(keys)
            yield n, at[kept], keys[kept]
        else:
            yield n, at, keys


def united(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys as one with their sum; keys ascend."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(counts[order], new) if len(new) else counts[:0]


class Summary:
    """A Misra-Gries summary: at most capacity keys with counts, each at most lost under its true count. Summaries of parts merge
    into one of the whole: where there are more keys than fit, all counts fall by the greatest that doesn't fit."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        k, c = united(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        if len(k) > self.capacity:
            fall = int(np.partition(c, len(c) - self.capacity - 1)[len(c) - self.capacity - 1])
            self.lost += fall
            c = c - fall
            k, c = k[c > 0], c[c > 0]
        self.keys, self.counts = k, c


SUMMARY = "part int, kind int, mass long, keys binary, counts binary"


def summaries(texts: DataFrame, level: int, filters: dict[int, Filter], longest: int, parts: int) -> DataFrame:
    """Counts of a level's n-grams in a task's texts, by hash partition: a row of kind 0 has a partition's mass, rows of kind 1
    its keys. Levels: 1 words, 2 pairs, 3 all longer ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def shipped() -> Iterator[pa.RecordBatch]:
            keys, counts = held.pop()
            part = (keys % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            keys, counts, part = keys[order], counts[order], part[order]
            edges = np.searchsorted(part, np.arange(parts + 1))
            rows: list[tuple] = []
            for p in np.flatnonzero(np.diff(edges)).tolist():
                a, b = int(edges[p]), int(edges[p + 1])
                rows.append((p, 0, int(counts[a:b].sum()), b"", b""))
                rows += [(p, 1, 0, keys[i : min(b, i + ROW)].tobytes(), counts[i : min(b, i + ROW)].tobytes()) for i in range(a, b, ROW)]
            for i in range(0, len(rows), 64):
                columns = zip(*rows[i : i + 64], strict=True)
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["part", "kind", "mass", "keys", "counts"])

        size = 0
        for batch in batches:
            for run, _, _ in read(batch):
                made = [keys for n, _, keys in chains(run, filters, 2 if level == 2 else longest if level == 3 else 1) if min(n, 3) == level]
                keys = np.concatenate(made) if made else np.zeros(0, np.uint64)
                keys, counts = united(keys, np.ones(len(keys), np.int64))
                held.append((keys, counts))
                size += len(keys)
                if size > 2 * HELD:
                    held[:] = [united(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                    size = len(held[0][0])
                    if size > HELD:
                        yield from shipped()
                        size = 0
        if held:
            held[:] = [united(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            yield from shipped()

    return texts.mapInArrow(work, SUMMARY)


def survivors(sent: DataFrame, parts: int, least: int) -> DataFrame:
    """(key) of all n-grams that can stand least times or more. A partition's summary holds more keys than its mass divided by
    least, so what a count lost is less than least; a key whose count and loss together reach least survives."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, held, waiting = None, 0, None, []

        def settle() -> None:
            nonlocal held
            if waiting:
                held = held or Summary(mass // least + 1)
                held.merge(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
                waiting.clear()

        def ended() -> Iterator[pa.RecordBatch]:
            settle()
            if held is not None:
                keys = held.keys[held.counts + held.lost >= least]
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys))], ["key"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    yield from ended()
                    part, mass, held = row["part"], 0, None
                if row["kind"] == 0:
                    mass += row["mass"]
                else:
                    waiting.append((np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.int64)))
                    if sum(len(k) for k, _ in waiting) > HELD // 2:
                        settle()
        yield from ended()

    return sent.repartition(parts, "part").sortWithinPartitions("part", "kind").mapInArrow(work, "key long")


def filter_of(keys: DataFrame) -> Filter:
    """Bits of keys: each slice of them is set in one task, and all of them together have a fixed size."""
    wide = 1 << (BITS - SLICES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            k = batch.column(1).to_numpy().view(np.uint64) >> np.uint64(64 - BITS)
            for s in np.unique(k >> np.uint64(BITS - SLICES)).tolist():
                mine = k[k >> np.uint64(BITS - SLICES) == s]
                made.setdefault(s, np.zeros(wide, bool))[(mine & np.uint64(wide - 1)).astype(np.int64)] = True
        yield pa.RecordBatch.from_pydict({"slice": pa.array(list(made), pa.int32()), "bits": pa.array([np.packbits(b, bitorder="little").tobytes() for b in made.values()], pa.binary())})

    sliced = keys.select(F.shiftrightunsigned("key", 64 - SLICES).cast("int").alias("slice"), "key")
    bits = np.zeros((1 << BITS) // 8, np.uint8)
    for r in sliced.repartition("slice").mapInArrow(work, "slice int, bits binary").collect():
        bits[r["slice"] * (wide // 8) : (r["slice"] + 1) * (wide // 8)] |= np.frombuffer(r["bits"], np.uint8)
    return Filter(bits)


COUNTED = "part int, names array<string>, counts binary"


def counted(texts: DataFrame, filters: dict[int, Filter], longest: int, parts: int) -> DataFrame:
    """Counts of the n-grams in the filters in a task's texts, by hash partition. A name is a language, a line break and a phrase (which
    has none); without a phrase it stands for all words of the language."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, number, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        names: list[str] = []
        totals: dict[str, int] = {}

        def shipped() -> Iterator[pa.RecordBatch]:
            order = np.argsort(keys % np.uint64(parts), kind="stable")
            part = (keys[order] % np.uint64(parts)).astype(np.int64)
            edges = np.searchsorted(part, np.arange(parts + 1))
            rows = [(seed(x) % parts, [f"{x}\n"], np.array([n], np.int64)) for x, n in totals.items()]
            for p in np.flatnonzero(np.diff(edges)).tolist():
                for i in range(int(edges[p]), int(edges[p + 1]), ROW):
                    at = order[i : min(int(edges[p + 1]), i + ROW)]
                    rows.append((p, [names[x] for x in number[at].tolist()], counts[at]))
            for p, named, c in rows:
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([named], pa.list_(pa.string())), pa.array([c.tobytes()], pa.binary())], ["part", "names", "counts"])

        for batch in batches:
            for run, langs, of in read(batch):
                for code, n in zip(*np.unique(of[run.doc], return_counts=True), strict=True):
                    totals[langs[code]] = totals.get(langs[code], 0) + int(n)
                for n, at, found in chains(run, filters, longest):
                    u, first, c = np.unique(found, return_index=True, return_counts=True)
                    place = np.searchsorted(keys, u)
                    known = place < len(keys)
                    known[known] = keys[place[known]] == u[known]
                    counts[place[known]] += c[known]
                    fresh = np.flatnonzero(~known)
                    number = np.insert(number, place[fresh], len(names) + np.arange(len(fresh)))
                    keys, counts = np.insert(keys, place[fresh], u[fresh]), np.insert(counts, place[fresh], c[fresh])
                    names += [f"{langs[of[run.doc[i]]]}\n{run.phrase(i, n)}" for i in at[first[fresh]].tolist()]
                if len(keys) > HELD_TEXTS:
                    yield from shipped()
                    keys, number, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
                    names.clear()
                    totals.clear()
        yield from shipped()

    return texts.mapInArrow(work, COUNTED)


def summed(sent: DataFrame, parts: int, least: int) -> DataFrame:
    """(lang, words, phrase, f) of all names that stand least times or more, and of the languages (0 words)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, Counter()

        def ended() -> Iterator[pa.RecordBatch]:
            rows = [(*name.rpartition("\n")[::2], f) for name, f in held.items() if f >= least or name.endswith("\n")]
            held.clear()
            for i in range(0, len(rows), 1 << 14):
                langs, named, f = zip(*rows[i : i + (1 << 14)], strict=True)
                words = [x.count(" ") + 1 if x else 0 for x in named]
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.int32()), pa.array(named, pa.string()), pa.array(f, pa.int64())], ["lang", "words", "phrase", "f"])

        for batch in batches:
            for p, names, counts in zip(*batch.columns, strict=True):
                if p.as_py() != part:
                    yield from ended()
                    part = p.as_py()
                for name, n in zip(names.values.to_pylist(), np.frombuffer(counts.as_py(), np.int64).tolist(), strict=True):
                    held[name] += n
        yield from ended()

    return sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(work, "lang string, words int, phrase string, f long")


def frequent(docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = 5, least: int = 100, unknown: str = "und") -> DataFrame:
    """(lang, words, phrase, f): every phrase of up to longest words that stands least times or more in the texts of a language,
    with its exact count, and a row of 0 words for all words of a language.

    First passes, for words, pairs and longer phrases: tasks count n-grams by 64-bit hashes and send the counts to hash partitions,
    whose summaries keep all that can be frequent; a phrase is looked at only if its words and pairs survived. A last pass
    counts the survivors by their texts. What the passes hand on to tasks has a fixed size. Within a task of the last pass two
    phrases with the same 64-bit hash would count as one. Null texts have no words, a null lang is unknown's. A
    repeated row counts each time. A text is held in parts of about a megabyte where it has ends of pieces, else whole.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(unknown)).alias("lang"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    filters: dict[int, Filter] = {}
    for level in range(1, min(longest, 3) + 1):
        filters[level] = filter_of(survivors(summaries(texts, level, dict(filters), longest, parts), parts, least))
    return materialize(summed(counted(texts, filters, longest, parts), parts, least))


def collocations(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = 5, least: int = 100, top: int = 2000, unknown: str = "und"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's top phrases of 2 to longest words that stand a >= least times.

    A cut of a phrase in two gives the counts l and r of its parts and the score floor(1000 * a * n / (l * r)), n being all words of
    the language; the lowest of its cuts counts, of equal ones the first. Phrases that stand within a longer one as often as
    anywhere are dropped. Order: score and a descending, then the phrase's bytes. Products are decimals of 38 digits.
    Letters A-Z are lowered; pieces end at . , ; : ! ? and line breaks; words at spaces and tabs. Empty tables give no rows.
    """
    every = frequent(docs, text=text, lang=lang, longest=longest, least=least, unknown=unknown)
    total = few(every.filter("words = 0").select("lang", F.col("f").alias("n")))
    phrases = every.filter("words > 0")
    parts = F.split("phrase", " ")
    some = phrases.filter("words > 1").withColumnRenamed("f", "a")

    def piece(start, length):
        return F.array_join(F.slice(parts, start, length), " ")

    cuts = some.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"left": piece(F.lit(1), F.col("k")), "right": piece(F.col("k") + 1, F.col("words") - F.col("k"))})
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(total, "lang")
    exact = "cast((1000 * cast(a as decimal(16,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as long)"
    cuts = cuts.withColumn("score", F.expr(exact))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("best"))
    lengths = F.explode(F.sequence(F.lit(2), F.col("words") - 1))
    within = some.filter("words > 2").withColumn("m", lengths).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)))
    within = within.select("lang", piece(F.col("i"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(within, ["lang", "phrase"], "left").filter("longer is null or longer < a")
    kept = kept.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
