"""Toxicity by a weighted lexicon: Aho-Corasick over folded text, normalised by length, with exception phrases."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts that look like Latin ones, and digits that stand for letters. l and i fold to
#: one letter, as 1 stands for either.
LOOKS = {
    "a": "аαạȧ@4", "b": "Ьв8", "c": "сϲ", "d": "ԁ", "e": "еєε3", "g": "ɡ9", "h": "һ", "i": "іιı1l|", "j": "ј", "k": "кκ", "m": "м", "n": "ո",
    "o": "оοօ0", "p": "рρ", "q": "ԛ", "s": "ѕ5", "t": "тτ7", "u": "υս", "v": "ѵν", "w": "ԝ", "x": "хχ", "y": "уү", "z": "ᴢ2",
}
FOLD = {ord(x): letter for letter, alike in LOOKS.items() for x in alike} | {0x200B: None, 0x200C: None, 0x200D: None, 0xAD: None}
WORD = re.compile(r"[^\W\d_]+")
#: Labelled rows that the lexicon is learned from, at most; prefixes of words that may become entries.
SAMPLE, PREFIXES = 12_000, (4, 5, 6)
#: Least surprise of an entry: chance would give its counts once in a million.
SURPRISE = math.log(1e6)


def fold(text: str) -> str:
    return text.lower().translate(FOLD)


def hashed_remainder(key: str, m: int) -> Column:
    """crc32 of the id as text, modulo m: the fold of a row."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % m


@dataclass
class Lexicon:
    """entries: folded term -> weight; a term that ends in * fits words that begin with it, any other whole words.
    exceptions: folded phrases of words in which entries don't count. bias, slope, count: of the logistic link."""

    entries: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    bias: float = -4.0
    slope: float = 2.0
    count: float = 0.5
    _automaton: object = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_automaton": None}  # each worker makes its own

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            found: dict[str, list] = {}
            for term, weight in self.entries.items():
                found.setdefault(term.rstrip("*"), []).append((weight, term.endswith("*")))
            for phrase in self.exceptions:
                found.setdefault(phrase, []).append((None, False))
            for term, uses in found.items():
                self._automaton.add_word(term, (len(term), uses))
            if found:
                self._automaton.make_automaton()
        return self._automaton

    def hits(self, text: str) -> tuple[float, int]:
        """Sum of weights and number of the words that an entry fits and no exception covers; a word counts once, by its
        heaviest entry."""
        automaton, low = self.automaton(), fold(text)
        words: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for last, (n, uses) in automaton.iter(low) if len(automaton) else ():
            start = last - n + 1
            if start and low[start - 1].isalpha():
                continue
            whole = last + 1 == len(low) or not low[last + 1].isalpha()
            for weight, prefix in uses:
                if weight is None:
                    if whole:
                        spared.append((start, last))
                elif whole or prefix:
                    words[start] = max(words.get(start, weight), weight)
        kept = [w for s, w in words.items() if not any(a <= s <= b for a, b in spared)] if spared else list(words.values())
        return sum(kept), len(kept)

    def features(self, text: str) -> tuple[float, float]:
        total, n = self.hits(text)
        if not n:
            return 0.0, 0.0
        words = 1 + text.count(" ") + text.count("\n")
        return math.log1p(100 * total / words), math.log1p(n)

    def score(self, text: str | None) -> float:
        rate, n = self.features(text or "")
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + self.slope * rate + self.count * n))))


def _terms(text: str) -> set[str]:
    words = set(WORD.findall(fold(text)))
    return words | {f"{w[:n]}*" for w in words for n in PREFIXES if len(w) >= n}


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", train: Column | None = None, sample: int = SAMPLE, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from labelled rows (those that train keeps; at most sample of them, by a hash of their ids).

    Tasks count in how many toxic and other documents each word and word beginning stands; counts are united by a grouped
    sum. An entry stands, smoothed, in 12 times as many toxic documents as its share, and chance would give its counts once
    in a million terms at most; a longer term that a shorter entry already finds is left out. Neighbouring words with which an
    entry stands in other documents only, in three at least, become exception phrases. All that pass these tests are taken, and
    only they come to the driver: they grow with the sample, not with the corpus. Without both kinds of labels the lexicon is empty.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = known.filter(train) if train is not None else known
    chosen = known.groupBy(key).agg(F.max(label).cast("int").alias("_y")).orderBy(F.xxhash64(key), key).limit(sample)
    rows = docs.select(key, F.coalesce(text, F.lit("")).alias("_text")).join(F.broadcast(chosen), key).select("_text", "_y")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for value, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen[y].update(_terms(value.as_py()))
        both = list(seen[0].keys() | seen[1].keys())
        for i in range(0, len(both), 50_000):
            part = both[i : i + 50_000]
            yield pa.RecordBatch.from_pydict({"term": pa.array(part, pa.string()), "n0": pa.array([seen[0][t] for t in part], pa.int64()), "n1": pa.array([seen[1][t] for t in part], pa.int64())})

    counts = rows.mapInArrow(count, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    found = rows.groupBy("_y").count().collect()  # two rows
    sizes = tuple(sum(r["count"] for r in found if r["_y"] == y) for y in (0, 1))
    lexicon = Lexicon({}, [fold(x) for x in exceptions])
    if not all(sizes):
        return lexicon
    weight, least = _weight(F.col("n1"), F.col("n0"), *sizes), surprise(F.col("n1"), F.col("n0"), sizes[1] / sum(sizes))
    kept = counts.filter(F.col("n1") >= 3).select("term", weight.alias("weight")).filter((F.col("weight") >= math.log(12)) & (least >= SURPRISE)).collect()
    entries: dict[str, float] = {}
    for r in sorted(kept, key=lambda r: (len(r["term"].rstrip("*")), not r["term"].endswith("*"), r["term"])):
        term = r["term"]
        if not any(f"{term[:n]}*" in entries for n in PREFIXES if n < len(term.rstrip("*")) or not term.endswith("*")):
            entries[term] = r["weight"]
    lexicon.entries = entries

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for value, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = [m for m in re.finditer(WORD, fold(value.as_py()))]
                named = [m[0] in entries or any(f"{m[0][:n]}*" in entries for n in PREFIXES) for m in words]
                low = fold(value.as_py())
                seen[y].update({low[a.start() : b.end()] for a, b, x, z in zip(words, words[1:], named, named[1:], strict=False) if x or z})
        both = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_pydict({"term": pa.array(both, pa.string()), "n0": pa.array([seen[0][t] for t in both], pa.int64()), "n1": pa.array([seen[1][t] for t in both], pa.int64())})

    phrases = rows.mapInArrow(beside, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    lexicon.exceptions += sorted(r["term"] for r in phrases.filter("n0 >= 3 and n1 = 0").collect())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicon.features(v.as_py()) for v in batch.column(0)]
            yield pa.RecordBatch.from_pydict({"rate": pa.array([x for x, _ in found], pa.float64()), "n": pa.array([x for _, x in found], pa.float64()), "y": batch.column(1)})

    measured = rows.mapInArrow(measure, "rate double, n double, y int").groupBy("rate", "n", "y").count().collect()  # sample rows at most
    lexicon.bias, lexicon.slope, lexicon.count = logistic(np.array([[r["rate"], r["n"]] for r in measured]), np.array([r["y"] for r in measured]), np.array([r["count"] for r in measured]))
    return lexicon


def _weight(n1: Column, n0: Column, none: int, toxic: int) -> Column:
    """The logarithm of how much larger a term's share of the toxic documents is than that of the others, smoothed."""
    return F.log((n1 + 0.5) / (toxic + 1)) - F.log((n0 + 0.5) / (none + 1))


def surprise(n1: Column, n0: Column, share: float) -> Column:
    """Minus the logarithm of a bound (Chernoff's) on the chance that n1 of n1 + n0 documents are toxic where share of all are."""
    n = n1 + n0
    q = n1 / n
    rest = F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - share))).otherwise(0.0)
    return F.when(q > share, n * (q * F.log(q / share) + rest)).otherwise(0.0)


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> tuple[float, float, float]:
    """Weights of a logistic regression by Newton's method, with a small ridge on all but the bias."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)]) * max(1, n.sum()) / 100
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + penalty, x.T @ (n * (y - p)) - penalty @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def score(docs: DataFrame, lexicon: Lexicon, *, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a score of 0 to 1 from the whole text. Null and empty texts get the score of no hit."""

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        return pd.Series([lexicon.score(t) for t in texts], dtype="float64")

    return docs.withColumn(out, scored(F.col(text)))
