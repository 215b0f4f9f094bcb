"""Quality by a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import runs, text_buffer

#: A filter sees WIDTH bytes, at every STRIDE bytes; HALF positions make half a chunk, and chunks overlap by half.
WIDTH, STRIDE, FILTERS, HALF = 8, 2, 12, 64
#: Labelled rows that the network is trained on, at most, and the bytes of all of them together.
SAMPLE, SAMPLE_BYTES = 2_400, 16 << 20


def _classes() -> np.ndarray:
    """64 classes of bytes: each small letter and each ASCII mark its own; capitals, digits, blanks, line ends, control bytes
    and the bytes of other characters one each."""
    of, nxt = np.zeros(256, np.uint16), 8
    of[ord("A") : ord("Z") + 1], of[ord("0") : ord("9") + 1], of[ord(" ")], of[ord("\n")], of[0x80:0xC0], of[0xC0:] = 1, 2, 3, 4, 5, 6
    for b in range(33, 127):
        if not chr(b).isupper() and not chr(b).isdigit():
            of[b], nxt = min(nxt, 63), nxt + 1
    return of


CLASS = _classes()


@dataclass
class Network:
    """weights: WIDTH x 64 x FILTERS of the filters; bias: of each filter; top: of the pooled filters; base: of the output."""

    weights: np.ndarray
    bias: np.ndarray
    top: np.ndarray
    base: float

    def tables(self) -> list[np.ndarray]:
        """For each two neighbouring bytes of the window, what a pair of classes adds to all filters."""
        return [(self.weights[k][:, None] + self.weights[k + 1][None]).reshape(4096, FILTERS) for k in range(0, WIDTH, 2)]


@dataclass
class Layout:
    """Positions of the windows of some documents, and where halves and documents begin among them."""

    pairs: np.ndarray
    halves: np.ndarray
    of: np.ndarray  # the document of each half
    docs: int


def layout(data: np.ndarray, at: np.ndarray) -> Layout:
    """Windows of each document, whole and padded with blanks of class 0 at its end; a document has at least one."""
    sizes = at[1:] - at[:-1]
    windows = np.maximum(1, -(-(sizes) // STRIDE))
    room = windows * STRIDE + WIDTH
    starts = np.cumsum(room) - room
    flat = np.zeros(int(room.sum()), np.uint16)
    shift = np.repeat(starts - at[:-1], sizes)
    flat[np.arange(at[0], at[-1]) + shift] = CLASS[data[at[0] : at[-1]]]
    pairs = flat[:-1] * np.uint16(64) + flat[1:]
    firsts = np.cumsum(windows) - windows
    positions = np.arange(windows.sum()) * STRIDE + np.repeat(starts - firsts * STRIDE, windows)
    counts = -(-windows // HALF)
    of = np.repeat(np.arange(len(sizes)), counts)
    halves = np.repeat(firsts, counts) + (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * HALF
    index = np.stack([pairs[np.minimum(positions + k, len(pairs) - 1)] for k in range(0, WIDTH, 2)])
    return Layout(index, halves, of, len(sizes))


def pooled(net: Network, x: Layout, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Of each chunk (a half and the next of the same document), the maximum of each filter; where: its position."""
    total = np.zeros((x.pairs.shape[1], FILTERS), np.float32)
    for index, table in zip(x.pairs, net.tables(), strict=True):
        total += table[index]
    most = np.maximum.reduceat(total, x.halves, axis=0)
    follows = np.append(x.of[1:] == x.of[:-1], False)
    nxt = np.where(follows, np.arange(len(most)) + 1, np.arange(len(most)))
    chunk = np.maximum(most, most[nxt])
    if not where:
        return np.maximum(chunk + net.bias, 0), None
    ends = np.append(x.halves[1:], len(total))
    spot = np.zeros(most.shape, np.int64)
    for i, (a, b) in enumerate(zip(x.halves, ends, strict=True)):
        spot[i] = a + total[a:b].argmax(0)
    spot = np.where(most >= most[nxt], spot, spot[nxt])
    return np.maximum(chunk + net.bias, 0), spot


def mean_by(values: np.ndarray, x: Layout) -> np.ndarray:
    n = np.bincount(x.of, minlength=x.docs)
    first = np.cumsum(n) - n
    return np.add.reduceat(values, first, axis=0) / n.reshape(-1, *[1] * (values.ndim - 1))


def logits(net: Network, x: Layout) -> np.ndarray:
    """Of each document: the mean over its chunks of the combined maxima."""
    return mean_by(pooled(net, x)[0], x) @ net.top + net.base


def train(texts: list[bytes], y: np.ndarray, *, epochs: int = 24, rate: float = 0.02, batch: int = 48, seed: int = 3) -> Network:
    """Adam on the logistic loss, with both labels weighted alike."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.08, (WIDTH, 64, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, FILTERS).astype(np.float32), 0.0)
    share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    laid = []
    for i in range(0, len(texts), batch):
        part = np.arange(i, min(i + batch, len(texts)))
        at = np.cumsum([0, *[len(texts[j]) for j in part]])
        laid.append((layout(np.frombuffer(b"".join(texts[j] for j in part), np.uint8), at), y[part], weight[part]))
    params = [net.weights, net.bias, net.top, np.zeros(1, np.float32)]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        for k in rng.permutation(len(laid)):
            x, target, w = laid[k]
            net.base = float(params[3][0])
            chunk, spot = pooled(net, x, where=True)
            mean = mean_by(chunk, x)
            p = 1 / (1 + np.exp(-np.clip(mean @ net.top + net.base, -30, 30)))
            g = (w * (p - target) / len(target)).astype(np.float32)
            n = np.bincount(x.of, minlength=x.docs)
            back = (g / n)[x.of][:, None] * net.top[None] * (chunk > 0)
            gw = np.zeros_like(net.weights)
            for pair in range(WIDTH // 2):
                index = x.pairs[pair][spot]
                f = np.broadcast_to(np.arange(FILTERS), index.shape)
                np.add.at(gw[2 * pair], (index >> 6, f), back)
                np.add.at(gw[2 * pair + 1], (index & 63, f), back)
            grads = [gw + 1e-5 * net.weights, back.sum(0), mean.T @ g + 1e-4 * net.top, np.array([g.sum()], np.float32)]
            t += 1
            step = rate * (0.5 + 0.5 * np.cos(np.pi * epoch / epochs))
            for q, grad, a, b in zip(params, grads, m, v, strict=True):
                a += 0.1 * (grad - a)
                b += 0.001 * (grad * grad - b)
                q -= (step * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    net.base = float(params[3][0])
    return net


def _fitting(texts: list[tuple], budget: int) -> list:
    """Keys of texts (hash, key, bytes) that fit into budget, in that order; the shortest where none does."""
    kept, used = [], 0
    for _, key, n in texts:
        if used + n <= budget:
            kept.append(key)
            used += n
    return kept or [key for _, key, _ in sorted(texts, key=lambda x: x[2])[:1]]


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", keep: Column | None = None, sample: int = SAMPLE) -> Network:
    """A network from labelled rows (those that keep holds for): at most half of sample of each label, by a hash of their
    ids, whole texts of at most SAMPLE_BYTES together. Each label has half of these bytes and what the other leaves of its half; a
    text that doesn't fit is skipped, and a label of which none fits gives its shortest. Training weighs both labels alike; the output is
    then moved by the share of the labels among all labelled rows."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = (known.filter(keep) if keep is not None else known).groupBy(key).agg(F.max(label).cast("int").alias("_y"))
    chosen = known.filter("_y = 0").orderBy(F.xxhash64(key), key).limit(sample // 2).union(known.filter("_y = 1").orderBy(F.xxhash64(key), key).limit(sample // 2))
    rows = docs.select(key, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_bytes")).join(F.broadcast(chosen), key)
    sizes = rows.groupBy(key, "_y").agg(F.sum(F.length("_bytes").cast("long")).alias("_n"), F.xxhash64(key).alias("_h")).collect()
    by = [sorted((r["_h"], r[key], r["_n"]) for r in sizes if r["_y"] == y) for y in (0, 1)]
    need = [sum(n for *_, n in x) for x in by]
    keys = [k for y in (0, 1) for k in _fitting(by[y], max(SAMPLE_BYTES // 2, SAMPLE_BYTES - need[1 - y]))]
    taken = docs.sparkSession.createDataFrame([(k,) for k in keys], rows.select(key).schema)
    got = sorted(rows.join(F.broadcast(taken), key).select(F.xxhash64(key).alias("_h"), "_bytes", "_y").collect())
    net = train([bytes(r["_bytes"]) for r in got], np.array([r["_y"] for r in got], np.float32))
    n = known.agg(F.count_if(F.col("_y") == 1).alias("one"), F.count_if(F.col("_y") == 0).alias("none")).first()
    net.base += float(np.log((n["one"] + 1) / (n["none"] + 1)))
    return net


def score(docs: DataFrame, net: Network, *, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a probability of 0 to 1 from the whole text; null counts as empty, and an empty text is scored too."""

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        data, at = text_buffer(pa.array(texts, pa.large_string()))
        found = [np.zeros(0)]
        for i, j in runs(at, 1 << 18):
            z = logits(net, layout(data, at[i : j + 1]))
            found.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return pd.Series(np.concatenate(found).astype(float))

    return docs.withColumn(out, scored(F.col(text)))
