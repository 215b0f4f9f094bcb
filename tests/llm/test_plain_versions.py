"""The automaton, the network, shards and the packing plan against plain versions of what they stand for."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np

from catalith.llm import packing, quality, queries, sharding, toxicity


def scanned(lexicon, text):
    """Every entry and phrase tried at every place of the folded text."""
    low = toxicity.fold(text)
    letter = lambda i: 0 <= i < len(low) and low[i].isalpha()
    words, spared = {}, []
    for start in range(len(low)):
        if letter(start - 1):
            continue
        for term, weight in lexicon.entries.items():
            own = term.rstrip("*")
            if low.startswith(own, start) and (term.endswith("*") or not letter(start + len(own))):
                words[start] = max(words.get(start, weight), weight)
        for phrase in lexicon.exceptions:
            if low.startswith(phrase, start) and not letter(start + len(phrase)):
                spared.append((start, start + len(phrase) - 1))
    kept = [w for s, w in words.items() if not any(a <= s <= b for a, b in spared)]
    return sum(kept), len(kept)


def test_the_automaton_is_a_plain_scan():
    rng = random.Random(1)
    for turn in range(60):
        alphabet = "abc"
        make = lambda n: "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, n)))
        entries = {make(4) + rng.choice(["", "*"]): rng.choice([0.5, 1.0, 2.0]) for _ in range(rng.randrange(0, 8))}
        own = toxicity.Lexicon(entries, [f"{make(4)} {make(4)}" for _ in range(rng.randrange(0, 3))])
        for _ in range(20):
            text = "".join(rng.choice("aAbc4@ .é1\n") for _ in range(rng.randrange(0, 40)))
            total, n = own.hits(text)
            want = scanned(own, text)
            assert (round(total, 9), n) == (round(want[0], 9), want[1]), (turn, text)


def convolved(net, text):
    """The logit of one text: each window by itself, chunks of two halves, their mean."""
    n = max(1, math.ceil(len(text) / quality.STRIDE))
    classes = [int(quality.CLASS[b]) for b in text] + [0] * (quality.WIDTH + quality.STRIDE)
    out = [sum(net.weights[k, classes[i * quality.STRIDE + k]].astype(float) for k in range(quality.WIDTH)) for i in range(n)]
    halves = [out[i : i + quality.HALF] for i in range(0, n, quality.HALF)]
    chunks = [halves[i] + (halves[i + 1] if i + 1 < len(halves) else []) for i in range(len(halves))]
    pools = [np.maximum(np.max(c, axis=0) + net.bias, 0) for c in chunks]
    return float(np.mean(pools, axis=0) @ net.top + net.base)


def random_net(seed):
    rng = np.random.default_rng(seed)
    return quality.Network(rng.normal(0, 0.5, (quality.WIDTH, 64, quality.FILTERS)).astype(np.float32), rng.normal(0, 0.2, quality.FILTERS).astype(np.float32), rng.normal(0, 1, quality.FILTERS).astype(np.float32), 0.3)


def laid(texts):
    return quality.layout(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))


def test_the_network_is_a_plain_convolution():
    rng = random.Random(2)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 2, 3, 7, 127, 128, 129, 255, 256, 257, 500, 1025)]
    net = random_net(4)
    got = quality.logits(net, laid(texts))
    assert np.allclose(got, [convolved(net, t) for t in texts], atol=1e-3)


def test_training_steps_against_the_gradient():
    """The first step of Adam goes by the sign of each parameter's gradient, which differences of the loss give."""
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab c.\n") for _ in range(rng.randrange(5, 400))) for _ in range(24)]
    y = np.array([i % 3 > 0 for i in range(24)], int)
    start = np.random.default_rng(3)
    first = quality.Network(start.normal(0, 0.08, (quality.WIDTH, 64, quality.FILTERS)).astype(np.float32), np.zeros(quality.FILTERS, np.float32), start.normal(0, 0.3, quality.FILTERS).astype(np.float32), 0.0)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    x = laid(texts)

    def loss(net):
        z = quality.logits(net, x).astype(float)
        return float(np.mean(weight * (np.logaddexp(0, z) - y * z)))

    after = quality.train(texts, y, epochs=1, rate=0.02, batch=48, seed=3)
    checked = 0
    for name in ("weights", "bias", "top"):
        values = getattr(first, name)
        for at in random.Random(5).sample(list(np.ndindex(values.shape)), min(values.size, 250)):
            old, sides = float(values[at]), []
            for d in (2e-3, -2e-3):
                values[at] = old + d
                sides.append(loss(first))
            values[at] = old
            slope = (sides[0] - sides[1]) / 4e-3
            if abs(slope) > 2e-3:
                checked += 1
                assert np.sign(getattr(after, name)[at] - old) == -np.sign(slope), (name, at, slope)
    assert checked > 20


def test_shards_and_slots_of_the_query_are_the_permutations(spark, tmp_path):
    rng = random.Random(6)
    rows = [(rng.choice([None, -3, 5, 5, i]), rng.choice([None, "", "é", f"t{i}"])) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    size = lambda t: len((t or "").encode()) + 1
    crc = lambda t: zlib.crc32((t or "").encode())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, crc(r[1]), size(r[1])))
    places = sharding.permute(np.arange(len(rows)), len(rows), 20)
    want = Counter((d, size(t), crc(t), "rows", int(p % 8), int(p // 8), None) for (d, t), p in zip(order, places, strict=True))
    assert Counter(map(tuple, queries.QUERIES["op4_sharding"](spark, str(tmp_path)).collect())) == want


def test_the_plan_is_best_fit():
    """As many sequences as best fit, longest first, piece by piece, and no sequence over its size."""
    rng = random.Random(7)
    for size in (10, 64, 1024):
        for _ in range(12):
            lengths = [rng.choice([size, rng.randrange(1, size + 1), rng.randrange(1, max(2, size // 8))]) for _ in range(rng.randrange(0, 400))]
            rooms: list[int] = []
            for n in sorted(lengths, reverse=True):
                fits = [i for i, room in enumerate(rooms) if room >= n]
                if fits:
                    rooms[min(fits, key=rooms.__getitem__)] -= n
                else:
                    rooms.append(size - n)
            places = packing.plan(dict(Counter(lengths)), size)
            used: dict[int, list] = {}
            for length, first, last, sequence, offset, per in places.tolist():
                for r in range(last - first):
                    used.setdefault(sequence + r // per, []).append((offset + r % per * length, length))
            assert sorted(n for x in used.values() for _, n in x) == sorted(lengths) and len(used) == len(rooms)
            for parts in used.values():
                parts.sort()
                assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and parts[-1][0] + parts[-1][1] <= size


def test_texts_of_one_word_take_seconds(spark):
    """Four thousand equal words against an item of three hundred, and items of which a part repeats."""
    import time

    from catalith.llm import decontaminate

    docs = [(1, "x " * 4_000), (2, "x " * 10), (3, "y x x x x " * 300), (4, "a b c d e f g " + "x " * 12 + "h i j k l m n"), (5, None)]
    items = [(1, "x " * 300), (2, "x " * 8), (3, "d e f g x x x x x x x x x x x x h i j k"), (4, "q r s t")]
    start = time.time()
    got = {(r["doc_id"], r["item_id"]): (r["n_equal"], r["n_item"]) for r in decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert time.time() - start < 150  # it was over ten minutes
    assert got[1, 1] == (300, 300) and got[1, 2] == (8, 8) and got[2, 2] == (8, 8) and got[4, 3] == (20, 20) and (2, 1) not in got and not any(i == 4 for _, i in got)
