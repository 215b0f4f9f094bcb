"""Hard negatives, phrases and BPE against brute force, the tokenizers library and each other."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalith.llm import bpe, hard_negatives, phrases, queries

VECTORS = "vec_id long, embedding array<float>, label int, rank string"


def hard(rows, k=5):
    """Brute force over (vec_id, vector, label) rows, label already changed."""
    kept = [(v, [int(np.floor(256 * float(x))) for x in e], lab) for v, e, lab in rows if lab is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    last = lambda v: (v is None, v or 0)
    out = []
    for i, (v, e, lab) in enumerate(kept):
        if v is None or v % 100:
            continue
        scored = sorted(((-dot(e, f), last(w), w, m) for j, (w, f, m) in enumerate(kept) if j != i), key=lambda x: x[:2])
        for s, _, p, _ in [x for x in scored if x[3] == lab][:k]:
            band = [x for x in scored if x[3] != lab and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(v, p, r + 1, x[2], -s, -x[0]) for r, x in enumerate(band)]
    return sorted(out, key=repr)


def changed(rows):
    return [(v, e, (lab + 1) % 10 if lab is not None and v is not None and v % 7 == 0 else lab) for v, e, lab in rows]


@pytest.mark.parametrize("width", [3, 64, 70])
def test_hard_negatives_are_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    rng = np.random.default_rng(width)
    centres = rng.standard_normal((6, width))
    rows = [(i, [float(np.float32(x)) for x in (centres[i % 6] + rng.standard_normal(width) * 0.7) / 4], int(rng.integers(0, 3))) for i in range(380)]
    rows += [(400, [0.0] * width, 1), (401, rows[0][1], 1), (402, rows[0][1], 2), (403, None, 1), (404, rows[1][1], None), (500, rows[5][1][:2], 0)]
    rows += [(405, [None, *rows[1][1][1:]], 0), (406, [float("nan"), *rows[1][1][1:]], 0), (407, [float("-inf"), *rows[1][1][1:]], 0), (None, rows[0][1], 2)]
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS)
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(df.withColumn("label", shifted), F.col("vec_id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = hard(changed(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) > 20


def test_repeated_and_empty_rows_of_hard_negatives(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.1], 2), (2, [0.9, 0.1], 2)]
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS)
    got = Counter(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 100 == 0).collect()))
    s, t = 256 * 256, 230 * 256
    # Both rows of id 0 are anchors, each with the other and with row 1 as positives; both rows of id 2 are negatives.
    assert got == {(0, p, r, 2, s, t): 2 for p in (0, 1) for r in (1, 2)}
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_intervals_hold_every_score():
    rng = np.random.default_rng(5)
    for size in (2, 64, 100, 1100):
        x = np.floor(256 * rng.standard_normal((300, size)) * rng.choice([0.01, 1, 50], (300, 1))).astype(np.int64)
        x[0] = 0
        turned = hard_negatives.rotations(size)
        coded = hard_negatives.encode(x, turned)
        ones = np.bitwise_count(coded[0]).sum(axis=1, dtype=np.int64)
        low, high = hard_negatives.bounds(hard_negatives.planes(x[:20], turned), np.linalg.norm(x[:20].astype(float), axis=1), coded, ones)
        score = x[:20] @ x.T
        assert (low <= score).all() and (score <= high).all()
        lengths = np.linalg.norm(x[:20].astype(float), axis=1)[1:, None] * np.linalg.norm(x.astype(float), axis=1)[None, 1:]
        assert ((high - low)[1:, 1:] < 1.9 * lengths + 1).mean() > 0.9  # they say more than that a cosine is between -1 and 1


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def mined(rows, least, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            for k in range(1, 6):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        often = {p: a for p, a in c.items() if a >= least}
        within = {p[i : i + m] for p, a in often.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if a >= c[p[i : i + m]]}
        made = []
        for p, a in often.items():
            if len(p) > 1 and p not in within:
                cuts = [(1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                made.append((-score, -a, " ".join(p).encode(), " ".join(p), a, c[p[:k]], c[p[k:]], n[lang], score))
        out += [(lang, i + 1, *x[3:]) for i, x in enumerate(sorted(made)[:top])]
    return sorted(out)


@pytest.mark.parametrize("held", [phrases.HELD, 50])
def test_phrases_are_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(phrases, "HELD", held)
    monkeypatch.setattr(phrases, "HELD_TEXTS", held)
    monkeypatch.setattr(phrases, "RUN_BYTES", 3000)
    rng = np.random.default_rng(2)
    words = [f"w{i}é" if i % 5 == 0 else f"W{i}" for i in range(60)]
    p = 1 / np.arange(1, 61)
    texts = ["".join(w + rng.choice([" ", "  ", "\t", ". ", ",", "\n", " - "], p=[0.7, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05]) for w in rng.choice(words, rng.integers(1, 120), p=p / p.sum())) for _ in range(150)]
    texts += [None, "", " ", "...", "one", "a b c d e f " * 30, "a b c d e f. " * 30, "x " * 900, "no end " * 2000, texts[0], texts[0]]
    rows = [(["en", "de", None, "und"][i % 4], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "lang string, text string, rank int, phrase string").repartition(5)
    for least, top in ((8, 2000), (3, 7)):
        got = phrases.collocations(df, least=least, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == mined(rows, least, top)
    assert phrases.collocations(df.limit(0)).count() == 0


def test_products_over_64_bits_are_exact(spark, monkeypatch):
    counts = [("en", 1, "a", 3_000_000_001), ("en", 1, "b", 2_000_000_011), ("en", 2, "a b", 1_999_999_973), ("en", 0, "", 7_000_000_000_001)]
    monkeypatch.setattr(phrases, "frequent", lambda *a, **k: spark.createDataFrame(counts, "lang string, words int, phrase string, f long"))
    (r,) = phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect()
    assert r["score"] == 1000 * 1_999_999_973 * 7_000_000_000_001 // (3_000_000_001 * 2_000_000_011)


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(3)
    for capacity in (1, 5, 40):
        stream = np.minimum(rng.zipf(1.3, 4000), 500).astype(np.uint64)
        own = phrases.Summary(capacity)
        for part in np.array_split(stream, 13):  # as summaries of parts merge
            own.merge(*phrases.united(part, np.ones(len(part), np.int64)))
        true = Counter(stream.tolist())
        assert len(own.keys) <= capacity and own.lost <= len(stream) / (capacity + 1)
        held = dict(zip(own.keys.tolist(), own.counts.tolist(), strict=True))
        assert all(true[k] - own.lost <= held.get(k, 0) <= true[k] for k in true)
        assert all(k in held for k, n in true.items() if n > len(stream) / (capacity + 1))


def test_survivors_hold_all_frequent_keys_at_the_least_capacity(spark):
    rng = np.random.default_rng(4)
    stream = np.minimum(rng.zipf(1.2, 20000), 5000).astype(np.uint64)
    rows = []
    for part in np.array_split(stream, 7):
        keys, counts = phrases.united(part, np.ones(len(part), np.int64))
        for p in range(3):
            mine = keys % np.uint64(3) == p
            rows += [(p, 0, int(counts[mine].sum()), b"", b""), (p, 1, 0, keys[mine].tobytes(), counts[mine].tobytes())]
    got = {r["key"] for r in phrases.survivors(spark.createDataFrame(rows, phrases.SUMMARY), 3, 100).collect()}
    true = Counter(stream.tolist())
    assert {k for k, n in true.items() if n >= 100} <= got and len(got) < len(true)


PATH = queries.vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def own():
    return bpe.vocabulary(PATH)


def same(own, text):
    ids = own.library.encode(text, add_special_tokens=False).ids
    made, decoded = own.encode(text)
    assert np.frombuffer(made, "<u4").tolist() == ids, text[:60]
    assert decoded == own.library.decode(ids, skip_special_tokens=False) == own.decode(np.frombuffer(made, "<u4"))


def test_ids_are_the_librarys(own):
    for c in [*range(0x250), *range(0x2000, 0x2070), 0x20AC, 0x3A3, 0x130, 0xFB01, 0x1E9E]:
        for text in (chr(c), f"ab{chr(c)}cd", f"A{chr(c)}", f"{chr(c)}1", f"'{chr(c)}s x", f"e{chr(c)}̈"):
            same(own, text)
    for text in ("<|endoftext|>", " <|startoftext|>a<|endoftext|>b", "<|endoftext|", "<|ENDOFTEXT|>", "a" * 900, "ab" * 700, "é" * 500, "the" * 400, "ΑΣ ΑΣ. İI", "don't we'll I'M", "12345 ½²"):
        same(own, text)


def test_ids_are_the_librarys_on_any_text(own):
    hypothesis = pytest.importorskip("hypothesis")
    from hypothesis import strategies as st

    @hypothesis.settings(max_examples=400, deadline=None)
    @hypothesis.given(st.text(max_size=60) | st.text("abcdehinorst' é.1", max_size=90))
    def check(text):
        same(own, text)

    check()


def test_no_token_reaches_over_a_cut(own):
    word = "straßenbahnxqzjvéa".encode() * 40
    cuts = own.cuts(word)
    assert own.cuts(word[:200]) == [c for c in cuts if c < 200 - 1] + ([199] if 199 in own.cuts(word[:200]) else [])
    whole = own._merged_by_heap([*(own.inner[b] for b in word[:-1]), own.last[word[-1]]])
    parts = [x for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True) for x in own.merged(word[a:b], b == len(word))]
    assert parts == whole and len(cuts) > 40
    ends = np.cumsum([len(own.tokens[i].replace(bpe.END, "")) for i in whole])
    assert set(cuts) <= set(ends.tolist())


def test_encoded_table(spark, own):
    texts = ["Some <|endoftext|> Text", None, "", "  ", "ï " * 50, "Some <|endoftext|> Text"]
    df = spark.createDataFrame([(i, t, "old", i) for i, t in enumerate(texts)], "doc_id long, text string, ids string, `a.b` int")
    rows = bpe.decode(bpe.encode(df, PATH), PATH, out="again").orderBy("doc_id").collect()
    assert rows[0].asDict().keys() == {"doc_id", "text", "a.b", "ids", "decoded", "again"}
    for r, t in zip(rows, texts, strict=True):
        ids = own.library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["decoded"] == r["again"] == own.library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_registered_queries(spark, tmp_path, own):
    texts = ["Hello World", None, "", "hello wörld " * 120]
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op13_bpe"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for r in got.collect():
        ids = own.library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(own.library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert [tuple(r) for r in queries.QUERIES["op12_phrases"](spark, str(tmp_path)).orderBy("rank").collect()] == mined([("en", t) for t in texts], 100)
    rows = [(i, [float(i % 5), float(i % 7)], i % 3) for i in range(0, 300)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert sorted(map(tuple, queries.QUERIES["op11_hard_negatives"](spark, str(tmp_path)).collect()), key=repr) == hard(changed(rows))


def test_rules_by_join_judge_rows_that_share_an_id(spark):
    from catalith.llm import url_filter

    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("block", "net", "/es/"), ("allow", "net", "/es/x/")]
    urls = ["http://b.net/es/", "http://A.example.com/en/1", "http://x.com/", None, "no url", "http://b.net/es/x/1", "http://b.org/"]
    rows = [(1, u, "r") for u in urls] + [(None, u, "r") for u in urls] + [(1, urls[0], "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    both = [f(pages, r, **more).select("page_id", "url", "host", "path", "rule", "verdict") for f, r, more in ((url_filter.judge, rules, {}), (url_filter.judge_by_join, spark.createDataFrame(rules, "verdict string, host string, path string"), {"page_id": "page_id"}))]
    got = [Counter(map(tuple, df.collect())) for df in both]
    assert got[0] == got[1] and sum(got[0].values()) == 15
    assert {k[4:] for k in got[0] if k[1] == urls[0]} == {("net/es/", "block")}
