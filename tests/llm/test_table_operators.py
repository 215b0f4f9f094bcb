"""Sharding, URL rules, joins, suffix dedup, packing, the chain of stages: exact round trips and brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalith.llm import common, components, ngram_join, packing, sharding, suffix_dedup, url_filter

DOCS = "doc_id long, text string"


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_feistel_is_a_permutation_with_its_inverse(n):
    x = np.arange(n)
    y = sharding.permute(x, n, 4)
    assert sorted(y) == list(range(n))
    assert list(sharding.permute(y, n, 4, inverse=True)) == list(x)
    assert n < 64 or list(y) != list(sharding.permute(x, n, 5))


def test_shards_and_slots(spark):
    ids = [None, -5, 3, 3, 1 << 50, *range(10, 400, 7), *range(20_000, 20_050)]
    df = spark.createDataFrame([(i, "s") for i in ids], "doc_id long, slot string")
    got = sharding.shard(df, 8).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert len(got) == len(ids) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sharding.shard(df.limit(0), 8).count() == 0


def test_global_rank(spark):
    rng = np.random.default_rng(0)
    ids = [int(x) for x in rng.integers(-(1 << 62), 1 << 62, 300)] + list(range(500)) + [None, None]
    got = {(r["k"], r["_rank"]) for r in common.global_rank(spark.createDataFrame([(i,) for i in ids], "k long"), "k", []).collect()}
    order = sorted(ids, key=lambda x: (x is not None, x or 0))
    assert {r for _, r in got} == set(range(len(ids))) and all(order[r] == k for k, r in got)


def test_cascade_is_exact_and_rules_win_by_length(spark):
    universe = spark.createDataFrame([(f"host{i}.example/",) for i in range(3000)], "key string")
    listed = universe.filter(F.crc32(F.col("key").cast("binary")) % 7 == 0)
    cascade = url_filter.build(listed, universe, rate=0.2)
    import pyarrow as pa

    keys = [r["key"] for r in universe.collect()]
    assert list(cascade.holds(url_filter.key_hashes(pa.array(keys)))) == [zlib.crc32(k.encode()) % 7 == 0 for k in keys]
    assert len(cascade.levels) > 2
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]
    urls = ["http://A.Example.com/en/1?q", "https://www.example.com/en/x#f", "http://example.com", "http://b.com/?x", "http://x.net/es/1", "http://x.net/e", "no url", "", None, "ftp://notexample.com/en/", "http://net/es/", "http://Ü.net/es/"]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")

    def judged(u):
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "")
        host, path = ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")
        fits = [(len(h) + len(p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, "allow")

    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    assert got == {i: judged(u) for i, u in enumerate(urls)}
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    assert got == {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_by_join(pages, table, page_id="page_id").collect()}
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, []).collect()} == {"allow"}


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    got = {r["v"]: r["c"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for v in top if find(v) != v}


def near_texts(seed=0):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + [f"Term{i}" for i in range(3000)]
    out = [None, "", " \t\n", "one", "ONE", "one two", "one two three four five", "One two three four  five", "x" * 5000, "a " * 3000]
    for _ in range(25):
        base = list(rng.choice(words, rng.integers(8, 120)))
        for _ in range(rng.integers(1, 6)):
            t = list(base)
            for _ in range(rng.integers(0, 4)):
                t[rng.integers(0, len(t))] = str(rng.choice(words))
            out.append(" ".join(t))
    hot = list(rng.choice(words, 90))
    for _ in range(70):
        t = list(hot)
        t[rng.integers(0, 90)] = str(rng.choice(words))
        out.append(" ".join(t))
    line = " ".join(rng.choice(words, 12))
    out += [line + " " + " ".join(rng.choice(words, rng.integers(2, 30))) for _ in range(60)]
    return out + out[30:40]


def linked(texts):
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize("small", [24, 3])
def test_ngram_join_is_brute_force(spark, small, monkeypatch):
    texts = near_texts()
    docs = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], DOCS + ", h string").repartition(3)
    # Workers import the module anew, so parameters of tasks stay; the driver's decide what is frequent.
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", small)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == linked(texts)
    kept = ngram_join.deduplicate(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in linked(texts).items() if i == c}


def test_ngram_join_edges(spark):
    empty = spark.createDataFrame([], DOCS)
    assert ngram_join.near_duplicates(empty).count() == 0
    twins = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (7, None), (9, "A b c d e f")], DOCS)
    assert Counter((r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(twins).collect()) == {(7, 7): 3, (9, 7): 1}


def test_product_is_set_intersection():
    rng = np.random.default_rng(3)
    for _ in range(40):
        base = rng.integers(0, 1 << 60, 60).astype(np.uint64)
        sets = [np.unique(np.where(rng.random(60) < rng.choice([0.0, 0.05, 0.2]), rng.integers(0, 1 << 60, 60).astype(np.uint64), base))[: rng.integers(1, 61)] for _ in range(rng.integers(2, 12))]
        n = np.array([len(x) for x in sets])
        right = rng.random(len(sets)) < rng.choice([0.0, 0.5])
        got = {tuple(sorted(p)) for p in zip(*map(np.ndarray.tolist, ngram_join.product(np.concatenate(sets), np.repeat(np.arange(len(sets)), n), n, right)), strict=True)}
        want = {(i, j) for j in range(len(sets)) for i in range(j) if (right[i] != right[j] or not right.any()) and 4 * len(np.intersect1d(sets[i], sets[j])) >= 3 * len(np.union1d(sets[i], sets[j]))}
        assert got == want


def test_blocks_of_near_copies_stay_small(spark, monkeypatch):
    """A large group of copies whose similarities lie around the bound: blocks stay within two parts, and no link is lost."""
    rng = np.random.default_rng(11)
    base, other = [f"w{i}" for i in range(60)], [f"o{i}" for i in range(60)]
    texts = []
    for i in range(260):
        t = list(base if i % 3 else other)
        for at in rng.integers(0, 60, rng.integers(1, 4)):
            t[at] = f"x{rng.integers(0, 40)}"
        texts.append(" ".join(t))
    sizes, real = [], ngram_join._links

    def links(blocks, *rest):
        sizes.append(blocks.groupBy("block").count().agg(F.max("count")).first()[0] or 0)
        return real(blocks, *rest)

    monkeypatch.setattr(ngram_join, "_links", links)
    monkeypatch.setattr(ngram_join, "PART", 32)
    monkeypatch.setattr(ngram_join, "TURNS", 1)
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == linked(texts) and len({c for _, c in got.values()}) > 2
    assert len(sizes) == 3 and max(sizes) <= 4 * 32


def test_any_keys_and_names(spark):
    docs = spark.createDataFrame([("b", "a b c d e f", 77, 1), ("a", "A b c d e f", 78, 2), (None, "x y z", 79, 3), ("c", None, 80, 4), ("a", "p q", 81, 5)], "doc_id string, text string, _rid int, _row int")
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in ngram_join.near_duplicates(docs).collect()}
    assert got == {("b", 2): "a", ("a", 2): "a", (None, 1): None, ("c", 0): "c", ("a", 1): "a"}
    kept = ngram_join.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r["_rid"] for r in kept.collect()) == [78, 79, 80, 81]
    named = spark.createDataFrame([(i, i + 100, i + 200, i + 300) for i in range(50)], "doc_id long, _rank long, _place long, _b0 long")
    assert all(r["_rank"] - 100 == r["_place"] - 200 == r["_b0"] - 300 == r["doc_id"] for r in sharding.shard(named, 8).collect())
    pages = spark.createDataFrame([(1, "http://x.com/", "k")], "page_id int, url string, _keys string")
    assert url_filter.judge(pages, [("block", "com", "/")]).first().asDict() == {"page_id": 1, "url": "http://x.com/", "_keys": "k", "host": "x.com", "path": "/", "rule": "com/", "verdict": "block"}
    long = "".join(chr(97 + i % 26) + str(i) for i in range(200))
    cut = suffix_dedup.deduplicate(spark.createDataFrame([(1, long, "n", 5), (2, long, "m", 6)], "doc_id long, text string, _null string, _rid int"))
    assert sorted(map(tuple, cut.collect())) == [(1, long, "n", 5), (2, "", "m", 6)]


def repeats(texts):
    seen, out = set(), {}
    for i, t in enumerate(texts):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            k = b[s : s + 100]
            if k in seen:
                gone[s : s + 100] = True
            seen.add(k)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone]))
    return out


def long_texts(seed=0):
    rng = np.random.default_rng(seed)
    make = lambda n: "".join(rng.choice(list("abcde é\n"), n))
    shared = [make(rng.integers(60, 400)) for _ in range(6)]
    out = [None, "", "short", "a" * 99, "a" * 100, "a" * 700, "ab" * 400, make(100)]
    for _ in range(80):
        out.append("".join(make(rng.integers(0, 150)) + (shared[rng.integers(0, 6)] if rng.random() < 0.7 else "") for _ in range(4)))
    base = make(600)
    for _ in range(30):
        t = list(base)
        t[rng.integers(0, 600)] = "X"
        out.append("".join(t))
    return out + out[4:30]


def test_suffix_dedup_is_brute_force(spark):
    texts = long_texts()
    docs = spark.createDataFrame([(3 * i, t, "k") for i, t in enumerate(texts)], DOCS + ", kept string").repartition(4)
    got = {r["_key"] // 3: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == repeats(texts)
    cut = {r["doc_id"] // 3: r["text"] for r in suffix_dedup.deduplicate(docs).collect()}
    assert cut == {i: t if t is None else k.decode("utf-8", "ignore") for (i, (_, _, _, k)), t in zip(repeats(texts).items(), texts, strict=True)}


def test_hot_anchors_are_dealt_alike(spark, monkeypatch):
    """Many documents with one common passage: over HOT occurrences of its anchors."""
    rng = np.random.default_rng(4)
    make = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    line, passage = make(61), make(230)
    texts = [make(40) + (line if i % 2 else passage) + make(45) for i in range(2400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], DOCS).repartition(5)
    got = {r["_key"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == repeats(texts)


def test_deep_shallow_sorts(spark):
    rng = np.random.default_rng(7)
    for _ in range(30):
        rows = rng.choice(np.frombuffer(b"ab", np.uint8), (rng.integers(1, 200), 40))
        rows[rng.integers(0, len(rows), len(rows) // 2), : rng.integers(1, 40)] = 97
        rows = rows[rng.integers(0, len(rows), 2 * len(rows))]
        buffer = np.append(rows.reshape(-1), np.zeros(16, np.uint8))
        order, same = suffix_dedup.deep_shallow(buffer, np.arange(len(rows)) * 40, 40)
        text = [bytes(r) for r in rows]
        assert [text[i] for i in order] == sorted(text)
        assert list(same) == [False] + [text[a] == text[b] for a, b in zip(order, order[1:], strict=False)]


def test_suffix_dedup_edges(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
    t = "".join(chr(97 + i % 26) + str(i) for i in range(200))
    twins = spark.createDataFrame([(4, t), (4, t), (None, t), (9, None)], DOCS)
    got = Counter((r["_key"], r["n_removed"] > 0) for r in suffix_dedup.remove_repeats(twins).collect())
    assert got == {(None, False): 1, (4, True): 2, (9, False): 1}


def test_plan_fills_sequences():
    rng = np.random.default_rng(0)
    for _ in range(40):
        counts = Counter(int(x) for x in rng.integers(1, 65, rng.integers(1, 400)))
        used, room = Counter(), defaultdict(list)
        for length, lo, hi, first, offset, per in packing.plan(counts, 64):
            used[length] += hi - lo
            for r in range(lo, hi):
                room[first + (r - lo) // per].append((offset + (r - lo) % per * length, length))
        assert used == counts
        for parts in room.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 64
        least = -(-sum(k * v for k, v in counts.items()) // 64)
        assert len(room) <= least * 1.25 + 1


def test_packing(spark):
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    path = public.path("byte_bpe_50k.json")
    own = tokenizers.Tokenizer.from_file(path)
    texts = [None, "", "Hello world", "l'été  naïve 中文 ​ x1234\n\n\tq", "<|endoftext|> as text", "word " * 3000, "a" * 5000, *[f"text {i} " * (i % 40) for i in range(200)], "dup", "dup"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(0, "again", 1)], DOCS + ", length int")
    rows = packing.pack(docs, path, 256, added=True).collect()
    by, room = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in enumerate(texts):
        if i:
            ids = np.array(own.encode(t or "", add_special_tokens=False).ids + [packing.END], "<u4")
            got = sorted(by[i], key=lambda r: r["piece"])
            assert [r["length"] for r in got][1:] == [256] * (len(got) - 1) and sum(r["length"] for r in got) == len(ids)
            for r in got:
                assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for parts in room.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 256
    assert packing.pack(docs.limit(0), path, 256).count() == 0


def test_op10_packing_takes_added_tokens_as_the_tokenizer_does(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    from catalith.llm import queries

    own = tokenizers.Tokenizer.from_file(queries.vocabulary())
    texts = ["<|endoftext|> as text", "a  <|endoftext|>\n\nb<|endoftext|><|endoftext|>", "<|endoftext|", "plain  text ", None]
    spark.createDataFrame(list(enumerate(texts)), DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    expect = {i: np.array(own.encode(t or "", add_special_tokens=False).ids + [packing.END], "<u4") for i, t in enumerate(texts)}
    assert 50256 in expect[0]
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in queries.op10_packing(spark, str(tmp_path)).collect()}
    assert got == {i: (len(ids), zlib.crc32(ids.tobytes())) for i, ids in expect.items()}


def test_chain_keeps_and_drops(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 9))) for _ in range(3000)]
    say = lambda n: " ".join(rng.choice(words, n))
    docs = [(i, say(80)) for i in range(200)]
    labels = []
    for i in range(0, 60):
        t = docs[i][1].split()
        t[3] = t[40] = t[60] = "zzbadword"
        docs[i] = (i, " ".join(t))
    labels = [(i, 1, int(i < 60)) for i in range(150)]
    item = say(40)
    docs += [(200, docs[100][1]), (201, docs[101][1] + " more"), (202, say(20) + " " + item + " " + say(20)), (203, None), (204, say(30) + " " + " ".join(docs[120][1].split()[:40])), (205, say(25))]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert out ^ (set(range(60, 200)) | {203, 204, 205}) == set()


def test_url_query_is_its_sql(spark):
    import os

    duckdb = pytest.importorskip("duckdb")
    from catalith.llm import queries

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no tables here")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    columns = "page_id, host, path, rule, verdict"
    got = sorted(map(tuple, queries.op5_url_rules(spark, sf).select(*columns.split(", ")).collect()))
    assert got == sorted(con.sql(f"select {columns} from ({queries.ORACLES['op5_url_rules']})").fetchall())
