"""What the findings of round 3 are about."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalith.functions import text
from catalith.operators import entities, postings, search, topics
from catalith.sources import versions
from catalith.streaming import snapshots, timers


@pytest.mark.parametrize(
    ("content", "expect"),
    [
        (b"MSH|" + b"x" * 8187 + "é".encode(), "hl7v2"),  # the head ends within a character
        (b'\xff\xfe{"resourceType": "Patient"}', "fhir"),
        (b"\xffMSH|", "hl7v2"),
        ("�MSH|".encode(), None),  # a character of its own, no broken byte
        (b"\xff\xd8\xff\xe0" * 64, None),
    ],
)
def test_a_signature_passes_over_bytes_that_are_no_text(spark, content, expect):
    assert spark.createDataFrame([(bytearray(content),)], "c binary").select(text.signature(F.col("c"))).first()[0] == expect


def test_contained_names_are_dealt_by_asset(spark):
    judged = spark.range(2000).select((F.col("id") % 1000).alias("asset_id"), F.lit("place").alias("entity_type"), F.lit("The old  bridge at Verona").alias("name")).coalesce(1)
    known = spark.createDataFrame([("place", "old bridge"), ("place", "Verona"), ("place", "bridge at"), ("person", "old")], "entity_type string, name string")
    links = entities.contained(judged, known)
    assert "REPARTITION_BY_COL" in links._jdf.queryExecution().executedPlan().toString()  # not all gathered in the task that reads
    assert links.count() == 3000 and links.distinct().count() == 3000
    assert {tuple(r) for r in entities.contained_report(links).collect()} == {("place", "The old  bridge at Verona", n, 1000, 0) for n in ("old bridge", "Verona", "bridge at")}


def test_bm25_in_blocks_is_the_plain_sum(spark):
    import math
    import random

    rng = random.Random(5)
    texts = {i: " ".join(rng.choice(["the", "a", *"bcdefgh"]) for _ in range(rng.randint(0, 12))) for i in range(120)} | {200: None, 201: "tie the tie x", 202: "x the tie tie"}
    asked = {n: " ".join(rng.choice(["the", "b", "c", "zz", "h"]) for _ in range(3)) for n in range(9)} | {9: "zz", 10: "The tie the"}
    q, d = spark.createDataFrame(list(asked.items()), "query long, text string"), spark.createDataFrame(list(texts.items()), "id long, text string")
    words = {i: (t or "").split() for i, t in texts.items()}
    avg = sum(map(len, words.values())) / len(words)
    want = set()
    for n, t in asked.items():
        score = {}
        for term in set(t.lower().split()):
            df = sum(term in w for w in words.values())
            for i, w in words.items():
                if term in w:
                    tf = w.count(term)
                    score[i] = score.get(i, 0) + math.log(1 + (len(words) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / avg))
        want |= {(n, i, round(s, 6), r) for r, (i, s) in enumerate(sorted(score.items(), key=lambda x: (-round(x[1], 9), x[0]))[:4], 1)}
    got = search.bm25(q, d, 4, block_queries=3, block_docs=16)
    assert {(r["query"], r["id"], round(r["score"], 6), r["rank"]) for r in got.collect()} == want
    assert "cogroup" in got._jdf.queryExecution().executedPlan().toString().lower()  # no row for each query, term and document


@pytest.mark.parametrize("few", [0, 2, 32])
def test_same_topic_deals_a_large_topic(spark, monkeypatch, few):
    monkeypatch.setattr(topics, "FEW", few, raising=False)
    rows = [(i, None if i % 13 == 0 else "big" if i % 9 else "small", None if i % 17 == 0 else "s") for i in range(200)]
    edges = [(i, i + 3, "active") for i in range(0, 190, 2)] + [(50, i, "active") for i in range(100, 140)] + [(7, 10, "gone"), (10, 10, "active"), (20, 23, "active")]
    b, e = spark.createDataFrame(rows, "asset_id long, topic string, subtopic string"), spark.createDataFrame(edges, "src long, dst long, status string")
    linked = {frozenset(x[:2]) for x in edges if x[2] == "active"}
    want = sorted((x[0], y[0], frozenset((x[0], y[0])) in linked) for x in rows if x[0] % 10 == 0 for y in rows if x[0] != y[0] and None not in x and x[1:] == y[1:])
    got = topics.same_topic(b, b.filter("asset_id % 10 = 0"), e, pairs_a_task=150)
    assert sorted(tuple(r) for r in got.collect()) == want
    # The large topic's pairs are made in several tasks.
    assert got.withColumn("at", F.spark_partition_id()).filter("src = 50").select("at").distinct().count() > 1


def test_classifications_are_made_once_a_batch(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def label(i):
        made.add(1)
        return f"l{i}"

    assets = spark.range(20).select(F.col("id").alias("asset_id"), F.lit("general").alias("domain_label"), F.lit(None).cast("double").alias("domain_confidence"))
    snapshots.merge(assets, f"{tmp_path}/assets", ["asset_id"])
    results = spark.range(0, 30, 3).select(F.col("id").alias("asset_id"), label("id").alias("label"), F.lit(0.5).alias("confidence"))
    snapshots.record_classifications(results, f"{tmp_path}/classified", f"{tmp_path}/assets")
    assert made.value == 10
    assert versions.load(spark, f"{tmp_path}/classified").count() == 10
    assert {r["asset_id"] for r in versions.load(spark, f"{tmp_path}/assets").filter("domain_label = concat('l', asset_id)").collect()} == {0, 3, 6, 9, 12, 15, 18}


def test_a_new_key_asks_for_no_timers_and_sends_no_empty_frame():
    class State:
        def __init__(self):
            self.value, self.calls = None, []

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def appendList(self, values):
            self.calls += values

    class Handle:
        def __init__(self):
            self.timers, self.listed = [], 0

        def listTimers(self):
            self.listed += 1
            return iter(list(self.timers))

        def deleteTimer(self, t):
            self.timers.remove(t)

        def registerTimer(self, t):
            self.timers.append(t)

    class Now:
        def getCurrentProcessingTimeInMs(self):
            return 0

    watch = timers.Watch(60, 2, True, None)
    watch.handle, watch.last, watch.attempts = Handle(), State(), State()
    frame = lambda *rows: iter([pd.DataFrame([(pd.Timestamp(s, unit="s"), n, state) for s, n, state in rows], columns=["ts", "event_id", "state"])])
    assert list(watch.handleInputRows((1,), frame((5, 2, "routing"), (3, 1, "failed")), Now())) == []
    assert watch.handle.timers == [65_001] and watch.handle.listed == 0 and len(watch.attempts.calls) == 1
    list(watch.handleInputRows((1,), frame((4, 3, "registered")), Now()))  # older than the last: nothing moves
    assert watch.handle.timers == [65_001]
    list(watch.handleInputRows((1,), frame((9, 4, "classifying")), Now()))
    assert watch.handle.timers == [69_001]
    list(watch.handleInputRows((1,), frame((10, 5, "registered")), Now()))
    assert watch.handle.timers == []


def test_an_addition_cuts_texts_once(spark, tmp_path):
    cut = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(i):
        cut.add(1)
        return None if i % 7 == 0 else f"W{i % 5} the, the {'x' * (i % 3)}"

    at = str(tmp_path / "index")
    postings.add(spark.range(60).select("id", told("id").alias("text")), at, group=8)
    assert cut.value == 60
    sizes, blocks = versions.load(spark, f"{at}/sizes").first(), versions.load(spark, f"{at}/blocks")
    texts = [f"w{i % 5} the the {'x' * (i % 3)}".split() if i % 7 else [] for i in range(60)]
    assert (sizes["n"], sizes["words"]) == (60, sum(map(len, texts)))
    held = {(r["term"], r["p"]["id"]): (r["p"]["tf"], r["p"]["dl"]) for r in blocks.select("term", F.explode("postings").alias("p")).collect()}
    assert held == {(w, i): (t.count(w), len(t)) for i, t in enumerate(texts) for w in t}
    for r in blocks.collect():
        assert (r["n"], r["most"], r["least"]) == (len(r["postings"]), max(p["tf"] for p in r["postings"]), min(p["dl"] for p in r["postings"]))
        assert [p["id"] for p in r["postings"]] == sorted(p["id"] for p in r["postings"])


@pytest.mark.parametrize(("guess", "group"), [(20, 16), (0, 16), (1, 1)])
def test_index_search_in_shares_is_the_scan(spark, tmp_path, monkeypatch, guess, group):
    import random

    monkeypatch.setattr(postings, "QUERIES", 3, raising=False)
    monkeypatch.setattr(postings, "DOCUMENTS", 32, raising=False)
    monkeypatch.setattr(postings, "GUESS", guess)
    rng = random.Random(9)
    words = ["the", "of", *[f"w{i}" for i in range(40)]]
    said = lambda n: " ".join(rng.choices(words, [40, 20, *[1 / (i + 1) for i in range(40)]], k=n))
    docs = [(i, None if i % 31 == 0 else "The  of!" if i % 10 == 0 else said(rng.randrange(0, 25))) for i in range(200)]
    asked = [(i, said(6)) for i in range(8)] + [(8, "the"), (9, "The of"), (10, None), (11, "w39 the"), (12, "unheard")]
    d, q = spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame(asked, "query long, text string")
    at = str(tmp_path / "index")
    for part in ("id % 3 < 2", "id % 3 = 2"):
        postings.add(d.filter(part), at, group=group)
    found = postings.search(q, at, 4)
    rows = lambda df: {(r["query"], r["id"], round(r["score"], 6), r["rank"]) for r in df.collect()}
    assert rows(found.results) == rows(search.bm25(q, d, 4))
    reads = {r["query"]: (r["read"], r["held"]) for r in found.reads().collect()}
    assert set(reads) == {*range(10), 11} and all(read > 0 for read, _ in reads.values())
    assert found.read[-1].count() <= len(asked) * -(-len(docs) // 32)  # what a query has read in a share is one row, whatever its terms
