"""Passes of the batch until nothing is left, and resyncs that fail."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalith.functions import tokens
from catalith.operators import entities
from catalith.sources import versions
from catalith.streaming import passes

START = dt.datetime(2026, 1, 1)


def test_passes_end_every_asset(spark):
    """Asset 3 always fails, 4 is always taken by someone else, 5 crashes each time: it stays under way without an event."""
    rows = [(i, "received", START, START, "x") for i in range(1, 7)] + [(9, "registered", START, START, "x"), (8, "routing", START, START, "x")]
    assets = spark.createDataFrame(rows, "asset_id long, status string, created_at timestamp, updated_at timestamp, extra string")
    events = spark.createDataFrame([], "asset_id long, state string")
    outcome = F.when(F.col("asset_id") == 3, "failed").when(F.col("asset_id") == 2, "deferred").otherwise("registered")
    seen = Counter()
    for turn in range(6):
        now = F.lit(START + dt.timedelta(hours=turn + 1)).cast("timestamp")
        made = passes.run(assets, events, lambda p: p.filter("asset_id <> 4").select("asset_id", outcome.alias("outcome"), F.lit("ValueError").alias("reason")), now, limit=4, cap=3, older_than_s=60)
        seen.update((r["asset_id"], r["outcome"]) for r in made.told.collect())
        assert made.assets.columns == assets.columns and made.assets.count() == 8
        assert sum(made.report().first()) == made.told.count()
        assets = spark.createDataFrame([tuple(r) for r in made.assets.collect()], assets.schema)
        events = spark.createDataFrame([tuple(r) for r in events.collect()] + [tuple(r) for r in made.events.select("asset_id", "state").collect()], events.schema)
    last = {r["asset_id"]: r["status"] for r in assets.collect()}
    assert last == {1: "registered", 2: "deferred", 3: "failed", 4: "received", 5: "registered", 6: "registered", 8: "registered", 9: "registered"}
    # Asset 3: a failure and a reset count as attempts each; the third attempt is over the cap.
    assert seen[3, "failed_retry"] + seen[3, "failed_terminal"] + seen[3, "reset_isolated"] >= 2 and seen[3, "failed_terminal"] + seen[3, "reset_isolated"] == 1
    assert seen[4, "skipped"] >= 3 and seen[8, "reset"] == 1


def test_nothing_to_do(spark):
    none = spark.createDataFrame([], "asset_id long, status string, created_at timestamp, updated_at timestamp")
    made = passes.run(none, spark.createDataFrame([], "asset_id long, state string"), lambda p: p.select("asset_id", F.lit("registered").alias("outcome"), F.lit(None).cast("string").alias("reason")), F.current_timestamp(), limit=5, cap=3, older_than_s=1)
    assert tuple(made.report().first()) == (0,) * 7 and made.assets.count() == 0


def test_a_resync_that_isnt_accepted_leaves_the_old_documents(spark, tmp_path):
    at = str(tmp_path / "docs")
    assets = spark.createDataFrame([(1, "registered"), (2, "registered"), (3, "failed")], "asset_id long, status string")
    vectors = spark.createDataFrame([(1, 0, [1.0]), (1, 1, [2.0]), (3, 0, [3.0])], "asset_id long, chunk_index int, embedding array<float>")
    labels = spark.createDataFrame([(1, "b", "x"), (1, "a", "y"), (1, "a", "y")], "asset_id long, skill_code string, label_code string")
    docs, without = entities.asset_documents(assets, labels, vectors)
    assert [tuple(r) for r in docs.collect()] == [(1, "registered", [1.0], 2, ["a/y", "b/x"])] and [r["asset_id"] for r in without.collect()] == [2]
    entities.resync(docs, at, least=1)
    with pytest.raises(ValueError, match="not accepted"):
        entities.resync(docs.limit(0), at, least=1)
    assert versions.load(spark, at).count() == 1


def test_a_tokenizer_is_loaded_in_the_worker(spark):
    class Words:
        def __call__(self, text):
            return len(text.split())

    df = spark.createDataFrame([(1, "a b  c"), (2, None), (3, "")], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(tokens.counted(Words)(F.col("t"))).collect()] == [3, 0, 0]
    assert df.limit(0).select(tokens.counted(Words)(F.col("t"))).count() == 0
