"""Timers, merges with a ledger, late rows and versions of tables, batch by batch and against plain loops."""

from __future__ import annotations

import datetime as dt
import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalith.operators import state
from catalith.sources import folders, versions
from catalith.streaming import late, lifecycle, snapshots, timers

EVENTS = "asset_id long, event_id long, ts timestamp, state string"
START = dt.datetime(2026, 1, 1, 12)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def put(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, schema, folder):
    return spark.readStream.schema(schema).parquet(str(folder))


def run_timers(spark, tmp_path, turns, **options):
    """Rows of the timers after each turn."""
    seen, out = Counter(), []
    for rows in turns:
        put(spark, rows, EVENTS, tmp_path / "in")
        with timers.timed_state(spark):
            lifecycle.drain(timers.resets(stream(spark, EVENTS, tmp_path / "in"), **options), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        now = Counter(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("asset_id", "was", "attempts", "status", "status_reason", "reset_event").collect())
        out.append(sorted((now - seen).elements()))
        seen = now
    return out


def test_timers_do_what_the_scan_does(spark, tmp_path):
    rows = [
        (1, 1, at(0), "received"), (1, 2, at(1), "routing"),  # stuck, never tried
        (2, 3, at(0), "routing"), (2, 4, at(1), "failed"), (2, 5, at(2), "reset"), (2, 6, at(3), "classifying"),  # stuck at the cap
        (3, 7, at(0), "extracting"), (3, 8, at(5), "registered"),  # ended
        (4, 9, at(0), "received"),  # waits for its turn
        (5, 10, at(99), "routing"), (6, 11, at(40), "routing"), (6, 12, at(40), "extracting"),  # at work; equal times: the greater event
        (7, 13, at(100), "received"),
    ]
    (got,) = run_timers(spark, tmp_path, [rows], older_than_s=60, cap=2)
    events = spark.createDataFrame(rows, EVENTS)
    last = events.groupBy("asset_id").agg(F.max("ts").alias("updated_at"), F.max_by("state", F.struct("ts", "event_id")).alias("status"))
    batch = state.reset_stuck(state.stuck(last, F.lit(at(100)), 60), events, 2)
    assert sorted((r["asset_id"], r["attempts"], r["status"], r["status_reason"], r["reset_event"]) for r in batch.collect()) == [(g[0], *g[2:]) for g in got]
    assert got == [(1, "routing", 0, "received", None, True), (2, "classifying", 2, "failed", "reset_cap_exceeded", False)]


def test_an_asset_that_keeps_getting_stuck_fails_at_the_cap(spark, tmp_path):
    turns = [[(1, 1, at(0), "routing"), (9, 2, at(100), "received")], [(1, 3, at(120), "routing"), (9, 4, at(300), "received")], [(1, 5, at(310), "routing"), (9, 6, at(500), "received")], [(9, 7, at(900), "received")]]
    got = run_timers(spark, tmp_path, turns, older_than_s=60, cap=2)
    assert got == [[(1, "routing", 0, "received", None, True)], [(1, "routing", 1, "received", None, True)], [(1, "routing", 2, "failed", "reset_cap_exceeded", False)], []]


def test_an_event_before_the_timer_keeps_the_asset(spark, tmp_path):
    turns = [[(1, 1, at(0), "routing"), (9, 2, at(50), "received")], [(1, 3, at(55), "classifying"), (1, 4, at(50), "routing"), (9, 5, at(100), "received")], [(1, 6, at(110), "registered"), (9, 7, at(400), "received")]]
    assert run_timers(spark, tmp_path, turns, older_than_s=60, cap=2) == [[], [], []]


def test_timers_by_the_clock(spark, tmp_path):
    put(spark, [(1, 1, at(0), "routing"), (2, 2, at(0), "received")], EVENTS, tmp_path / "in")
    with timers.timed_state(spark):
        lifecycle.run_until(timers.resets(stream(spark, EVENTS, tmp_path / "in"), 1.0, 3, delay=None, forget_s=600), str(tmp_path / "out"), str(tmp_path / "checkpoint"), 25)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("asset_id", "status", "reset_event").collect()] == [(1, "received", True)]
    with pytest.raises(ValueError, match="clock"):
        timers.resets(stream(spark, EVENTS, tmp_path / "in"), 1, 1, forget_s=5)


STATE = "k long, v string, n int, ts long"


def rows_of(spark, path):
    return sorted(tuple(r) for r in versions.load(spark, path).select("k", "v", "n", "ts").collect())


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(i, "a", i, 10) for i in range(200)], STATE)
    first = snapshots.merge(one, path, ["k"], order=["ts"], buckets=8, stream="s", batch=0)
    assert len(first["folders"]) == 8 and len(first["written"]) == 8
    two = spark.createDataFrame([(3, "b", 0, 11), (3, "late", 0, 9), (3, "b", 0, 11), (4, "old", 0, 9), (None, "x", 0, 99), (777, "new", 1, 1)], STATE)
    second = snapshots.merge(two, path, ["k"], order=["ts"], stream="s", batch=1)
    want = sorted([*((i, "a", i, 10) for i in range(200) if i != 3), (3, "b", 0, 11), (777, "new", 1, 1)])
    assert rows_of(spark, path) == want and 1 <= len(second["written"]) <= 2
    kept = {b: f for b, f in first["folders"].items() if int(b) not in second["written"]}
    assert len(kept) >= 6 and all(second["folders"][b] == f for b, f in kept.items())  # untouched buckets are the same files
    files = sorted(str(p) for p in Path(path).rglob("*.parquet"))
    assert snapshots.merge(two, path, ["k"], order=["ts"], stream="s", batch=1) == second  # the same batch again
    third = snapshots.merge(two, path, ["k"], order=["ts"], stream="s", batch=2)  # the same rows in another batch
    assert third["written"] == [] and sorted(str(p) for p in Path(path).rglob("*.parquet")) == files and rows_of(spark, path) == want
    assert sorted(tuple(r) for r in versions.load(spark, path, first["version"]).collect()) == sorted((i, "a", i, 10) for i in range(200))


def test_batches_in_any_order_give_the_same(spark, tmp_path):
    batches = [[(k, f"v{b}", b, 10 * ((b * 7 + k) % 5) + b) for k in range(30) if (k + b) % 3] for b in range(5)]
    want = {}
    for k, v, n, ts in sorted((x for b in batches for x in b), key=lambda x: x[3]):
        want[k] = (k, v, n, ts)
    for name, order in (("a", [0, 1, 2, 3, 4]), ("b", [4, 2, 0, 2, 3, 1])):
        for turn, b in enumerate(order):
            snapshots.merge(spark.createDataFrame(batches[b], STATE), str(tmp_path / name), ["k"], order=["ts"], buckets=4, stream="s", batch=turn)
        assert rows_of(spark, str(tmp_path / name)) == sorted(want.values())


def test_a_writer_that_dies_or_races_leaves_the_last_version(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a", 1, 1)], STATE)
    made = snapshots.merge(one, path, ["k"], stream="s", batch=0)
    Path(path, "manifests", f"{made['version'] + 1:012d}.json").write_text('{"version": 2, "fol')  # died while it wrote
    assert rows_of(spark, path) == [(1, "a", 1, 1)]
    snapshots.merge(spark.createDataFrame([(2, "b", 1, 1)], STATE), path, ["k"], stream="s", batch=1)
    assert rows_of(spark, path) == [(1, "a", 1, 1), (2, "b", 1, 1)]
    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, made, made)


def test_classifications_are_mirrored_onto_known_assets(spark, tmp_path):
    a, c = str(tmp_path / "assets"), str(tmp_path / "classified")
    snapshots.merge(spark.createDataFrame([(1, "p", "general", None), (2, "q", "general", None)], "asset_id long, fs_path string, domain_label string, domain_confidence double"), a, ["asset_id"])
    results = spark.createDataFrame([(1, "medical", 1.0, {"medical": "x"}), (3, "en", 0.9, {})], "asset_id long, label string, confidence double, stage1_scores map<string,string>")
    for batch in (0, 0):
        snapshots.record_classifications(results, c, a, stream="s", batch=batch)
    assert sorted(map(tuple, versions.load(spark, a).collect())) == [(1, "p", "medical", 1.0), (2, "q", "general", None)]
    # A crash between the two snapshots: the second one takes the batch when it is run again.
    again = spark.createDataFrame([(2, "en", 0.9, {})], results.schema)
    snapshots.merge(again, c, ["asset_id"], stream="s", batch=1)
    snapshots.record_classifications(again, c, a, stream="s", batch=1)
    assert sorted(map(tuple, versions.load(spark, a).collect())) == [(1, "p", "medical", 1.0), (2, "q", "en", 0.9)]
    assert versions.load(spark, c).count() == 3


def plain_once(batches, delay_s):
    """The definition, row by row: (taken, late) of lists of (key, seconds)."""
    mark, seen, taken, behind = None, {}, [], []
    for rows in batches:
        on_time = []
        for k, s in rows:
            (behind if k is None or s is None or (mark is not None and s <= mark) else on_time).append((k, s))
        firsts = {}
        for k, s in on_time:
            firsts[k] = min(firsts.get(k, s), s)
        for k, s in firsts.items():
            if k not in seen or (mark is not None and seen[k] <= mark):
                taken.append((k, s))
                seen[k] = s + delay_s
        tops = [s for _, s in rows if s is not None]
        if tops:
            mark = max(tops) - delay_s if mark is None else max(mark, max(tops) - delay_s)
    return sorted(taken), sorted(behind, key=repr)


def test_late_rows_and_copies_out_of_order(spark, tmp_path):
    import random

    rng = random.Random(3)
    batches = [[(rng.randrange(12), b * 40 + rng.randrange(-90, 60)) for _ in range(25)] for b in range(6)]
    batches[2] += [(None, 100), (5, None)]
    batches.append(batches[1])  # all of an old batch again
    schema = "k long, ts timestamp"
    for rows in batches:
        put(spark, [(k, None if s is None else at(s)) for k, s in rows], schema, tmp_path / "in")
        snapshots.follow(stream(spark, schema, tmp_path / "in"), str(tmp_path / "checkpoint"), "once", lambda df, n: late.take_once(df, n, str(tmp_path), key="k", delay_s=50))
    read = lambda name: sorted(((r["k"], None if r["ts"] is None else (r["ts"] - START).total_seconds()) for r in spark.read.schema(schema).parquet(f"{tmp_path}/{name}/*").collect()), key=repr)
    taken, behind = plain_once(batches, 50)
    assert read("taken") == sorted(taken, key=repr) and read("late") == behind and len(behind) > 25


def test_a_batch_run_again_after_a_crash_takes_the_same(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, at(0)), (1, at(5)), (2, at(1))], "k long, ts timestamp")
    with monkeypatch.context() as m:
        m.setattr(snapshots, "merge", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            late.take_once(df, 0, str(tmp_path), key="k", delay_s=10)
    for _ in range(2):
        late.take_once(df, 0, str(tmp_path), key="k", delay_s=10)
    assert spark.read.parquet(f"{tmp_path}/taken/*").count() == 2
    assert late.mark_of(versions.manifest(spark, f"{tmp_path}/seen")) == int((START - dt.datetime(1970, 1, 1)).total_seconds() - 5) * 1_000_000


def test_published_versions(spark, tmp_path):
    path = str(tmp_path / "docs")
    df = spark.createDataFrame([(i, "x") for i in range(10)], "id long, t string")
    with pytest.raises(FileNotFoundError):
        versions.load(spark, path)
    one = versions.publish(df, path)
    with pytest.raises(ValueError, match="not accepted"):
        versions.publish(df.limit(3), path, accept=lambda _, n: n >= 10)
    bad = df.select("id", F.raise_error(F.lit("broken")).cast("string").alias("t"))
    with pytest.raises(Exception, match="broken"):
        versions.publish(bad, path)
    assert versions.load(spark, path).count() == 10
    versions.publish(df.limit(3), path, append=True)
    assert versions.load(spark, path).count() == 13 and versions.load(spark, path, one["version"]).count() == 10
    with pytest.raises(ValueError, match="other columns"):
        versions.publish(df.withColumn("more", F.lit(1)), path, append=True)
    three = versions.publish(df.limit(2), path)
    assert versions.load(spark, path).count() == 2 and sum(three["rows"].values()) == 2
    assert versions.clean(spark, path, keep=1) >= 2 and versions.load(spark, path).count() == 2
    assert len(list(Path(path, "manifests").glob("*.json"))) == 1 and json.loads(next(Path(path, "manifests").glob("*.json")).read_text())["version"] == three["version"]


class Session:
    """As much of a session as a folder's place takes."""

    def __init__(self, master, at):
        self.conf, self.sparkContext = {"spark.checkpoint.dir": at}, self
        self.master, self.applicationId, self.getCheckpointDir = master, "app", lambda: None


def test_the_shared_folder_is_the_sessions():
    assert folders.fresh(Session("spark://x", "/somewhere/shared"), "x").startswith("/somewhere/shared/catalith-app/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        folders.shared(Session("spark://x", None))
