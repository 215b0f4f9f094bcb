"""Metadata of any shape, and the queries without SQL against plain loops over their own input."""

from __future__ import annotations

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalith import plans
from catalith.functions import variants
from catalith.session import table
from catalith.streaming import lifecycle

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


def test_values_keep_their_kinds(spark):
    given = ['{"a": "x", "l": ["p", 1, null, true], "n": 12, "o": {"k": [1]}, "b": false, "q\'s": "y"}', '{"a": ["x"], "l": "text", "n": "12", "o": 3}', '{"a": null, "l": [], "n": "12x", "o": []}', '{"a"', None, "[1, 2]", '"text"', "7", "null", "", '{"n": 99999999999999999999, "a": 1.5}']
    m = F.col("m")
    rows = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, g string").withColumn("m", variants.parsed(F.col("g")))
    got = [tuple(r) for r in rows.select(*variants.row(m, ["a", "o", "b", "q's"], ["l", "a"]), variants.length(m, "l"), variants.whole(m, "n"), variants.kind(m, "o")).orderBy("i").collect()]
    assert got[0] == ("x", None, "false", "y", ["p", "1", None, "true"], None, 4, 12, "object")
    assert got[1] == (None, "3", None, None, None, ["x"], None, 12, "scalar")
    assert got[2] == (None, None, None, None, [], None, 0, -1, "array")
    for r in got[3:10]:  # broken, absent, or no object: everything is null
        assert r == (None, None, None, None, None, None, None, -1, None)
    assert got[10][0] == "1.5" and got[10][7] == -1


def test_merged_metadata_keeps_lists_and_objects(spark):
    rows = [('{"a": [1, {"b": 2}], "gone": 1, "c": "old"}', '{"c": {"new": []}, "d": null}'), ("broken", '{"c": 1}'), (None, None), ("[1]", '{"c": []}'), ('{"a": 1}', "3")]
    df = spark.createDataFrame(rows, "o string, n string")
    out = df.select(F.to_json(variants.merged(variants.parsed(F.col("o")), variants.parsed(F.col("n")), ("gone",))).alias("j")).collect()
    assert [json.loads(r["j"]) for r in out] == [{"a": [1, {"b": 2}], "c": {"new": []}, "d": None}, {"c": 1}, {}, {"c": []}, {"a": 1}]


def unit(v):
    n = np.linalg.norm(v)
    return v / n if n else v


def plain_walk(rows, window, cap):
    """(scene, vec_id) -> (kept, reason), frame by frame."""
    out, held, kept, scene = {}, [], 0, object()
    for s, i, v in sorted(rows):
        if s != scene:
            scene, held, kept = s, [], 0
        bits = sum(1 << 62 - j for j in range(63) if v[j] > v[j + 1])
        near = [h for h in held[-window:] if (h[0] ^ bits).bit_count() <= 24]
        best = max((float(unit(v) @ h[1]) for h in near), default=-1)
        third = max((float(unit(v[:16]) @ h[2]) for h in near), default=-1)
        reason = "similar" if best >= 0.4 else "third" if best >= 0.2 and third >= 0.5 else None
        if reason is None:
            held.append((bits, unit(v), unit(v[:16])))
            kept += 1
            reason = "cap" if cap is not None and kept > cap else None
        out[s, i] = (reason is None, reason)
    return out


@here
@pytest.mark.parametrize("name, scene, cap", [("sequence_dedup", lambda r: r["vec_id"] // 40, None), ("long_sequence", lambda r: r["label"], 40)])
def test_sequences_are_the_plain_walk(spark, name, scene, cap):
    rows = [(scene(r), r["vec_id"], np.asarray(r["embedding"], float)) for r in table(spark, SF, "embeddings").collect()]
    want = plain_walk([(s, i, v) for s, i, v in rows], 4, cap) if len({(s, i) for s, i, _ in rows}) == len(rows) else None
    got = {(r["scene"], r["vec_id"]): (r["kept"], r["reason"]) for r in plans.QUERIES[name](spark, SF).collect()}
    assert got == want


@here
def test_the_lifecycle_stream_is_the_plain_loop(spark):
    events = plans.registry.lineage(spark, SF).orderBy("ts", "event_id").collect()
    states, want = {}, []
    for e in events:
        state, failures = states.get(e["asset_id"], (None, 0))
        state, failures, ok, reason = lifecycle.step(state, failures, e["state"], 3)
        states[e["asset_id"]] = state, failures
        want.append((e["asset_id"], e["event_id"], e["state"], ok, reason))
    assert sorted(map(tuple, plans.QUERIES["lifecycle_stream"](spark, SF).collect()), key=repr) == sorted(want, key=repr)
