"""Selection by rank, positions, numbered names, cells of fingerprints and one row a key: against plain loops."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from catalith.operators import dedup, entities, relations, reports, state
from catalith.sources import inputs, numbering


@pytest.mark.parametrize("kind", ["long", "double", "int"])
def test_upper_median_of_any_values(spark, kind):
    rng = random.Random(1)
    make = {"long": lambda: rng.choice([rng.randrange(-(1 << 62), 1 << 62), (1 << 61) + rng.randrange(9), 7]), "double": lambda: rng.choice([rng.gauss(0, 1e-300), rng.gauss(0, 1e300), 1.5, -1.7e308, 1.7e308, 1 + rng.randrange(5) * 2**-52]), "int": lambda: rng.randrange(-50, 50)}[kind]
    rows = [(g, make()) for g in "aaaaabbc" for _ in range(101)] + [("d", make()), ("e", None)]
    if kind == "double":
        rows += [("a", float("nan")), ("f", float("nan"))]
    df = spark.createDataFrame(rows, f"g string, v {kind}")
    fine = lambda v: v is not None and v == v
    by = {}
    for g, v in rows:
        if fine(v):
            by.setdefault(g, []).append(v)
    want = {g: (len(v), min(v), max(v), sorted(v)[len(v) // 2]) for g, v in by.items()}
    assert {r["g"]: (r["n"], r["least"], r["greatest"], r["median"]) for r in reports.upper_median(df, "v", ["g"]).collect()} == want
    every = sorted(v for _, v in rows if fine(v))
    assert [tuple(r) for r in reports.upper_median(df, "v").collect()] == [(len(every), every[0], every[-1], every[len(every) // 2])]
    assert reports.upper_median(df.limit(0), "v").count() == 0


def test_no_task_sees_all_distinct_values(spark):
    """After the counts of equal values, nothing but at most RANGES + 2 rows a group meets in a window."""
    plan = numbering.by_rank(spark.range(50_000).withColumn("v", F.col("id") * 3), "v", F.expr("n div 2"))
    assert plan.first()["chosen"] == 75_000
    assert "Window" not in plan._jdf.queryExecution().toString()


def numbered(files, taken):
    """Plain: the first of each free name keeps it, then the others take the smallest numbers that nobody has."""
    have, out = set(taken), {}
    given = {(f, n) for _, f, n in files}
    for i, f, n in sorted(files):
        if (f, n) not in have and (f, n) not in out.values():
            out[i] = (f, n)
    have |= given
    for i, f, n in sorted(files):
        if i not in out:
            stem, dot, ext = n.partition(".") if "." in n else (n, "", "")
            k = 1
            while (f, f"{stem}_{k}{dot}{ext}") in have | set(out.values()):
                k += 1
            out[i] = (f, f"{stem}_{k}{dot}{ext}")
    return {i: n for i, (_, n) in out.items()}


def test_numbered_names_never_meet(spark):
    files = [(0, "d", "a.txt"), (1, "d", "a.txt"), (2, "d", "a_1.txt"), (3, "d", "a_1.txt"), (4, "d", "a_01.txt"), (5, "e", "a.txt"), (6, "d", "noext"), (7, "d", "noext")]
    rng = random.Random(2)
    files += [(i, rng.choice("de"), rng.choice(["a.txt", "a_2.txt", "a_1_1.txt", "b", "b_3", "a_0.txt"])) for i in range(10, 60)]
    taken = [("d", "a_3.txt"), ("e", "b"), ("e", "b_1"), ("d", "a_5.txt"), ("d", "a_5.txt")]
    df = spark.createDataFrame([(*f, "x") for f in files], "asset_id int, folder string, name string, _r string")
    got = inputs.numbered(df, spark.createDataFrame(taken, "folder string, name string"))
    assert got.columns == [*df.columns, "dest_name"]
    rows = got.collect()
    assert {r["asset_id"]: r["dest_name"] for r in rows} == numbered(files, taken)
    assert len({(r["folder"], r["dest_name"]) for r in rows} | set(taken)) == len(files) + len(set(taken))


def test_lists_and_folders_keep_their_order(spark, tmp_path):
    lines = {"b.txt": [f" /b/{i} " for i in range(4000)], "a.txt": ["/a/2", "", "/a/1"]}
    (tmp_path / "lists").mkdir()
    for name, own in lines.items():
        (tmp_path / "lists" / name).write_text("\n".join(own))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # several splits a file
    try:
        got = [r["path"] for r in inputs.read_path_list(spark, str(tmp_path / "lists")).orderBy("pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == ["/a/2", "/a/1", *[f"/b/{i}" for i in range(4000)]]
    (tmp_path / "files" / "z").mkdir(parents=True)
    for name in ("d", "a", "B", "c", "z/a", "é"):
        (tmp_path / "files" / name).write_text("x")
    rows = inputs.read_folder(spark, str(tmp_path / "files")).orderBy("pos").collect()
    paths = [r["path"] for r in rows]
    assert [r["pos"] for r in rows] == list(range(6)) and paths == sorted(paths, key=str.encode) and [p.rsplit("/", 1)[1] for p in paths[:4]] == ["B", "a", "c", "d"]


def close(values, most):
    return sorted((i, j, (a ^ b).bit_count()) for i, a in values for j, b in values if i < j and (a ^ b).bit_count() <= most)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("shape", ["constant upper bits", "spread", "one varying byte", "prefixes"])
def test_close_fingerprints_are_exact_and_cells_stay_small(spark, shape):
    rng = random.Random(len(shape))
    upper = rng.getrandbits(40) << 24
    draw = {
        "constant upper bits": lambda: upper | rng.getrandbits(24), "spread": lambda: rng.getrandbits(64), "one varying byte": lambda: (0xAB << 56) | rng.getrandbits(8),
        "prefixes": lambda: (rng.choice([0, 0, 0, 0xFFFF]) << 48) | rng.getrandbits(rng.choice([3, 40])),
    }[shape]
    seen = list({draw() for _ in range(700)})
    seen += list({x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for x in seen[:150]} - set(seen))
    values = list(enumerate(seen))
    df = spark.createDataFrame([(i, signed(x)) for i, x in values] + [(10_000 + i, signed(x)) for i, x in values[:5]] + [(20_000, None)], "id long, bits long")
    got = sorted((r["a"], r["b"], r["distance"]) for r in dedup.close_pairs(df, key="id", bits="bits", most=2, hot=64).collect())
    assert got == close(values, 2) and got
    classes = df.filter("bits is not null").groupBy("bits").agg(F.min("id").alias("id"))
    top = dedup.cells_of(classes, key="id", bits="bits", most=2, hot=64).groupBy("cell").count().agg(F.max("count")).first()[0]
    assert top <= 64


def test_one_row_of_updates_that_share_a_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    delta = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (3, "z"), (None, "n")], "k int, v string")
    assert sorted(map(tuple, state.upsert(target, delta, ["k"]).collect())) == [(1, "y"), (2, "b"), (3, "z")]
    meta = spark.createDataFrame([(1, {"a": "1"})], "k int, m map<string,string>")
    twice = spark.createDataFrame([(1, {"b": "1"}), (1, {"b": "2"})], meta.schema)
    assert [r["m"] for r in state.merge_meta(meta, twice, "k", "m").collect()] == [{"a": "1", "b": "2"}]
    judged = spark.createDataFrame([("t", "n", "w")], "entity_type string, name string, keyword string")
    aliases = spark.createDataFrame([("t", "n", "B"), ("t", "n", "A"), ("t", "m", "C")], "entity_type string, alias string, canonical string")
    assert [tuple(r) for r in entities.resolve_names(judged, aliases).select("entity_type", "name", "keyword").collect()] == [("t", "A", "w")]


def test_blocks_of_vectors_beyond_the_first_meet(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    norm = lambda v: sum(x * x for x in v) ** 0.5
    want = {}
    for i, v in rows[:40]:
        best = sorted((-round(sum(x * y for x, y in zip(v, w, strict=True)) / norm(v) / norm(w), 12), j) for j, w in rows if j != i)[:3]
        want[i] = [j for _, j in best]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # partitions aren't joined, so equal keys have to hash alike
    try:
        got = relations.nearest(df.filter("id < 40"), df, 3, block_rows=16).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    found = {}
    for r in sorted(got, key=lambda r: (r["query"], r["rank"])):
        found.setdefault(r["query"], []).append(r["id"])
    assert found == want


@pytest.mark.parametrize("mode, cap, cap_first", [("recent", None, False), ("last", 17, False), ("recent", 25, True)])
def test_a_long_sequence_in_blocks_is_the_walk_of_one_task(spark, mode, cap, cap_first):
    rng = random.Random(cap or 0)
    rows = []
    for g, n in (("a", 90), ("b", 1), (None, 23), ("c", 40)):
        v = [1.0, 0.0, 0.0]
        for i in range(n):
            if rng.random() < 0.4:
                v = [rng.gauss(0, 1) for _ in range(3)]
            own = [x + rng.gauss(0, 0.12) for x in v]
            rows.append((g, i, rng.choice([0, 1, 3]), own if rng.random() < 0.97 else [0.0] * 3, own[::-1], "x"))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, pos int, bits long, vector array<double>, third array<double>, kind string")
    options = dict(group="g", order="pos", bits="bits", vector="vector", third="third", mode=mode, window=3, hash_max=1, near=0.97, grey=0.9, third_near=0.95, cap=cap, cap_first=cap_first)
    want = sorted(((r["g"], r["pos"], r["kept"], r["reason"]) for r in dedup.suppress_sequence(df, **options).collect()), key=repr)
    got = dedup.suppress_long(df, **options, block_rows=8)
    assert got.columns == [*df.columns, "kept", "reason"]
    assert sorted(((r["g"], r["pos"], r["kept"], r["reason"]) for r in got.collect()), key=repr) == want
    assert {None, "similar"} <= {w[3] for w in want}
    with pytest.raises(ValueError, match="bounded"):
        dedup.suppress_long(df, **{**options, "mode": "global"})
