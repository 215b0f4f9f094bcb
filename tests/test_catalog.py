"""Edge rows of the catalog's operators: nulls, ties, boundaries, empty tables, reruns."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from catalith.functions import meta, scores, text
from catalith.operators import classify, dedup, entities, relations, reports, search, state, topics
from catalith.sources import inputs
from catalith.streaming import lifecycle


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "expect"), [("1.5", 1.0), ("-0.3", 0.0), ("NaN", 0.0), ("높음", 0.0), ("0.8", 0.8), (None, 0.0), ("Infinity", 1.0)])
def test_clamped(spark, raw, expect):
    assert one(spark, scores.clamped(F.lit(raw).cast("string"))) == expect


def test_edge_status_and_pairs(spark):
    status = lambda c, s, floor: one(spark, scores.edge_status(F.lit(c).cast("double"), F.lit(s).cast("double"), 0.7, floor))
    assert [status(0.7, None, 0.0), status(0.69, 1.0, 0.0), status(0.9, 0.4, 0.5), status(0.9, 0.5, 0.5), status(None, 1.0, 0.0), status(0.9, None, 0.5)] == ["active", "proposed", "proposed", "active", "proposed", "proposed"]
    a, b = scores.canonical(F.lit(5), F.lit(2), F.lit(True))
    assert (one(spark, a), one(spark, b)) == (2, 5)
    assert one(spark, scores.verdict(F.lit(0.5))) == "match"


def test_vectors(spark):
    v = lambda *x: F.array(*[F.lit(float(i)).cast("float") for i in x])
    assert one(spark, scores.cosine(v(1, 0), v(0, 0))) == 0.0
    assert one(spark, scores.cosine(v(1, 2), v(2, 4))) == pytest.approx(1.0)
    assert one(spark, scores.finite(F.lit(float("nan")))) == 0.0
    assert one(spark, F.size(scores.padded(v(1, 2), 6))) == 6
    assert one(spark, scores.hamming(F.lit(0b1011).cast("long"), F.lit(-1).cast("long"))) == 61
    assert one(spark, scores.difference_bits(v(3, 2, 5, 1))) == 0b101


def test_lexicon_boundaries(spark):
    hits = lambda t, *terms: one(spark, text.lexicon_hits(F.lit(t).cast("string"), list(terms)))
    assert hits("Éle le LE x", "le", "ele") == ["le"]
    assert hits("심장이식", "심장") == ["심장"]
    assert hits("High blood pressure; blood!", "blood pressure", "blood", "pressure") == ["blood", "blood pressure"] and hits("high blood pressure", "blood pressure", "blood") == ["blood pressure"]
    assert hits("heart_rate", "heart") == [] and hits(None, "a") == [] and hits("x", "") == []
    terms = [f"t{i:02}" for i in range(30)]
    assert one(spark, F.size(text.shown_hits(text.lexicon_hits(F.lit(" ".join(terms)), terms)))) == 20


@pytest.mark.parametrize(("content", "expect"), [(b"x" * 128 + b"DICM", "dicom"), (b"x" * 127 + b"DICM", None), (b"\xef\xbb\xbf  MSH|^", "hl7v2"), (b'{"resourceType" : "Patient"}', "fhir"), (b'{"resourceType":"Car"}', None), (b"", None)])
def test_signature(spark, content, expect):
    assert one(spark, text.signature(F.lit(content))) == expect


def test_languages_and_counts(spark):
    lang = lambda t: one(spark, text.language(text.hangul(F.lit(t)), text.latin(F.lit(t))))
    assert [lang("가나다abcdefg"), lang("가나abcdefgh"), lang("только слова ab"), lang("только")] == ["ko", "en", "en", "unknown"]
    assert one(spark, text.sentences(F.lit("A. B!? \n\n C"))) == 3
    assert one(spark, text.chunks(F.lit("abcdefg"), 3)) == ["abc", "def", "g"] and one(spark, text.chunks(F.lit("abcde"), 3, 1)) == ["abc", "cde", "e"]
    assert one(spark, text.chunks(F.lit(None).cast("string"), 3)) == []
    assert one(spark, text.guarded(F.lit(" " * 20 + "short"), F.lit("s"))) is None and one(spark, text.guarded(F.lit("x" * 15), F.lit("s"))) == "s"


def test_meta(spark):
    m = F.create_map(F.lit("summary"), F.lit("s"), F.lit("width"), F.lit("3"))
    assert one(spark, meta.file_facts(m)) == {"width": "3"} and one(spark, meta.content_signals(m)) == {"summary": "s"}
    new = F.create_map(F.lit("about"), F.lit("[]"))
    assert one(spark, meta.merged(m, new, ["width"])) == {"summary": "s", "about": "[]"}
    assert one(spark, meta.key_missing(meta.merged(m, new), "about")) is False
    assert one(spark, meta.whole_number(F.lit("12x"))) == -1 and one(spark, meta.whole_number(F.lit("12"))) == 12
    assert one(spark, meta.array_length(F.lit('{"a":1}'))) is None and one(spark, meta.array_length(F.lit("[1,2]"))) == 2
    assert one(spark, meta.under(F.lit("/in/x"), "/in")) and not one(spark, meta.under(F.lit("/inbox/x"), "/in")) and not one(spark, meta.under(F.lit("/in"), "/in"))
    assert one(spark, meta.about(F.lit('[" a ", "", "b", "c", "d"]'))) == ["a", "b", "c"] and one(spark, meta.about(F.lit("nope"))) == []
    assert one(spark, meta.embedding_text(F.lit(" "), F.lit(None).cast("array<string>"), F.lit(None).cast("array<string>"))) == " "
    assert one(spark, meta.with_title(F.lit("  "), F.lit("T"))) == "  "
    assert one(spark, meta.nfc(F.lit("é"))) == "é"


@pytest.mark.parametrize(("args", "expect"), [(("h", None, False, 1, None, "p", None), "new"), (("h", None, True, 1, 1, "p", "p"), "hash_null"), (("h", "g", True, 1, 1, "p", "p"), "hash_changed"), (("h", "h", True, 2, 1, "p", "p"), "skill_version"), (("h", "h", True, 1, 1, "q", "p"), "prompt_version"), (("h", "g", True, 2, 1, "p", "p"), "mixed"), (("h", "h", True, 1, 1, "p", "p"), None)])
def test_drift(spark, args, expect):
    kinds = ("string", "string", "boolean", "int", "int", "string", "string")
    assert one(spark, meta.drift(*[F.lit(a).cast(k) for a, k in zip(args, kinds, strict=True)])) == expect


def test_inputs(spark, tmp_path):
    (tmp_path / "list.txt").write_text(" /a \n\n/b\n/a\n")
    listed = inputs.read_path_list(spark, str(tmp_path / "list.txt"))
    given = spark.createDataFrame([("/b", 0), ("/c", 1)], "path string, pos long")
    got = {r["path"]: r["source"] for r in inputs.collect_inputs(listed, None, given).collect()}
    assert got == {"/a": 0, "/b": 0, "/c": 2}
    with pytest.raises(ValueError, match="give"):
        inputs.collect_inputs(None, None)
    files = spark.createDataFrame([("/x/MANIFEST.json", True), ("/x/my_manifest.json", True), ("/x/a.weird", True), ("/x/b.TXT", True), ("/x/c.txt", False)], "path string, present boolean")
    got = {r["path"]: (r["reason"], r["modality"]) for r in inputs.route(files).collect()}
    assert got == {"/x/MANIFEST.json": ("ledger_file", "text"), "/x/my_manifest.json": (None, "text"), "/x/a.weird": ("unknown_modality", "unknown"), "/x/b.TXT": (None, "text"), "/x/c.txt": ("missing", "text")}


def test_numbered_names(spark):
    files = spark.createDataFrame([(i, "d", "a.txt") for i in range(4)] + [(9, "d", "noext")], "asset_id int, folder string, name string")
    taken = spark.createDataFrame([("d", "a.txt"), ("d", "a_2.txt")], "folder string, name string")
    got = {r["asset_id"]: r["dest_name"] for r in inputs.numbered(files, taken).collect()}
    assert got == {0: "a_1.txt", 1: "a_3.txt", 2: "a_4.txt", 3: "a_5.txt", 9: "noext"}


def test_leaders(spark):
    rows = [(1, 5, "h", "failed"), (2, 6, "h", "received"), (3, 6, "h", "received"), (4, 1, None, "received"), (5, 1, None, "received"), (6, 2, "k", "failed")]
    df = spark.createDataFrame(rows, "asset_id int, created_at int, file_hash string, status string")
    got = {r["asset_id"]: (r["leader"], r["copy"]) for r in dedup.with_leader(df).collect()}
    assert got == {1: (2, False), 2: (2, False), 3: (2, True), 4: (None, False), 5: (None, False), 6: (None, False)}
    out = {r["asset_id"]: (r["status"], r["status_reason"], r["file_hash"]) for r in dedup.defer_copies(df).collect()}
    assert out[3] == ("deferred", "duplicate_content:2", None) and out[2] == ("received", None, "h")
    assert dedup.with_leader(df.limit(0)).count() == 0


@pytest.mark.parametrize(("mode", "kept"), [("recent", [0, 2, 4]), ("last", [0, 2, 3, 4]), ("global", [0, 2, 4])])
def test_sequences(spark, mode, kept):
    a, b, c = [1.0, 0.0], [0.0, 1.0], [1.0, 1.0]
    rows = [("s", i, 0, v, v) for i, v in enumerate([a, a, b, a, c])]
    df = spark.createDataFrame(rows, "g string, i int, bits long, v array<double>, w array<double>")
    out = dedup.suppress_sequence(df, group="g", order="i", bits="bits", vector="v", third="w", mode=mode)
    assert sorted(r["i"] for r in out.collect() if r["kept"]) == kept
    assert out.columns == [*df.columns, "kept", "reason"]
    with pytest.raises(ValueError, match="mode"):
        dedup.suppress_sequence(df, group="g", order="i", bits="bits", vector="v", third="w", mode="x")


def test_state(spark):
    target = spark.createDataFrame([(1, "a", "v"), (2, "b", "v")], "k int, x string, policy string")
    delta = spark.createDataFrame([(2, None), (3, "c")], "k int, x string")
    got = {r["k"]: (r["x"], r["policy"]) for r in state.upsert(target, delta, ["k"]).collect()}
    assert got == {1: ("a", "v"), 2: (None, "v"), 3: ("c", None)}
    again = {r["k"]: (r["x"], r["policy"]) for r in state.upsert(state.upsert(target, delta, ["k"]), delta, ["k"]).collect()}
    assert again == got
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, x string")
    new = spark.createDataFrame([(1, "z")], "k int, x string")
    assert {(r["k"], r["x"]) for r in state.replace_partition(old, new, ["k"]).collect()} == {(1, "z"), (2, "c")}


def test_resolution(spark):
    st = spark.createDataFrame([(1, "pending", 2, "x"), (2, "pending", 0, None), (3, "resolved", 1, None)], "asset_id int, status string, attempts int, last_reason string")
    res = spark.createDataFrame([(1, 0, "TimeoutError"), (2, 3, None), (4, 0, None), (5, 0, "E")], "asset_id int, edges int, error string")
    got = {r["asset_id"]: (r["status"], r["attempts"], r["last_reason"]) for r in state.resolve(st, res, 3).collect()}
    assert got == {1: ("failed", 3, "TimeoutError"), 2: ("resolved", 0, None), 3: ("resolved", 1, None), 4: ("isolated", 0, "no_edges"), 5: ("pending", 1, "E")}


def test_facets(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "asset_id int")
    labels = spark.createDataFrame([(1, "s", "b"), (1, "r", "a"), (1, "s", "b"), (2, "s", "unassigned")], "asset_id int, skill_code string, label_code string")
    assert {r["asset_id"]: r["facets"] for r in state.facet_keys(a, labels).collect()} == {1: ["r/a", "s/b"], 2: [], 3: []}


def test_cascade(spark):
    rows = spark.createDataFrame([(1, "MSH|heart"), (2, "heart lung"), (3, "heart"), (4, "nothing"), (5, "heart lung law court"), (6, None)], "asset_id int, text string")
    lexicons = {"medical": ["heart", "lung"], "legal": ["law", "court"]}
    verdicts = spark.createDataFrame([(3, " Legal "), (5, "other")], "asset_id int, label string")
    got = {r["asset_id"]: (r["label"], r["confidence"], r["stage"]) for r in classify.cascade(rows, lexicons, verdicts=verdicts).collect()}
    assert got == {1: ("medical", 1.0, 1), 2: ("medical", 0.9, 2), 3: ("legal", 0.6, 3), 4: ("general", 0.7, 2), 5: ("review", 0.0, 3), 6: ("general", 0.7, 2)}


def test_edges(spark):
    old = spark.createDataFrame([(1, 2, "k", 0.5, "old", "rejected")], "src int, dst int, kind_code string, confidence double, reason string, status string")
    make = lambda c, r: spark.createDataFrame([(1, 2, "k", c, r, "active")], old.schema)
    after = relations.upsert_edges(old, make(0.9, "a")).first()
    assert (after["confidence"], after["reason"], after["status"]) == (0.9, "a", "rejected")
    same = relations.upsert_edges(make(0.9, "a"), make(0.9, "b")).first()
    assert same["reason"] == "a"
    assert relations.upsert_edges(make(0.9, "a"), make(0.3, "b")).first()["confidence"] == 0.9


def test_nearest(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.0], "a"), (3, [0.0, 0.0], "b"), (4, [0.0, 1.0], "b"), (5, [1.0, 1.0], "b")]
    df = spark.createDataFrame(rows, "id int, embedding array<float>, modality string")
    got = [(r["id"], r["rank"]) for r in relations.nearest(df.filter("id = 1"), df, 2, block_rows=2).orderBy("rank").collect()]
    assert got == [(2, 1), (5, 2)]
    each = {(r["modality"], r["id"]) for r in search.by_modality(df.filter("id = 1").withColumn("domain_label", F.lit("g")), df.withColumn("domain_label", F.lit("g")), 1, excluded=("x",), block_rows=2).collect()}
    assert each == {("a", 2), ("b", 5)}
    assert relations.nearest(df, df.limit(0), 2, block_rows=2).count() == 0


def test_pair_scores(spark):
    e = spark.createDataFrame([(1, "st", 0, [1.0, 0.0]), (2, "st", 0, [0.0, 1.0]), (2, "st", 1, [1.0, 1.0]), (3, "clip", 0, [1.0, 0.0])], "asset_id int, channel string, chunk_index int, embedding array<float>")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 9)], "src int, dst int")
    got = {r["dst"]: r["score"] for r in relations.pair_scores(pairs, e).collect()}
    assert got[2] == pytest.approx(math.sqrt(0.5)) and got[3] == got[9] == 0.0


def test_entities(spark):
    edges = spark.createDataFrame([("t", 1, a, "active") for a in range(5)] + [("u", 1, 9, "active"), ("t", 2, 1, "rejected")], "entity_type string, entity_uid int, asset_id int, status string")
    notes = spark.createDataFrame([(0, None), (1, "b"), (2, "c"), (3, "d"), (4, "e"), (9, "z")], "asset_id int, summary string")
    wanted = spark.createDataFrame([("t", 1)], "entity_type string, entity_uid int")
    got = {(r["entity_type"], r["entity_uid"]): r["summaries"] for r in entities.member_summaries(edges, notes, wanted).collect()}
    assert got == {("t", 1): ["b", "c", "d"]}
    assert [(r["entity_type"], r["members"]) for r in entities.bundles(edges, 5).collect()] == [("t", 5)]
    now = spark.createDataFrame([("t", 1, "h"), ("t", 2, "g"), ("t", 3, None)], "entity_type string, entity_uid int, material_hash string")
    old = spark.createDataFrame([("t", 1, "h"), ("t", 2, "x"), ("t", 4, "y")], now.schema)
    assert {r["entity_uid"]: r["action"] for r in entities.embedding_upkeep(now, old).collect()} == {1: "reused", 2: "updated", 3: "created", 4: "purged"}
    with pytest.raises(ValueError, match="mode"):
        entities.bind(wanted, wanted, "x")


def test_contained_names(spark):
    judged = spark.createDataFrame([(1, "t", "The Old Bridge of Verona"), (2, "t", "bridges"), (3, "u", "Old Bridge")], "asset_id int, entity_type string, name string")
    known = spark.createDataFrame([("t", "old bridge"), ("t", "Verona"), ("t", "the old bridge of verona"), ("t", "bridge of verona x y")], "entity_type string, name string")
    assert {(r["asset_id"], r["to_name"]) for r in entities.contained(judged, known).collect()} == {(1, "old bridge"), (1, "Verona")}


def test_label_work_is_starvation_free(spark):
    cand = spark.createDataFrame([("t", i, f"h{i}", 10 - i) for i in range(4)], "entity_type string, entity_uid int, material_hash string, members int")
    skills = spark.createDataFrame([("s", 1)], "skill_code string, skill_version int")
    st = spark.createDataFrame([], "entity_type string, entity_uid int, skill_code string, material_hash string, skill_version int, prompt_version string")
    seen = []
    for _ in range(2):
        due = entities.label_work(cand, skills, st, "p", 2).collect()
        seen += sorted(r["entity_uid"] for r in due)
        st = st.unionByName(spark.createDataFrame([("t", r["entity_uid"], "s", f"h{r['entity_uid']}", 1, "p") for r in due], st.schema))
    assert seen == [0, 1, 2, 3] and entities.label_work(cand, skills, st, "p", 2).count() == 0


def test_topics(spark):
    reg = spark.createDataFrame([("A", None), ("B", None), ("etc", None), ("x", "A"), ("x", "B"), ("y", "B")], "name string, parent string")
    texts = spark.createDataFrame([(1, "t"), (2, "t"), (3, " "), (4, "t")], "asset_id int, text string")
    said = spark.createDataFrame([(1, 1, "Z", 0.1), (1, 2, "A", 0.2), (2, 1, "etc", 0.3), (3, 1, "A", 0.4), (4, 3, "A", 0.5)], "asset_id int, attempt int, topic string, confidence double")
    got = {r["asset_id"]: r["topic"] for r in topics.closed_topic(texts, said, reg).collect()}
    assert got == {1: "A", 2: "unassigned", 3: "unassigned", 4: "unassigned"}
    al = spark.createDataFrame([("aa", "A", None), ("why", "y", "B")], "raw string, canonical string, parent string")
    rows = spark.createDataFrame([(1, "aa", "why"), (2, "B", "why"), (3, "B", "B"), (4, "B", "Image")], "asset_id int, topic string, subtopic string")
    assert {r["asset_id"]: (r["topic"], r["subtopic"]) for r in topics.canonical_topics(rows, al).collect()} == {1: ("A", "why"), 2: ("B", "y"), 3: ("B", None), 4: ("B", None)}
    assert topics.canonical_topics(rows, al, on=False) is rows


def test_search(spark):
    lex = spark.createDataFrame([(1, 1, 4.0), (1, 2, 2.0)], "query int, id int, score double")
    vec = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.9)], "query int, id int, similarity double")
    got = {r["id"]: r["similarity"] for r in search.fuse(lex, vec, (0.5, 0.5)).collect()}
    assert got == {1: 0.5, 2: 0.5, 3: 0.5}
    assert [r["id"] for r in search.merge(search.fuse(lex, vec), 2).orderBy("rank").collect()] == [1, 2]
    assert search.gate(vec, ["query"], 0.95, 0.1).count() == 0 and search.gate(vec, ["query"], 0.95, 0.1, on=False).count() == 2
    with pytest.raises(ValueError, match="smell, taste"):
        search.modalities("text, smell,taste")
    ranked = spark.createDataFrame([(1, 7, 1), (1, 8, 2)], "query int, id int, rank int")
    rel = spark.createDataFrame([(1, 8), (1, 9), (2, 5)], "query int, id int")
    m = {r["query"]: r for r in search.metrics(ranked, rel, 2).collect()}
    assert (m[1]["recall"], m[1]["precision"], m[1]["mrr"]) == (0.5, 0.5, 0.5) and m[1]["ndcg"] == pytest.approx((1 / math.log2(3)) / (1 + 1 / math.log2(3)))
    assert (m[2]["recall"], m[2]["mrr"], m[2]["nonrelevant_mean_rank"]) == (0.0, 0.0, None)


def test_reports(spark):
    rows = spark.createDataFrame([("a", x) for x in (1, 2, 3, 4)] + [("b", None)], "g string, v int")
    got = {r["g"]: (r["n"], r["median"]) for r in reports.upper_median(rows, "v", ["g"]).collect()}
    assert got == {"a": (4, 3)}
    frames = spark.createDataFrame([(1, 0, " ", [], [], [1.0]), (1, 1, "cat", ["k"], ["l"], None)], "asset_id int, chunk_index int, summary string, keywords array<string>, labels array<string>, vector array<double>")
    out = {(r["channel"], r["chunk_index"]) for r in reports.paired_channels(frames).collect()}
    assert out == {("st", 0), ("st", 1), ("clip", 0)}


def test_lifecycle_stream_is_its_batch(spark, tmp_path):
    t0 = dt.datetime(2026, 1, 1)
    rows = [(a, i, t0 + dt.timedelta(seconds=i), s) for a in (1, 2) for i, s in enumerate(["received", "routing", "extracting", "failed", "routing", "failed", "failed", "received"], start=10 * a)]
    df = spark.createDataFrame(rows, "asset_id long, event_id long, ts timestamp, state string")
    df.write.parquet(f"{tmp_path}/in")
    lifecycle.drain(lifecycle.follow(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/c")
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
    assert got == sorted(map(tuple, lifecycle.follow_batch(df).collect()))
    assert [r[4] for r in got[:8]] == [None, None, "illegal", "retry", None, "retry", "cap", "late"]


def test_micro_batches_keep_dead_letters(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    df.write.parquet(f"{tmp_path}/in")
    lifecycle.micro_batches(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), lambda d: (d.filter("x is not null"), d.filter("x is null")), f"{tmp_path}/o", f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/o/good").count() == 2 and spark.read.parquet(f"{tmp_path}/o/dead").count() == 1


def test_settled_assets_lead_and_stay(spark):
    rows = [(1, "h", "received", 1), (2, "h", "registered", 2), (3, "h", "deferred", 3), (4, "h", "failed", 0), (5, "g", "received", 5), (6, "g", "routing", 4), (7, None, "received", 7), (8, None, "received", 8)]
    assets = spark.createDataFrame(rows, "asset_id int, file_hash string, status string, created_at int")
    got = {r["asset_id"]: (r["status"], r["status_reason"]) for r in dedup.defer_copies(assets).collect()}
    assert got == {1: ("deferred", "duplicate_content:2"), 2: ("registered", None), 3: ("deferred", None), 4: ("failed", None), 5: ("deferred", "duplicate_content:6"), 6: ("routing", None), 7: ("received", None), 8: ("received", None)}


def test_passages_are_found_whole(spark):
    docs = spark.createDataFrame([(1, "x Aone two  three four five six seven eight nine tenB"), (2, "one two three four five six seven eight nine ten"), (3, "a b c"), (4, None), (5, "two three four five six seven eight nine")], "id int, text string")
    asked = spark.createDataFrame([("p", "one two three four five six seven eight nine ten"), ("q", "a b c"), ("r", "b c"), ("s", None)], "query string, text string")
    assert sorted(map(tuple, search.containing(docs, asked).collect())) == [("p", 2), ("q", 3)]


def test_path_classes(spark):
    paths = ["/d/a.txt", "/d/A copy.txt", "/d/a_2.md", "/e/a.txt", "/d/b.txt", "/d/12.txt", None, "/e/a (3).txt", "a.txt", "/d/b.txt"]
    df = spark.createDataFrame(list(enumerate(paths, 1)), "asset_id int, fs_path string")
    stems = dict(df.select("asset_id", relations.stem(F.col("fs_path"))).collect())
    group = {i: (p.rpartition("/")[0], stems[i]) if p and stems[i] else i for i, p in enumerate(paths, 1)}
    of = {i: sorted(j for j in group if group[j] == group[i]) for i in group}
    classes = relations.path_classes(df)
    assert {(r["asset_id"], r["class_id"], r["links"]) for r in classes.collect()} == {(i, of[i][0], len(of[i]) - 1) for i in of}
    assert len(of[1]) == 3 and of[12 - 2] == [5, 10]
    got = {(r["src"], r["dst"], r["emb_score"]) for r in relations.path_candidates(df, df).collect()}
    assert got == {(i, of[i][of[i][0] == i], 0.0) for i in of if len(of[i]) > 1}
    assert relations.path_classes(df.limit(0)).count() == relations.path_candidates(df.limit(0), df).count() == 0


def test_edges_within_a_class_are_allowed(spark):
    edges = spark.createDataFrame([(1, 2, "k"), (1, 3, "k"), (2, 3, "k"), (1, 1, "k"), (9, 8, "k")], "src int, dst int, kind_code string")
    allowed = spark.createDataFrame([(1, 3)], "src int, dst int")
    kinds = spark.createDataFrame([("k",)], "kind_code string")
    classes = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (3, 3)], "asset_id int, class_id int")
    got = {(r["src"], r["dst"]): r["skipped"] for r in relations.checked_edges(edges, allowed, kinds, classes=classes).collect()}
    assert got == {(1, 2): None, (1, 3): None, (2, 3): "not_allowed", (1, 1): "self", (9, 8): "not_allowed"}
    assert relations.checked_edges(edges, allowed, kinds, classes=classes).count() == 5
    without = {(r["src"], r["dst"]): r["skipped"] for r in relations.checked_edges(edges, allowed, kinds).collect()}
    assert without[1, 2] == "not_allowed" and without[1, 3] is None
