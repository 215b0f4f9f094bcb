"""What the findings of round 4 are about."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from catalith.operators import search

DOCS = {1: "a b c", 2: "xb cy", 3: "b  c", 4: None, 5: "", 6: "Straße b cd", 7: "the end of the day the end", 8: "end of it", 9: " ", 10: "b c b c"}
ASKED = {1: "a b c", 2: "b c", 3: "c", 4: "", 5: " ", 6: None, 7: "aß", 8: "b c", 9: "the end of the", 10: " of ", 11: "end of", 12: "zz", 13: " b  ", 14: "ndß"}
#: In one list, and in blocks of it that meet blocks of documents.
SIZES = [{}, {"list_bytes": 64, "doc_bytes": 16}]


@pytest.mark.parametrize("sizes", SIZES)
def test_short_passages_are_found_too(spark, sizes):
    docs, asked = spark.createDataFrame(list(DOCS.items()), "id long, text string"), spark.createDataFrame(list(ASKED.items()), "query long, text string")
    got = search.containing_any(docs, asked, **sizes)
    assert sorted(map(tuple, got.collect())) == sorted((q, i) for q, p in ASKED.items() for i, t in DOCS.items() if None not in (p, t) and p in t)
    none = search.containing_any(docs.filter("text is null"), asked, **sizes)
    assert none.count() == 0 and none.dtypes == got.dtypes
    # Without a short one no document is read for them.
    assert sorted(map(tuple, search.containing_any(docs, asked.filter("query in (1, 6, 9)"), **sizes).collect())) == [(1, 1), (9, 7)]


@pytest.mark.parametrize("sizes", SIZES)
def test_short_passages_in_bytes_and_by_name(spark, sizes):
    docs = spark.sql("select * from values ('d1', cast(x'78ff6279' as string)), ('d2', 'by'), (null, 'xb') as t(id, text)")
    asked = spark.createDataFrame([("q", "b"), (None, "by")], "query string, text string")
    assert set(map(tuple, search.containing_any(docs, asked, **sizes).collect())) == {("q", "d1"), ("q", "d2"), ("q", None), (None, "d1"), (None, "d2")}


def test_search_metrics_of_short_passages_are_its_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    more = {100 + i: f"the end of day {i} in town" for i in range(30)}
    spark.createDataFrame(list((DOCS | more).items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list((ASKED | {20: "town", 21: "day 7", 22: "n t"}).items()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    got = __spark_entry__.queries()["search_metrics"](spark, str(tmp_path))
    want = con.execute(f"select {', '.join(got.columns)} from ({__spark_entry__.oracle_sql()['search_metrics']}) order by query").fetchall()
    assert [tuple(r) for r in got.orderBy("query").collect()] == [pytest.approx(r, abs=1e-6) for r in want]
    assert len(want) > 10


def test_relevant_pairs_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def one(i):
        made.add(1)
        return i

    ranked = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "query long, id long, rank int")
    assert search.metrics(ranked, spark.range(5, 7).select(F.lit(1).cast("long").alias("query"), one("id").alias("id")), 2).first()["recall"] == 1.0
    assert made.value == 2
