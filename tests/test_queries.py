"""Every registered query with an SQL twin against DuckDB on the smallest tables."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__
from catalith import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v).replace("+00:00", "") if hasattr(v, "isoformat") else round(float(v), 6) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", [n for n in plans.QUERIES if n in plans.ORACLES])
def test_query_is_its_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(df.columns)
    sql = plans.ORACLES[name]
    assert columns == sorted(duck.sql(sql).columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expect = sorted((tuple(map(plain, r)) for r in duck.sql(f"select {quoted} from ({sql})").fetchall()), key=repr)
    assert sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr) == expect


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_all_names_are_callable():
    assert all(callable(f) for f in __spark_entry__.queries().values())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
