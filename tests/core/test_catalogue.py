"""Every query of the catalogue against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

import rankloom.catalog  # noqa: E402, F401  fills the entries
import rankloom.plans.catalogue as catalogue  # noqa: E402


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(catalogue.ENTRIES))
def test_query(spark, con, name):
    query, sql = catalogue.ENTRIES[name]
    got = query(spark, SF)
    if sql is None:
        assert got.count() > 0
        return
    want = con.execute(sql)
    columns = sorted(got.columns)
    assert columns == sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(c) for c in columns]
    plain = lambda v: v.replace(tzinfo=None) if hasattr(v, "tzinfo") else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    key = lambda r: tuple((v is None, str(v)) for v in r)
    a = sorted((tuple(plain(v) for v in r) for r in got.select(*columns).collect()), key=key)
    b = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=key)
    assert a == b


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_full_outer_over_whole_tables(spark):
    got = catalogue.ENTRIES["full_outer_guarded"][0](spark, SF).groupBy("source").count().collect()
    n = {r["source"]: r["count"] for r in got}
    rows = lambda t: spark.read.parquet(f"{SF}/{t}.parquet").count()
    assert n["both"] > 0 and n["both"] + n.get("left", 0) == rows("customer") and n["both"] + n.get("right", 0) == rows("supplier")
