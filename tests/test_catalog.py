import os

import duckdb
import pytest

from conftest import ROOT, SF001
import __spark_entry__ as entry
from robustagg import catalog
from tools.check_oracles import TABLES, compare


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["product_id", "popularity", "rank"]
    assert 0 < len(rows) <= 5


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.oracles())
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.oracles()) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle_sf0001(spark, con, name):
    df = catalog.QUERIES[name](spark, SF001)
    rows = df.collect()
    cur = con.execute(catalog.oracles()[name])
    err = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert err is None, err


def test_scale_conf():
    from robustagg.session import scale_conf
    conf = scale_conf(100 * 10**12)
    assert 350_000 < int(conf["spark.sql.shuffle.partitions"]) < 400_000
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "8"
