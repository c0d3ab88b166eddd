"""Every catalogue query with SQL, against DuckDB at the smallest size."""

from pathlib import Path

import duckdb
import pytest

from chronocell import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def same(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: "" if v is None or v != v else repr(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query(spark, con, name):
    df, sql = catalogue.Q[name](spark, SF), con.sql(catalogue.SQL[name])
    assert sorted(df.columns) == sorted(sql.columns)
    assert same(df.columns, df.collect()) == same(sql.columns, sql.fetchall())


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
def test_dilation_and_rolling_bins_take_the_whole_table(spark, con):
    d = catalogue.Q["n1_dilation_days"](spark, SF)
    assert d.count() == con.sql(f"WITH {catalogue.OBS} SELECT DISTINCT solar_day, y, x FROM obs").count("*").fetchall()[0][0]
    assert 0 < d.where("dilated").count() < d.count()
    assert catalogue.Q["b6_rolling_span"](spark, SF).select("id").distinct().count() == con.sql("SELECT DISTINCT l_orderkey * 10 + l_linenumber FROM lineitem").count("*").fetchall()[0][0]
