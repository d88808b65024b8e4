"""Every query of the catalog against its SQL on the smallest tables."""

import glob
import os

import numpy as np
import pandas as pd
import pytest

duckdb = pytest.importorskip("duckdb")

from tidewater.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def shown(v) -> str:
    if isinstance(v, (list, np.ndarray)):
        return str([shown(x) for x in v])
    if v is None or v is pd.NaT or v != v:
        return ""
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (int, float, np.integer, np.floating)):
        return f"{float(v):.9g}"
    return pd.Timestamp(v).isoformat() if hasattr(v, "isoformat") else str(v)


def rows(df: pd.DataFrame) -> list:
    return sorted(tuple(map(shown, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, SF).toPandas()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert len(got)
        return
    want = duck.execute(sql).fetch_df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_band_join_has_no_nested_loop(spark):
    from tidewater.plans import links

    plan = links.j7_band_join(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_columns_are_pruned(spark):
    from tidewater.plans import star

    plan = star.a7_commodity_counts(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
