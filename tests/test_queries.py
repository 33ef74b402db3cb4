"""Every query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from tessera.queries import aggregations, components, filters, joins, rasters, scalars, scans, streams, windows  # noqa: F401
from tessera.queries.registry import ORACLES, QUERIES, compared
from tessera.views import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{os.path.join(SF, t)}.parquet'")
    return db


def plain(value):
    if value is None or value is pd.NA or value is pd.NaT or value != value:
        return None
    if isinstance(value, str):
        return value
    value = float(value)
    return round(value, 6) + 0.0


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(repr(tuple(map(plain, r))) for r in frame[columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    got = compared(name)(spark, SF).toPandas()
    if name in ORACLES:
        assert rows(got) == rows(sql.sql(ORACLES[name]).df())
    else:
        assert len(got.columns) > 0


def test_names_are_inventory_ids():
    assert all(n[:3].isalpha() for n in QUERIES) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["jon05_overlap_self_join", "jon06_overlap_join", "jon08_distance_join", "flt07_aoi_overlap"])
def test_place_joins_are_equi_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_reach_the_files(spark):
    from tessera.views import table

    plan = table(spark, SF, "lineitem").where("l_quantity > 40").select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity" in plan


def test_buffers_of_all_truths(spark):
    from tessera.views import view

    assert QUERIES["geo10_buffer"](spark, SF).count() == view(spark, SF, "truth").count() > 0
