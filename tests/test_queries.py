"""Every query with SQL against DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from quillstone.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(x):
    if isinstance(x, float):
        return round(x, 6)
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    return x


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, oracle, name):
    frame = registry.QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    if name in registry.SQL:
        result = oracle.execute(registry.SQL[name])
        names = [c[0] for c in result.description]
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        assert got == sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=repr)


def test_plans_have_no_nested_loops(spark):
    for name in ("j05_interval_join_dissimilar", "j07_nearest_within", "j08_nearest_unbounded", "j12_band_to_edges", "j32_band_self_join", "j41_overlap_hull"):
        plan = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_scans_read_only_their_columns(spark):
    plan = registry.QUERIES["a43_signal_counts"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string>" in plan
