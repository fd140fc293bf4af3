"""Every registered query with SQL gives the SQL's rows, on the smallest tables; the others run and are not empty."""

from __future__ import annotations

import math

import duckdb
import pytest

from captureframe.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
EMPTY_AT_THIS_SIZE = {"bbox_overlap_pairs", "surface_integrity", "door_tree", "cutouts_classify", "void_intervals", "room_communities"}  # ten suppliers in as many nations: no two share a capture


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    out = QUERIES[name](spark, SF)
    columns = sorted(out.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in out.collect()), key=str)
    cursor = con.execute(ORACLES[name])
    named = [d[0] for d in cursor.description]
    want = sorted((tuple(plain(dict(zip(named, r, strict=True))[c]) for c in columns) for r in cursor.fetchall()), key=str)
    assert sorted(named) == columns
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert rows or name in EMPTY_AT_THIS_SIZE
