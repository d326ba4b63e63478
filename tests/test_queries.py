"""Queries over the analytic tables against their SQL, on keys as larger tables have them."""

import duckdb
import pytest

from geoloom.plans import queries

SF = "/root/testdata/sf0.001"
#: How far keys are moved: past the last that a fixed-point coordinate of 32 bits can hold, and that of larger tables.
FAR = (200_000, 9_000_000, 150_000_000)


@pytest.fixture(scope="module")
def far_keys(tmp_path_factory):
    """Tables of sf0.001 with copies whose keys are moved."""
    folder = tmp_path_factory.mktemp("far")
    moved = {"orders": ["o_orderkey", "o_custkey"], "customer": ["c_custkey"], "events": ["event_id", "user_id"]}
    for name, keys in moved.items():
        shifted = ", ".join(f"{k} + i AS {k}" for k in keys)
        duckdb.sql(f"COPY (SELECT * REPLACE ({shifted}) FROM '{SF}/{name}.parquet', (SELECT unnest({[0, *FAR]}) AS i)) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", ["degrees", "element_xml", "bbox_all_or_nothing"])
def test_coordinates_of_far_keys(spark, far_keys, name):
    db = duckdb.connect()
    for table in ("orders", "customer", "events"):
        db.sql(f"CREATE VIEW {table} AS FROM '{far_keys}/{table}.parquet'")
    want = db.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, str(far_keys))
    assert got.columns == want.columns
    key = lambda row: tuple(map(repr, row))
    rows = sorted(map(tuple, got.collect()), key=key)
    assert rows == sorted(want.fetchall(), key=key) and len(rows) > 4 * 50
