"""Queries against their SQL in DuckDB. TEST_ALL_QUERIES=1 runs the whole catalog."""

import os
import sys

import duckdb
import pytest

from firmalign.catalog.oracles import oracle_sql
from firmalign.catalog.queries import queries
from testing_paths import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check import rows  # noqa: E402

SOME = (
    "match_prediction", "match_prediction__v1", "resolve_matches", "new_from_oa_tuple_in",
    "patient_impact__detail", "null_payer_impact", "duplicate_keys", "feed_cardinality",
    "usage_match_quality", "usage_venn", "reference_coverage", "update_matched__feed",
    "delete_garbage__b_patients", "run_sync", "run_usage_cleanup__safe",
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from read_parquet('{SF}/{f}')")
    return con


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()) if os.environ.get("TEST_ALL_QUERIES") else SOME)
def test_same_result(name, spark, duck):
    df = queries()[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    cursor = duck.execute(oracle_sql()[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(
        [c[0] for c in cursor.description], cursor.fetchall())
