"""Registered queries against their DuckDB twins (the driver's correctness gate).

A representative subset runs by default on sf0.001; EVOCLUST_FULL_ORACLE=1
runs every registered query.
"""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DEFAULT = ["s_points_from_columns", "j1_assign", "k_fit_3_iterations", "k_center_history", "e2_ari",
           "e5_silhouette_exact", "e7_davies_bouldin", "e8_report", "g5_selection", "g7_crossover_rotated",
           "g8_mutation", "g9_kmo_guarded", "g11_fit", "g11_fit_mutation", "g15_population_log", "g6_crossover_ring",
           "a5_sse_offset", "e6_silhouette_offset", "s_points_by_position", "d1_pca_part",
           "e5_silhouette_pruned", "g13_fit_defaults", "g11_fit_parity", "g6_crossover_ring_p10", "d2_projection", "s1_numeric_csv",
           "s2_named_csv", "s4_iris_csv", "p8_abalone_csv", "s7_report_file", "k_bounds_events", "e7_davies_bouldin_events"]
NAMES = sorted(set(E.oracle_sql()) & set(E.QUERIES)) if os.environ.get("EVOCLUST_FULL_ORACLE") else DEFAULT


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted(tuple(norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want


def test_every_query_has_a_name_and_entry_runs(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    assert E.entry(spark).count() > 0
