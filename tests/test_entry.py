"""The driver's contract: names, and a few queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__

DATA = "/root/testdata/sf0.001"


def test_names():
    found = __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(found) and len(found) > 50


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", ["b9_infer_metadata", "g2_quality_gate", "g14_best_by_domain", "j12_failure_streak", "k12_row_group", "q2_final_states"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    got = __spark_entry__.queries()[name](spark, DATA)
    found = con.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, found.fetchall()))
