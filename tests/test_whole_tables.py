"""Queries whose SQL covers a part of a table, against that SQL without the part's condition."""

import os

import duckdb
import pytest

from tessella.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, part", [("mirror_empty_arbitration", " WHERE event_id < 600"), ("osm_member_assembly", " WHERE l_orderkey < 2000"), ("coastline_side_test", " WHERE row_id % 5 = 0")])
def test_whole_table(spark, name, part):
    sql = registry.ORACLE_SQL[name].replace(part, "")
    duck = duckdb.connect()
    for f in os.listdir(SF):
        duck.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got = registry.QUERIES[name](spark, SF)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, duck.execute(f"SELECT {', '.join(got.columns)} FROM ({sql})").fetchall()))
