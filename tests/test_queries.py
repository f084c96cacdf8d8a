"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import os

import duckdb
import pytest

from tessella.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    return [plain(x) for x in v] if isinstance(v, list | tuple) else float(v) if isinstance(v, int | float) and not isinstance(v, bool) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    rows = [tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect()]
    if name in registry.ORACLE_SQL:
        want = duck.execute(registry.ORACLE_SQL[name])
        names = [x[0] for x in want.description]
        assert sorted(names) == sorted(got.columns)
        order = [names.index(c) for c in sorted(names)]
        assert sorted(map(repr, rows)) == sorted(repr(tuple(plain(r[k]) for k in order)) for r in want.fetchall())
    else:
        assert rows
