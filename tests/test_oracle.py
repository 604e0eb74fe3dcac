"""Every registered query with SQL agrees with it on the smallest tables."""

import math

import pytest

from quirelake.plans.registry import ORACLE_SQL, QUERIES

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple((k, norm(x)) for k, x in sorted(v.items()))
    if isinstance(v, list | tuple):
        return tuple(map(norm, v))
    if type(v).__name__ == "Decimal":
        v = float(v)
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = sorted(repr([norm(x) for x in r]) for r in df.select(*sorted(df.columns)).collect())
    if name not in ORACLE_SQL:
        assert got
        return
    want = con.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == sorted(df.columns)
    assert got == sorted(repr([norm(x) for x in r]) for r in want.select(*[f'"{c}"' for c in sorted(want.columns)]).fetchall())
