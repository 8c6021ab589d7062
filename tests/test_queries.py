"""Every registered query of the library against its SQL, on the smallest tables."""

import math

import pytest

from strandline.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(float(v), 5) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    if name not in ORACLES:
        return
    want = duck.execute(ORACLES[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(df.columns)
    a = sorted((tuple(plain(r[c]) for c in sorted(cols)) for r in got), key=repr)
    order = [cols.index(c) for c in sorted(cols)]
    b = sorted((tuple(plain(r[i]) for i in order) for r in want.fetchall()), key=repr)
    assert a == b
