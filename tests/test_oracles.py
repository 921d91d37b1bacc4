"""Every query of the comparison engine against its SQL, on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from strandloom.plans import catalog

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
