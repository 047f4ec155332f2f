"""Every query with SQL gives the rows DuckDB gives; the others run here and are re-derived in test_rederived.py."""

import math
from pathlib import Path

import duckdb
import pytest

from seamline import plans

DATA = Path("/root/testdata/sf0.001")
plans.load()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, str(DATA))
    found = duck.execute(plans.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(found.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_others_run(spark, name):
    assert plans.QUERIES[name](spark, str(DATA)).count() >= 0


def test_flagship(spark):
    assert plans.QUERIES[plans.FLAGSHIP](spark, str(DATA)).count() > 0
