"""Every registered query with a DuckDB twin gives the same rows on the smallest tables."""

import duckdb
import pytest

from tellurion.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def text(v):
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("+00:00", "")
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_twin(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    r = duck.execute(catalog.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(text(row[names.index(c)]) for c in sorted(names)) for row in r.fetchall())
    assert sorted(tuple(text(row[c]) for c in sorted(names)) for row in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() >= 0
