"""Every query of the library against its SQL, on the smallest tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

from poolside.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def _plain(value):
    """One form for a value of either engine."""
    if isinstance(value, decimal.Decimal | float):
        return "nan" if math.isnan(value) else f"{float(value):.6f}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, list | tuple):
        return str([_plain(v) for v in value])
    return str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def test_each_query_has_sql():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert len(catalog.oracle_sql()) >= 0.9 * len(catalog.queries())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    want = duck.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    expected = sorted(tuple(_plain(row[i]) for i in order) for row in want.fetchall())
    found = sorted(tuple(_plain(v) for v in row) for row in df.select(*sorted(df.columns)).collect())
    assert found == expected
