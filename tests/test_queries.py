"""Each query of the reference operators against DuckDB."""

import glob
import os

import duckdb
import pytest

from pagemill.plans import reference

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def _rows(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else None if x is None else str(x) for x in r) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(reference.QUERIES))
def test_query(spark, duck, name):
    df = reference.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    if name not in reference.ORACLES:
        assert df.count() > 0
        return
    want = duck.sql("select " + ", ".join(f'"{c}"' for c in names) + f" from ({reference.ORACLES[name]})").fetchall()
    assert _rows(df.select(*names).collect()) == _rows(want)


def test_library_does_not_need_the_llm_folder():
    for p in glob.glob(os.path.join(os.path.dirname(reference.__file__), "..", "**", "*.py"), recursive=True):
        if f"{os.sep}llm{os.sep}" not in p:
            assert "pagemill.llm" not in open(p).read()
