"""Every query with SQL gives the SQL's rows."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def registry():
    from siftwork.plans import registry

    return registry


def rows(df):
    def form(v):
        if not isinstance(v, (list, dict)) and pd.isna(v):
            return "null"
        if isinstance(v, float):
            return f"{v:.6f}".rstrip("0").rstrip(".")
        return str(v)

    return sorted(tuple(form(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in DATA.iterdir():
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry().oracle_sql()))
def test_query(spark, con, name):
    got = registry().queries()[name](spark, str(DATA)).toPandas()
    want = con.sql(registry().oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["doc_id", "n_chars"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_nothing_outside_llm_imports_it():
    root = Path(__file__).parent.parent
    for p in [*root.glob("siftwork/**/*.py"), *root.glob("tests/*.py")]:
        if "llm" not in p.relative_to(root).parts and p.name != "test_queries.py":
            assert "siftwork.llm" not in p.read_text(), p
