from pathlib import Path

import duckdb
import pytest

from siftwork.llm import queries

DATA = Path("/root/testdata/sf0.001")
COLUMNS = {
    "p1_found": {"field", "id_a", "id_b"}, "p2_found": {"record_id", "task_id"}, "p3_found": {"record_id", "site", "thread_no"}, "p4_found": {"thread_id", "post_index", "line_no"},
    "p5_found": {"record_id", "defect"}, "p7_found": {"field", "id"}, "p8_ids": {"doc_id", "ids"}, "p10_found": {"doc_id"},
}


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    df = queries.queries()[name](spark, str(DATA))
    if name in COLUMNS:
        assert set(df.columns) == COLUMNS[name]
    rows = [str(r) for r in df.collect()]
    assert rows and (name == "p9_mix" or len(rows) == len(set(rows)) or not name.endswith("_found"))


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, name):
    con = duckdb.connect()
    for p in DATA.iterdir():
        con.execute(f"create view {p.stem} as select * from '{p}'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, str(DATA)).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
