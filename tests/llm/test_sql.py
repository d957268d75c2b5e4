"""What SQL can say of the operators' queries, said by DuckDB over the same tables."""

from pathlib import Path

import pytest

from quarrylit.llm import queries

duckdb = pytest.importorskip("duckdb")
pytest.importorskip("public_tokenizers")
DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    cursor = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    got = queries.queries()[name](spark, str(DATA))
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == sorted(cursor.fetchall(), key=repr)
