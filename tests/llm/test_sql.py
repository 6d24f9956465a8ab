"""The corpus queries that SQL can express against DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from conftest import SF

from corpusweave.llm import registry


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_same_as_sql(spark, name):
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df, want = registry.queries()[name](spark, SF), c.sql(registry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*(f"`{x}`" for x in cols)).collect())
    assert got == sorted(repr(tuple(r)) for r in want.project(",".join(f'"{x}"' for x in cols)).fetchall())
