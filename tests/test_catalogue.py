"""Each query against its oracle in DuckDB, and the contract of the entry module."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from threadloom.plans import catalogue

SF = "/root/testdata/sf0.001"
EMPTY = {"graph_link_check", "identity_invariants", "top3_origins"}  # no breach, or may have no row at this scale


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).iterdir():
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 9) if isinstance(v, float) else v if isinstance(v, (int, str)) else str(v)


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    rows = table(df.collect(), df.columns)
    if name in catalogue.ORACLES:
        result = duck.execute(catalogue.ORACLES[name])
        columns = [c[0] for c in result.description]
        assert sorted(df.columns) == sorted(columns)
        assert rows == table(result.fetchall(), columns)
    if name.startswith("resolver"):
        assert len({r[sorted(df.columns).index("evidence_class")] for r in rows}) >= 3


def test_entry_has_rows_and_a_stable_schema(spark):
    a, b = entry.entry(spark), entry.entry(spark)
    assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(catalogue.ORACLES) >= len(catalogue.QUERIES) - 2


def test_nothing_else_imports_the_training_data_subpackage():
    for p in Path(catalogue.__file__).parents[1].rglob("*.py"):
        if "llm" not in p.parts:
            assert "threadloom.llm" not in p.read_text()
