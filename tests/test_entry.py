"""Every query with SQL gives DuckDB's rows on the smallest tables; the rest at least runs."""

import importlib.util
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from strandweave.plans import queries as own

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame, columns):
    return sorted(map(repr, frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(own.QUERIES))
def test_query(spark, name):
    got = own.QUERIES[name](spark, SF).toPandas()
    if name not in own.SQL:
        return
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS FROM read_parquet('{SF}/{t}.parquet')")
    want = db.execute(own.SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert rows(got, columns) == rows(want, columns)


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if importlib.util.find_spec("strandweave.llm"):
        assert {f"op{n}_" for n in range(1, 14)} <= {k[: k.index("_") + 1] for k in entry.queries() if k.startswith("op")}


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_queries_list_without_a_session():
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=os.path.dirname(os.path.abspath(entry.__file__)), capture_output=True, text=True)
    assert int(out.stdout.split()[-1]) >= len(own.QUERIES)
