"""Every query of the catalogue that has SQL against DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from voxlake.plans.catalogue import QUERIES
from voxlake.plans.oracle import ORACLE

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else [plain(x) for x in v] if isinstance(v, list) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([[plain(r[i]) for i in order] for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DATA)
    got = df.collect()
    if name in ORACLE:
        said = db.execute(ORACLE[name])
        columns = [c[0] for c in said.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows_of(df.columns, got) == rows_of(columns, said.fetchall())
    else:
        assert got


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_escaped_html_of_long_urls(spark, tmp_path):
    rows = [(i, f"<a href='{i}'>&</a>", "é" + "x" * n) for i, n in enumerate((0, 54, 55, 56, 57, 112, 113, 5000))] + [(-1, None, None), (-2, "", "")]
    spark.createDataFrame(rows, "page_id long, html string, url string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    df = QUERIES["escaped_html"](spark, str(tmp_path))
    said = con.execute(ORACLE["escaped_html"])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in said.description], said.fetchall())
