"""Runs a registered query and its SQL over the same tables."""

import os
from pathlib import Path

import duckdb

TABLES = Path(os.environ.get("GRIDFRAME_TABLES", "/root/testdata/sf0.001"))


def both(spark, run, sql):
    """Sorted rows by Spark and by SQL, columns by name."""
    df = run(spark, str(TABLES))
    columns = sorted(df.columns)
    con = duckdb.connect()
    for f in TABLES.glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    found = con.sql(sql)
    assert sorted(found.columns) == columns
    order = [found.columns.index(c) for c in columns]
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))), sorted(repr(tuple(r[k] for k in order)) for r in found.fetchall())
