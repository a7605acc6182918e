"""Compare a Spark result with DuckDB's, as multisets of rows."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(con, sql: str, result) -> str | None:
    """None when the rows and columns agree, else what differs."""
    con.register("got", result.toArrow())
    con.execute(f"CREATE OR REPLACE TEMP TABLE wanted AS {sql}")
    shapes = {}
    for table in ("got", "wanted"):
        described = con.execute(f"DESCRIBE SELECT * FROM {table}").fetchall()
        shapes[table] = {row[0]: row[1] for row in described}
    if shapes["got"] != shapes["wanted"]:
        return f"schema {shapes['got']} != {shapes['wanted']}"
    columns = ", ".join(f'"{c}"' for c in sorted(shapes["got"]))
    counts = [con.execute(f"SELECT count(*) FROM {t}").fetchall()[0][0] for t in shapes]
    extra = [con.execute(f"SELECT count(*) FROM (SELECT {columns} FROM {x} EXCEPT ALL "
                         f"SELECT {columns} FROM {y})").fetchall()[0][0]
             for x, y in (("got", "wanted"), ("wanted", "got"))]
    if counts[0] != counts[1] or any(extra):
        return f"rows {counts}, only in Spark {extra[0]}, only in DuckDB {extra[1]}"
    return None
