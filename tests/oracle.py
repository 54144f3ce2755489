"""Running a registered query and its SQL side by side."""

from __future__ import annotations

import glob
import os

import duckdb

DATA = "/root/testdata/sf0.01"


def connect(sf_dir: str = DATA):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(round(value, 6))
    return repr(value)


def expected(con, sql: str) -> tuple[list[str], list[tuple]]:
    names = [row[0] for row in con.execute(f"DESCRIBE {sql}").fetchall()]
    return _sorted(names, con.execute(sql).fetchall())


def actual(df) -> tuple[list[str], list[tuple]]:
    return _sorted(df.columns, [tuple(row) for row in df.collect()])


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = sorted(tuple(_plain(row[i]) for i in order) for row in rows)
    return [names[i] for i in order], plain


def types(con, sql: str) -> dict[str, str]:
    return {row[0]: row[1].lower() for row in con.execute(f"DESCRIBE {sql}").fetchall()}
