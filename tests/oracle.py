"""Runs SQL over the tables with DuckDB and compares rows, whatever their order."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def expected(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{p}/*.parquet')" if os.path.isdir(p) else f"create view {t} as select * from read_parquet('{p}')")
    con.execute(sql)
    names = [d[0] for d in con.description]
    return names, con.fetchall()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, bool) or value is None:
        return value
    return str(value) if not isinstance(value, int) else value


def normal(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(frame, sql: str, sf_dir: str) -> str:
    """Empty if the frame's rows are the SQL's."""
    names, rows = expected(sql, sf_dir)
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(names)}"
    got, want = normal(frame.columns, frame.collect()), normal(names, rows)
    if got != want:
        only = [x for x in got if x not in set(want)][:2], [x for x in want if x not in set(got)][:2]
        return f"{len(got)} rows instead of {len(want)}; only here {only[0]}; only there {only[1]}"
    return ""
