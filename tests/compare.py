"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(plain, key=repr)


def differences(spark_df, con, sql: str, show: int = 3) -> list[str]:
    result = con.execute(sql)
    names, want = _rows([d[0] for d in result.description], result.fetchall())
    got_names, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if names != got_names:
        return [f"columns {got_names} instead of {names}"]
    problems = [] if len(got) == len(want) else [f"{len(got)} rows instead of {len(want)}"]
    kinds = {n: (type(a), type(b)) for g, w in zip(got, want) for n, a, b in zip(names, g, w)
             if a is not None and b is not None and type(a) is not type(b)}
    problems += [f"type of {n}: {a.__name__} instead of {b.__name__}" for n, (a, b) in kinds.items()]
    unlike = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    problems += [f"{len(unlike)} rows differ"] if unlike else []
    problems += [f"got {g}, want {w}" for g, w in unlike[:show]]
    return problems
