"""Compare a registered query with its SQL, row by row and without order."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _norm(value):
    """Floats must agree to the last digit; both sides round."""
    return repr(value) if isinstance(value, float) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when equal, else a short account of the first differences."""
    cur = con.execute(sql)
    names, want = _rows([d[0] for d in cur.description], cur.fetchall())
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return f"columns {got_names} != {names}"
    kinds = {d[0]: str(d[1]) for d in cur.description}
    other = {c: (t, kinds[c]) for c, t in df.dtypes if TYPES.get(t) != kinds[c]}
    if other:
        return f"types {other}"
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{sum(got.values())} vs {sum(want.values())} rows; extra {extra}; missing {missing}"
    return None
