"""Run queries next to their SQL equivalents: ``python -m tests.compare [folder] [query …]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from corpusloom.session import remove_intermediate

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, "nan") if math.isnan(v) else (2, repr(round(v, 6) + 0.0))
    if isinstance(v, int):
        return (3, str(v))
    return (4, str(v))


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def type_notes(df, cur) -> str:
    """Columns whose types differ between the two engines."""
    theirs = {d[0]: str(d[1]) for d in cur.description}
    return ", ".join(
        f"{c} {t}/{theirs[c]}" for c, t in df.dtypes if c in theirs and TYPES.get(t, t) != theirs[c]
    )


def compare(spark, con, name: str, folder: str, build, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    df = build(spark, folder)
    got = rows_of(df.columns, df.collect())
    remove_intermediate(spark)
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    notes = type_notes(df, cur)
    want = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"
    return f"types {notes}" if notes else None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from corpusloom.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    con = connect(folder)
    failed = 0
    builders, oracles = entry.queries(), entry.oracle_sql()
    for name, build in builders.items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, folder, build, oracles[name])
            else:
                n = len(build(spark, folder).collect())
                problem = None if n else "no rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.1f}s {'' if name in oracles else '(rows only)'} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
