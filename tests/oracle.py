"""Compare registered queries with their SQL twins. Run as a script: python tests/oracle.py [sf] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


def connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


KIND = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(spark, con, name, query, sql, sf_dir):
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = sorted(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    if sql is None:
        return None if rows else "no rows"
    result = con.sql(sql)
    if sorted(result.columns) != columns:
        return f"columns {columns} / {sorted(result.columns)}"
    theirs = dict(zip(result.columns, [str(t) for t in result.types]))
    wrong = {c: (types[c], theirs[c]) for c in columns if KIND.get(types[c]) != theirs[c]}
    order = [result.columns.index(c) for c in columns]
    expected = sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    if wrong:
        return f"types {wrong}"
    if not rows:
        return "no rows"
    if rows != expected:
        ours, other = set(rows) - set(expected), set(expected) - set(rows)
        return f"{len(rows)}/{len(expected)} rows; columns {columns}; only Spark {sorted(ours)[:2]}; only SQL {sorted(other)[:2]}"
    return None


def main(argv):
    from tests.conftest import session
    import __spark_entry__ as entry
    sf = argv[0] if argv else "0.01"
    spark, con = session(), connect(f"{DATA}/sf{sf}")
    sql, bad = entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if argv[1:] and not any(name.startswith(a) for a in argv[1:]):
            continue
        begun = time.time()
        try:
            problem = compare(spark, con, name, query, sql.get(name), f"{DATA}/sf{sf}")
        except Exception as err:  # noqa: BLE001
            problem = f"{type(err).__name__} {str(err)[:700]}"
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - begun:.2f}s {problem or ''}", flush=True)
        bad += [name] if problem else []
    print("bad:", bad)
    sys.stdout.flush()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
