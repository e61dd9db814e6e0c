"""Compare registered queries with their SQL on the driver tables. Run as a script: ``python tests/oracle.py [sf] [names]``."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in r) for r in rows), key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r))


_KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "smallint": "SMALLINT", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]"}


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> tuple[str, int]:
    """('' when equal, else what differs; row count)."""
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    got = _sorted(df.select(*[f"`{c}`" for c in names]).collect())
    if sql is None:
        return ("" if got else "no rows", len(got))
    cur = con.execute(sql)
    found = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    if sorted(found) != names:
        return f"columns {names} vs {sorted(found)}", len(got)
    for c, kind in df.dtypes:
        if _KINDS.get(kind, kind.upper()) != types[c]:
            return f"type of {c}: {kind} vs {types[c]}", len(got)
    at = [found.index(c) for c in names]
    want = _sorted([tuple(r[i] for i in at) for r in cur.fetchall()])
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}", len(got)
    for g, w in zip(got, want):
        if g != w:
            return f"{g} vs {w}", len(got)
    return "", len(got)


def main(argv):
    from flowmart.session import build_session
    from flowmart.showcase import ORACLE, QUERIES

    sf = argv[0] if argv else "0.01"
    names = argv[1:] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names:
        t = time.time()
        try:
            said, n = compare(spark, con, sf_dir, name, QUERIES[name], ORACLE.get(name))
        except Exception as e:
            said, n = f"{type(e).__name__}: {str(e)[:700]}", 0
        bad += bool(said)
        print(f"{'FAIL' if said else 'ok  '} {name:28s} rows={n:<8d} {time.time() - t:6.2f}s {'' if name in ORACLE else '(rows only)'} {said[:900]}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
