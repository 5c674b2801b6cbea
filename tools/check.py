"""Compare every query with its SQL on one scale: names, types, row count and values.

Usage: python tools/check.py [--sf sf0.01] [--bench] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import collections
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corvane.plans import load_all  # noqa: E402
from corvane.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(df, con, sql: str) -> list[str]:
    """Problems found; empty when names, types, counts and values agree."""
    rel = con.sql(sql)
    want = dict(zip(rel.columns, map(str, rel.types)))
    have = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if want != have:
        return [f"schema: spark {have} sql {want}"]
    cols = sorted(want)
    mine = collections.Counter(tuple(repr(r[c]) for c in cols) for r in df.collect())
    order = [rel.columns.index(c) for c in cols]
    theirs = collections.Counter(tuple(repr(r[i]) for i in order) for r in rel.fetchall())
    if mine == theirs:
        return [] if mine else ["both sides are empty"]
    only, missing = mine - theirs, theirs - mine
    return [f"rows: spark {sum(mine.values())} sql {sum(theirs.values())}",
            f"cols {cols}", f"only spark ({sum(only.values())}): {str(sorted(only)[:2])[:600]}",
            f"only sql ({sum(missing.values())}): {str(sorted(missing)[:2])[:600]}"]


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="sf0.01")
    parser.add_argument("prefix", nargs="*")
    args = parser.parse_args()
    sf_dir = args.sf if "/" in args.sf else f"/root/testdata/{args.sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, q in load_all().items():
        if args.prefix and not any(name.startswith(p) for p in args.prefix):
            continue
        start = time.time()
        try:
            df = q.run(spark, sf_dir)
            problems = compare(df, con, q.sql) if q.sql else []
            note = "" if q.sql else f"rows only: {df.count()}"
        except Exception as e:  # report and go on to the next query
            problems, note = [f"{type(e).__name__}: {str(e)[:700]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
