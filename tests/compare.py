"""Run registered queries beside their SQL twins and compare all rows.

    python tests/compare.py [--sf sf0.01] [prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def key(row):
    return tuple((x is None, type(x).__name__, str(x)) for x in row)


def compare(spark_df, con, sql):
    """Empty string when both results agree, else what differs."""
    cols = sorted(spark_df.columns)
    left = [tuple(norm(r[c]) for c in cols) for r in spark_df.collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != cols:
        return f"columns {cols} vs {sorted(names)}"
    order = [names.index(c) for c in cols]
    right = [tuple(norm(r[i]) for i in order) for r in rel.fetchall()]
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}; {left[:2]} vs {right[:2]}"
    if not left:
        return "no rows"
    left.sort(key=key)
    right.sort(key=key)
    bad = [(a, b) for a, b in zip(left, right) if [(type(x), x) for x in a] != [(type(x), x) for x in b]]
    return f"{len(bad)} of {len(left)} rows differ, cols {cols}: {str(bad[:2])[:1500]}" if bad else ""


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="sf0.01")
    ap.add_argument("prefix", nargs="*")
    args = ap.parse_args()
    from __spark_entry__ import oracle_sql, queries
    from loomspark.session import local_session

    spark = local_session("compare")
    sf_dir = f"/root/testdata/{args.sf}"
    con = duck(sf_dir)
    sqls = oracle_sql()
    failed = 0
    for name, fn in queries().items():
        if args.prefix and not any(name.startswith(p) for p in args.prefix):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                msg = compare(df, con, sqls[name])
            else:
                n = len(df.collect())
                msg = "" if n else "no rows"
        except Exception as e:  # noqa: BLE001
            msg = f"{type(e).__name__}: {str(e)[:900]}"
        failed += bool(msg)
        print(f"{'FAIL' if msg else 'ok  '} {name:36s} {time.time() - t0:6.2f}s {'' if name in sqls else '(rows only) '}{msg}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
