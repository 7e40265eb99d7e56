"""Compare registered queries with their SQL checks: python tools/check.py [sf_dir] [name ...]"""

from __future__ import annotations

import importlib
import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool)):
        return float(f"{float(v):.9g}")
    return v


def main() -> int:
    import duckdb

    from lagloom.session import build_session

    entry = importlib.import_module("__spark_entry__")
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions=os.environ.get("CHECK_PARTITIONS", "8"),
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    sql, bad = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            rows = df.collect()
            took = time.time() - t0
            if name not in sql:
                print(f"ROWS  {name:34s} {len(rows):8d} rows {took:6.2f}s")
                continue
            t0 = time.time()
            rel = con.execute(sql[name])
            cols = [c[0] for c in rel.description]
            want = rel.fetchall()
            otook = time.time() - t0
            order = sorted(df.columns)
            if order != sorted(cols):
                raise AssertionError(f"columns {order} vs {sorted(cols)}")
            got_i, want_i = [df.columns.index(c) for c in order], [cols.index(c) for c in order]
            got = sorted((tuple(plain(r[i]) for i in got_i) for r in rows), key=repr)
            exp = sorted((tuple(plain(r[i]) for i in want_i) for r in want), key=repr)
            diff = [(g, e) for g, e in zip(got, exp) if g != e]
            state = "ok   " if len(got) == len(exp) and not diff else "DIFF "
            print(f"{state} {name:34s} {len(got):8d}/{len(exp)} rows {took:6.2f}s sql {otook:6.2f}s", flush=True)
            if state == "DIFF ":
                bad.append(name)
                print("   ", order)
                for g, e in diff[:3]:
                    print("    got", str(g)[:400], "\n    exp", str(e)[:400])
        except Exception as e:  # report and go on
            bad.append(name)
            print(f"FAIL  {name}: {type(e).__name__} {str(e)[:900]}", flush=True)
    print("bad:", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
