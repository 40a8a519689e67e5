"""Run registered queries in Spark and their twins in DuckDB and compare the rows.

Usage: python tools/check_oracle.py [sf] [name-prefix ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from floegrid.queries import load_all  # noqa: E402
from floegrid.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def normal(frame: pd.DataFrame) -> list[tuple]:
    cols = sorted(frame.columns)
    rows = []
    for rec in frame[cols].itertuples(index=False, name=None):
        out = []
        for v in rec:
            if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
                out.append("∅")
            elif isinstance(v, float):
                out.append(repr(v + 0.0))
            elif hasattr(v, "isoformat"):
                out.append(pd.Timestamp(v).isoformat())
            else:
                out.append(str(v))
        rows.append(tuple(out))
    return sorted(rows)


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    prefixes = tuple(sys.argv[2:])
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session("oracle", master="local[8]",
                        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                           "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name, (fn, sql) in load_all().items():
        if prefixes and not name.startswith(prefixes):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            got = df.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: {str(e)[:1500]}", flush=True)
            bad += 1
            continue
        secs = time.time() - t0
        if sql is None:
            print(f"rows {name}: {len(got)} ({secs:.2f}s)", flush=True)
            continue
        try:
            want = con.execute(sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"SQLFAIL {name}: {str(e)[:800]}", flush=True)
            bad += 1
            continue
        types = {c: str(t) for c, t in got.dtypes.items()}
        wtypes = {c: str(t) for c, t in want.dtypes.items()}
        a, b = (normal(got), normal(want)) if sorted(got.columns) == sorted(want.columns) else ([], [0])
        diff = {c: (types.get(c), wtypes.get(c)) for c in set(types) | set(wtypes)
                if types.get(c) != wtypes.get(c)}
        state = "ok" if a == b else "DIFF"
        bad += a != b
        print(f"{state} {name}: {len(got)} vs {len(want)} ({secs:.2f}s)"
              + (f" dtypes {diff}" if diff else ""), flush=True)
        if a != b:
            sa, sb = set(a), set(b)
            print("   columns", sorted(got.columns), sorted(want.columns))
            print("   spark only", sorted(sa - sb)[:3], "\n   duckdb only", sorted(map(str, sb - sa))[:3])
    print("bad", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
