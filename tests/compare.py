"""Compare queries with their SQL twins: row counts, column names, values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cliniform.demo.adapter import RAW_TABLES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def cell(v: object) -> str:
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if hasattr(v, "as_tuple"):
        return repr(round(float(v), 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(cell(x) for x in v) + "]"
    return str(v)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    cols = sorted(df.columns)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns: only left {sorted(set(cols) - set(names))}, only right {sorted(set(names) - set(cols))}"
    at = [names.index(c) for c in cols]
    right = sorted(tuple(cell(r[i]) for i in at) for r in cur.fetchall())
    left = sorted(tuple(cell(r[c]) for c in cols) for r in df.collect())
    if left == right:
        return None
    ls, rs = set(left), set(right)
    only_l, only_r = sorted(ls - rs)[:3], sorted(rs - ls)[:3]
    text = f"rows {len(left)} vs {len(right)}; only-left {len(ls - rs)}, only-right {len(rs - ls)}"
    if only_l and only_r:
        key = max(only_r, key=lambda r: max(sum(a == b for a, b in zip(l, r)) for l in only_l))
        near = max(only_l, key=lambda l: sum(a == b for a, b in zip(l, key)))
        text += "; " + ", ".join(f"{c}: {a} | {b}" for c, a, b in zip(cols, near, key) if a != b)[:700]
    else:
        text += f"; {(only_l or only_r)[:1]}"[:500]
    return text


def main() -> None:
    from pyspark.sql import SparkSession

    from cliniform.checks import queries, sql_twins
    folder = f"/root/testdata/{sys.argv[1]}"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = connect(folder), sql_twins(), []
    wanted = sys.argv[2:]
    for name, run in queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        t = time.time()
        try:
            df = run(spark, folder)
            if name in twins:
                diff, n = difference(df, con, twins[name]), "twin"
            else:
                n, diff = f"{df.count()} rows", None
        except Exception as e:  # noqa: BLE001
            diff, n = f"{type(e).__name__} {str(e)[:1200]}", "error"
        print(f"{'ok ' if diff is None else 'BAD'} {name} [{n}] {time.time() - t:.2f}s {diff or ''}", flush=True)
        if diff:
            bad.append(name)
    print(len(bad), "bad:", bad)


if __name__ == "__main__":
    main()
