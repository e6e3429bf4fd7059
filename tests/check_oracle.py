"""Compare every query with its SQL: `python tests/check_oracle.py [sf] [query ...]`."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402
from tracemill.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(str(r[i]) for i in order) for r in rows))


SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return len(got), "no SQL"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = canonical(cur.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} against {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in cur.description}
    for column, kind in df.dtypes:
        if SQL_TYPES.get(kind) != kinds[column]:
            return len(got), f"{column} is {kind} against {kinds[column]}"
    if got != want:
        extra = next((g for g in got if g not in set(want)), None)
        lacking = next((w for w in want if w not in set(got)), None)
        return len(got), f"{len(got)} rows against {len(want)}; extra {extra}; lacking {lacking}"
    return len(got), "ok"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or entry.queries():
        began = time.time()
        try:
            rows, verdict = compare(spark, con, sf_dir, name)
        except Exception as exc:
            rows, verdict = -1, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += verdict not in ("ok", "no SQL")
        print(f"{name:24} {rows:8} {time.time() - began:6.2f}s {verdict}", flush=True)
    print("failed:", bad)
