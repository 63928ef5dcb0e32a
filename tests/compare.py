"""Run registered queries against their SQL counterparts: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    """Rows as a multiset, columns in order of name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def compare(spark, con, sf_dir: str, name: str) -> str:
    """Empty if both engines agree in names, types and values, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    rel = con.sql(entry.oracle_sql()[name])
    types = {c: KINDS.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    if types != dict(df.dtypes):
        wrong = {k: (dict(df.dtypes).get(k), types.get(k)) for k in {*types, *df.columns}}
        return f"types {({k: v for k, v in wrong.items() if v[0] != v[1]})}"
    ours, theirs = bag(df.columns, df.collect()), bag(rel.columns, rel.fetchall())
    if ours != theirs:
        only = lambda a, b: list((a[1] - b[1]).items())[:3]
        return f"{ours[0]} rows {ours[1].total()} / {theirs[1].total()}: {only(ours, theirs)} <> {only(theirs, ours)}"
    return ""


def main() -> int:
    from skyfact import spark_session

    conf = {"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g", "spark.ui.enabled": "false"}
    conf["spark.ui.showConsoleProgress"] = "false"
    spark = spark_session("compare", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sys.argv[1]), 0
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        if name not in entry.oracle_sql():
            print(f"{name:24} rows only: {entry.queries()[name](spark, sys.argv[1]).count()}", flush=True)
            continue
        try:
            fault = compare(spark, con, sys.argv[1], name)
        except Exception as e:  # noqa: BLE001
            fault = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(fault)
        print(f"{name:24} {'ok' if not fault else 'DIFFERS ' + fault} ({time.time() - start:.1f}s)", flush=True)
    print("differing:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
