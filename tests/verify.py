"""Run named queries and their SQL side by side: ``python tests/verify.py <sf> [names]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6f}"
    if hasattr(value, "is_integer") or type(value).__name__ == "Decimal":
        return f"{float(value):.6f}"
    return str(value)


def table_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def column_kinds(columns, rows):
    """Python types seen per column, nulls aside."""
    return {
        name: sorted({type(r[i]).__name__ for r in rows if r[i] is not None})
        for i, name in enumerate(columns)
    }


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> tuple[bool, str]:
    began = time.time()
    frame = query(spark, sf_dir)
    spark_rows = [tuple(r) for r in frame.collect()]
    found = table_rows(frame.columns, spark_rows)
    took = time.time() - began
    if sql is None:
        return True, f"{took:.1f}s rows={len(found[1])} (no SQL)"
    result = con.execute(sql)
    names, sql_rows = [d[0] for d in result.description], result.fetchall()
    wanted = table_rows(names, sql_rows)
    detail = f"{took:.1f}s spark={len(found[1])} sql={len(wanted[1])} sql_time={time.time() - began - took:.1f}s"
    kinds = column_kinds(frame.columns, spark_rows), column_kinds(names, sql_rows)
    if found == wanted and kinds[0] != kinds[1]:
        return False, f"{detail} kinds {[(a, b) for a, b in zip(*map(sorted, map(dict.items, kinds))) if a != b]}"
    if found == wanted:
        return True, detail
    if found[0] != wanted[0]:
        return False, f"{detail} columns {found[0]} != {wanted[0]}"
    extra = [r for r in found[1] if r not in set(wanted[1])][:2]
    missing = [r for r in wanted[1] if r not in set(found[1])][:2]
    return False, f"{detail}\n   only spark {str(extra)[:600]}\n   only sql   {str(missing)[:600]}"


def main() -> None:
    from postgauge.registry.oracles import ORACLES
    from postgauge.registry.queries import QUERIES
    from postgauge.session import build_session

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    bad = []
    for name in names:
        try:
            good, detail = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES.get(name))
        except Exception as failure:  # noqa: BLE001 - report and go on
            good, detail = False, f"{type(failure).__name__}: {str(failure)[:500]}"
        print("ok  " if good else "FAIL", name, detail, flush=True)
        if not good:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()
