"""Run queries against their SQL: python tests/compare.py <sf dir> [query ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))


def oracle(folder: str):
    import duckdb
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of_sql(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(r[i] for i in order) for r in rows],
                                             key=lambda r: tuple((v is None, str(type(v)), v) if not isinstance(v, float)
                                                                 else (False, "n", round(v, 6)) for v in r))


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12)
    return a == b and type(a) is type(b)


def difference(spark_df, con, sql: str) -> str | None:
    names_b, rows_b = normal(*rows_of_sql(con, sql))
    names_a, rows_a = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if names_a != names_b:
        return f"columns {names_a} <> {names_b}"
    if len(rows_a) != len(rows_b):
        return f"rows {len(rows_a)} <> {len(rows_b)}; first {rows_a[:2]} <> {rows_b[:2]}"
    bad = [(a, b) for a, b in zip(rows_a, rows_b) if not all(same(x, y) for x, y in zip(a, b))]
    return f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None


def main() -> None:
    from pyspark.sql import SparkSession
    import __spark_entry__ as e
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
             .config("spark.log.level", "ERROR").getOrCreate())
    con, sqls = oracle(folder), e.oracle_sql()
    for name, build in e.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in sqls:
                problem = difference(df, con, sqls[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        rows = "" if problem else "ok" if name in sqls else "ok (no SQL)"
        print(f"{name:28s} {time.time() - start:6.1f}s {rows}{problem or ''}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
