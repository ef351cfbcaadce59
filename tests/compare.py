"""Run registered queries beside their SQL and compare the rows.

``python -m tests.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    return repr(float(value)) if isinstance(value, int) else str(value)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, sorted(tuple(_plain(v) for v in row) for row in df.select(*columns).collect())


def duck_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    con.execute(sql)
    names = [d[0] for d in con.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = con.fetchall()
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark: SparkSession, sf_dir: str, query, sql: str) -> str | None:
    """What differs, or None."""
    columns, got = spark_rows(query(spark, sf_dir))
    wanted_columns, wanted = duck_rows(sf_dir, sql)
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}; e.g. {got[:1]} / {wanted[:1]}"
    wrong = [(g, w) for g, w in zip(got, wanted) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, e.g. {wrong[0][0]} != {wrong[0][1]}"
    return None if got else "no rows"


def main() -> None:
    import __spark_entry__ as entry
    from lumenframe.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                                    "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, sf_dir, entry.queries()[name], entry.oracle_sql()[name])
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")


if __name__ == "__main__":
    main()
