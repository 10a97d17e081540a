"""Compare registered queries with their SQL twins.

``python -m tests.oracle SF_DIR [name …]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("boxlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(con, df, sql: str) -> tuple[list[str], int, int, list]:
    """Problems found, both row counts and a few differing rows."""
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    right = rows_of(names, found.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} / {sorted(names)}")
    types = {c[0]: str(c[1]) for c in found.description}
    spark_types = dict(df.dtypes)
    pairs = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    for name in sorted(set(names) & set(df.columns)):
        if pairs.get(types[name]) != spark_types[name]:
            problems.append(f"type {name}: {spark_types[name]} / {types[name]}")
    diff = [("spark", r, n) for r, n in (left - right).items()] + [("twin", r, n) for r, n in (right - left).items()]
    if diff:
        problems.append(f"{len(diff)} differing rows")
    diff.sort(key=lambda x: tuple(str(c) for c in x[1]))
    return problems, sum(left.values()), sum(right.values()), diff[:6]


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con, twins = session(), duck(sys.argv[1]), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if (wanted and name not in wanted) or name not in twins:
            continue
        start = time.time()
        try:
            problems, n, m, diff = compare(con, query(spark, sf_dir), twins[name])
        except Exception as e:  # noqa: BLE001
            text = "".join(traceback.format_exception_only(e))
            problems, n, m, diff = [text[:1500]], -1, -1, []
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {n}/{m} {time.time() - start:.1f}s", *problems, sep=" | ", flush=True)
        for d in diff:
            print("    ", d)
    print("bad:", bad)


if __name__ == "__main__":
    main()
