"""Run registered queries and their SQL side by side: python tests/oracle_check.py FOLDER [NAME...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _key(row):
    return tuple(
        (value is None, f"{value:.6g}" if isinstance(value, float) else str(value)) for value in row
    )


def differences(spark_rows, sql_rows, columns, exact=False) -> list[str]:
    """First differing cells; floats agree within 1e-9 relative unless `exact`."""
    if len(spark_rows) != len(sql_rows):
        return [f"row count {len(spark_rows)} != {len(sql_rows)}"]
    found = []
    for a, b in zip(sorted(spark_rows, key=_key), sorted(sql_rows, key=_key)):
        for name, x, y in zip(columns, a, b):
            same = x == y
            if not same and not exact and isinstance(x, float) and isinstance(y, float):
                same = math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12)
            if not same:
                found.append(f"{name}: {x!r} != {y!r} in {a}")
                if len(found) == 3:
                    return found
    return found


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(folder):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{folder}/{file}'")
    return con


def compare(spark, con, folder: str, name: str, query, sql: str):
    """(differences, exact match, seconds in Spark, rows, type pairs)."""
    start = time.time()
    df = query(spark, folder)
    columns = sorted(df.columns)
    rows = [tuple(row[c] for c in columns) for row in df.collect()]
    spent = time.time() - start
    relation = con.sql(sql)
    theirs = list(relation.columns)
    if sorted(theirs) != columns:
        return [f"columns {columns} != {sorted(theirs)}"], False, spent, len(rows), []
    types = dict(zip(theirs, [str(t) for t in relation.types]))
    pairs = {(df.schema[c].dataType.simpleString(), types[c]) for c in columns}
    cells = [tuple(row[theirs.index(c)] for c in columns) for row in relation.fetchall()]
    return (
        differences(rows, cells, columns),
        not differences(rows, cells, columns, exact=True),
        spent,
        len(rows),
        sorted(pairs),
    )


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get("CHECK_CPUS", "8")}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    seen = set()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        try:
            diff, exact, spent, rows, pairs = compare(spark, con, folder, name, query, sql[name])
        except Exception as error:  # noqa: BLE001
            print(f"{name:24} ERROR {str(error)[:1500]}", flush=True)
            continue
        state = "exact" if exact else "close" if not diff else "DIFF"
        print(f"{name:24} {state:6} rows={rows:<7} {spent:6.2f}s {diff[:2] if diff else ''}", flush=True)
        seen |= set(pairs)
    print(sorted(seen))
