"""Run registered queries against their SQL: ``python tests/check.py [sf folder] [name part …]``."""

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def database(folder):
    db = duckdb.connect()
    for t in TABLES.split():
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return db


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return str(value) if type(value).__name__ in ("Decimal", "datetime", "Timestamp") else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(db, spark, folder, make, sql):
    """None when equal, else a short account of the difference."""
    df = make(spark, folder)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    wanted = rows_of(columns, result.fetchall())
    if got == wanted:
        return None
    extra, lacking = sorted(set(got) - set(wanted), key=repr), sorted(set(wanted) - set(got), key=repr)
    return f"{len(got)} rows against {len(wanted)}; only here {extra[:2]}; only there {lacking[:2]}"


def main():
    from conftest import ROOT  # noqa: F401  (puts the package on the path)
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    db, sql, bad = database(folder), entry.oracle_sql(), 0
    for name, make in entry.queries().items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            problem = compare(db, spark, folder, make, sql.get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "" if name in sql else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name}{kind} {time.time() - start:.1f}s {problem or ''}"[:900], flush=True)
    print(f"{bad} failed")
    spark.stop()


if __name__ == "__main__":
    main()
