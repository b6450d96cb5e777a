"""Compare a query with its SQL: python tests/oracle.py FOLDER [NAME...]."""

import datetime
import decimal
import math
import re
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    if isinstance(value, decimal.Decimal):
        return f"{value:.9f}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(x) for x in value]
    return value


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(folder).glob("*.parquet"):
        source = f"{path}/*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{source}')")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


def compare(spark, con, folder, query, sql):
    df = query(spark, folder)
    ours = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cursor.description), (df.columns, cursor.description)
    return ours, theirs


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tessera.session import build_session

    spark = build_session(master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con, folder = connect(sys.argv[1]), sys.argv[1]
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if sys.argv[2:] and not any(re.fullmatch(x, name) for x in sys.argv[2:]):
            continue
        began = time.time()
        try:
            if name not in oracles:
                print(f"{name}: {query(spark, folder).count()} rows, no SQL, {time.time() - began:.1f} s", flush=True)
                continue
            ours, theirs = compare(spark, con, folder, query, oracles[name])
            took = time.time() - began
            if ours == theirs:
                print(f"{name}: equal, {len(ours)} rows, {took:.1f} s", flush=True)
            else:
                a, b = set(ours), set(theirs)
                print(f"{name}: DIFFERENT, {len(ours)} and {len(theirs)} rows; only ours {sorted(a - b)[:3]}; only SQL {sorted(b - a)[:3]}", flush=True)
        except Exception as e:
            print(f"{name}: ERROR {str(e)[:900]}", flush=True)
