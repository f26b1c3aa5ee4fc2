"""Compares every query with its SQL on a folder: python tests/oracle_check.py [FOLDER] [NAME...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def compare(df, sql, folder):
    """None if the rows agree, else what differs."""
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(folder):
        path = f"{folder}/{f}"
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    found = con.execute(sql)
    names = [x[0] for x in found.description]
    want = found.fetchall()
    order = sorted(range(len(names)), key=lambda k: names[k])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    key = lambda v: (v is not None, -0.0 + 0.0 if v == 0 else v)
    got = sorted(tuple(key(r[c]) for c in sorted(names)) for r in df.collect())
    want = sorted(tuple(key(r[k]) for k in order) for r in want)
    if got == want:
        return None
    return f"{len(got)} and {len(want)} rows, first {next((x for x in zip(got, want) if x[0] != x[1]), '')}"[:400]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    sql = E.oracle_sql()
    for name, q in E.queries().items():
        if sys.argv[2:] and not any(name.startswith(x) for x in sys.argv[2:]):
            continue
        t = time.time()
        try:
            df = q(s, folder)
            said = compare(df, sql[name], folder) if name in sql else f"no SQL, {len(df.collect())} rows"
        except Exception as e:
            said = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name}: {said or 'same'} ({time.time() - t:.1f} s)", flush=True)
