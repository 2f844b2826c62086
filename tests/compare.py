"""python tests/compare.py [NAME...]: each query at sf0.01 (or $SF) against its SQL in DuckDB, as sorted rows."""

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        v = v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return str([cell(x) for x in v])
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def main(names):
    import duckdb

    import __spark_entry__ as entry
    from chatloom.session import local_session

    directory = os.environ.get("SF", "/root/testdata/sf0.01")
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for path in Path(directory).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*' if path.is_dir() else ''}'")
    sql, bad = entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = query(spark, directory)
            got = rows_of(df.columns, df.collect())
            if name not in sql:
                print(f"{name}: {len(got)} rows, no SQL, {time.time() - began:.1f} s", flush=True)
                continue
            result = db.execute(sql[name])
            columns = [d[0] for d in result.description]
            want = rows_of(columns, result.fetchall())
            same = got == want and sorted(columns) == sorted(df.columns)
            print(f"{name}: {'same' if same else 'DIFFERENT'} {len(got)} {len(want)} rows, {time.time() - began:.1f} s", flush=True)
            if not same:
                bad.append(name)
                print("  columns", sorted(df.columns), sorted(columns))
                a, b = set(got), set(want)
                print("  only Spark", list(a - b)[:3], "\n  only SQL", list(b - a)[:3])
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"{name}: ERROR {str(e)[:900]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
