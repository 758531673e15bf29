"""Compare every registered query with its SQL: python tests/oracle_check.py SF_DIR [name ...]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

import __spark_entry__ as entry
from airwave import session

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda r: tuple(map(repr, r)))


def compare(spark, db, sf_dir: str, name: str):
    """(spark side, sql side), each as sorted columns and rows."""
    df = entry.queries()[name](spark, sf_dir)
    ours = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(entry.oracle_sql()[name])
    theirs = sorted_rows([c[0] for c in cursor.description], cursor.fetchall())
    return ours, theirs, df, cursor.description


def main(sf_dir: str, names: list[str]) -> int:
    spark = session.build("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = connect(sf_dir), 0
    for name in names or sorted(entry.queries()):
        began = time.time()
        try:
            ours, theirs, df, described = compare(spark, db, sf_dir, name)
        except Exception as error:
            bad += 1
            print(f"FAIL {name}: {str(error)[:600]}", flush=True)
            continue
        same = ours == theirs
        bad += not same
        print(f"{'ok  ' if same else 'DIFF'} {name} {len(ours[1])} {len(theirs[1])} "
              f"{time.time() - began:.1f}s", flush=True)
        if not same:
            print("  columns", ours[0], theirs[0])
            only_ours = [r for r in ours[1] if r not in set(theirs[1])][:3]
            only_theirs = [r for r in theirs[1] if r not in set(ours[1])][:3]
            print("  spark:", only_ours, "\n  sql:  ", only_theirs)
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        kinds = {c[0]: str(c[1]).lower() for c in described}
        match = {"string": "varchar", "bigint": "bigint", "int": "integer", "double": "double",
                 "boolean": "boolean"}
        odd = {n: (t, kinds.get(n)) for n, t in types.items() if match.get(t) != kinds.get(n)}
        if odd:
            print("  types", odd)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
