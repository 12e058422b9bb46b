"""Run registered queries beside their SQL counterparts and compare values."""

import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[int, list[str]]:
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    problems = []
    if sorted(columns) != sorted(frame.columns):
        problems.append(f"columns {sorted(frame.columns)} != {sorted(columns)}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows, expected {len(want)}")
    for a, b in zip(got, want):
        if a != b:
            problems.append(f"first difference:\n  got  {a!r:.600}\n  want {b!r:.600}")
            break
    return len(got), problems


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as e
    from gazette_lake.session import build_session

    sf_dir, names = argv[0], argv[1:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), e.oracle_sql(), 0
    for name, query in e.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                n, problems = differences(spark, con, name, query, oracles[name], sf_dir)
            else:
                n, problems = query(spark, sf_dir).count(), []
        except Exception as error:  # noqa: BLE001 - report and go on
            n, problems = -1, [f"{type(error).__name__}: {str(error)[:800]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name:26} {n:8} rows {time.time() - start:6.1f} s", flush=True)
        for problem in problems:
            print("   ", problem, flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
