"""Compare a catalogued query with its SQL statement in DuckDB."""

import math
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        number = float(value)
        return None if math.isnan(number) else number + 0.0
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (sorted(columns),
            sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr))


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def differences(df, con, sql, limit=3):
    columns, got = spark_rows(df)
    expected_columns, expected = duck_rows(con, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if got == expected:
        return ""
    a, b = set(got), set(expected)
    return (f"{len(got)} rows, expected {len(expected)}; only Spark: "
            f"{sorted(a - b, key=repr)[:limit]}; only SQL: {sorted(b - a, key=repr)[:limit]}")


if __name__ == "__main__":
    import pathlib
    import time
    sys.path.insert(0, str(pathlib.Path(__file__).parents[1]))
    import __spark_entry__ as entry
    from zonepulse.session import build_session
    sf, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = run(spark, sf)
            sql = entry.oracle_sql().get(name)
            note = differences(df, con, sql) if sql else f"no SQL, {df.count()} rows"
        except Exception as error:
            note = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:26s} {time.time() - began:6.2f}s  {note or 'ok'}", flush=True)
