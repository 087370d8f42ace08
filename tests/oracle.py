"""Compare registered queries with their SQL in DuckDB: columns, types, rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

# The test tables.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """The differences found; an empty list means equal."""
    spark_types = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    expected = con.execute(sql)
    columns = [d[0] for d in expected.description]
    rows = expected.fetchall()
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(spark_types) != sorted(columns):
        return [f"columns {sorted(spark_types)} != {sorted(columns)}"]
    problems += [f"type of {c}: {spark_types[c]} != {duck_types[c]}" for c in columns if spark_types[c] != duck_types[c]]
    got, want = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(columns, rows)
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        only_got, only_want = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        problems.append(f"values in {sorted(columns)}: spark only {only_got}, sql only {only_want}")
    if not want:
        problems.append("no rows to compare")
    return problems


def main(sf: str = "0.01", *names: str) -> int:
    from matchmill.plans.queries import REGISTRY
    from matchmill.session import build_session, clear_scratch

    spark = build_session("oracle", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, failed = connect(sf_dir), 0
    for name, query in REGISTRY.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            problems = compare(query.run(spark, sf_dir), con, query.sql) if query.sql else []
        except Exception as error:  # keep going: the list of all failures is the point
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ")
    clear_scratch(spark)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
