"""Compare every query with its SQL: ``python -m tests.compare [folder] [query ...]``."""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a query's rows and its SQL's; None if nothing does."""
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(kinds) != sorted(df.columns):
        return f"columns {sorted(set(kinds) ^ set(df.columns))}"
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    odd = {c: (t, kinds[c]) for c, t in types.items() if SAME_TYPE.get(t, t.upper()) != kinds[c]}
    if odd:
        return f"types {odd}"
    path = f"{tempfile.mkdtemp(prefix='compare-')}/rows"
    df.write.parquet(path)
    columns = ", ".join(f'"{c}"' for c in kinds)
    con.execute(f"CREATE OR REPLACE TEMP TABLE want AS SELECT {columns} FROM ({sql})")
    con.execute(f"CREATE OR REPLACE TEMP TABLE got AS SELECT {columns} FROM read_parquet('{path}/*.parquet')")
    extra, missing = (
        con.execute(f"SELECT * FROM {one} EXCEPT ALL SELECT * FROM {other} LIMIT 3").fetchall()
        for one, other in (("got", "want"), ("want", "got"))
    )
    return f"only here {extra}; only there {missing}" if extra or missing else None


def main(folder: str, chosen: list[str]) -> int:
    import __spark_entry__ as e
    from shelfwise.session import builder

    spark = (
        builder("compare")
        .master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = duck(folder), e.oracle_sql()
    names = [n for n in e.queries() if not chosen or n in chosen]
    bad = 0
    for name in names:
        start = time.time()
        found = difference(e.queries()[name](spark, folder), con, sql[name])
        bad += found is not None
        print(f"{name}: {found or 'same'} ({time.time() - start:.1f} s)", flush=True)
    print(f"{len(names)} queries, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
