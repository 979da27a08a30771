"""Compare registered queries with their SQL: python tests/check.py [folder] [name ...]."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, cells as comparable text, rows sorted."""
    out = {}
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_bool_dtype(column):
            out[name] = column.map(lambda v: str(bool(v)))
        elif pd.api.types.is_datetime64_any_dtype(column):
            out[name] = column.map(lambda v: "null" if pd.isna(v) else pd.Timestamp(v).isoformat())
        elif pd.api.types.is_numeric_dtype(column):
            out[name] = column.map(lambda v: "null" if pd.isna(v) else f"{float(v) + 0.0:.9g}")
        else:
            out[name] = column.map(_cell)
    plain = pd.DataFrame(out)
    return plain.sort_values(list(plain.columns)).reset_index(drop=True)


def _cell(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, (bool, str)):
        return str(value)
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, (int, float)):
        return f"{float(value) + 0.0:.9g}"
    return str(value)


def mismatch(found: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    """First difference between two results, regardless of row and column order."""
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} != {sorted(wanted.columns)}"
    if len(found) != len(wanted):
        return f"rows {len(found)} != {len(wanted)}"
    a, b = _plain(found), _plain(wanted)
    if a.equals(b):
        return None
    differing = (a != b).any(axis=1)
    first = differing.idxmax()
    return f"{int(differing.sum())} rows differ, first {a.loc[first].to_dict()} != {b.loc[first].to_dict()}"


def _family(kind: str) -> str:
    kind = kind.lower()
    for family, names in {
        "whole": ("tinyint", "smallint", "int", "integer", "bigint"),
        "real": ("float", "double"),
        "text": ("string", "varchar"),
        "flag": ("boolean",),
        "date": ("date",),
        "time": ("timestamp", "timestamp_ntz"),
    }.items():
        if kind in names:
            return family
    return kind


def type_mismatch(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """Columns whose kind of type differs between the engines."""
    described = con.execute(f"describe {sql}").fetchall()
    wanted = {row[0]: _family(row[1]) for row in described}
    found = {f.name: _family(f.dataType.simpleString()) for f in frame.schema.fields}
    odd = {c: (found[c], wanted[c]) for c in found if c in wanted and found[c] != wanted[c]}
    return f"types {odd}" if odd else None


def main() -> int:
    import __spark_entry__ as registered
    from airloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session("check", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), registered.oracle_sql(), 0
    for name, fn in registered.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = fn(spark, folder)
            found = frame.toPandas()
            spent = time.time() - start
            if name not in sql:
                print(f"rows  {name}: {len(found)} {spent:.1f}s", flush=True)
                if not len(found):
                    bad += 1
                continue
            start = time.time()
            problem = mismatch(found, con.execute(sql[name]).df())
            problem = problem or type_mismatch(frame, con, sql[name])
            took = f"{spent:.1f}s, sql {time.time() - start:.1f}s"
            print(f"{'FAIL' if problem else 'ok'}  {name}: {len(found)} {took} {problem or ''}", flush=True)
            bad += problem is not None
        except Exception as error:
            bad += 1
            print(f"ERROR {name}: {type(error).__name__} {str(error)[:1500]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
