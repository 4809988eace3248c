"""Side-by-side check of the registered queries: Spark against DuckDB on the same tables.

``python -m workload.compare /root/testdata/sf0.01 [query ...]``
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from gridtide.session import build_session

from . import oracle, registry

_SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> list[str]:
    """What differs for one query: columns, types, row count, values. Empty when all agree."""
    df = registry.queries()[name](spark, sf_dir)
    ours = df.toPandas()
    relation = con.sql(oracle.oracle_sql()[name])
    types = dict(zip(relation.columns, map(str, relation.types)))
    theirs = relation.df()
    if set(ours.columns) != set(theirs.columns):
        return [f"columns differ: {sorted(set(ours.columns) ^ set(theirs.columns))}"]
    found = [f"{c}: {t} / {types[c]}" for c, t in df.dtypes if _SAME_TYPE.get(t) != types[c]]
    if len(ours) != len(theirs):
        return [*found, f"rows: {len(ours)} / {len(theirs)}"]
    columns = sorted(ours.columns)
    a, b = (_text(frame, columns) for frame in (ours, theirs))
    unequal = (a != b).any(axis=1)
    if unequal.any():
        row = unequal.idxmax()
        cells = [f"{c}={a.at[row, c]}/{b.at[row, c]}" for c in columns if a.at[row, c] != b.at[row, c]]
        found.append(f"{int(unequal.sum())} of {len(a)} rows differ, first: {', '.join(cells)}")
    return found


def _text(frame: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame({c: _column_text(frame[c]) for c in columns})
    return out.sort_values(columns).reset_index(drop=True)


def _column_text(column: pd.Series) -> pd.Series:
    if str(column.dtype).startswith("datetime"):
        text = column.dt.strftime("%Y-%m-%d %H:%M:%S.%f").str.replace(" 00:00:00.000000", "")
    elif column.dtype == "float64" and column.dropna().map(float.is_integer).all():
        text = column.map(lambda v: repr(float(v)))
    else:
        text = column.map(lambda v: repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v))
    return text.where(column.notna(), "NULL")


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or list(oracle.oracle_sql()):
        start = time.time()
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = [str(error)[:800]]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok':5s}{name:32s}{time.time() - start:7.2f}s {'; '.join(found)}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
