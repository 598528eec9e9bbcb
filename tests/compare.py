"""Run catalog queries and their SQL twins side by side: python tests/compare.py [folder] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order, values comparable across engines."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_bool_dtype(column) or pd.api.types.is_datetime64_any_dtype(column):
            frame[name] = column.astype(str)
        elif pd.api.types.is_numeric_dtype(column):
            frame[name] = column.astype(float)
        else:
            frame[name] = column.where(column.notna(), None).map(lambda v: None if v is None else str(v))
    return frame.sort_values(list(frame.columns), kind="stable", na_position="last").reset_index(drop=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """None if equal, else what differs."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    a, b = normalised(ours), normalised(theirs)
    for name in a.columns:
        equal = (a[name] == b[name]) | (a[name].isna() & b[name].isna())
        if not equal.all():
            return f"{name}: {(~equal).sum()} of {len(a)}, e.g. {a[~equal].head(2).to_dict('records')} / {b[~equal].head(2).to_dict('records')}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from trisect.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con, sql = local_session(8), oracle_connection(folder), entry.oracle_sql()
    bad = 0
    for name, make in entry.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.monotonic()
        try:
            ours = make(spark, folder).toPandas()
            problem = differences(ours, con.sql(sql[name]).df()) if name in sql else None
        except Exception as error:
            ours, problem = pd.DataFrame(), f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        state = f"DIFFERENT {problem}" if problem else ("equal" if name in sql else "rows only")
        print(f"## {name:34s} {len(ours):7d} rows {time.monotonic() - started:6.2f} s  {state}", flush=True)
    print(f"## {bad} different")
    sys.exit(bad > 0)
