"""Compare a query with its SQL: rows as multisets, doubles to nine digits."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sf_dir: str, sql: str) -> pd.DataFrame:
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db.sql(sql).df()


def _cell(x: object) -> object:
    if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if hasattr(x, "item"):
        x = x.item()
        if isinstance(x, float) and math.isnan(x):
            return None
    if isinstance(x, (int, float)) and not isinstance(x, bool):
        return float(f"{float(x):.9g}")
    if hasattr(x, "isoformat"):
        return str(x)[:10]
    return x


def rows(df: pd.DataFrame) -> Counter:
    columns = sorted(df.columns)
    return Counter(tuple(_cell(x) for x in r) for r in df[columns].itertuples(index=False, name=None))


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    return "" if a == b else f"{sum(a.values())} and {sum(b.values())} rows; only ours {list((a - b).items())[:3]}, only theirs {list((b - a).items())[:3]}"
