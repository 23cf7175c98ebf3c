"""Results of a query and of its SQL in one form."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def cell(v):
    if v is None or (pd.api.types.is_scalar(v) and pd.isna(v)):
        return ""
    if hasattr(v, "item") and not isinstance(v, pd.Timestamp):
        v = v.item()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(round(float(v), 5) + 0.0)
    return str(v).replace(" 00:00:00", "")


def normal(frame):
    frame = frame[sorted(frame.columns)]
    rows = [tuple(map(cell, r)) for r in frame.itertuples(index=False, name=None)]
    return list(frame.columns), sorted(rows)
