"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import numpy as np
import pandas as pd


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, (float, np.floating)):
        return None if math.isnan(value) else repr(float(value))
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, (int, np.integer)):
        return repr(float(value)) if abs(int(value)) < 2**53 else int(value)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, (pd.Timestamp, dt.datetime, np.datetime64)):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, dt.date):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    lists = [[plain(v) for v in frame[c].tolist()] for c in columns]
    return sorted(zip(*lists), key=repr)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    left, right = rows_of(got), rows_of(want)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"row {a!r:.600} != {b!r:.600}"
    return ""
