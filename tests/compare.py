import datetime

import numpy as np
import pandas as pd


def _value(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_value(x) for x in v)
    if v is None or (not isinstance(v, (str, bytes, bool)) and pd.isna(v)):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return float(v)
    if isinstance(v, (float, np.floating)):
        return round(float(v), 6) + 0.0
    if isinstance(v, (datetime.datetime, pd.Timestamp)):
        return str(v)
    return v


def rows(frame: pd.DataFrame) -> list:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(_value(v) for v in r) for r in frame.itertuples(index=False)), key=repr)
