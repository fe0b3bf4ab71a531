"""Calendar and cyclic features of a timestamp (Monday = 0)."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

CALENDAR_COLUMNS = ("hour", "dow", "is_weekend", "month", "hour_sin", "hour_cos")


def cyclic(hour: Column) -> dict[str, Column]:
    angle = F.lit(2 * math.pi) * hour / F.lit(24.0)
    return {"hour_sin": F.sin(angle), "hour_cos": F.cos(angle)}


def calendar_columns(ts: Column, with_month: bool = True) -> dict[str, Column]:
    """hour, dow, is_weekend, month, hour_sin, hour_cos as named expressions."""
    hour, dow = F.hour(ts), F.weekday(ts)
    columns = {"hour": hour, "dow": dow, "is_weekend": dow.isin(5, 6).cast("int")}
    if with_month:
        columns["month"] = F.month(ts)
    return {**columns, **cyclic(hour)}


def calendar_of(ts: datetime) -> dict[str, float]:
    """The same features of one driver-side timestamp, for forecasts at a fixed future time."""
    angle = 2 * math.pi * ts.hour / 24
    return {
        "hour": ts.hour,
        "dow": ts.weekday(),
        "is_weekend": int(ts.weekday() >= 5),
        "month": ts.month,
        "hour_sin": math.sin(angle),
        "hour_cos": math.cos(angle),
    }
