"""Fixed daily slots: the grid, and the rule that sends each observation to the slot it can serve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.functions.timestamps import add_minutes

# fixed values: the slots, lead and tolerance of the original jobs
DEFAULT_SLOTS = ("09:00", "13:00", "16:00", "20:00")
DEFAULT_LEAD_MINUTES = 10
DEFAULT_TOLERANCE_MINUTES = 5
DEFAULT_ZONE = "America/Argentina/Buenos_Aires"
GENERATED_FROM = "preprocess/slots_v1"


def minute_of_day(label: str) -> int:
    hours, minutes = label.split(":")
    return int(hours) * 60 + int(minutes)


def smallest_gap_minutes(slots: Sequence[str]) -> int:
    """The shortest distance between neighbouring slots, over midnight too."""
    marks = sorted({minute_of_day(s) for s in slots})
    return min(b - a for a, b in zip(marks, [*marks[1:], marks[0] + 1440], strict=True))


def next_slot(ts: Column, slots: Sequence[str], lead_minutes: int = 0) -> Column:
    """The first slot whose cut (slot minus lead) is at or after the time, as a timestamp."""
    shifted = add_minutes(ts, lead_minutes) if lead_minutes else ts
    day = F.to_date(shifted)
    marks = sorted({minute_of_day(s) for s in slots})
    chosen = add_minutes(day.cast("timestamp_ntz"), marks[0] + 1440)
    for mark in reversed(marks):
        at = add_minutes(day.cast("timestamp_ntz"), mark)
        chosen = F.when(shifted <= at, at).otherwise(chosen)
    return chosen


def slot_order(label: Column, slots: Sequence[str] = DEFAULT_SLOTS) -> Column:
    """Position among the preferred slots; any other label comes after them."""
    position = F.array_position(F.array(*[F.lit(s) for s in slots]), label)
    return F.when(position > 0, position).otherwise(F.lit(len(slots) + 1)).cast("int")


def slot_grid(obs: DataFrame, key: str, ts: str, slots: Sequence[str] = DEFAULT_SLOTS) -> DataFrame:
    """Every station on every day between the first and last observation of all stations, at every slot inside that range.

    Built by row-local explodes from the distinct stations; the range is two values.
    """
    low, high = obs.agg(F.min(ts).alias("low"), F.max(ts).alias("high")).first()
    stations = obs.where(F.col(key).isNotNull()).select(key).distinct()
    if low is None:
        return stations.select(key, F.lit(None).cast("timestamp_ntz").alias("t_slot"), F.lit("").alias("slot_label")).limit(0)
    bounds = [F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz") for v in (low, high)]
    days = F.sequence(F.to_date(bounds[0]), F.to_date(bounds[1]))
    labels = F.array(*[F.struct(F.lit(s).alias("slot_label"), F.lit(minute_of_day(s)).alias("minute")) for s in slots])
    grid = stations.withColumn("day", F.explode(days)).select(key, "day", F.inline(labels))
    t_slot = add_minutes(F.col("day").cast("timestamp_ntz"), F.col("minute"))
    return grid.select(key, t_slot.alias("t_slot"), "slot_label").where(F.col("t_slot").between(*bounds))
