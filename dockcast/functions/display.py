"""Availability levels, colours and capacity figures for the map tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: levels, labels and colours that the served tables must carry
LEVEL_HIGH_FROM = 10
LEVEL_MEDIUM_FROM = 3
LEVEL_COLORS = {"high": "#2ECC71", "medium": "#F1C40F", "low": "#E74C3C", "na": "#BDC3C7"}
LIGHT_RGB = {"gris": (160, 160, 160), "rojo": (220, 0, 0), "verde": (0, 180, 0), "amarillo": (240, 200, 0)}
LIGHT_HEX = {"verde": "#2ecc71", "amarillo": "#f1c40f", "rojo": "#e74c3c", "gris": "#95a5a6"}
CAPACITY_COLUMNS = ("capacity", "num_docks_total", "dock_count", "capacidad", "_capacity")


def _lookup(key: Column, table: dict[str, str], default: str) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(default))


def level(yhat: Column) -> Column:
    return (
        F.when(yhat.isNull(), "na")
        .when(yhat >= LEVEL_HIGH_FROM, "high")
        .when(yhat >= LEVEL_MEDIUM_FROM, "medium")
        .otherwise("low")
    )


def level_color(name: Column) -> Column:
    return _lookup(name, LEVEL_COLORS, LEVEL_COLORS["na"])


def light_label(pct: Column, bikes: Column) -> Column:
    """Grey without a percentage, red without bikes, green from half full on, yellow above zero."""
    return (
        F.when(pct.isNull(), "gris")
        .when(bikes <= 0, "rojo")
        .when(pct >= 50, "verde")
        .when(pct > 0, "amarillo")
        .otherwise("rojo")
    )


def light_rgb(label: Column) -> Column:
    rgb = F.lit(None).cast("array<int>")
    for name, triple in LIGHT_RGB.items():
        rgb = F.when(label == name, F.array(*[F.lit(v) for v in triple])).otherwise(rgb)
    return rgb


def light_hex(label: Column) -> Column:
    return _lookup(label, LIGHT_HEX, LIGHT_HEX["gris"])


def capacity_column(columns: list[str]) -> Column:
    """The first capacity column present, as a number, or NULL."""
    for name in CAPACITY_COLUMNS:
        if name in columns:
            return F.col(name).try_cast("double")
    return F.lit(None).cast("double")


def capacity_metrics(yhat: Column, capacity: Column) -> dict[str, Column]:
    """Predicted free docks and both percentages; percentages only for a positive capacity."""
    docks = capacity - yhat
    return {
        "docks_pred": docks,
        "pct_bikes": F.when(capacity > 0, yhat / capacity * 100),
        "pct_docks": F.when(capacity > 0, docks / capacity * 100),
    }
