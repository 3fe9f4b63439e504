"""Filters and guards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def as_of_column(df: DataFrame, as_of=None, time_column: str = "ts") -> Column:
    """The reference time: given, or the newest time in ``df`` as a scalar subquery."""
    if as_of is None:
        return df.select(F.max(time_column)).scalar()
    if isinstance(as_of, Column):
        return as_of
    # A naive time is UTC, whatever the time zone of this process.
    return F.expr(f"timestamp_micros({(as_of - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)}L)")


def recent(df: DataFrame, minutes: int, as_of=None, time_column: str = "ts") -> DataFrame:
    """Rows of the trailing window; there is no upper bound, so future-stamped rows stay."""
    start = as_of_column(df, as_of, time_column) - F.expr(f"interval {int(minutes)} minutes")
    return df.where(F.col(time_column) >= start)


def quality_gate(df: DataFrame, minimum: float = 0.7, require: tuple[str, ...] = ("pm25", "co2_ppm")) -> DataFrame:
    """Rows good enough to detect on or to score, with the required values known."""
    known = "".join(f" and {column} is not null" for column in require)
    return df.where(f"data_quality_score > {minimum}D{known}")


def training_gate(df: DataFrame, minimum: float = 0.8, require: tuple[str, ...] = ("pm25", "co2_ppm")) -> DataFrame:
    """Rows good enough to train on: a stricter score and a known label."""
    return quality_gate(df, minimum, require).where("aqi_bucket is not null")


def active_stations(stations: DataFrame) -> DataFrame:
    return stations.where("is_active")


def open_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts still open, by their status or by the flag of the older layout; all when neither is there."""
    if "status" in alerts.columns:
        return alerts.where("status = 'Open'")
    return alerts.where("not is_resolved") if "is_resolved" in alerts.columns else alerts


def min_rows_guard(df: DataFrame, minimum: int) -> DataFrame:
    """All rows when there are at least ``minimum``, otherwise none.

    The count stops at the minimum, so the guard does not read the frame a second time in full.
    """
    seen = df.select(F.lit(1)).limit(minimum).agg(F.count(F.lit(1))).scalar()
    return df.where(seen >= minimum)
