"""Derived columns and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerolens.functions import features, ladders, text


def with_aqi_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("aqi_bucket", F.expr(ladders.aqi_bucket()))


def with_reading_status(df: DataFrame, steps=ladders.STATUS_4, name: str = "status") -> DataFrame:
    return df.withColumn(name, F.expr(ladders.reading_status(steps)))


def with_derived_features(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in features.DERIVED.items()})


def metric_display(metrics: DataFrame) -> DataFrame:
    """Metric rows as shown on cards: title, value with unit, time text."""
    value = "cast(cast(round(try_cast(metric_value as decimal(38,6)), 2) as decimal(20,2)) as string)"
    return metrics.selectExpr(
        "metric_id",
        f"{text.title_case('metric_name')} as title",
        f"concat_ws(' ', {value}, metric_unit) as value_text",
        f"{text.timestamp_text('recorded_at')} as time_text",
    )


def select_available(df: DataFrame, columns: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in columns if c in df.columns])
