"""Statistical outlier detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerolens.operators.statistics import exact_quantiles, imputed_moments, with_scalar
from aerolens.schema import MONITOR_FEATURES


def zscore_outliers(
    df: DataFrame,
    features: list[str] = MONITOR_FEATURES,
    limit: float = 3.0,
    moments: DataFrame | None = None,
) -> DataFrame:
    """Flag rows with any feature more than ``limit`` sample deviations from its mean.

    Missing values count as the median. A feature without spread flags nothing.
    ``moments`` takes the result of ``imputed_moments`` when it is already at hand.
    """
    moments = imputed_moments(df, features) if moments is None else moments
    beyond = " or ".join(
        f"coalesce(abs(try_divide(coalesce({c}, _s.{c}.median) - _s.{c}.mean, _s.{c}.std)) > {limit}D, false)"
        for c in features
    )
    return with_scalar(df, moments, "_s").withColumn("is_statistical_outlier", F.expr(beyond)).drop("_s")


def zsum_outliers(df: DataFrame, features: tuple[str, ...] = ("pm25", "co2_ppm"), limit: float = 5.0) -> DataFrame:
    """Score a batch by the sum of absolute z-scores and flag scores over ``limit``."""
    moments = df.agg(
        *[F.expr(f"named_struct('mean', avg({c}), 'std', stddev_samp({c})) as {c}") for c in features]
    )
    score = " + ".join(f"abs(({c} - _s.{c}.mean) / (_s.{c}.std + 1e-6D))" for c in features)
    return (
        with_scalar(df, moments, "_s")
        .withColumn("anomaly_score", F.expr(score))
        .withColumn("is_anomaly", F.expr(f"coalesce(anomaly_score > {limit}D, false)"))
        .drop("_s")
    )


def percentile_outliers(df: DataFrame, score: str = "anomaly_score", probability: float = 0.98) -> DataFrame:
    """Flag the rows strictly above the exact percentile of a score."""
    limit = exact_quantiles(df, [score], probability).scalar()
    return df.withColumn("is_anomaly", F.coalesce(F.col(score) > limit, F.lit(False)))
