"""Exact quantiles and imputed moments against numpy."""

import numpy as np
import pandas as pd
import pytest

from aerolens.operators.statistics import exact_quantiles, impute_median, imputed_moments, settled


def frames(spark, pdf):
    return spark.createDataFrame(pdf).selectExpr(*[f"if(isnan({c}), null, {c}) as {c}" for c in pdf.columns])


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({
        "smooth": rng.normal(size=40_000),
        "steps": rng.integers(0, 50, 40_000).astype(float),
        # A third of the rows share one value, and a few lie far out.
        "hot": np.where(rng.random(40_000) < 0.34, 7.0, rng.lognormal(2, 2, 40_000)),
        "gaps": np.where(rng.random(40_000) < 0.5, np.nan, rng.random(40_000)),
        "same": np.full(40_000, 3.0),
    })
    return pdf


@pytest.mark.parametrize("probability", [0.0, 0.02, 0.5, 0.98, 1.0])
def test_quantiles(spark, values, probability):
    # A low accuracy makes the brackets narrow compared with the number of rows.
    got = exact_quantiles(frames(spark, values), list(values.columns), probability, accuracy=500).first()
    for name in values.columns:
        assert got[name] == pytest.approx(np.nanquantile(values[name], probability), abs=1e-12), name


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 50])
def test_few_rows(spark, values, rows):
    part = values.head(rows)
    got = exact_quantiles(frames(spark, part), ["smooth", "gaps"], 0.3).first()
    assert got["smooth"] == pytest.approx(np.quantile(part["smooth"], 0.3))
    known = part["gaps"].dropna()
    assert got["gaps"] == (pytest.approx(np.quantile(known, 0.3)) if len(known) else None)


def test_moments_equal_those_of_the_filled_column(spark, values):
    got = imputed_moments(frames(spark, values), list(values.columns)).first()
    filled = values.fillna(values.median())
    for name in values.columns:
        assert got[name]["median"] == pytest.approx(values[name].median())
        assert got[name]["mean"] == pytest.approx(filled[name].mean())
        assert got[name]["std"] == pytest.approx(filled[name].std(), abs=1e-12)


def test_settled_keeps_values(spark, values):
    row = imputed_moments(frames(spark, values.head(100)), ["smooth", "gaps"])
    assert settled(row).first() == row.first()
    assert settled(row).schema.simpleString() == row.schema.simpleString()


def test_impute(spark, values):
    part = values.head(101)
    got = impute_median(frames(spark, part), ["gaps"]).toPandas()["gaps"]
    assert sorted(got) == pytest.approx(sorted(part["gaps"].fillna(part["gaps"].median())))


def test_all_missing(spark):
    df = spark.sql("select cast(null as double) as a, 1D as b")
    assert exact_quantiles(df, ["a", "b"]).first()["a"] is None
    row = imputed_moments(df, ["a", "b"]).first()
    assert row["a"]["std"] is None and row["b"]["mean"] == 1.0


def test_few_rows_take_one_pass(small):
    from aerolens.operators.statistics import exact_quantiles

    columns = ["pm25", "co2_ppm", "temperature_c"]
    for probability in (0.5, 0.98):
        given = [exact_quantiles(small.readings, columns, probability, rows=rows).first() for rows in (None, 1000, 10**9)]
        for row in given[1:]:
            assert all(abs(row[c] - given[0][c]) < 1e-9 for c in columns)


def test_first_bracket_alone_gives_the_same(spark, values):
    frame, names = frames(spark, values), list(values.columns)
    for probability in (0.02, 0.5, 0.98):
        wide, short = (exact_quantiles(frame, names, probability, accuracy=500, narrow=n) for n in (True, False))
        assert wide.first() == short.first()
    assert imputed_moments(frame, names).first() == imputed_moments(frame, names, narrow=False).first()


def test_monitor_makes_no_pass_for_a_narrower_bracket(spark, small, tmp_path, monkeypatch):
    from aerolens.operators import statistics
    from aerolens.plans.monitor import run_cycle
    from aerolens.plans.store import Store
    from aerolens.sources.tables import write_partitioned

    store = Store(spark, str(tmp_path), "day")
    write_partitioned(small.readings, store.path("readings"))
    monkeypatch.setattr(statistics, "_narrowed", None)
    report = run_cycle(spark, store, cycle=1, outlier_window=7 * 1440, ml_window=7 * 1440, trees=5)
    assert not report.errors and report.predictions > 0
