"""Conformance and integrity checks that a database would enforce."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerolens.functions.ladders import place_in
from aerolens.schema import DECIMALS, DEFAULTS, LENGTHS, RANGES, RENAMED


def conform_readings(df: DataFrame) -> DataFrame:
    """Canonical names, declared precision and defaults.

    A value that does not fit its declared precision becomes NULL instead of failing the job; check rows
    with ``checked_readings`` before, which reports such values.
    """
    named = with_defaults(df)
    changes = {
        name: F.expr(f"try_cast({name} as decimal({precision},{scale}))")
        for name, (precision, scale) in DECIMALS.items()
        if name in named.columns
    }
    return named.withColumns(changes)


def with_defaults(df: DataFrame) -> DataFrame:
    """Canonical names, and the declared defaults of columns that are left out."""
    renamed = df.withColumnsRenamed(RENAMED)
    return renamed.withColumns({name: F.lit(value) for name, value in DEFAULTS.items() if name not in renamed.columns})


def checked_readings(df: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Rows with canonical names and defaults, and in ``violations`` all that a database would reject them for.

    Besides the checks of ``validate_readings`` these are values beyond their declared precision, and, with
    ``stations``, a station that is not among them.
    """
    validated = validate_readings(with_defaults(df))
    beyond = [
        f"if({name} is not null and try_cast({name} as decimal({precision},{scale})) is null, '{name}_overflow', null)"
        for name, (precision, scale) in DECIMALS.items()
        if name in validated.columns
    ]
    found = f"concat(violations, array_compact(array({', '.join(beyond)})))" if beyond else "violations"
    checked = validated.withColumn("violations", F.expr(found))
    if stations is None:
        return checked
    known = stations.select(F.col("station_id").alias("_station")).distinct()
    orphan = "station_id is not null and _station is null"
    return checked.join(known, F.col("station_id") == F.col("_station"), "left").withColumn(
        "violations", F.expr(f"if({orphan}, array_append(violations, 'station_id_orphan'), violations)")
    ).drop("_station")


def as_declared(checked: DataFrame) -> DataFrame:
    """Rows without violations, rounded to the declared precision and kept as doubles to compute with."""
    good = good_rows(checked)
    changes = {
        name: F.expr(f"cast(cast({name} as decimal({precision},{scale})) as double)")
        for name, (precision, scale) in DECIMALS.items()
        if name in good.columns
    }
    return good.withColumns(changes)


def violation_codes(columns: list[str], not_null: tuple[str, ...] = ("record_id", "station_id", "ts")) -> str:
    """Array of the checks a row fails. Range and length checks pass on NULL."""
    checks = [f"if({name} is null, '{name}_missing', null)" for name in not_null]
    for name, (lower, upper) in RANGES.items():
        if name in columns:
            beyond = f" or {name} > {upper}" if upper is not None else ""
            checks.append(f"if({name} < {lower}{beyond}, '{name}_range', null)")
    for name, longest in LENGTHS.items():
        if name in columns:
            checks.append(f"if(length({name}) > {longest}, '{name}_length', null)")
    return f"array_compact(array({', '.join(checks)}))"


def validate_readings(df: DataFrame) -> DataFrame:
    """Every row with its failed checks in ``violations``."""
    return df.withColumn("violations", F.expr(violation_codes(df.columns)))


def good_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("violations") == 0).drop("violations")


def quarantine_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("violations") > 0)


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is set but has no parent. AQE sends a small parent to all tasks."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; a key with a NULL part never clashes."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def enum_violations(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows whose value is set but not declared."""
    return df.where(~F.col(column).isin(allowed))


def enum_check(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows per value, with the value's place in the declared order (NULL when undeclared)."""
    counted = df.where(f"{column} is not null").groupBy(column).count()
    return counted.selectExpr(
        f"'{column}' as column", f"{column} as value", f"{place_in(column, allowed)} as rank",
        f"{place_in(column, allowed)} is not null as is_declared", "count as rows",
    )
