"""Threshold ladders: labels, statuses and severities as CASE expressions."""

from __future__ import annotations

from aerolens.schema import AQI_LABELS, SEVERITIES


def aqi_bucket(pm25: str = "pm25") -> str:
    """AQI class of a PM2.5 value; upper limits are inclusive, NULL stays NULL."""
    return (
        f"case when {pm25} <= 12 then 'Good' when {pm25} <= 35 then 'Moderate'"
        f" when {pm25} <= 55 then 'Unhealthy' when {pm25} is not null then 'Hazardous' end"
    )


def above(pm25_limit: float, co2_limit: float, pm25: str = "pm25", co2: str = "co2_ppm") -> str:
    """True when either gas is strictly above its limit; a missing value is not above."""
    return f"(coalesce({pm25} > {pm25_limit}, false) or coalesce({co2} > {co2_limit}, false))"


# Fixed values: (label, PM2.5 limit, CO2 limit), strongest first.
STATUS_4 = [("Critical", 100, 850), ("Alert", 55, 700), ("Warning", 35, 600)]
STATUS_3 = [("Alert", 100, 800), ("Warning", 55, 600)]
ANOMALY_SEVERITY = [("Critical", 150, 1000), ("High", 100, 800), ("Moderate", 55, 600)]


def _ladder(steps: list[tuple[str, float, float]], otherwise: str) -> str:
    cases = " ".join(f"when {above(pm25, co2)} then '{label}'" for label, pm25, co2 in steps)
    return f"case {cases} else '{otherwise}' end"


def reading_status(steps=STATUS_4) -> str:
    """Status of a reading on a parameterised ladder, ``Normal`` below all steps."""
    return _ladder(steps, "Normal")


def anomaly_severity() -> str:
    """Severity of an anomaly found by the monitor."""
    return _ladder(ANOMALY_SEVERITY, "Low")


def place_in(value: str, declared: list[str]) -> str:
    """Position in a declared order, from 1; NULL for an undeclared value."""
    names = ", ".join(f"'{name}'" for name in declared)
    return f"nullif(array_position(array({names}), {value}), 0L)"


def severity_rank(severity: str = "severity") -> str:
    return place_in(severity, SEVERITIES)


def label_index(label: str) -> str:
    """Class number of an AQI label, from 0."""
    return f"cast({place_in(label, AQI_LABELS)} - 1 as double)"


def traffic_light(value: str, high: float, mid: float) -> str:
    """Three-level band, strict limits; NULL (no data) gives NULL."""
    return (
        f"case when {value} > {high} then 'red' when {value} > {mid} then 'yellow'"
        f" when {value} is not null then 'green' end"
    )
