"""Text formatting of measurements and metric names."""

from __future__ import annotations


def fixed_decimals(value: str, digits: int) -> str:
    """Decimal text with ``digits`` places, half rounded up; ``nan`` when missing."""
    # The shortest decimal text of the value is rounded, once. What is beyond the range is shown as missing.
    rounded = f"round(try_cast({value} as decimal(38,18)), {digits})"
    return f"coalesce(cast(cast({rounded} as decimal(20,{digits})) as string), 'nan')"


def title_case(name: str) -> str:
    """``avg_pm25`` -> ``Avg Pm25``."""
    return f"initcap(replace({name}, '_', ' '))"


def timestamp_text(ts: str) -> str:
    return f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss')"
