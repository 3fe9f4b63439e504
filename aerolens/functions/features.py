"""Derived classifier features, by name."""

from __future__ import annotations

# The small constant keeps the ratio finite for a PM2.5 value of zero.
DERIVED = {
    "pm_ratio": "try_divide(pm10, pm25 + 0.001D)",
    "temp_humidity": "temperature_c * humidity",
    "pollution_index": "pm25 + no2_ppm * 100 + o3_ppm * 100",
}
