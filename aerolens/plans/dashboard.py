"""Dashboard queries over the stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from aerolens.operators import aggregates, joins, series
from aerolens.plans.store import Store


#: Days looked at for the newest alerts, before all are.
ALERT_DAYS = (1, 30)


class Dashboard:
    """What the monitoring page shows. ``as_of`` defaults to the newest reading."""

    def __init__(self, store: Store, as_of: dt.datetime | None = None):
        self.store = store
        self.as_of = as_of or store.latest()

    def readings(self, minutes: int = 180, limit: int = 1000) -> DataFrame:
        """Newest readings, then their station and prediction."""
        return joins.dashboard_readings(
            self.store.readings(minutes, self.as_of), self.store.stations(), self._predictions(minutes), limit
        )

    def readings_full(self, minutes: int = 180, limit: int = 5000) -> DataFrame:
        """Readings with all prediction columns, limited last."""
        return joins.dashboard_readings_full(
            self.store.readings(minutes, self.as_of), self.store.stations(), self._predictions(minutes), limit
        )

    def alerts(self, limit: int = 200) -> DataFrame:
        """Newest alerts with a station. Older days are read only if the newest do not have enough."""
        for days in ALERT_DAYS if self.as_of else ():
            newest = joins.alerts_with_station(
                self.store.alerts(self.as_of - dt.timedelta(days=days)), self.store.stations(), limit
            )
            if newest.count() == limit:
                return newest
        return joins.alerts_with_station(self.store.alerts(), self.store.stations(), limit)

    def metrics(self, limit: int = 100) -> DataFrame:
        return series.recent_metrics(self.store.metrics(), limit)

    def key_figures(self, minutes: int = 180, limit: int = 1000) -> DataFrame:
        """Averages, maximum and counts over what the page has loaded."""
        return aggregates.kpi_summary(self.readings(minutes, limit), self.alerts())

    def severity_counts(self) -> DataFrame:
        return aggregates.severity_counts(self.alerts())

    def zone_series(self, minutes: int = 180, limit: int = 1000) -> DataFrame:
        return series.zone_series(self.readings(minutes, limit))

    def latest_per_station(self, minutes: int = 180, limit: int = 1000) -> DataFrame:
        return series.latest_per_station(self.readings(minutes, limit))

    def lineage(self, minutes: int = 60) -> DataFrame:
        """Readings with everything that hangs on them.

        Predictions and alerts are cut to the window by the time of their reading before they are
        joined, so their older history is never shuffled.
        """
        return joins.reading_lineage(
            self.store.readings(minutes, self.as_of),
            self.store.stations(),
            self.store.sensors(),
            self._predictions(minutes),
            self.store.alerts(self._start(minutes)),
        )

    def _start(self, minutes: int) -> dt.datetime | None:
        return self.as_of - dt.timedelta(minutes=minutes) if self.as_of else None

    def _predictions(self, minutes: int) -> DataFrame:
        return self.store.predictions(self._start(minutes))
