"""Scalar expressions on power, battery and price columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from homegrid.functions.clock import UTC, ColumnOrName, as_column, local_wall

# Grid tariff per kWh by season and rate band.
TARIFFS = {
    "summer": {"low": 0.1220, "high": 0.1831, "peak": 0.4760},
    "winter": {"low": 0.1220, "high": 0.3661, "peak": 1.0985},
}
SUMMER_MONTHS = (4, 9)
LOW_HOURS = (0, 5)
PEAK_HOURS = (17, 20)
CHEAP_BELOW = 0.65


def or_zero(col: ColumnOrName) -> Column:
    return F.coalesce(as_column(col), F.lit(0.0))


def finite(col: ColumnOrName) -> Column:
    """NULL in place of NaN and ±infinity."""
    col = as_column(col)
    return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)


def normalize_soc(col: ColumnOrName, min_soc: float = 5, span: float = 95) -> Column:
    """State of charge as a share of the usable range, snapped to 0 and 100 at the ends.

    The defaults are those of one battery pack; (12, 86) is the other known one.
    """
    pct = F.bround((as_column(col).cast("double") - min_soc) * 100 / span, 1)
    return F.when(pct < 1, 0.0).when(pct > 99, 100.0).otherwise(pct)


def tariff_offset(ts: ColumnOrName, tz: str | None = None) -> Column:
    """Tariff by local month and hour (``tz``), or by the stored time without one."""
    wall = local_wall(ts, tz or UTC)
    hour = F.hour(wall)

    def band(rates: dict[str, float]) -> Column:
        return (
            F.when(hour.between(*LOW_HOURS), rates["low"])
            .when(hour.between(*PEAK_HOURS), rates["peak"])
            .otherwise(rates["high"])
        )

    return F.when(
        F.month(wall).between(*SUMMER_MONTHS), band(TARIFFS["summer"])
    ).otherwise(band(TARIFFS["winter"]))
