"""The scheduled jobs as single plans over the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homegrid.operators.cluster import ROUNDS, cluster_devices, cluster_usage
from homegrid.operators.cycles import cycle_marks, cycle_pairs, cycle_steps, profile_grid
from homegrid.operators.devices import device_readings, second_means
from homegrid.operators.joins import spread_join
from homegrid.operators.prices import clean_prices, union_prices
from homegrid.operators.series import (
    dedupe_last,
    dst_repair,
    resample_ffill,
    rolling_row_sum,
    rolling_time_sum,
    sampling_step,
)
from homegrid.session import stored_copy

PRICE_WINDOW = "3 hours"
PRICE_STEP = "15 minutes"
PRICE_ROWS = 12


def day_ahead_prices(*fetches: DataFrame | None, keys: Sequence[str] = ()) -> DataFrame:
    """Hourly price job, for :func:`homegrid.sinks.keyed.write_keyed`.

    ``fetches`` are rows of ``parse_prices(position=True)`` for today and, when there,
    tomorrow. The sums are taken before rows without a price are dropped. The rows in a
    window are counted first, for each of ``keys``, such as the price area, on its own.
    """
    ordered = [
        f.withColumn("arrival", F.struct(F.lit(i).alias("fetch"), "position")).drop("position")
        for i, f in enumerate(f for f in fetches if f is not None)
    ]
    prices = union_prices(*ordered, arrival="arrival")
    counts = sampling_step(prices, "timestamp", PRICE_WINDOW, keys)
    if keys:
        own = counts.select(*keys, F.col("rows_in_window").alias("_n"))
        prices, n = spread_join(prices, own, keys).withColumn("_n", F.coalesce("_n", F.lit(1))), "_n"
    else:
        n = int(counts.first()["rows_in_window"] or 1)
    rolled = rolling_time_sum(prices, "timestamp", "price", PRICE_WINDOW, n, keys=keys, arrival="arrival")
    return dst_repair(clean_prices(rolled), "timestamp", "arrival", keys).drop("arrival", "_n")


def price_history(fetches: DataFrame, arrival: str, keys: Sequence[str] = ()) -> DataFrame:
    """Price backfill: clean, last fetch of a time, regular grid, full windows only."""
    prices = dedupe_last(clean_prices(fetches), [*keys, "timestamp"], arrival)
    grid = resample_ffill(prices, "timestamp", ["price", "currency"], PRICE_STEP, keys)
    return rolling_row_sum(grid, "timestamp", "price", PRICE_ROWS, keys=keys)


def appliance_steps(consumption: DataFrame, dev_id: int | None = None) -> DataFrame:
    """Cycle profiles of all located devices, or of one, as step functions."""
    means = second_means(device_readings(consumption, dev_id), columns=["watts"])
    return cycle_steps(means, cycle_pairs(cycle_marks(means)))


def appliance_profiles(consumption: DataFrame, dev_id: int | None = None, step_s: int = 1) -> DataFrame:
    """The same on a grid of seconds."""
    return profile_grid(appliance_steps(consumption, dev_id), step_s)


def appliance_summary(consumption: DataFrame, k: int = 3, rounds: int = ROUNDS) -> DataFrame:
    """Use of an average cycle in each cluster of each located device."""
    steps = stored_copy(appliance_steps(consumption), "steps")
    return cluster_usage(steps, cluster_devices(steps, k, rounds))
