"""Diary, backfills, tariffs and dashboard reads on small inputs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from homegrid.functions import normalize_soc
from homegrid.operators import daily, dashboard, prices, weather


def telemetry(spark, rows):
    df = spark.createDataFrame(rows, "timestamp string, p_solar double, battery_state double, e_day double")
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def test_diary_and_snapshots(spark):
    df = telemetry(
        spark,
        [
            ("2024-01-01 00:30:00", 0.0, 20.0, None),
            ("2024-01-01 01:30:00", 0.0, 30.0, None),  # as near to 01:00 as the one before
            ("2024-01-01 05:10:00", 60.0, 45.0, 10.0),
            ("2024-01-01 12:00:00", 2500.0, 90.0, 900.0),
            ("2024-01-01 13:00:00", 1000.0, 100.0, 950.0),
            ("2024-01-02 09:00:00", 5.0, 50.0, None),
        ],
    )
    one, two = daily.day_summary(df).orderBy("date").collect()
    assert (one.first_prod, one.last_prod) == (datetime(2024, 1, 1, 5, 10), datetime(2024, 1, 1, 13))
    assert (one.first_1kw, one.last_1kw) == (datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 13))
    assert (one.first_2kw, one.last_2kw) == (datetime(2024, 1, 1, 12),) * 2
    assert (one.min_battery_raw, one.max_battery_raw, one.max_battery) == (20, 100, 100)
    assert (one.peak_solar, one.daily_total) == (2500, 950)
    assert (two.first_prod, two.daily_total) == (None, 0)
    first, second = daily.night_charge(daily.battery_snapshot(df)).orderBy("date").collect()
    assert (first.battery_at_1am, first.battery_at_5am, first.night_grid_charge) == (20, 45, True)
    assert (second.battery_at_1am, second.battery_at_5am, second.night_grid_charge) == (0, 0, False)
    west = daily.day_summary(df, tz="America/New_York").orderBy("date").collect()
    assert [r.date for r in west] == [date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 2)]


def test_new_days_of_an_empty_store(spark, events):
    df = telemetry(spark, [("2024-01-01 00:00:00", 1.0, 1.0, 1.0), ("2024-01-02 00:00:00", 1.0, 1.0, 1.0)])
    none = spark.sql("select date'2024-01-01' as date").limit(0)
    assert daily.incremental_days(df, none, "2024-01-02").count() == 1
    assert daily.incremental_days(df, none.union(spark.sql("select date'2024-01-01'")), "2024-01-03").count() == 1


def test_empty_backfills(spark):
    stored = spark.sql("select date'2024-01-01' as date, 3.0D as daily_solar_est, false as night_grid_charge")
    df = telemetry(spark, [("2024-01-01 00:00:00", 1.0, 1.0, 1.0)])
    assert daily.backfill_solar_estimate(stored, df).count() == 0
    assert daily.backfill_night_charge(stored, df).count() == 0
    assert daily.backfill_window(stored, "daily_solar_est").first().start is None


def test_estimate_without_readings_keeps_the_old_value(spark):
    stored = spark.sql(
        "select * from values (date'2024-01-01', null), (date'2024-01-02', 3.0D), (date'2024-06-01', null) t(date, daily_solar_est)"
    )
    before = telemetry(spark, [("2023-01-01 00:00:00", 1.0, 1.0, 1.0)])
    got = {str(r.date): r.daily_solar_est for r in daily.backfill_solar_estimate(stored, before, days=90).collect()}
    assert got == {"2024-01-01": 0.0, "2024-01-02": 3.0}
    some = telemetry(spark, [("2024-01-01 00:00:00", 3.6e6, 1.0, 1.0)])
    got = {str(r.date): r.daily_solar_est for r in daily.backfill_solar_estimate(stored, some, days=90).collect()}
    assert got == {"2024-01-01": 1.0, "2024-01-02": 0.0}


@pytest.mark.parametrize("soc, a, b", [(5, 0, 0), (12, 7.4, 0), (98, 97.9, 100), (100, 100, 100), (55, 52.6, 50.0)])
def test_normalize_soc(spark, soc, a, b):
    row = spark.range(1).select(normalize_soc(F.lit(soc)).alias("a"), normalize_soc(F.lit(soc), 12, 86).alias("b")).first()
    assert (row.a, row.b) == (a, b)


@pytest.mark.parametrize(
    "utc, offset",
    [
        ("2024-03-31 22:30:00", 0.1220),  # 00:30 on April 1 in summer time
        ("2024-03-31 15:30:00", 1.0985),  # 17:30 on March 31
        ("2024-07-01 12:00:00", 0.1831),
        ("2024-07-01 18:59:00", 0.4760),
        ("2024-12-01 20:00:00", 0.3661),
    ],
)
def test_tariff(spark, utc, offset):
    df = spark.sql(f"select timestamp'{utc}' as timestamp, 0.1D as price")
    assert prices.with_tariff(df, "Europe/Copenhagen").first().offset == offset


def test_price_view(spark):
    df = spark.sql(
        "select timestamp'2024-01-01 22:00:00' + make_dt_interval(0, id) as timestamp, id / 10.0D as price, 0D as rolling_sum, 'DKK' as currency from range(30)"
    )
    view = prices.price_view(df, "2024-01-01 23:00:00", 26, "2024-01-02 02:30:00", "Europe/Copenhagen").persist()
    first = view.orderBy("timestamp").first()
    assert (first.timestamp, first.row_index, first.price) == (datetime(2024, 1, 2, 3), 3, 0.4)
    assert tuple(prices.price_span(view).first()) == ("2024-01-02 to 2024-01-03", "DKK")
    assert prices.first_midnight(view).first().midnight == datetime(2024, 1, 3)
    at_start = prices.price_view(df, "2024-01-01 23:00:00", 10, tz="Europe/Copenhagen")
    assert prices.first_midnight(at_start).first().midnight is None
    assert prices.price_span(at_start).first().label == "2024-01-02"


def test_daylight_edges(spark):
    hours = spark.sql("select timestamp'2024-01-01 06:00:00' + make_dt_interval(0, id) as date from range(4)")
    sun = spark.sql("select date'2024-01-01' as date, timestamp'2024-01-01 07:00:00' as sunrise, timestamp'2024-01-01 08:00:00' as sunset, 'x' as summary")
    flags = [r.during_day for r in weather.with_daylight(hours, sun).orderBy("date").collect()]
    assert flags == [False, True, True, False]
    assert not any(r.during_day for r in weather.with_daylight(hours, sun.limit(0)).collect())
    assert weather.sun_lookup(sun, "2024-01-02").first().summary == weather.NO_WEATHER
    assert weather.sun_lookup(sun, "2024-01-01").first().sunset == datetime(2024, 1, 1, 8)


def test_battery_reads(spark):
    df = spark.sql(
        "select timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) as timestamp, id - 5.0D as battery_state_norm from range(120)"
    )
    latest = dashboard.battery_latest(df, 118)
    assert latest.count() == 118
    assert latest.agg(F.min("battery_state_norm"), F.max("battery_state_norm")).first()[:] == (0, 100)
    gauge = dashboard.battery_gauge(latest).first()
    assert tuple(gauge) == (100, 55, 45)
