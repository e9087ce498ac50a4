"""Several homes or price areas at once give what each gives on its own."""

import pytest
from pyspark.sql import functions as F

from homegrid.operators import dashboard, weather
from homegrid.plans import jobs, views
from homegrid.streaming import ingest


def alone_and_together(spark, df, key, run):
    """Rows of ``run`` over all keys, and those of each key run by itself."""
    together = {}
    for r in run(df, [key]).collect():
        row = r.asDict()
        together.setdefault(row.pop(key), []).append(tuple(row[c] for c in sorted(row)))
    for value, rows in together.items():
        own = [r.asDict() for r in run(df.filter(F.col(key) == value).drop(key), []).collect()]
        assert sorted(rows, key=str) == sorted((tuple(r[c] for c in sorted(r)) for r in own), key=str)
    return together


@pytest.fixture
def areas(events):
    rows = views.prices_raw(events).filter("timestamp < '2024-01-09'")
    area = F.when(F.minute("timestamp") == 0, F.array(F.lit("DK1"), F.lit("DK2"))).otherwise(F.array(F.lit("DK2")))
    return rows.select(F.explode(area).alias("area"), "timestamp", "price", F.lit("DKK").alias("currency"))


def test_price_job_of_areas_with_other_steps(spark, areas):
    rows = areas.withColumn("position", F.lit(0))
    found = alone_and_together(spark, rows, "area", lambda df, keys: jobs.day_ahead_prices(df, None, keys=keys))
    assert set(found) == {"DK1", "DK2"}


def test_price_history_of_areas(spark, areas):
    rows = areas.withColumn("arrival", F.lit(1))
    alone_and_together(spark, rows, "area", lambda df, keys: jobs.price_history(df, "arrival", keys))


def test_lists_of_homes(spark, events):
    rows = views.telemetry(events).select(
        "timestamp", (F.col("event_id") % 3).alias("site"), F.col("battery_state").alias("battery_state_norm"),
        *[F.col("p_solar").alias(f"pv_estimate{n}") for n in ("", "10", "90")],
    )
    alone_and_together(spark, rows, "site", lambda df, keys: dashboard.battery_latest(df, 7, keys))
    alone_and_together(spark, rows, "site", lambda df, keys: dashboard.forecast_view(df, "2024-01-10", limit=9, keys=keys))


def test_daylight_of_places(spark):
    hours = spark.sql("select place, timestamp_ntz'2024-01-01 00:00' + make_dt_interval(0, h) as date from (select explode(array('a', 'b')) as place) cross join (select explode(sequence(0, 23)) as h)")
    sun = spark.sql(
        "select * from values ('a', date'2024-01-01', timestamp_ntz'2024-01-01 08:00', timestamp_ntz'2024-01-01 16:00'), "
        "('b', date'2024-01-01', timestamp_ntz'2024-01-01 04:00', timestamp_ntz'2024-01-01 20:00') t(place, date, sunrise, sunset)"
    )
    light = weather.with_daylight(hours, sun, keys=["place"]).filter("during_day").groupBy("place").count().collect()
    assert {r.place: r["count"] for r in light} == {"a": 9, "b": 17}


def test_stream_diary_of_homes(spark, tmp_path):
    rows = spark.sql(
        "select * from values (1, timestamp'2024-01-01 10:00', 60D, 1D, 5), (2, timestamp'2024-01-01 11:00', 2100D, 9D, 7), "
        "(1, timestamp'2024-01-02 10:00', 70D, 2D, 6) t(site, timestamp, p_solar, battery_state, e_day)"
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    days = ingest.stream_day_summary(stream, keys=["site"])
    query = ingest.start_day_summary(days, str(tmp_path / "out"), str(tmp_path / "checkpoint"), ["site"])
    query.awaitTermination()
    assert query.exception() is None
    got = {(r.site, str(r.date)): (r.peak_solar, r.daily_total) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, "2024-01-01"): (60.0, 5), (2, "2024-01-01"): (2100.0, 7), (1, "2024-01-02"): (70.0, 6)}
