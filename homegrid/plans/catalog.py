"""One query per operator over the given tables.

Doubles are rounded to four decimals and instants are ``timestamp_ntz``, so that results
can be compared with SQL on the same files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homegrid.functions import epoch_seconds, normalize_soc
from homegrid.functions.clock import from_seconds
from homegrid.operators import cluster, cycles, daily, dashboard, devices, prices, series, weather
from homegrid.plans import jobs, views
from homegrid.session import shared_dir, stored_copy
from homegrid.sinks import keyed, typed
from homegrid.sources import payloads, tables
from homegrid.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 4
FINE_DIGITS = 6  # for prices per kWh, whose sums have up to six decimals
GRID = "1 minute"
SLOT = "15 minutes"
LOCAL = "Europe/Copenhagen"
STAMP = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"


def query(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Register a query over the events table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        fine = fn.__name__ in ("price_view", "forecast_view", "forecast_series", "parse_solar_forecast")
        return plain(fn(views.events(spark, sf_dir)), FINE_DIGITS if fine else DIGITS)

    QUERIES[fn.__name__] = run
    return fn


def source_query(fn: Query) -> Query:
    """Register a query which reads the files itself."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def plain(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    def one(field: T.StructField) -> Column:
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DoubleType):
            col = F.round(col, digits)
        elif isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        return col.alias(field.name)

    return df.select(*[one(f) for f in df.schema.fields])


def _slots(ev: DataFrame) -> DataFrame:
    """Every event as a price of its quarter hour, in order of arrival."""
    return ev.select(
        F.window("ts", SLOT).start.cast("timestamp_ntz").alias("timestamp"),
        (F.col("value") * 10).alias("price"),
        F.col("event_id").alias("arrival"),
    )


def _kwh_prices(ev: DataFrame) -> DataFrame:
    return views.prices_raw(ev).withColumn("price", F.col("price") / 1000)


# -- daily ----------------------------------------------------------------------------


@query
def day_summary(ev):
    return daily.day_summary(views.telemetry(ev))


@query
def battery_snapshot(ev):
    return daily.battery_snapshot(views.telemetry(ev))


@query
def night_charge(ev):
    return daily.night_charge(daily.battery_snapshot(views.telemetry(ev)))


@query
def solar_energy_daily(ev):
    return series.energy_daily(views.telemetry(ev))


@query
def solar_energy_by_device(ev):
    return series.energy_daily(views.consumption(ev), value="watts", keys=["dev_id"])


@query
def solar_energy_local_days(ev):
    return series.energy_daily(views.telemetry(ev), tz=LOCAL)


@query
def incremental_days(ev):
    new = daily.incremental_days(views.telemetry(ev), views.summary_stored(ev), "2024-01-29")
    return new.select("event_id", "timestamp", "p_solar")


def _sites(ev: DataFrame) -> DataFrame:
    """The telemetry of five homes."""
    return views.telemetry(ev).join(ev.select("event_id", (F.col("user_id") % 5).alias("site_id")), "event_id")


@query
def incremental_days_by_site(ev):
    """Home 0 has all of summary_stored, home 1 its first ten days, the others nothing."""
    stored = views.summary_stored(ev).select("date", F.explode(F.array(F.lit(0), F.lit(1))).alias("site_id"))
    stored = stored.filter("site_id = 0 or dayofmonth(date) <= 10").withColumn("site_id", F.col("site_id").cast("long"))
    new = daily.incremental_days(_sites(ev), stored, "2024-01-29", keys=["site_id"])
    return new.select("event_id", "site_id", "timestamp")


@query
def daily_job(ev):
    return daily.daily_summary(views.telemetry(ev), views.summary_stored(ev), "2024-01-30")


@query
def backfill_window(ev):
    return daily.backfill_window(views.summary_stored(ev), "daily_solar_est")


@query
def solar_estimate_backfill(ev):
    stored = views.summary_stored(ev).drop("night_grid_charge")
    return daily.backfill_solar_estimate(stored, views.telemetry(ev))


@query
def night_charge_backfill(ev):
    return daily.backfill_night_charge(views.summary_stored(ev), views.telemetry(ev))


@query
def merge_production_log(ev):
    summary = daily.day_summary(views.telemetry(ev)).select("date", "peak_solar", "daily_total")
    return daily.merge_production_log(summary, views.production_log(ev))


@query
def production_log_new(ev):
    return tables.new_log_days(views.production_log(ev), "2024-02-10", views.summary_stored(ev))


# -- scans and spines -----------------------------------------------------------------


@source_query
def scan_range(spark, sf_dir):
    return tables.read_table(
        spark, sf_dir, "events.parquet", "2024-01-05", "2024-01-20", ["event_id", "ts", "value"], ts="ts"
    )


@query
def date_spine(ev):
    return tables.spine_of(views.production_log(ev))


@query
def missing_dates(ev):
    return tables.missing_dates(tables.spine_of(views.sun(ev)), views.production_log(ev))


# -- sinks ----------------------------------------------------------------------------


def _readings(ev: DataFrame, *types: str) -> DataFrame:
    rows = ev.filter(F.col("event_type").isin(*types)) if types else ev
    return views.consumption(rows).select("timestamp", "dev_id", "watts")


def _second(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", F.date_trunc("second", "timestamp").cast("timestamp_ntz"))


def _corrections(ev: DataFrame) -> DataFrame:
    """Errors reported again with a value, and sign-ups of a later month."""
    again = _readings(ev, "error").withColumn("watts", F.lit(1.0))
    later = _readings(ev, "signup").withColumn(
        "timestamp", F.col("timestamp") + F.expr("interval 31 days")
    )
    return again.unionByName(later)


@query
def keyed_replace(ev):
    return keyed.keyed_replace(_readings(ev), _corrections(ev), ["timestamp", "dev_id"])


@query
def keyed_replace_plug(ev):
    """By timestamp alone: in one second, a device erases the others."""
    existing = _second(_readings(ev))
    incoming = _second(_readings(ev, "error")).withColumn("watts", F.lit(1.0))
    return keyed.keyed_replace(existing, incoming, ["timestamp"])


@query
def insert_new(ev):
    clicks = series.dedupe_first(_slots(ev.filter("event_type = 'click'")), ["timestamp"], "arrival")
    return keyed.insert_new(clicks, _slots(ev), ["timestamp"], "arrival")


@query
def conform_daily(ev):
    days = daily_job(ev)
    return typed.conform(days, "daily_summary")


@query
def label_devices(ev):
    rows = views.consumption(ev)
    new_names = devices.device_counts(rows).filter("dev_id <> 1").select(
        "dev_id", F.concat(F.lit("socket "), F.col("dev_id").cast("string")).alias("device_location")
    )
    return devices.label_devices(rows, new_names)


# -- prices ---------------------------------------------------------------------------


@query
def price_union(ev):
    rows = views.prices_raw(ev)
    today = rows.filter("timestamp < timestamp_ntz '2024-01-17'")
    tomorrow = rows.filter("timestamp >= timestamp_ntz '2024-01-15'")
    return prices.union_prices(today, tomorrow, None)


@query
def clean_prices(ev):
    kind = F.col("event_type")
    value = (
        F.when(kind == "error", float("nan"))
        .when(kind == "click", float("inf"))
        .when(kind == "view", float("-inf"))
        .when(kind != "signup", F.col("value"))
    )
    return prices.clean_prices(ev.select("event_id", value.alias("price")))


@query
def dedupe_last(ev):
    return series.dedupe_last(_slots(ev), ["timestamp"], "arrival")


@query
def dst_repair(ev):
    return series.dst_repair(_slots(ev), "timestamp", "arrival")


@query
def resample_ffill(ev):
    return series.resample_ffill(views.prices_raw(ev), "timestamp", "price", SLOT)


@query
def resample_ffill_off_grid(ev):
    """Readings at any second on a five-minute grid: both edges of the grid are off it."""
    return series.resample_ffill(views.telemetry(ev), "timestamp", "p_solar", "5 minutes")


@query
def price_step(ev):
    return series.sampling_step(views.prices_raw(ev), "timestamp")


@query
def price_rolling_time(ev):
    return series.rolling_time_sum(views.prices_raw(ev), "timestamp", "price", "3 hours", 12)


@query
def price_rolling_rows(ev):
    return series.rolling_row_sum(resample_ffill(ev), "timestamp", "price", 12)


@query
def price_history(ev):
    """Every slot was fetched twice; the later fetch has the price, a third one has none."""
    last = views.prices_raw(ev).withColumn("currency", F.lit("DKK")).withColumn("arrival", F.lit(2))
    first = last.withColumn("price", F.col("price") + 100).withColumn("arrival", F.lit(1))
    none = last.withColumn("price", F.lit(float("inf"))).withColumn("arrival", F.lit(3))
    return jobs.price_history(first.unionByName(none).unionByName(last), "arrival")


def _price_fetch(rows: DataFrame) -> DataFrame:
    """Rows of prices as parse_prices gives them, from one payload per day."""
    end = F.col("timestamp") + F.expr("interval 15 minutes")
    element = F.struct(
        _stamp("timestamp").alias("start"), F.date_format(end, STAMP).alias("end"), (F.col("price") * 1000).alias("value")
    )
    area = F.create_map(F.lit("DK2"), F.struct(F.col("items").alias("values")))
    bodies = _by_day(rows, element, "timestamp").select(F.to_json(F.struct(area.alias("areas"))).alias("body"))
    return payloads.parse_prices(bodies, "DK2", "DKK", position=True)


@query
def price_job(ev):
    """Two fetches which share a day, and a third that is missing."""
    rows = views.prices_raw(ev)
    today, tomorrow = rows.filter("timestamp < '2024-01-16'"), rows.filter("timestamp >= '2024-01-15'")
    return jobs.day_ahead_prices(_price_fetch(today), _price_fetch(tomorrow), None)


@query
def price_job_two_fetches(ev):
    """The second fetch has other prices for a day which both have: times repeat and are repaired."""
    rows = views.prices_raw(ev)
    today, tomorrow = rows.filter("timestamp < '2024-01-16'"), rows.filter("timestamp >= '2024-01-15'")
    tomorrow = tomorrow.withColumn("price", F.col("price") + 8)
    return jobs.day_ahead_prices(_price_fetch(today), _price_fetch(tomorrow))


def _areas(ev: DataFrame) -> DataFrame:
    """Prices of three areas, each of the events of its users."""
    area = (F.col("user_id") % 3).cast("int").alias("area")
    slot = F.window("ts", SLOT).start.cast("timestamp_ntz").alias("timestamp")
    last = F.max_by("value", F.struct("ts", "event_id"))
    return ev.groupBy(area, slot).agg((last * 10).alias("price"))


@query
def price_job_by_area(ev):
    """The price job of three areas at once, each with its own step."""
    rows = _areas(ev).withColumns({"currency": F.lit("DKK"), "position": F.lit(0)})
    return jobs.day_ahead_prices(rows, keys=["area"])


@query
def price_span_by_area(ev):
    """Label and midnight of each area, over all its rows."""
    rows = _areas(ev).withColumns({"price": F.col("price") / 1000, "currency": F.lit("DKK")})
    view = prices.price_view(rows, "2024-01-10", None, "2024-01-10 20:10:00", LOCAL, ["area"])
    return prices.price_span(view, ["area"]).join(prices.first_midnight(view, ["area"]), "area")


@query
def battery_latest_by_site(ev):
    rows = _sites(ev).withColumn("battery_state_norm", normalize_soc("battery_state"))
    return dashboard.battery_latest(rows, 50, ["site_id"])


@query
def price_tariff(ev):
    return prices.with_tariff(_kwh_prices(ev), LOCAL)


@query
def price_tariff_stored_time(ev):
    return prices.with_tariff(_kwh_prices(ev))


def _view(ev: DataFrame, limit: int | None = 1000) -> DataFrame:
    rows = series.rolling_time_sum(_kwh_prices(ev), "timestamp", "price", "3 hours", 12)
    rows = rows.withColumn("currency", F.lit("DKK"))
    return prices.price_view(rows, "2024-01-10", limit, "2024-01-10 20:10:00", LOCAL)


@query
def price_view(ev):
    return _view(ev)


@query
def price_span(ev):
    return prices.price_span(_view(ev, None))


@query
def price_midnight(ev):
    return prices.first_midnight(_view(ev, None))


# -- weather and dashboard ------------------------------------------------------------


@query
def daylight_flag(ev):
    return weather.with_daylight(views.hourly(ev), views.sun(ev))


@query
def sun_lookup(ev):
    return weather.sun_lookup(views.sun(ev), "2024-01-11")


@query
def sun_lookup_missing(ev):
    return weather.sun_lookup(views.sun(ev), "2024-01-17")


@query
def sun_clock(ev):
    return weather.sun_clock(weather.sun_lookup(views.sun(ev), "2024-01-11"), LOCAL)


@query
def sun_clock_missing(ev):
    return weather.sun_clock(weather.sun_lookup(views.sun(ev), "2024-01-17"), LOCAL)


def _forecast(ev: DataFrame) -> DataFrame:
    half_hour = F.window("ts", "30 minutes").start.cast("timestamp_ntz").alias("timestamp")
    return ev.groupBy(half_hour).agg(
        (F.sum("value") / 1000).alias("pv_estimate"),
        (F.min("value") / 100).alias("pv_estimate10"),
        (F.max("value") / 100).alias("pv_estimate90"),
    )


@query
def forecast_view(ev):
    return dashboard.forecast_view(_forecast(ev), "2024-01-10")


@query
def forecast_series(ev):
    return dashboard.forecast_series(dashboard.forecast_view(_forecast(ev), "2024-01-10"))


def _battery(ev: DataFrame) -> DataFrame:
    return views.telemetry(ev).withColumn("battery_state_norm", normalize_soc("battery_state"))


@query
def battery_latest(ev):
    return dashboard.battery_latest(_battery(ev))


@query
def battery_gauge(ev):
    return dashboard.battery_gauge(_battery(ev))


@query
def battery_gauge_dense(ev):
    """A reading each second, 3600 an hour, of which the oldest of the hour counts."""
    rows = ev.select(
        (F.lit("2024-02-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("event_id"))).alias("timestamp"),
        (F.col("event_id") % 1000 / 10).cast("double").alias("battery_state_norm"),
    )
    return dashboard.battery_gauge(rows)


@query
def battery_gauge_by_site(ev):
    return dashboard.battery_gauge(
        _sites(ev).withColumn("battery_state_norm", normalize_soc("battery_state")), keys=["site_id"]
    )


@query
def soc_scale(ev):
    """Both battery packs; the second one may leave 0..100 before it is snapped."""
    return views.telemetry(ev).select(
        "event_id",
        normalize_soc("battery_state").alias("pack_a"),
        normalize_soc("battery_state", 12, 86).alias("pack_b"),
    )


QUERIES["normalize_soc"] = QUERIES.pop("soc_scale")


# -- devices, cycles, clusters --------------------------------------------------------


def _means(ev: DataFrame) -> DataFrame:
    return devices.second_means(views.consumption(ev), columns=["watts"])


def _steps(ev: DataFrame) -> DataFrame:
    return jobs.appliance_steps(views.consumption(ev))


def _labels(ev: DataFrame) -> DataFrame:
    """Cycles by length, a clustering which SQL can repeat."""
    means = devices.second_means(devices.device_readings(views.consumption(ev)), columns=["watts"])
    pairs = cycles.cycle_pairs(cycles.cycle_marks(means))
    length = F.col("seconds")
    return pairs.select(
        "dev_id",
        "cycle_start",
        F.when(length < 7200, 0).when(length < 10800, 1).otherwise(2).alias("cluster"),
    )


@query
def device_readings(ev):
    return devices.device_readings(views.consumption(ev))


@query
def device_counts(ev):
    return devices.device_counts(views.consumption(ev))


@query
def device_location(ev):
    return devices.device_location(views.consumption(ev))


@query
def plug_second_means(ev):
    return devices.second_means(views.consumption(ev))


@query
def resample_bfill(ev):
    """On a grid of minutes, where a label has the next reading at or after it."""
    return series.resample_bfill(_means(ev), "timestamp", "watts", ["dev_id"], GRID)


@query
def bfill_seconds(ev):
    """On a grid of seconds, as the runs of seconds that one reading fills."""
    runs = series.bfill_intervals(_means(ev), "timestamp", "watts", ["dev_id"], 1)
    return runs.select("dev_id", from_seconds("lo").alias("first"), from_seconds("hi").alias("last"), "watts")


@query
def cycle_marks(ev):
    return cycles.cycle_marks(_means(ev))


@query
def cycle_pairs(ev):
    return cycles.with_cycle_label(cycles.cycle_pairs(cycles.cycle_marks(_means(ev))))


@query
def cycle_span(ev):
    return cycles.cycle_span(cycles.cycle_pairs(cycles.cycle_marks(_means(ev))))


@query
def cycle_profiles(ev):
    """All seconds of every cycle, as runs of seconds with the same reading."""
    return _steps(ev)


@query
def cycle_profile_grid(ev):
    """Profiles drawn on a grid of five minutes."""
    return cycles.profile_grid(_steps(ev), 300)


@query
def cluster_profiles(ev):
    return cycles.with_minutes(cluster.cluster_profiles(_steps(ev), _labels(ev)))


@query
def cluster_usage(ev):
    return cluster.cluster_usage(_steps(ev), _labels(ev))


@query
def cluster_cycles(ev):
    return cluster.cluster_cycles(stored_copy(_steps(ev), "steps"))


@query
def cluster_devices(ev):
    return cluster.cluster_devices(stored_copy(_steps(ev), "steps"))


@query
def appliance_summary(ev):
    return jobs.appliance_summary(views.consumption(ev))


@query
def cluster_elbow(ev):
    return cluster.k_sweep(stored_copy(_steps(ev), "steps"))


@query
def cluster_silhouette(ev):
    return cluster.silhouettes(stored_copy(_steps(ev), "steps"))


# -- payloads -------------------------------------------------------------------------


def _stamp(ts: str) -> Column:
    return F.date_format(ts, STAMP)


def _power_flow_bodies(ev: DataFrame) -> DataFrame:
    """Power flow payloads. No sun in a "view", no battery in a "signup", junk in an "error";
    one in eleven has no grid power."""
    kind = F.col("event_type")
    site = F.struct(
        F.lit(1.5).alias("P_Grid"),
        F.round("value", 2).alias("P_Akku"),
        F.round(-F.col("value"), 2).alias("P_Load"),
        F.when(kind != "view", F.col("value") * 20).alias("P_PV"),
        F.lit(100.0).alias("rel_SelfConsumption"),
        F.lit(50.5).alias("rel_Autonomy"),
        F.col("event_id").alias("E_Day"),
        (F.col("event_id") * 2).alias("E_Year"),
        F.lit(7.25).alias("E_Total"),
    )
    soc = F.regexp_extract("props", "([0-9]+)", 1).try_cast("double")
    inverter = F.struct(F.col("value").alias("P"), F.when(kind != "signup", soc).alias("SOC"))
    body = F.to_json(
        F.struct(
            F.struct(
                F.struct(
                    F.create_map(F.lit("1"), inverter).alias("Inverters"), site.alias("Site")
                ).alias("Data")
            ).alias("Body"),
            F.struct(_stamp("ts").alias("Timestamp")).alias("Head"),
        ),
        {"ignoreNullFields": "false"},
    )
    body = F.when(F.col("event_id") % 11 == 0, F.replace(body, F.lit('"P_Grid":1.5,'), F.lit(""))).otherwise(body)
    return ev.select(
        "event_id", F.when(kind == "error", F.concat(F.lit("{oops "), body)).otherwise(body).alias("body")
    )


@query
def parse_power_flow(ev):
    return payloads.parse_power_flow(_power_flow_bodies(ev), keep=["event_id"])


@query
def parse_power_flow_rejects(ev):
    return payloads.bad_rows(_power_flow_bodies(ev)).select("event_id")


@query
def parse_reject_reasons(ev):
    """Why payloads of the inverter, and forecasts cut short in every third hour, give no rows."""
    flow = payloads.rejects(_power_flow_bodies(ev), "power_flow").select("event_id", "reason")
    text = F.to_json(F.struct(F.array(F.struct(F.col("value").alias("pv_estimate"))).alias("forecasts")))
    bodies = ev.select(
        (-F.col("event_id") - 1).alias("event_id"),
        F.when(F.hour("ts") % 3 == 0, F.substring(text, 1, 9)).when(F.hour("ts") % 3 == 1, '{"forecasts": []}').otherwise(text).alias("body"),
    )
    return flow.unionByName(payloads.rejects(bodies, "solar_forecast").select("event_id", "reason"))


def _plug_bodies(ev: DataFrame) -> DataFrame:
    """Plug payloads. No update in a "view", no power in a "click", no time in an "error"."""
    kind = F.col("event_type")
    milliamps = F.col("event_id").cast("string")
    deciwatts = F.when(kind == "click", "0").otherwise(F.floor(F.col("value") * 100).cast("string"))
    new = F.create_map(
        F.lit("1"), F.lit("true"), F.lit("18"), milliamps, F.lit("19"), deciwatts, F.lit("20"), F.lit("2300")
    )
    old = F.create_map(F.lit("18"), F.lit("500"), F.lit("19"), F.lit("0"), F.lit("20"), F.lit("2310"))
    body = F.to_json(
        F.struct(
            F.when(
                kind != "view",
                F.struct(new.alias("dps"), F.when(kind != "error", epoch_seconds("ts")).alias("t")),
            ).alias("update"),
            F.struct(old.alias("dps")).alias("status"),
            (F.col("user_id") % 3).cast("int").alias("dev_id"),
            F.concat(F.lit("plug"), (F.col("user_id") % 3).cast("string")).alias("device_id"),
            _stamp("ts").alias("received_at"),
        )
    )
    return ev.select("event_id", body.alias("body"))


@query
def parse_plug_rejects(ev):
    """Every seventh text is cut short."""
    cut = F.when(F.col("event_id") % 7 == 0, F.substring("body", 1, 20)).otherwise(F.col("body"))
    return payloads.plug_rejects(_plug_bodies(ev).withColumn("body", cut)).select("event_id")


@query
def parse_plug_status(ev):
    return payloads.parse_plug_status(_plug_bodies(ev), keep=["event_id"])


def _by_day(rows: DataFrame, element: Column, order: str) -> DataFrame:
    """One array per day of slot rows, at most one row per slot."""
    return rows.groupBy(F.to_date(order).alias("day")).agg(
        F.sort_array(F.collect_list(element)).alias("items")
    )


@query
def parse_prices(ev):
    end = F.col("timestamp") + F.expr("interval 15 minutes")
    element = F.struct(
        _stamp("timestamp").alias("start"), F.date_format(end, STAMP).alias("end"), F.col("price").alias("value")
    )
    days = _by_day(views.prices_raw(ev), element, "timestamp")
    area = F.create_map(F.lit("DK2"), F.struct(F.col("items").alias("values")))
    bodies = days.select(F.to_json(F.struct(area.alias("areas"))).alias("body"))
    return payloads.parse_prices(bodies, "DK2", "DKK")


@query
def parse_solar_forecast(ev):
    end = F.col("timestamp") + F.expr("interval 30 minutes")
    element = F.struct(
        F.date_format(end, STAMP).alias("period_end"),
        F.lit("PT30M").alias("period"),
        "pv_estimate",
        "pv_estimate10",
        "pv_estimate90",
    )
    days = _by_day(_forecast(ev), element, "timestamp")
    bodies = days.select(F.to_json(F.struct(F.col("items").alias("forecasts"))).alias("body"))
    return payloads.parse_solar_forecast(bodies)


def _condition(temp: str) -> Column:
    return F.array(
        F.struct(
            F.lit(800).alias("id"),
            F.when(F.col(temp) > 10, "Clear").otherwise("Clouds").alias("main"),
            F.lit("sky").alias("description"),
            F.lit("01d").alias("icon"),
        )
    )


@query
def parse_weather_hourly(ev):
    wet = F.col("temp") > 12
    element = F.struct(
        epoch_seconds("date").alias("dt"),
        "temp",
        F.when(wet, F.struct((F.col("temp") / 10).alias("1h"))).alias("rain"),
        _condition("temp").alias("weather"),
    )
    days = _by_day(views.hourly(ev), element, "date")
    bodies = days.select(
        F.to_json(F.struct(F.lit(LOCAL).alias("timezone"), F.col("items").alias("hourly"))).alias("body")
    )
    rows = payloads.parse_weather_hourly(bodies)
    return rows.select("date", "local_time", "temp", "id", "main", "description", "icon", "rain", "snow")


@query
def parse_weather_daily(ev):
    days = views.sun(ev).join(
        views.hourly(ev).groupBy(F.to_date("date").alias("date")).agg(
            F.min("temp").alias("low"), F.max("temp").alias("high")
        ),
        "date",
    )
    element = F.struct(
        epoch_seconds("sunrise").alias("dt"),
        epoch_seconds("sunrise").alias("sunrise"),
        epoch_seconds("sunset").alias("sunset"),
        "summary",
        F.struct(F.col("low").alias("min"), F.col("high").alias("max")).alias("temp"),
        F.struct(F.col("low").alias("night")).alias("feels_like"),
        _condition("high").alias("weather"),
    )
    bodies = days.select(
        F.to_json(F.struct(F.lit(LOCAL).alias("timezone"), F.array(element).alias("daily"))).alias("body")
    )
    return payloads.parse_weather_daily(bodies).select(
        "date", "sunrise", "sunset", "summary", "main", "temp_min", "temp_max", "feels_like_night"
    )


@query
def parse_weather_current(ev):
    """One payload per event; a "view" reports two conditions, an "error" none."""
    kind = F.col("event_type")
    one = F.struct(F.lit(800).alias("id"), kind.alias("main"), F.lit("sky").alias("description"), F.lit("01d").alias("icon"))
    two = F.struct(F.lit(701).alias("id"), F.lit("Mist").alias("main"), F.lit("mist").alias("description"), F.lit("50d").alias("icon"))
    weather = F.when(kind == "view", F.array(one, two)).when(kind != "error", F.array(one))
    seconds = epoch_seconds("ts")
    now = F.struct(
        seconds.alias("dt"), (seconds - 3600).alias("sunrise"), (seconds + 3600).alias("sunset"),
        F.col("value").alias("temp"), weather.alias("weather"),
    )
    body = F.to_json(F.struct(F.lit(LOCAL).alias("timezone"), now.alias("current")))
    rows = payloads.parse_weather_current(ev.select(body.alias("body")))
    return rows.select("dt", "sunrise", "sunset", "temp", "id", "main", "description", "icon")


@query
def parse_sun_times(ev):
    times = F.struct(_stamp("sunrise").alias("sunrise"), _stamp("sunset").alias("sunset"))
    bodies = views.sun(ev).select("date", F.to_json(F.struct(times.alias("results"))).alias("body"))
    return payloads.parse_sun_times(bodies).select("date", "sunrise", "sunset")


# -- tables that are written, written again and read back ------------------------------


@source_query
def write_keyed_table(spark, sf_dir):
    """Readings of the plugs; the second batch replaces those of "purchase" and repeats a key."""
    ev = views.events(spark, sf_dir)
    rows = ev.select("event_id", (F.col("user_id") % 3).alias("dev_id"), F.col("ts").alias("timestamp"), "value", F.to_date("ts").alias("date"))
    path = f"{shared_dir(spark, 'keyed')}/table"
    keyed.write_keyed(rows, path, ["event_id"])
    again = rows.join(ev.filter("event_type = 'purchase'").select("event_id"), "event_id")
    again = again.withColumn("arrival", F.lit(1)).withColumn("value", F.lit(-2.0)).unionByName(
        again.withColumn("arrival", F.lit(0)).withColumn("value", F.lit(-1.0))
    )
    for _ in range(2):
        keyed.write_keyed(again, path, ["event_id"], arrival="arrival")
    return spark.read.parquet(path)


@source_query
def battery_newest_days(spark, sf_dir):
    """The newest readings of a stored table, of which only the newest days are opened."""
    rows = views.telemetry(views.events(spark, sf_dir)).withColumn("date", F.to_date("timestamp"))
    path = f"{shared_dir(spark, 'telemetry')}/table"
    keyed.write_new(rows, path, ["event_id"])
    return tables.newest_rows(spark, path, 1000, columns=["event_id", "timestamp", "battery_state"])


@source_query
def write_new_table(spark, sf_dir):
    """The first event of each slot stays, whatever comes later."""
    ev = views.events(spark, sf_dir)
    rows = ev.select(
        F.window("ts", SLOT).start.cast("timestamp_ntz").alias("timestamp"), "event_id", F.to_date("ts").alias("date")
    )
    path = f"{shared_dir(spark, 'new')}/table"
    for part in ("event_id % 2 = 0", "true", "true"):
        keyed.write_new(rows.filter(part), path, ["timestamp"], arrival="event_id")
    return spark.read.parquet(path)


@source_query
def append_days_table(spark, sf_dir):
    """Days of two homes, written twice; each keeps its own days."""
    ev = views.events(spark, sf_dir)
    days = daily.day_summary(_sites(ev), keys=["site_id"]).select("site_id", "date", "daily_total").filter("site_id < 2")
    path = f"{shared_dir(spark, 'days')}/table"
    keyed.append_days(days.filter("dayofmonth(date) <= 20"), path, keys=["site_id"])
    for _ in range(2):
        keyed.append_days(days.withColumn("daily_total", F.col("daily_total") + 1), path, keys=["site_id"])
    return spark.read.parquet(path)


# -- streams --------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = views.events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@source_query
def stream_ingest(spark, sf_dir):
    work = shared_dir(spark, "stream")
    bodies = _power_flow_bodies(_event_stream(spark, sf_dir))
    _finish(
        ingest.stream_ingest(
            bodies,
            lambda df: payloads.parse_power_flow(df, keep=["event_id"]),
            f"{work}/table",
            f"{work}/checkpoint",
            arrival="event_id",
        )
    )
    return spark.read.parquet(f"{work}/table").select("timestamp", "p_solar", "battery_state_norm", "e_day")


@source_query
def stream_dedupe(spark, sf_dir):
    work = shared_dir(spark, "stream")
    rows = _event_stream(spark, sf_dir).select(
        F.window("ts", SLOT).start.cast("timestamp").alias("timestamp"),
        (F.col("user_id") % 3).cast("int").alias("dev_id"),
    )
    out = ingest.stream_dedupe(rows, ["timestamp", "dev_id"])
    _finish(
        out.writeStream.format("parquet")
        .option("path", f"{work}/table")
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    return spark.read.parquet(f"{work}/table")


@source_query
def stream_day_summary(spark, sf_dir):
    work = shared_dir(spark, "stream")
    rows = views.telemetry(_event_stream(spark, sf_dir)).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")
    )
    days = ingest.stream_day_summary(rows)
    _finish(ingest.start_day_summary(days, f"{work}/table", f"{work}/checkpoint"))
    return spark.read.parquet(f"{work}/table").drop("month")
