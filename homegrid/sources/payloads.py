"""Payload text → typed rows.

Each function takes a (batch or streaming) DataFrame with one JSON text per row in
``col``. Unknown fields are ignored, missing ones are NULL. Everything is row by row, so
no parser shuffles. ``keep`` passes columns of the source through, such as the order of
arrival.

A payload that gives no row has a reason for it. :func:`rejects` gives these payloads, and with
``observed`` a parser counts them in the pass that parses: an ``Observation`` in batch, or a
name under which a stream reports the counts with each of its batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from homegrid import schemas
from homegrid.functions.clock import local_wall
from homegrid.functions.energy import normalize_soc, or_zero

BODY = "body"
FORECAST_PERIOD = "interval 30 minutes"
PRICE_UNIT = 1000  # per MWh → per kWh
_CORRUPT = "_corrupt"


def payload_files(
    spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """One payload per file, over as many lines as it has: ``body``, ``path`` and ``arrival``.

    ``arrival`` orders payloads by the time their file was written and then by its path. With
    ``stream`` the files are those that land in ``path`` from now on.
    """
    reader = (spark.readStream if stream else spark.read).format("text").option("wholetext", True)
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    file = F.col("_metadata.file_path")
    return reader.load(path).select(
        F.col("value").alias(BODY),
        file.alias("path"),
        F.struct(F.col("_metadata.file_modification_time").alias("written"), file.alias("path")).alias("arrival"),
    )


def _read(df: DataFrame, col: str, schema: str, options: dict[str, str] | None = None) -> DataFrame:
    ddl = f"{schema.strip()}, {_CORRUPT} STRING"
    opts = {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE", **(options or {})}
    return df.withColumn("_p", F.from_json(F.col(col), ddl, opts))


# -- inverter -------------------------------------------------------------------------


# The site's fields which a payload must have, if only as null.
SITE_FIELDS = {
    "p_battery": "P_Akku",
    "p_grid": "P_Grid",
    "p_local": "P_Load",
    "p_solar": "P_PV",
    "pct_selfsufficient": "rel_SelfConsumption",
    "pct_autonomy": "rel_Autonomy",
    "e_day": "E_Day",
    "e_year": "E_Year",
    "e_total": "E_Total",
}
_SITE = "_p.Body.Data.Site"
UNREADABLE, NO_TIME, NO_DEVICE, NO_ROWS = "unreadable", "no time", "no device", "no rows"


def _accounted(rows: DataFrame, reasons: Sequence[str], observed: Observation | str | None) -> DataFrame:
    """Rows with a ``_reason``, counted as they pass: payloads, accepted ones, and each reason."""
    if observed is None:
        return rows
    counts = [F.count_if(F.col("_reason") == r).alias(f"rejected: {r}") for r in reasons]
    accepted = F.count_if(F.col("_reason").isNull()).alias("accepted")
    return rows.observe(observed, F.count(F.lit(1)).alias("payloads"), accepted, *counts)


def _generated(rows: DataFrame, row: Column, keep: Sequence[str]) -> DataFrame:
    """The accepted rows. They come out of a generator and not a filter, which would move below
    the parsing and parse every text again."""
    parsed = rows.select(*keep, F.inline(F.when(F.col("_reason").isNull(), F.array(row))))
    return parsed.select(*[c for c in parsed.columns if c not in keep], *keep)


def _inverter() -> Column:
    return F.try_element_at("_p.Body.Data.Inverters", F.lit("1"))


def _power_flow(df: DataFrame, col: str) -> DataFrame:
    """The columns of ``df`` with the numbers, the time and the reason, each worked out once.

    A null counts as 0, a missing field does not; only the state of charge may be missing.
    """
    fields = _read(df, col, schemas.POWER_FLOW, {"allowComments": "true"}).select(
        *df.columns,
        F.col(f"_p.{_CORRUPT}").isNotNull().alias("_bad"),
        F.try_to_timestamp("_p.Head.Timestamp", F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")).alias("_stamp"),
        F.col(_SITE).alias("_site"),
        _inverter().alias("_inverter"),
    )
    needed = F.array(*[F.lit(name) for name in SITE_FIELDS.values()])
    absent = F.array_except(needed, F.coalesce(F.map_keys("_site"), F.array().cast("array<string>")))
    no_power = ~F.coalesce(F.map_contains_key("_inverter", "P"), F.lit(False))

    def number(fields: str, name: str) -> Column:
        return or_zero(F.try_element_at(fields, F.lit(name)).try_cast("double"))

    reason = (
        F.when(F.col("_bad"), UNREADABLE)
        .when(F.size(absent) > 0, F.concat(F.lit("no "), absent[0]))
        .when(no_power, "no P")
        .when(F.col("_stamp").isNull(), NO_TIME)
    )
    return fields.select(
        *df.columns,
        F.col("_stamp").alias("_timestamp"),
        reason.alias("_reason"),
        *[number("_site", name).alias(f"_{to}") for to, name in SITE_FIELDS.items()],
        number("_inverter", "P").alias("_p_total"),
        number("_inverter", "SOC").alias("_soc"),
    )


POWER_FLOW_REASONS = (UNREADABLE, *[f"no {name}" for name in SITE_FIELDS.values()], "no P", NO_TIME)


def parse_power_flow(
    df: DataFrame, col: str = BODY, keep: Sequence[str] = (), observed: Observation | str | None = None
) -> DataFrame:
    """Inverter power flow → ``inverter_data`` rows; unusable payloads give none."""
    order = ("p_battery", "p_grid", "p_local", "p_solar", "pct_selfsufficient", "pct_autonomy")
    row = F.struct(
        F.col("_timestamp").alias("timestamp"),
        *[F.col(f"_{name}").alias(name) for name in (*order, "p_total")],
        F.col("_soc").alias("battery_state"),
        normalize_soc("_soc").alias("battery_state_norm"),
        *[F.col(f"_{name}").alias(name) for name in ("e_day", "e_year", "e_total")],
    )
    body = df.select(*dict.fromkeys([*keep, col]))
    return _generated(_accounted(_power_flow(body, col), POWER_FLOW_REASONS, observed), row, keep)


def _only_rejects(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    reasons = F.when(F.col("_reason").isNotNull(), F.array("_reason"))
    return rows.select(*columns, F.explode(reasons).alias("reason"))


def bad_rows(df: DataFrame, col: str = BODY) -> DataFrame:
    """The payloads which :func:`parse_power_flow` drops."""
    return _only_rejects(_power_flow(df, col), df.columns).drop("reason")


# -- smart plugs ----------------------------------------------------------------------


# Datapoint number and scale of current, power and voltage.
_POINTS = {"amps": ("18", 1000), "watts": ("19", 10), "volts": ("20", 10)}
PLUG_REASONS = (UNREADABLE, NO_DEVICE, NO_TIME)


def _plug(df: DataFrame, col: str) -> DataFrame:
    def reading(point: str, scale: int) -> Column:
        # other datapoints are switches or texts, so values are read as text
        new, old = (
            F.try_element_at(f"_p.{part}.dps", F.lit(point)).try_cast("double")
            for part in ("update", "status")
        )
        return F.coalesce(F.nullif(new, F.lit(0.0)), old, F.lit(0.0)) / scale

    time = F.coalesce(F.timestamp_seconds("_p.update.t"), F.date_trunc("second", "_p.received_at"))
    reason = (
        F.when(F.col(f"_p.{_CORRUPT}").isNotNull(), UNREADABLE)
        .when(F.col("_p.dev_id").isNull(), NO_DEVICE)
        .when(time.isNull(), NO_TIME)
    )
    return _read(df, col, schemas.PLUG_STATUS).select(
        *df.columns,
        time.alias("_timestamp"),
        reason.alias("_reason"),
        F.col("_p.dev_id").alias("_dev_id"),
        F.col("_p.device_id").alias("_device_id"),
        *[reading(*how).alias(f"_{name}") for name, how in _POINTS.items()],
    )


def plug_rejects(df: DataFrame, col: str = BODY) -> DataFrame:
    """The payloads which :func:`parse_plug_status` drops."""
    return _only_rejects(_plug(df, col), df.columns).drop("reason")


def parse_plug_status(
    df: DataFrame, col: str = BODY, keep: Sequence[str] = (), observed: Observation | str | None = None
) -> DataFrame:
    """Plug status → ``consumption`` rows; corrupt texts and those without time or device give none.

    An updated value counts when it is not 0, else the status value does. Without a
    power reading, power is current times voltage.
    """
    watts = F.when(F.col("_watts") == 0, F.col("_amps") * F.col("_volts")).otherwise(F.col("_watts"))
    row = F.struct(
        F.col("_timestamp").alias("timestamp"),
        F.col("_dev_id").alias("dev_id"),
        F.col("_device_id").alias("device_id"),
        F.col("_amps").alias("amps"),
        watts.alias("watts"),
        F.col("_volts").alias("volts"),
        F.lit("").alias("device_location"),
        F.lit("").alias("comment"),
    )
    body = df.select(*dict.fromkeys([*keep, col]))
    return _generated(_accounted(_plug(body, col), PLUG_REASONS, observed), row, keep)


# -- lists of rows: prices, forecast, weather -----------------------------------------


#: Schema of each payload that is a list of rows, and where the list is.
LISTS = {
    "prices": (schemas.PRICES, None),
    "solar_forecast": (schemas.SOLAR_FORECAST, "_p.forecasts"),
    "weather_hourly": (schemas.WEATHER, "_p.hourly"),
    "weather_daily": (schemas.WEATHER, "_p.daily"),
    "weather_current": (schemas.WEATHER, "_p.current.weather"),
    "sun_times": (schemas.SUN_TIMES, None),
}
LIST_REASONS = (UNREADABLE, NO_ROWS)


def _listed(
    df: DataFrame, kind: str, col: str, observed: Observation | str | None = None, area: str | None = None
) -> DataFrame:
    """Payloads of a list with the reason why they give no row, if so."""
    schema, place = LISTS[kind]
    rows = _read(df, col, schema)
    if kind == "prices":
        items = F.try_element_at("_p.areas", F.lit(area))["values"]
    elif kind == "sun_times":
        sun = F.col("_p.results")
        items = F.when(sun["sunrise"].isNotNull() | sun["sunset"].isNotNull(), F.array(sun))
    else:
        items = F.col(place)
    reason = F.when(F.col(f"_p.{_CORRUPT}").isNotNull(), UNREADABLE).when(
        F.coalesce(F.size(items), F.lit(0)) < 1, NO_ROWS
    )
    return _accounted(rows.withColumn("_reason", reason), LIST_REASONS, observed)


def rejects(df: DataFrame, kind: str, col: str = BODY, area: str | None = None) -> DataFrame:
    """The payloads that give no row, with the ``reason``, for parsers of any kind.

    ``kind`` is "power_flow", "plug_status" or one of ``LISTS``; prices are those of one ``area``.
    """
    if kind == "power_flow":
        rows = _power_flow(df, col)
    elif kind == "plug_status":
        rows = _plug(df, col)
    else:
        rows = _listed(df, kind, col, area=area)
    return _only_rejects(rows, df.columns)


# -- prices and forecast --------------------------------------------------------------


def parse_prices(
    df: DataFrame,
    area: str,
    currency: str,
    col: str = BODY,
    position: bool = False,
    keep: Sequence[str] = (),
    observed: Observation | str | None = None,
) -> DataFrame:
    """Day-ahead prices of one area, per kWh.

    ``position`` adds the place in the payload; with a column of ``keep`` that orders the
    payloads it orders the rows of many of them.
    """
    values = F.try_element_at("_p.areas", F.lit(area))["values"]
    rows = _listed(df, "prices", col, observed, area).select(*keep, F.posexplode(values).alias("position", "v"))
    prices = rows.select(
        F.col("v.start").alias("timestamp"),
        (F.col("v.value") / PRICE_UNIT).alias("price"),
        F.lit(currency).alias("currency"),
        "position",
        *keep,
    )
    return prices if position else prices.drop("position")


def parse_solar_forecast(
    df: DataFrame, col: str = BODY, observed: Observation | str | None = None
) -> DataFrame:
    """Solar forecast, stamped with the start of each half hour."""
    return (
        _listed(df, "solar_forecast", col, observed)
        .select(F.inline("_p.forecasts"))
        .withColumn("timestamp", F.col("period_end") - F.expr(FORECAST_PERIOD))
        .select("timestamp", "pv_estimate", "pv_estimate10", "pv_estimate90")
    )


# -- weather --------------------------------------------------------------------------


def _fields(df: DataFrame, struct: str) -> list[str]:
    return df.select(f"{struct}.*").columns


def _local(seconds: str) -> Column:
    """Wall time in the zone that the payload names."""
    return F.convert_timezone(
        F.lit("UTC"), F.col("_zone"), F.timestamp_seconds(seconds).cast("timestamp_ntz")
    )


def parse_weather_hourly(
    df: DataFrame, col: str = BODY, observed: Observation | str | None = None
) -> DataFrame:
    """Hourly forecast: ``date`` is the instant, ``local_time`` the wall time of the place."""
    rows = _listed(df, "weather_hourly", col, observed).select(
        F.col("_p.timezone").alias("_zone"), F.explode("_p.hourly").alias("h")
    )
    plain = [c for c in _fields(rows, "h") if c not in ("dt", "rain", "snow", "weather")]
    return rows.select(
        F.timestamp_seconds("h.dt").alias("date"),
        _local("h.dt").alias("local_time"),
        *[f"h.{c}" for c in plain],
        F.get("h.weather", F.lit(0)).alias("w"),
        or_zero("h.rain.1h").alias("rain"),
        or_zero("h.snow.1h").alias("snow"),
    ).select("date", "local_time", *plain, "w.*", "rain", "snow")


def parse_weather_daily(
    df: DataFrame, col: str = BODY, observed: Observation | str | None = None
) -> DataFrame:
    """Daily forecast by local date. Children of temp and feels_like keep their parent's name."""
    rows = _listed(df, "weather_daily", col, observed).select(
        F.col("_p.timezone").alias("_zone"), F.explode("_p.daily").alias("d")
    )
    clocks = ("sunrise", "sunset", "moonrise", "moonset")
    nested = ("temp", "feels_like")
    plain = [c for c in _fields(rows, "d") if c not in ("dt", "weather", *clocks, *nested)]
    return rows.select(
        F.to_date(_local("d.dt")).alias("date"),
        *[F.timestamp_seconds(f"d.{c}").alias(c) for c in clocks],
        *[f"d.{c}" for c in plain],
        F.get("d.weather", F.lit(0)).alias("w"),
        *[F.col(f"d.{n}.{c}").alias(f"{n}_{c}") for n in nested for c in _fields(rows, f"d.{n}")],
    ).select(
        "date", *clocks, *plain, "w.*", *[f"{n}_{c}" for n in nested for c in _fields(rows, f"d.{n}")]
    )


def parse_weather_current(
    df: DataFrame, col: str = BODY, observed: Observation | str | None = None
) -> DataFrame:
    """Weather now; one row per reported condition."""
    rows = _listed(df, "weather_current", col, observed).select(
        F.col("_p.timezone").alias("_zone"),
        F.col("_p.current").alias("c"),
        F.explode("_p.current.weather").alias("w"),
    )
    clocks = ("dt", "sunrise", "sunset")
    plain = [c for c in _fields(rows, "c") if c not in ("weather", *clocks)]
    return rows.select(
        *[_local(f"c.{c}").alias(c) for c in clocks], *[f"c.{c}" for c in plain], "w.*"
    )


def parse_sun_times(
    df: DataFrame, date_col: str = "date", col: str = BODY, observed: Observation | str | None = None
) -> DataFrame:
    """History of sunrise and sunset, one payload per date; the summary is not known."""
    rows = _listed(df, "sun_times", col, observed)
    return rows.select(
        F.col(date_col).cast("date").alias("date"),
        F.try_to_timestamp("_p.results.sunrise").alias("sunrise"),
        F.try_to_timestamp("_p.results.sunset").alias("sunset"),
        F.lit(None).cast("string").alias("summary"),
    )
