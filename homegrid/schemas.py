"""Declared types of payloads and stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Fields of the payloads as the devices and services send them.
POWER_FLOW = """
Body STRUCT<Data: STRUCT<
  Inverters: MAP<STRING, MAP<STRING, STRING>>, Site: MAP<STRING, STRING>, Version: STRING>>,
Head STRUCT<Status: STRUCT<Code: INT, Reason: STRING, UserMessage: STRING>, Timestamp: STRING>
"""

PLUG_STATUS = """
update STRUCT<dps: MAP<STRING, STRING>, t: BIGINT>,
status STRUCT<dps: MAP<STRING, STRING>>,
dev_id INT, device_id STRING, received_at TIMESTAMP
"""

PRICES = """
areas MAP<STRING, STRUCT<values: ARRAY<STRUCT<start: TIMESTAMP, end: TIMESTAMP, value: DOUBLE>>>>
"""

SOLAR_FORECAST = """
forecasts ARRAY<STRUCT<pv_estimate: DOUBLE, pv_estimate10: DOUBLE, pv_estimate90: DOUBLE,
  period_end: TIMESTAMP, period: STRING>>
"""

_CONDITION = "ARRAY<STRUCT<id: INT, main: STRING, description: STRING, icon: STRING>>"
_READING = """dt: BIGINT, temp: DOUBLE, feels_like: DOUBLE, pressure: DOUBLE, humidity: DOUBLE,
  dew_point: DOUBLE, uvi: DOUBLE, clouds: DOUBLE, visibility: DOUBLE, wind_speed: DOUBLE,
  wind_deg: DOUBLE"""
WEATHER = f"""
timezone STRING,
current STRUCT<{_READING}, sunrise: BIGINT, sunset: BIGINT, weather: {_CONDITION}>,
hourly ARRAY<STRUCT<{_READING}, wind_gust: DOUBLE, pop: DOUBLE, rain: STRUCT<`1h`: DOUBLE>,
  snow: STRUCT<`1h`: DOUBLE>, weather: {_CONDITION}>>,
daily ARRAY<STRUCT<dt: BIGINT, sunrise: BIGINT, sunset: BIGINT, moonrise: BIGINT,
  moonset: BIGINT, moon_phase: DOUBLE, summary: STRING,
  temp: STRUCT<day: DOUBLE, min: DOUBLE, max: DOUBLE, night: DOUBLE, eve: DOUBLE, morn: DOUBLE>,
  feels_like: STRUCT<day: DOUBLE, night: DOUBLE, eve: DOUBLE, morn: DOUBLE>,
  pressure: DOUBLE, humidity: DOUBLE, dew_point: DOUBLE, wind_speed: DOUBLE, wind_deg: DOUBLE,
  wind_gust: DOUBLE, clouds: DOUBLE, pop: DOUBLE, rain: DOUBLE, snow: DOUBLE, uvi: DOUBLE,
  weather: {_CONDITION}>>
"""

SUN_TIMES = "results STRUCT<sunrise: STRING, sunset: STRING>"

PRODUCTION_LOG = "date DATE, total_wh DOUBLE"

# Columns and precision of the stored tables.
TABLES = {
    "inverter_data": """
        timestamp TIMESTAMP, p_battery DECIMAL(7,2), p_grid DECIMAL(7,2),
        p_local DECIMAL(7,2), p_solar DECIMAL(7,2), pct_selfsufficient DECIMAL(4,1),
        pct_autonomy DECIMAL(4,1), p_total DECIMAL(7,2), battery_state DECIMAL(4,1),
        battery_state_norm DECIMAL(4,1), e_day DECIMAL(6,0), e_year DECIMAL(8,0),
        e_total DECIMAL(10,0)""",
    "consumption": """
        timestamp TIMESTAMP, dev_id INT, device_id STRING, amps DOUBLE, watts DOUBLE,
        volts DOUBLE, device_location STRING, comment STRING""",
    "price_data": """
        timestamp TIMESTAMP, price DECIMAL(7,2), rolling_sum DECIMAL(7,2),
        currency VARCHAR(3)""",
    "solar_forecast": """
        timestamp TIMESTAMP, pv_estimate DECIMAL(6,4), pv_estimate10 DECIMAL(6,4),
        pv_estimate90 DECIMAL(6,4)""",
    "weather_hourly": """
        date TIMESTAMP, temp DECIMAL(6,2), feels_like DECIMAL(6,2), pressure DECIMAL(6,0),
        humidity DECIMAL(3,0), dew_point DECIMAL(6,2), uvi DECIMAL(6,2),
        clouds DECIMAL(3,0), visibility DECIMAL(6,0), wind_speed DECIMAL(6,2),
        wind_deg DECIMAL(3,0), wind_gust DECIMAL(6,2), pop DECIMAL(6,2), id DECIMAL(3,0),
        main VARCHAR(20), description VARCHAR(50), icon VARCHAR(5), rain DECIMAL(6,2),
        snow DECIMAL(6,2), during_day BOOLEAN""",
    "weather_sunrise": """
        date DATE, sunrise TIMESTAMP, sunset TIMESTAMP, summary VARCHAR(125)""",
    "daily_summary": """
        date DATE, min_battery DECIMAL(5,2), max_battery DECIMAL(5,2),
        min_battery_raw DECIMAL(5,2), max_battery_raw DECIMAL(5,2), first_1kw TIMESTAMP,
        last_1kw TIMESTAMP, first_2kw TIMESTAMP, last_2kw TIMESTAMP, first_prod TIMESTAMP,
        last_prod TIMESTAMP, peak_solar DECIMAL(7,2), daily_total DECIMAL(6,0),
        daily_solar_est DECIMAL(3,0), battery_at_1am DECIMAL(5,2),
        battery_at_5am DECIMAL(5,2), night_grid_charge BOOLEAN""",
}

# The key of each stored table.
TABLE_KEYS = {
    "inverter_data": ["timestamp"],
    "consumption": ["timestamp", "dev_id"],
    "price_data": ["timestamp"],
    "solar_forecast": ["timestamp"],
    "weather_hourly": ["date"],
    "weather_sunrise": ["date"],
    "daily_summary": ["date"],
}


def table_schema(name: str) -> T.StructType:
    """Schema of a stored table; text columns keep their declared length."""
    return T.StructType.fromDDL(TABLES[name])
