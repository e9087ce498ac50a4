"""Parsers on hand-written payloads."""

import json
from datetime import date, datetime

import pytest

from homegrid.plans import jobs
from homegrid.sources import payloads, tables


def bodies(spark, *texts):
    return spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "body string")


def power_flow(stamp="2022-02-03T10:11:12+01:00", soc=75.5, pv=7.8, **site):
    inverter = {"Battery_Mode": "normal", "DT": 1, "P": 421}
    if soc != "missing":
        inverter["SOC"] = soc
    site = {
        "E_Day": 1200, "E_Total": 90000, "E_Year": 8100, "P_Akku": 310.5, "P_Grid": 12.4,
        "P_Load": -330.7, "P_PV": pv, "rel_Autonomy": 88.6, "rel_SelfConsumption": 97, **site,
    }
    data = {"Inverters": {"1": inverter}, "Site": site, "Version": "12"}
    head = {"RequestArguments": {}, "Status": {"Code": 0}, "Timestamp": stamp}
    return {"Body": {"Data": data}, "Head": head}


def test_power_flow(spark):
    row = payloads.parse_power_flow(bodies(spark, power_flow())).first()
    assert row.timestamp == datetime(2022, 2, 3, 9, 11, 12)
    assert (row.p_battery, row.p_grid, row.p_local, row.p_solar, row.p_total) == (310.5, 12.4, -330.7, 7.8, 421)
    assert (row.pct_selfsufficient, row.pct_autonomy) == (97, 88.6)
    assert (row.battery_state, row.battery_state_norm) == (75.5, 74.2)
    assert (row.e_day, row.e_year, row.e_total) == (1200, 8100, 90000)


def test_power_flow_with_comments(spark):
    text = json.dumps(power_flow(), indent=2).replace('"P": 421,', '"P": 421,  // watts now')
    assert payloads.parse_power_flow(bodies(spark, "// reading\n" + text)).first().p_total == 421


@pytest.mark.parametrize(
    "soc, norm", [(None, 0), ("missing", 0), (3, 0), (5.9, 0), (6, 1.1), (50, 47.4), (99, 98.9), (99.5, 100)]
)
def test_battery_levels(spark, soc, norm):
    assert payloads.parse_power_flow(bodies(spark, power_flow(soc=soc))).first().battery_state_norm == norm


def test_night_and_summer_offset(spark):
    row = payloads.parse_power_flow(bodies(spark, power_flow("2021-07-01T02:00:00+02:00", pv=None))).first()
    assert row.timestamp == datetime(2021, 7, 1) and row.p_solar == 0


def test_bad_power_flow_is_dropped(spark):
    no_inverter = power_flow()
    no_inverter["Body"]["Data"]["Inverters"] = {}
    df = bodies(spark, power_flow(), "{oops", no_inverter, power_flow(stamp="yesterday"), "{}", "")
    assert payloads.parse_power_flow(df).count() == 1
    assert payloads.bad_rows(df).count() == 5


@pytest.mark.parametrize("missing", [*payloads.SITE_FIELDS.values(), "P"])
def test_a_missing_field_is_a_reject_and_a_null_is_0(spark, missing):
    short, null = power_flow(), power_flow()
    for flow in (short, null):
        fields = flow["Body"]["Data"]["Inverters"]["1"] if missing == "P" else flow["Body"]["Data"]["Site"]
        fields[missing] = None
    del (short["Body"]["Data"]["Inverters"]["1"] if missing == "P" else short["Body"]["Data"]["Site"])[missing]
    df = bodies(spark, short, null)
    assert payloads.parse_power_flow(df).count() == payloads.bad_rows(df).count() == 1


PLUG = {"status": {"dps": {"1": True, "18": 500, "19": 1150, "20": 2300, "38": "memory"}}, "dev_id": 1,
        "device_id": "x", "received_at": "2024-01-01T00:00:05.7Z"}


def test_plug_status(spark):
    t = 1704067200
    cases = [
        ({"update": {"dps": {"18": 700, "19": 1610, "20": 2310}, "t": t}}, (0.7, 161.0, 231.0), 0),
        ({"update": {"dps": {"19": 0}, "t": t}}, (0.5, 115.0, 230.0), 0),
        ({"update": None}, (0.5, 115.0, 230.0), 5),
        ({"update": {"dps": {"18": 0}, "t": t}, "status": {"dps": {"18": 500, "20": 2300}}}, (0.5, 115.0, 230.0), 0),
        ({"update": {"dps": {}}, "status": {"dps": {}}}, (0.0, 0.0, 0.0), 5),
    ]
    for change, values, second in cases:
        row = payloads.parse_plug_status(bodies(spark, {**PLUG, **change})).first()
        assert (row.amps, row.watts, row.volts) == pytest.approx(values)
        assert row.timestamp == datetime(2024, 1, 1, 0, 0, second)
        assert (row.dev_id, row.device_id, row.device_location, row.comment) == (1, "x", "", "")


def price_body(start, values, hours=1, area="DK2"):
    items = [
        {"start": f"2023-10-{start:02d}T{i * hours:02d}:00:00Z", "end": f"2023-10-{start:02d}T{i * hours:02d}:59:59Z", "value": v}
        for i, v in enumerate(values)
    ]
    return {"areas": {area: {"values": items}}}


def test_prices(spark):
    df = bodies(spark, price_body(1, [500.0, None]))
    rows = payloads.parse_prices(df, "DK2", "DKK").orderBy("timestamp").collect()
    assert [(r.timestamp, r.price, r.currency) for r in rows] == [
        (datetime(2023, 10, 1, 0), 0.5, "DKK"),
        (datetime(2023, 10, 1, 1), None, "DKK"),
    ]
    assert payloads.parse_prices(df, "SE4", "SEK").count() == 0


def test_price_job(spark):
    """Hourly prices, tomorrow repeats today's last hour with another price."""
    def fetch(body):
        return payloads.parse_prices(bodies(spark, body), "DK2", "DKK", position=True)

    today = fetch(price_body(1, [1000.0 * i for i in range(24)]))
    out = jobs.day_ahead_prices(today, None).orderBy("timestamp").collect()
    assert len(out) == 24
    assert [r.rolling_sum for r in out[:2]] == [(0 + 1 + 2) / 4, (1 + 2 + 3) / 4]
    assert [r.rolling_sum for r in out[-2:]] == [None, None]

    body = price_body(2, [7000.0])
    body["areas"]["DK2"]["values"].insert(
        0, {"start": "2023-10-01T23:00:00Z", "end": "2023-10-01T23:59:59Z", "value": 9000.0}
    )
    both = jobs.day_ahead_prices(today, fetch(body)).collect()
    at = {}
    for r in both:
        at.setdefault(r.timestamp, []).append(r.price)
    # the earlier fetch of 23:00 moves to 22:00, the later one stays
    assert sorted(at[datetime(2023, 10, 1, 22)]) == [22.0, 23.0]
    assert at[datetime(2023, 10, 1, 23)] == [9.0]


def test_price_history_job(spark):
    rows = [("2023-10-01 00:00:00", 1.0, 0), ("2023-10-01 00:00:00", 2.0, 1), ("2023-10-01 04:00:00", float("inf"), 2),
            ("2023-10-01 05:00:00", 3.0, 3)]
    df = spark.createDataFrame(rows, "timestamp string, price double, arrival int").selectExpr(
        "cast(timestamp as timestamp) timestamp", "price", "'DKK' currency", "arrival"
    )
    out = jobs.price_history(df, "arrival").orderBy("timestamp").collect()
    assert len(out) == 21 and {r.price for r in out[:20]} == {2.0} and out[-1].price == 3.0
    assert out[0].rolling_sum == 6.0 and out[9].rolling_sum == (11 * 2 + 3) / 4 and out[10].rolling_sum is None


def test_solar_forecast(spark):
    body = {"forecasts": [{"pv_estimate": 1.5, "pv_estimate10": 1.0, "pv_estimate90": 2.0,
                           "period_end": "2024-06-01T00:30:00.0000000Z", "period": "PT30M"}]}
    row = payloads.parse_solar_forecast(bodies(spark, body)).first()
    assert tuple(row) == (datetime(2024, 6, 1), 1.5, 1.0, 2.0)


CLEAR = [{"id": 800, "main": "Clear", "description": "clear sky", "icon": "01d"}]
MIST = {"id": 701, "main": "Mist", "description": "mist", "icon": "50d"}
WEATHER = {
    "timezone": "Europe/Copenhagen",
    "current": {"dt": 1717232400, "sunrise": 1717208000, "sunset": 1717269000, "temp": 20.5, "weather": [*CLEAR, MIST]},
    "hourly": [
        {"dt": 1717200000, "temp": 11.0, "rain": {"1h": 0.4}, "weather": [*CLEAR, MIST], "unknown": 1},
        {"dt": 1717203600, "temp": 12.0, "snow": {"1h": 0.1}, "weather": CLEAR},
        {"dt": 1717207200, "temp": 13.0, "weather": CLEAR},
    ],
    "daily": [
        {"dt": 1717236000, "sunrise": 1717208000, "sunset": 1717269000, "moonrise": 1717200000, "moonset": 1717240000,
         "summary": "fine", "temp": {"day": 20.0, "min": 10.0}, "feels_like": {"day": 19.0}, "weather": CLEAR}
    ],
}


def test_weather(spark):
    df = bodies(spark, WEATHER)
    hourly = payloads.parse_weather_hourly(df).orderBy("date").collect()
    assert [(r.rain, r.snow, r.id) for r in hourly] == [(0.4, 0, 800), (0, 0.1, 800), (0, 0, 800)]
    assert hourly[0].date == datetime(2024, 6, 1) and hourly[0].local_time == datetime(2024, 6, 1, 2)
    day = payloads.parse_weather_daily(df).first()
    assert (day.date, day.summary, day.main) == (date(2024, 6, 1), "fine", "Clear")
    assert (day.temp_day, day.temp_min, day.temp_max, day.feels_like_day) == (20, 10, None, 19)
    now = payloads.parse_weather_current(df).collect()
    assert [r.main for r in now] == ["Clear", "Mist"] and now[0].dt == datetime(2024, 6, 1, 11)


def test_sun_times(spark):
    body = json.dumps({"results": {"sunrise": "2020-01-01T07:36:53+00:00", "sunset": "2020-01-01T14:47:00+00:00"}})
    df = spark.createDataFrame([("2020-01-01", body), ("2020-01-02", "{oops")], "date string, body string")
    rows = payloads.parse_sun_times(df).orderBy("date").collect()
    assert rows[0][:3] == (date(2020, 1, 1), datetime(2020, 1, 1, 7, 36, 53), datetime(2020, 1, 1, 14, 47))
    assert rows[1].sunrise is None


def test_production_log(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("date,total_wh\n2024-01-01,100\n2024-01-02,200\n2024-01-03,300\n")
    days = tables.read_production_log(spark, str(path), "2024-01-03")
    assert [(str(r.date), r.e_day) for r in days.orderBy("date").collect()] == [("2024-01-01", 100), ("2024-01-02", 200)]
    stored = spark.sql("select date'2024-01-01' as date")
    assert tables.read_production_log(spark, str(path), "2024-01-03", stored).count() == 1
    assert tables.read_production_log(spark, str(path), "2024-01-03", stored.limit(0)).count() == 2


def test_dates(spark):
    spine = tables.date_spine(spark, "2024-02-27", "2024-03-01")
    assert spine.count() == 4
    assert [str(r.date) for r in tables.recent_dates(spark, "2024-03-01", 2).collect()] == ["2024-02-29", "2024-03-01"]
    stored = spark.sql("select date'2024-02-29' as date")
    assert [str(r.date) for r in tables.missing_dates(spine, stored).collect()] == ["2024-02-27", "2024-02-28"]
    assert tables.missing_dates(spine, stored.limit(0)).count() == 4


def test_a_corrupt_plug_text_is_a_reject_and_no_row(spark):
    df = spark.createDataFrame([("{oops",), ("{}",)], "body string")
    assert payloads.parse_plug_status(df).count() == 0
    assert payloads.plug_rejects(df).count() == 2


# -- reasons, counts and files --------------------------------------------------------


def some_flows(spark):
    no_power, no_grid = power_flow(), power_flow()
    del no_power["Body"]["Data"]["Inverters"]["1"]["P"], no_grid["Body"]["Data"]["Site"]["P_Grid"]
    return bodies(spark, power_flow(), power_flow("2022-02-03T10:11:17+01:00"), "{oops", no_power, no_grid, power_flow(stamp="later"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rejects_have_a_reason(spark):
    reasons = sorted(r.reason for r in payloads.rejects(some_flows(spark), "power_flow").collect())
    assert reasons == ["no P", "no P_Grid", "no time", "unreadable"]
    plugs = bodies(spark, PLUG, "{", {**PLUG, "dev_id": None}, {**PLUG, "received_at": None})
    assert sorted(r.reason for r in payloads.rejects(plugs, "plug_status").collect()) == ["no device", "no time", "unreadable"]
    prices = bodies(spark, price_body(1, [5.0]), price_body(1, [5.0], area="SE4"), price_body(1, []), "[")
    assert sorted(r.reason for r in payloads.rejects(prices, "prices", area="DK2").collect()) == ["no rows", "no rows", "unreadable"]
    for kind, good in (
        ("solar_forecast", {"forecasts": [{"pv_estimate": 1.0}]}),
        ("weather_hourly", {"hourly": [{"dt": 1}]}),
        ("weather_daily", {"daily": [{"dt": 1}]}),
        ("weather_current", {"current": {"dt": 1, "weather": [{"id": 1}]}}),
        ("sun_times", {"results": {"sunrise": "2024-01-01T07:00:00+00:00"}}),
    ):
        df = bodies(spark, good, {}, "{cut")
        assert sorted((r.body, r.reason) for r in payloads.rejects(df, kind).collect()) == [("{cut", "unreadable"), ("{}", "no rows")]


def test_rejects_are_counted_in_the_pass_that_parses(spark, tmp_path):
    """Counts equal a second pass, and the files are read once."""
    from collections import Counter

    from pyspark.sql import Observation

    some_flows(spark).write.parquet(str(tmp_path / "flows"))
    df = spark.read.parquet(str(tmp_path / "flows"))
    seen = Observation("flows")
    rows = payloads.parse_power_flow(df, observed=seen)
    assert plan_of(rows).count("FileScan") == 1
    accepted = len(rows.collect())
    counts = {k: v for k, v in seen.get.items() if v}
    again = Counter(r.reason for r in payloads.rejects(df, "power_flow").collect())
    assert counts == {"payloads": 6, "accepted": accepted, **{f"rejected: {r}": n for r, n in again.items()}}

    forecasts = bodies(spark, {"forecasts": [{"pv_estimate": 1.0}, {"pv_estimate": 2.0}]}, {"forecasts": []}, "{")
    seen = Observation("forecasts")
    assert len(payloads.parse_solar_forecast(forecasts, observed=seen).collect()) == 2
    assert seen.get == {"payloads": 3, "accepted": 1, "rejected: unreadable": 1, "rejected: no rows": 1}


def test_lost_values_are_counted_while_they_are_conformed(spark):
    from pyspark.sql import Observation

    from homegrid.sinks import typed

    df = spark.sql("select * from values (timestamp'2024-01-01', 1.5D, 1e9D), (timestamp'2024-01-02', 1e9D, 2.0D) t(timestamp, price, rolling_sum)")
    seen = Observation("prices")
    typed.conform(df, "price_data", "null", seen).collect()
    assert seen.get == {"rows": 2, "lost: timestamp": 0, "lost: price": 1, "lost: rolling_sum": 1}
    assert typed.conform_rejects(df, "price_data").count() == 2


def written(folder, name, payload, age):
    import os

    text = "// reading\n" + json.dumps(payload, indent=4).replace('"P": 421,', '"P": 421, // watts now') + "\n"
    assert text.count("\n") > 20
    (folder / name).write_text(text)
    os.utime(folder / name, (1_700_000_000 - age, 1_700_000_000 - age))


def test_payload_files_of_many_lines(spark, tmp_path):
    written(tmp_path, "b.json", power_flow(pv=1.0), age=100)
    written(tmp_path, "a.json", power_flow(pv=2.0), age=50)
    written(tmp_path, "c.json", power_flow(pv=3.0), age=50)
    files = payloads.payload_files(spark, str(tmp_path))
    rows = payloads.parse_power_flow(files, keep=["arrival"]).orderBy("arrival").collect()
    assert [r.p_solar for r in rows] == [1.0, 2.0, 3.0] and {r.p_total for r in rows} == {421}


def test_stream_of_payload_files(spark, tmp_path):
    """The first file of a time stays, whatever its name; rejects are counted by batch."""
    from homegrid.streaming import ingest

    landing = tmp_path / "landing"
    landing.mkdir()
    written(landing, "z.json", power_flow(pv=1.0), age=100)
    written(landing, "a.json", power_flow(pv=2.0), age=50)
    (landing / "bad.json").write_text("{oops")
    files = payloads.payload_files(spark, str(landing), stream=True)
    query = ingest.stream_ingest(
        files, lambda df: payloads.parse_power_flow(df, keep=["arrival"], observed="flows"),
        str(tmp_path / "table"), str(tmp_path / "checkpoint"), arrival="arrival",
    )
    query.awaitTermination()
    assert query.exception() is None
    assert [r.p_solar for r in spark.read.parquet(str(tmp_path / "table")).collect()] == [1.0]
    counts = [p.observedMetrics["flows"] for p in query.recentProgress if "flows" in p.observedMetrics]
    assert sum(c.accepted for c in counts) == 2 and sum(c["rejected: unreadable"] for c in counts) == 1
