"""Household electricity time series as Spark jobs."""

from homegrid.functions import normalize_soc, tariff_offset
from homegrid.operators.cluster import (
    cluster_cycles,
    cluster_devices,
    cluster_profiles,
    cluster_usage,
    k_sweep,
    silhouettes,
)
from homegrid.operators.cycles import (
    cycle_marks,
    cycle_pairs,
    cycle_profiles,
    cycle_span,
    cycle_steps,
    profile_grid,
    with_cycle_label,
    with_minutes,
)
from homegrid.operators.daily import (
    backfill_night_charge,
    backfill_solar_estimate,
    backfill_window,
    battery_snapshot,
    daily_summary,
    day_summary,
    incremental_days,
    merge_production_log,
    night_charge,
)
from homegrid.operators.dashboard import (
    battery_gauge,
    battery_latest,
    forecast_series,
    forecast_view,
)
from homegrid.operators.devices import (
    device_counts,
    device_location,
    device_readings,
    label_devices,
    second_means,
)
from homegrid.operators.prices import (
    clean_prices,
    first_midnight,
    price_span,
    price_view,
    union_prices,
    with_tariff,
)
from homegrid.operators.series import (
    bfill_intervals,
    dedupe_first,
    dedupe_last,
    dst_repair,
    energy_daily,
    resample_bfill,
    resample_ffill,
    rolling_row_sum,
    rolling_time_sum,
    sampling_step,
)
from homegrid.operators.weather import sun_clock, sun_lookup, with_daylight
from homegrid.plans.jobs import (
    appliance_profiles,
    appliance_steps,
    appliance_summary,
    day_ahead_prices,
    price_history,
)
from homegrid.session import session
from homegrid.sinks.keyed import (
    append_days,
    insert_new,
    keyed_replace,
    write_keyed,
    write_new,
)
from homegrid.sinks.typed import conform, conform_rejects
from homegrid.sources.payloads import (
    bad_rows,
    parse_plug_status,
    parse_power_flow,
    parse_prices,
    parse_solar_forecast,
    parse_sun_times,
    parse_weather_current,
    parse_weather_daily,
    parse_weather_hourly,
    payload_files,
    rejects,
)
from homegrid.sources.tables import (
    date_bounds,
    date_spine,
    missing_dates,
    newest_rows,
    read_production_log,
    read_table,
    recent_dates,
)
from homegrid.streaming.ingest import (
    payload_stream,
    start_day_summary,
    stream_day_summary,
    stream_dedupe,
    stream_ingest,
)

__all__ = [name for name in dir() if not name.startswith("_")]
