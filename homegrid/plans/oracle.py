"""The queries of :mod:`homegrid.plans.catalog` as SQL over the same files.

They are written the direct way, with global windows, dense grids and as-of joins.
"""

from __future__ import annotations

# Grid tariff per kWh; low before 6, peak from 17 to 20, high otherwise.
RATES = {"summer": (0.1220, 0.1831, 0.4760), "winter": (0.1220, 0.3661, 1.0985)}
SLOT = "time_bucket(interval 15 minute, ts)"

VIEWS = {
    "telemetry": """
        select event_id, ts as timestamp, value * 20 as p_solar,
               cast(regexp_extract(props, '([0-9]+)', 1) as double) as battery_state,
               cast(hour(ts) * 100 + minute(ts) as int) as e_day
        from events""",
    "consumption": """
        select ts as timestamp, cast(user_id % 3 as int) as dev_id,
               case when event_type = 'error' then 0.0::double else value * 10 end as watts,
               230::double as volts,
               case user_id % 3 when 0 then 'dishwasher' when 1 then 'laundry machine'
                    else '' end as device_location,
               event_type
        from events""",
    "prices_raw": f"""
        select {SLOT} as timestamp, max_by(value, (ts, event_id)) * 10 as price
        from events group by 1""",
    "sun": """
        select distinct cast(ts as date) as date,
               cast(cast(ts as date) as timestamp) + interval 8 hour as sunrise,
               cast(cast(ts as date) as timestamp) + interval 16 hour as sunset,
               'fine' as summary
        from events where dayofmonth(ts) <> 17""",
    "production_log": """
        select cast(ts as date) + 20 as date, cast(count(*) * 100 as double) as e_day
        from events group by 1""",
    "summary_stored": """
        select cast(ts as date) as date, max(value * 20) as peak_solar,
               case when dayofmonth(cast(ts as date)) <= 10 then 1::double end as daily_solar_est,
               case when dayofmonth(cast(ts as date)) <= 10 then false end as night_grid_charge
        from events where dayofmonth(ts) <= 20 group by 1""",
    "hourly": """
        select date_trunc('hour', ts) as date, count(*)::double as temp from events group by 1""",
    "slots": f"""
        select {SLOT} as timestamp, value * 10 as price, event_id as arrival from events""",
    "kwh_prices": "select timestamp, price / 1000 as price from prices_raw",
    "forecast": """
        select time_bucket(interval 30 minute, ts) as timestamp, sum(value) / 1000 as pv_estimate,
               min(value) / 100 as pv_estimate10, max(value) / 100 as pv_estimate90
        from events group by 1""",
    "norm": """
        select event_id, timestamp, battery_state, round_even((battery_state - 5) * 100 / 95, 1) as a,
               round_even((battery_state - 12) * 100 / 86, 1) as b
        from telemetry""",
    "battery": """
        select timestamp, case when a < 1 then 0 when a > 99 then 100 else a end as battery_state_norm
        from norm""",
    # daily
    "diary": """
        select cast(timestamp as date) as date,
               min(battery_state) as min_battery_raw, max(battery_state) as max_battery_raw,
               min(level) as min_battery, max(level) as max_battery,
               min(timestamp) filter (p_solar >= 50) as first_prod,
               max(timestamp) filter (p_solar >= 50) as last_prod,
               min(timestamp) filter (p_solar >= 1000) as first_1kw,
               max(timestamp) filter (p_solar >= 1000) as last_1kw,
               min(timestamp) filter (p_solar >= 2000) as first_2kw,
               max(timestamp) filter (p_solar >= 2000) as last_2kw,
               round(max(p_solar), 4) as peak_solar,
               cast(coalesce(max(e_day), 0) as int) as daily_total
        from (select t.*, battery_state_norm as level
              from telemetry t join battery b using (timestamp))
        group by 1""",
    "ranked": """
        select cast(timestamp as date) as date, battery_state,
               row_number() over (partition by cast(timestamp as date) order by
                 abs(epoch_us(timestamp) % 86400000000 - 3600000000), timestamp) as one,
               row_number() over (partition by cast(timestamp as date) order by
                 abs(epoch_us(timestamp) % 86400000000 - 18000000000), timestamp) as five
        from telemetry where epoch_us(timestamp) % 86400000000 < 28800000000""",
    "snapshots": """
        select d.date, coalesce(a.battery_state, 0) as battery_at_1am,
               coalesce(b.battery_state, 0) as battery_at_5am
        from (select distinct cast(timestamp as date) as date from telemetry) d
        left join ranked a on a.date = d.date and a.one = 1
        left join ranked b on b.date = d.date and b.five = 1""",
    "spans": """
        select timestamp, p_solar, epoch_us(timestamp) // 1000000 as hi,
               lag(epoch_us(timestamp) // 1000000) over (order by timestamp) + 1 as lo
        from telemetry""",
    "dense": """
        select p_solar, make_timestamp(1000000 * unnest(generate_series(coalesce(lo, hi), hi))) as g
        from spans""",
    "energy": """
        select cast(g as date) as date, sum(p_solar) / 3600000 as kwh from dense group by 1""",
    # cycles
    "located": "select * from consumption where device_location <> ''",
    "means_all": """
        select dev_id, date_trunc('second', timestamp) as timestamp, avg(watts) as watts,
               avg(volts) as volts
        from consumption group by 1, 2""",
    "means": """
        select dev_id, timestamp, watts, epoch(timestamp)::bigint as s from means_all""",
    "neighbours": """
        select *, lead(watts) over w as next_watts, lag(s) over w as prev_s,
               max(s) over (partition by dev_id) as series_end
        from means window w as (partition by dev_id order by s)""",
    "looking_ahead": """
        select *, first(case when watts > 0 then prev_s end ignore nulls) over (
                 partition by dev_id order by s rows between 1 following and unbounded following)
                 as zero_until
        from neighbours""",
    "marks": """
        select dev_id, timestamp, s,
               case when watts = 0 and next_watts > 0 then 'start'
                    when watts > 0 and next_watts = 0
                     and (series_end - s < 300 or coalesce(zero_until, series_end) - s >= 300)
                    then 'end' end as mark
        from looking_ahead""",
    "next_ends": """
        select *, min(case when mark = 'end' then timestamp end) over (
                 partition by dev_id order by s rows between 1 following and unbounded following)
                 as cycle_end
        from marks where mark is not null""",
    "pairs": """
        select dev_id, min(timestamp) as cycle_start, cycle_end,
               epoch(cycle_end - min(timestamp))::bigint as seconds
        from next_ends
        where mark = 'start' and cycle_end - timestamp > interval 5400 second
        group by dev_id, cycle_end""",
    # every second with the next reading, cut into cycles
    "seconds": """
        select dev_id, s as reading, watts, unnest(generate_series(coalesce(prev_s + 1, s), s)) as g
        from neighbours where dev_id <> 2""",
    "profiles": """
        select dev_id, cycle_start, g - epoch(cycle_start)::bigint as t, watts, reading
        from seconds join pairs using (dev_id)
        where g between epoch(cycle_start)::bigint and epoch(cycle_end)::bigint""",
    "steps": """
        select dev_id, cycle_start, min(t) as lo, max(t) as hi, any_value(watts) as watts
        from profiles group by dev_id, cycle_start, reading""",
    "labels": """
        select dev_id, cycle_start,
               case when seconds < 7200 then 0 when seconds < 10800 then 1 else 2 end as cluster
        from pairs where dev_id <> 2""",
    "sizes": "select dev_id, cluster, count(*) as cycles from labels group by 1, 2",
    # mean watts of every second, and whether a cycle of the cluster changes or has ended there
    "cluster_seconds": """
        select dev_id, cluster, t, sum(watts) as watts, bool_or(is_new) as is_new, count(*) as alive
        from (select dev_id, cycle_start, t, cast(watts as decimal(28, 9)) as watts,
                     reading is distinct from lag(reading) over (partition by dev_id, cycle_start order by t) as is_new
              from profiles)
        join labels using (dev_id, cycle_start) group by 1, 2, 3""",
    "cluster_runs": """
        select *, sum(case when is_new or alive <> before then 1 else 0 end) over (partition by dev_id, cluster order by t) as run
        from (select *, lag(alive, 1, 0) over (partition by dev_id, cluster order by t) as before from cluster_seconds)""",
    # price view
    "rolled": """
        select timestamp, price, lead(s, 11) over (order by timestamp) as rolling_sum
        from (select *, sum(price) over (order by timestamp range between
                interval '10799.999999 seconds' preceding and current row) / 4 as s
              from kwh_prices)""",
    "ffill": """
        select g as timestamp, price from (
          select unnest(generate_series(min(timestamp), max(timestamp), interval 15 minute)) as g
          from prices_raw) asof left join prices_raw p on g >= p.timestamp""",
}

#: Marks a view whose rows are to be computed once, however often it is used.
KEPT = "materialized:"
#: k-means is at rest after fewer rounds on the given tables; the rounds after that change nothing.
ROUNDS = 30


def _share(number: int) -> str:
    return f"-ln((cast('0x' || substr(md5(name || '|{number}'), 1, 8) as bigint) + 0.5) / 4294967296)"


def _fit(tag: str, population: str, ks: range) -> dict[str, str]:
    """k-means by way of inner products: a center is the set of its cycles, and its distance to a
    cycle a sum over their products. Nothing is computed with centers as rows of numbers."""
    out = {
        f"{tag}_cycles": f"""
            select {population} as g, dev_id, cycle_start, dev_id || '|' || strftime(cycle_start, '%Y-%m-%d %H:%M:%S') as name,
                   row_number() over (partition by {population} order by dev_id, cycle_start) as i
            from (select distinct dev_id, cycle_start from steps)""",
        f"{tag}_steps": f"select g, i, lo, hi, watts from steps join {tag}_cycles using (dev_id, cycle_start)",
        f"{tag}_segments": f"""
            select g, e, len from (
              select g, e, lead(e) over (partition by g order by e) - e as len
              from (select g, lo as e from {tag}_steps union select g, hi + 1 from {tag}_steps))
            where len is not null""",
        f"{tag}_cells": f"""
            select c.g, c.i, c.e, c.len, case when c.e <= p.hi then p.watts else 0 end as w
            from (select g, i, e, len from {tag}_cycles join {tag}_segments using (g)) c
            asof left join {tag}_steps p on c.g = p.g and c.i = p.i and c.e >= p.lo""",
        f"{tag}_x": f"""
            select g, i, e, x from (
              select g, i, e, sqrt(len) * (w - min(w) over span) / nullif(max(w) over span - min(w) over span, 0) as x
              from {tag}_cells window span as (partition by g, e))
            where x <> 0""",
        f"{tag}_products": f"""
            select a.g, a.i, b.i as j, sum(a.x * b.x) as v from {tag}_x a join {tag}_x b on a.g = b.g and a.e = b.e group by 1, 2, 3""",
        f"{tag}_gram": f"""
            select a.g, a.i, b.i as j, coalesce(v, 0) as v from {tag}_cycles a join {tag}_cycles b on a.g = b.g
            left join {tag}_products p on p.g = a.g and p.i = a.i and p.j = b.i""",
        f"{tag}_norms": f"select g, i, v as own from {tag}_gram where i = j",
        f"{tag}_seed_0": f"select g, 0 as cluster, arg_min(i, ({_share(0)}, name)) as i from {tag}_cycles group by 1",
        f"{tag}_gap_0": f"select g, i, 1e300::double as gap from {tag}_cycles",
    }
    for r in range(1, max(ks)):
        out[f"{tag}_gap_{r}"] = f"""
            select a.g, a.i, least(gap, a.own - 2 * p.v + b.own) as gap
            from {tag}_gap_{r - 1} q join {tag}_norms a on q.g = a.g and q.i = a.i
            join {tag}_seed_{r - 1} s on s.g = a.g join {tag}_norms b on b.g = s.g and b.i = s.i
            join {tag}_gram p on p.g = a.g and p.i = a.i and p.j = s.i"""
        out[f"{tag}_seed_{r}"] = f"""
            select g, {r} as cluster, arg_min(i, ({_share(r)} / gap, name)) as i
            from {tag}_gap_{r} join {tag}_cycles using (g, i) where gap > 1e-9 group by 1"""
    seeds = " union all ".join(f"select * from {tag}_seed_{r}" for r in range(max(ks)))
    out[f"{tag}_members_0"] = f"select g, k, cluster, i from ({seeds}) join (select unnest({list(ks)}) as k) on cluster < k"
    for r in range(ROUNDS + 1):
        out[f"{tag}_cross_{r}"] = f"""
            select g, k, cluster, p.i, avg(p.v) as v from {tag}_members_{r} m join {tag}_gram p using (g)
            where p.j = m.i group by 1, 2, 3, 4"""
        out[f"{tag}_inner_{r}"] = f"""
            select g, k, cluster, avg(v) as v from {tag}_members_{r} join {tag}_cross_{r} using (g, k, cluster, i) group by 1, 2, 3"""
        out[f"{tag}_label_{r}"] = f"""
            select c.g, c.k, c.i, arg_min(c.cluster, (own - 2 * c.v + s.v, c.cluster)) as cluster, min(own - 2 * c.v + s.v) as d
            from {tag}_cross_{r} c join {tag}_inner_{r} s using (g, k, cluster) join {tag}_norms n on n.g = c.g and n.i = c.i
            group by 1, 2, 3"""
        out[f"{tag}_members_{r + 1}"] = f"""
            select g, k, cluster, i from {tag}_label_{r} union all
            select g, k, cluster, i from {tag}_members_{r} anti join {tag}_label_{r} using (g, k, cluster)"""
    # mean squared distance of every cycle to every cluster
    out[f"{tag}_spread"] = f"""
        select c.g, c.k, c.i, c.cluster, n.own - 2 * c.v + z.mean_own as d, z.size from {tag}_cross_{ROUNDS} c
        join (select g, k, cluster, count(*) as size, avg(own) as mean_own
              from {tag}_label_{ROUNDS} join {tag}_norms using (g, i) group by 1, 2, 3) z using (g, k, cluster)
        join {tag}_norms n on n.g = c.g and n.i = c.i"""
    out[f"{tag}_scores"] = f"""
        select l.g, l.k, l.i,
               max(case when s.cluster = l.cluster then s.d * s.size / greatest(s.size - 1, 1) end) as near,
               max(case when s.cluster = l.cluster then s.size end) as size,
               min(case when s.cluster <> l.cluster then s.d end) as far
        from {tag}_label_{ROUNDS} l join {tag}_spread s on s.g = l.g and s.k = l.k and s.i = l.i group by 1, 2, 3"""
    return {name: KEPT + sql for name, sql in out.items()}


for _tag, _population, _ks in (("each", "dev_id", range(3, 4)), ("pool", "0", range(3, 4)), ("sweep", "dev_id", range(2, 10)), ("score", "dev_id", range(2, 6))):
    VIEWS.update(_fit(_tag, _population, _ks))
LAST = f"each_label_{ROUNDS} join each_cycles using (g, i)"


def tariff(ts: str) -> str:
    def band(season: str) -> str:
        low, high, peak = RATES[season]
        return f"case when hour({ts}) < 6 then {low} when hour({ts}) in (17, 18, 19, 20) then {peak} else {high} end"

    return (
        f"cast(case when month({ts}) in (4, 5, 6, 7, 8, 9) then {band('summer')}"
        f" else {band('winter')} end as double)"
    )


# Copenhagen is one hour ahead of UTC in January, where the given events are.
LOCAL = "(timestamp + interval 1 hour)"

for _name, _limit in (("view_rows", "limit 1000"), ("all_view_rows", "")):
    VIEWS[_name] = f"""
    select timestamp + interval 1 hour as timestamp, price, rolling_sum, 'DKK' as currency,
           {tariff(LOCAL)} as "offset", price + {tariff(LOCAL)} as price_with_tariff,
           price + {tariff(LOCAL)} < 0.65 as is_cheap, row_index, hour({LOCAL}) as hour
    from (select *, (row_number() over (order by timestamp) - 1)::int as row_index
          from (select * from rolled where timestamp >= timestamp '2024-01-10'
                order by timestamp {_limit}))
    where timestamp > timestamp '2024-01-10 19:10:00'"""

_LEVEL = "case when {0} < 1 then 0 when {0} > 99 then 100 else {0} end"

QUERIES = {
    "day_summary": "select * from diary",
    "battery_snapshot": "select * from snapshots",
    "night_charge": """
        select *, battery_at_1am + 10 < battery_at_5am as night_grid_charge from snapshots""",
    "solar_energy_daily": "select date, round(kwh, 4) as kwh from energy",
    "solar_energy_by_device": """
        select dev_id, cast(g as date) as date, round(sum(watts) / 3600000, 4) as kwh
        from (select dev_id, watts,
                make_timestamp(1000000 * unnest(generate_series(coalesce(lo, hi), hi))) as g
              from (select *, epoch_us(timestamp) // 1000000 as hi,
                      lag(epoch_us(timestamp) // 1000000) over
                        (partition by dev_id order by timestamp) + 1 as lo
                    from consumption))
        group by 1, 2""",
    "solar_energy_local_days": """
        select cast(g + interval 1 hour as date) as date, round(sum(p_solar) / 3600000, 4) as kwh
        from dense group by 1""",
    "incremental_days": """
        select event_id, timestamp, round(p_solar, 4) as p_solar from telemetry
        where cast(timestamp as date) > (select max(date) from summary_stored)
          and cast(timestamp as date) < date '2024-01-29'""",
    "daily_job": """
        select diary.*, battery_at_1am, battery_at_5am,
               battery_at_1am + 10 < battery_at_5am as night_grid_charge,
               round(coalesce(new_energy.kwh, 0), 4) as daily_solar_est
        from diary join snapshots using (date)
        left join (
          select cast(g as date) as date, sum(p_solar) / 3600000 as kwh
          from (select p_solar,
                  make_timestamp(1000000 * unnest(generate_series(coalesce(lo, hi), hi))) as g
                from (select p_solar, epoch_us(timestamp) // 1000000 as hi,
                        lag(epoch_us(timestamp) // 1000000) over (order by timestamp) + 1 as lo
                      from telemetry where timestamp >= date '2024-01-21' and timestamp < date '2024-01-30'))
          group by 1) new_energy using (date)
        where date > (select max(date) from summary_stored) and date < date '2024-01-30'""",
    "backfill_window": """
        select min(date) as start, cast(null as date) as "end" from summary_stored
        where daily_solar_est is null""",
    "solar_estimate_backfill": """
        select s.date, round(s.peak_solar, 4) as peak_solar,
               round(coalesce(e.kwh, 0), 4) as daily_solar_est
        from summary_stored s
        left join (
          select cast(g as date) as date, sum(p_solar) / 3600000 as kwh
          from (select p_solar,
                  make_timestamp(1000000 * unnest(generate_series(coalesce(lo, hi), hi))) as g
                from (select p_solar, epoch_us(timestamp) // 1000000 as hi,
                        lag(epoch_us(timestamp) // 1000000) over (order by timestamp) + 1 as lo
                      from telemetry
                where timestamp >= (select min(date) from summary_stored where daily_solar_est is null)))
          group by 1) e on e.date = s.date
        where s.date >= (select min(date) from summary_stored where daily_solar_est is null)""",
    "night_charge_backfill": """
        select s.date, round(peak_solar, 4) as peak_solar, daily_solar_est,
               coalesce(battery_at_1am, 0) as battery_at_1am,
               coalesce(battery_at_5am, 0) as battery_at_5am,
               coalesce(battery_at_1am, 0) + 10 < coalesce(battery_at_5am, 0) as night_grid_charge
        from summary_stored s left join snapshots using (date)
        where s.date >= (select min(date) from summary_stored where night_grid_charge is null)""",
    "merge_production_log": """
        select coalesce(d.date, l.date) as date, peak_solar,
               cast(coalesce(daily_total, l.e_day, 0) as int) as daily_total
        from diary d full join production_log l on d.date = l.date""",
    "production_log_new": """
        select date, e_day from production_log
        where date < date '2024-02-10' and date > (select max(date) from summary_stored)""",
    "scan_range": """
        select event_id, ts, value from events
        where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20'""",
    "date_spine": """
        select cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date
        from production_log""",
    "missing_dates": """
        select cast(d as date) as date
        from (select unnest(generate_series(min(date), max(date), interval 1 day)) as d from sun)
        where d < (select min(date) from production_log)""",
    "keyed_replace": """
        with again as (select timestamp, dev_id, 1.0::double as watts from consumption
                       where event_type = 'error'),
        later as (select timestamp + interval 31 day as timestamp, dev_id, watts from consumption
                  where event_type = 'signup'),
        batch as (select * from again union all select * from later)
        select timestamp, dev_id, round(watts, 4) as watts from consumption
        where (timestamp, dev_id) not in (select (timestamp, dev_id) from batch)
        union all select timestamp, dev_id, round(watts, 4) from batch""",
    "keyed_replace_plug": """
        with rows as (select date_trunc('second', timestamp) as timestamp, dev_id, watts, event_type
                      from consumption)
        select timestamp, dev_id, round(watts, 4) as watts from rows
        where timestamp not in (select timestamp from rows where event_type = 'error')
        union all select timestamp, dev_id, 1.0 from rows where event_type = 'error'""",
    "insert_new": f"""
        with clicks as (select {SLOT} as timestamp, value * 10 as price, event_id as arrival
          from events where event_type = 'click'
          qualify row_number() over (partition by {SLOT} order by event_id) = 1),
        firsts as (select * from slots
          qualify row_number() over (partition by timestamp order by arrival) = 1)
        select timestamp, round(price, 4) as price, arrival from clicks
        union all select timestamp, round(price, 4), arrival from firsts
        where timestamp not in (select timestamp from clicks)""",
    "label_devices": """
        select timestamp, dev_id, round(watts, 4) as watts, volts,
               case when dev_id = 1 then device_location else 'socket ' || dev_id end
                 as device_location
        from consumption""",
    "price_union": "select timestamp, round(price, 4) as price from prices_raw",
    "clean_prices": """
        select event_id, round(value, 4) as price from events where event_type = 'purchase'""",
    "dedupe_last": """
        select timestamp, round(price, 4) as price, arrival from slots
        qualify row_number() over (partition by timestamp order by arrival desc) = 1""",
    "dst_repair": """
        select case when row_number() over (partition by timestamp order by arrival desc) > 1
                    then timestamp - interval 1 hour else timestamp end as timestamp,
               round(price, 4) as price, arrival
        from slots""",
    "resample_ffill": "select timestamp, round(price, 4) as price from ffill",
    "resample_ffill_off_grid": """
        select g as timestamp, round(p_solar, 4) as p_solar from (
          select unnest(generate_series(time_bucket(interval 5 minute, min(timestamp)),
            time_bucket(interval 5 minute, max(timestamp)), interval 5 minute)) as g
          from telemetry) asof left join telemetry t on g >= t.timestamp""",
    "price_step": """
        select median(step)::double as step_us, floor(10800000000 / median(step))::bigint as rows_in_window
        from (select epoch_us(timestamp) - lag(epoch_us(timestamp)) over (order by timestamp) as step
              from prices_raw)""",
    "price_rolling_time": """
        select timestamp, round(price * 1000, 4) as price, round(rolling_sum * 1000, 4) as rolling_sum
        from rolled""",
    "price_rolling_rows": """
        select timestamp, round(price, 4) as price,
               round(case when count(price) over w = 12 then sum(price) over w / 4 end, 4)
                 as rolling_sum
        from ffill window w as (order by timestamp rows between current row and 11 following)""",
    "price_history": """
        select timestamp, round(price, 4) as price, 'DKK' as currency,
               round(case when count(price) over w = 12 then sum(price) over w / 4 end, 4)
                 as rolling_sum
        from ffill window w as (order by timestamp rows between current row and 11 following)""",
    "price_job": """
        with rows_in as (
          select floor(10800000000 / median(step))::bigint as n
          from (select epoch_us(timestamp) - lag(epoch_us(timestamp)) over (order by timestamp) as step from prices_raw)),
        numbered as (
          select timestamp, price, row_number() over (order by timestamp) as i,
                 sum(price) over (order by timestamp range between
                   interval '10799.999999 seconds' preceding and current row) / 4 as s
          from prices_raw)
        select a.timestamp, round(a.price, 4) as price, round(b.s, 4) as rolling_sum, 'DKK' as currency
        from numbered a left join numbered b on b.i = a.i + (select n from rows_in) - 1""",
    "price_job_two_fetches": """
        with fetched as (
          select timestamp, price, 0 as part from prices_raw where timestamp < date '2024-01-16'
          union all select timestamp, price + 8, 1 from prices_raw where timestamp >= date '2024-01-15'),
        numbered as (select *, row_number() over (order by timestamp, part) as i from fetched),
        rows_in as (
          select floor(10800000000 / median(step))::bigint as n
          from (select epoch_us(timestamp) - lag(epoch_us(timestamp)) over (order by i) as step from numbered)),
        sums as (
          select a.i, sum(b.price) / 4 as s from numbered a
          join numbered b on b.i <= a.i and b.timestamp > a.timestamp - interval 3 hour group by 1)
        select case when a.part = 0 and a.timestamp >= date '2024-01-15' and a.timestamp in (select timestamp from fetched where part = 1)
                    then a.timestamp - interval 1 hour else a.timestamp end as timestamp,
               round(a.price, 4) as price, round(s.s, 4) as rolling_sum, 'DKK' as currency
        from numbered a left join sums s on s.i = a.i + (select n from rows_in) - 1""",
    "price_job_by_area": f"""
        with rows_of as (
          select cast(user_id % 3 as int) as area, {SLOT} as timestamp, max_by(value, (ts, event_id)) * 10 as price from events group by 1, 2),
        counts as (
          select area, floor(10800000000 / median(step))::bigint as n
          from (select area, epoch_us(timestamp) - lag(epoch_us(timestamp)) over (partition by area order by timestamp) as step from rows_of) group by 1),
        summed as (
          select *, row_number() over (partition by area order by timestamp) as i,
                 sum(price) over (partition by area order by timestamp range between
                   interval '10799.999999 seconds' preceding and current row) / 4 as s
          from rows_of)
        select a.area, a.timestamp, round(a.price, 4) as price, 'DKK' as currency, round(b.s, 4) as rolling_sum
        from summed a join counts c on a.area = c.area left join summed b on b.area = a.area and b.i = a.i + c.n - 1""",
    "price_span_by_area": f"""
        select area, case when cast(min(t) as date) = cast(max(t) as date) then cast(min(t) as date)::varchar
                          else cast(min(t) as date)::varchar || ' to ' || cast(max(t) as date)::varchar end as label,
               'DKK' as currency, min(t) filter (hour(t) = 0 and i > 1) as midnight
        from (select area, s + interval 1 hour as t, s, row_number() over (partition by area order by s) as i
              from (select distinct cast(user_id % 3 as int) as area, {SLOT} as s from events) where s >= date '2024-01-10')
        where s > timestamp '2024-01-10 19:10:00' group by 1""",
    "battery_latest_by_site": """
        select user_id % 5 as site_id, timestamp, battery_state_norm
        from (select event_id, timestamp, case when a < 1 then 0 when a > 99 then 100 else a end as battery_state_norm from norm)
        join events using (event_id)
        qualify row_number() over (partition by user_id % 5 order by timestamp desc) <= 50""",
    "price_tariff": f"""
        select timestamp, round(price, 4) as price, {tariff(LOCAL)} as "offset",
               round(price + {tariff(LOCAL)}, 4) as price_with_tariff,
               price + {tariff(LOCAL)} < 0.65 as is_cheap
        from kwh_prices""",
    "price_tariff_stored_time": f"""
        select timestamp, round(price, 4) as price, {tariff('timestamp')} as "offset",
               round(price + {tariff('timestamp')}, 4) as price_with_tariff,
               price + {tariff('timestamp')} < 0.65 as is_cheap
        from kwh_prices""",
    "price_view": """
        select timestamp, round(price, 6) as price, round(rolling_sum, 6) as rolling_sum, currency,
               "offset", round(price_with_tariff, 6) as price_with_tariff, is_cheap, row_index, hour
        from view_rows""",
    "price_span": """
        select case when cast(min(timestamp) as date) = cast(max(timestamp) as date)
                    then cast(min(timestamp) as date)::varchar
                    else cast(min(timestamp) as date)::varchar || ' to '
                      || cast(max(timestamp) as date)::varchar end as label,
               min_by(currency, timestamp) as currency
        from all_view_rows""",
    "price_midnight": """
        select min(timestamp) as midnight from all_view_rows where hour = 0 and row_index <> 0""",
    "daylight_flag": """
        select h.date, h.temp,
               coalesce(h.date::time >= s.sunrise::time and h.date::time <= s.sunset::time, false)
                 as during_day
        from hourly h left join sun s on cast(h.date as date) = s.date""",
    "sun_lookup": "select sunrise, sunset, summary from sun where date = date '2024-01-11'",
    "sun_lookup_missing": """
        select null::timestamp as sunrise, null::timestamp as sunset,
               'No weather data available for today.' as summary""",
    "sun_clock": """
        select strftime(sunrise + interval 1 hour, '%H:%M:%S') as sunrise,
               strftime(sunset + interval 1 hour, '%H:%M:%S') as sunset, summary
        from sun where date = date '2024-01-11'""",
    "sun_clock_missing": """
        select 'unknown' as sunrise, 'unknown' as sunset,
               'No weather data available for today.' as summary""",
    "forecast_series": """
        select timestamp, round(pv_estimate, 6) as "Estimate",
               round(pv_estimate10, 6) as "Pessimistic", round(pv_estimate90, 6) as "Optimistic"
        from forecast where timestamp >= date '2024-01-10' and timestamp < date '2024-01-13'
        order by timestamp limit 250""",
    "forecast_view": """
        select timestamp, round(pv_estimate, 6) as pv_estimate,
               round(pv_estimate10, 6) as pv_estimate10, round(pv_estimate90, 6) as pv_estimate90
        from forecast where timestamp >= date '2024-01-10' and timestamp < date '2024-01-13'
        order by timestamp limit 250""",
    "battery_latest": """
        select timestamp, battery_state_norm from battery order by timestamp desc limit 1000""",
    "battery_gauge": """
        with recent as (select * from battery
                        where timestamp > (select max(timestamp) from battery) - interval 1 hour)
        select max_by(battery_state_norm, timestamp) as battery_pct,
               min_by(battery_state_norm, timestamp) as battery_pct_before,
               round(max_by(battery_state_norm, timestamp) - min_by(battery_state_norm, timestamp), 4)
                 as delta
        from recent""",
    "battery_gauge_dense": """
        with recent as (select event_id, (event_id % 1000) / 10 as level from events
                        where event_id > (select max(event_id) from events) - 3600)
        select max_by(level, event_id) as battery_pct, min_by(level, event_id) as battery_pct_before,
               round(max_by(level, event_id) - min_by(level, event_id), 4) as delta
        from recent""",
    "battery_gauge_by_site": """
        with own as (select user_id % 5 as site_id, ts, case when a < 1 then 0 when a > 99 then 100 else a end as level
                     from norm join events using (event_id)),
        recent as (select * from own join (select site_id, max(ts) as newest from own group by 1) using (site_id)
                   where ts > newest - interval 1 hour)
        select site_id, max_by(level, ts) as battery_pct, min_by(level, ts) as battery_pct_before,
               round(max_by(level, ts) - min_by(level, ts), 4) as delta
        from recent group by 1""",
    "incremental_days_by_site": """
        select event_id, user_id % 5 as site_id, ts as timestamp from events
        where cast(ts as date) < date '2024-01-29'
          and (user_id % 5 > 1
               or user_id % 5 = 0 and cast(ts as date) > (select max(date) from summary_stored)
               or user_id % 5 = 1 and cast(ts as date) > (select max(date) from summary_stored where dayofmonth(date) <= 10))""",
    "parse_plug_rejects": "select event_id from events where event_id % 7 = 0",
    "write_keyed_table": """
        select event_id, user_id % 3 as dev_id, ts as timestamp,
               case when event_type = 'purchase' then -2 else round(value, 4) end as value, cast(ts as date) as date
        from events""",
    "battery_newest_days": "select event_id, timestamp, battery_state from telemetry order by timestamp desc limit 1000",
    "write_new_table": f"""
        with slots_of as (select {SLOT} as timestamp, event_id, cast(ts as date) as date from events)
        select timestamp, coalesce(min(event_id) filter (where event_id % 2 = 0), min(event_id)) as event_id,
               min(date) as date
        from slots_of group by 1""",
    "append_days_table": """
        select user_id % 5 as site_id, cast(ts as date) as date,
               cast(max(hour(ts) * 100 + minute(ts)) as int) + case when dayofmonth(ts) <= 20 then 0 else 1 end as daily_total
        from events where user_id % 5 < 2 group by user_id % 5, cast(ts as date), dayofmonth(ts)""",
    "normalize_soc": f"""
        select event_id, {_LEVEL.format('a')} as pack_a, {_LEVEL.format('b')} as pack_b from norm""",
    "device_readings": """
        select timestamp, dev_id, round(watts, 4) as watts, volts, device_location from located""",
    "device_counts": """
        select dev_id, device_location, count(*) as n from consumption group by 1, 2""",
    "device_location": """
        select dev_id, min_by(device_location, timestamp) as device_location
        from consumption group by 1""",
    "plug_second_means": """
        select dev_id, timestamp, round(watts, 4) as watts, volts from means_all""",
    "bfill_seconds": """
        select dev_id, coalesce(make_timestamp(1000000 * (lag(s) over (partition by dev_id order by s) + 1)), timestamp) as first,
               timestamp as last, round(watts, 4) as watts
        from means""",
    "resample_bfill": """
        select g.dev_id, g as timestamp, round(watts, 4) as watts
        from (select dev_id, unnest(generate_series(date_trunc('minute', min(timestamp)),
                date_trunc('minute', max(timestamp)), interval 1 minute)) as g
              from means group by 1) g
        asof join means m on g.dev_id = m.dev_id and g.g <= m.timestamp""",
    "cycle_marks": "select dev_id, timestamp, mark from marks where mark is not null",
    "cycle_pairs": """
        select *, strftime(cycle_start, '%Y-%m-%d %H:%M') as label from pairs""",
    "cycle_profiles": "select dev_id, cycle_start, lo, hi, round(watts, 4) as watts from steps",
    "cycle_profile_grid": "select dev_id, cycle_start, t, round(watts, 4) as watts from profiles where t % 300 = 0",
    "cluster_profiles": """
        select dev_id, cluster, min(t) as t, max(t) as t_end, round(any_value(r.watts)::double / any_value(cycles), 4) as watts,
               round(min(t) / 60, 4) as minutes
        from cluster_runs r join sizes using (dev_id, cluster) group by dev_id, cluster, run""",
    "cycle_span": """
        select dev_id, strftime(min(cycle_start), '%y-%m-%d') as first_day,
               strftime(max(cycle_start), '%y-%m-%d') as last_day, count(*) as cycles
        from pairs group by 1""",
    "cluster_usage": """
        select dev_id, cluster, round_even(ws / 1000, 0) as kws, round(ws / 3600000, 4) as kwh
        from (select dev_id, cluster, sum(watts)::double / any_value(cycles) as ws
              from cluster_seconds join sizes using (dev_id, cluster) group by 1, 2)""",
    "cluster_devices": f"select dev_id, cycle_start, cluster from {LAST}",
    "cluster_cycles": f"select dev_id, cycle_start, cluster from pool_label_{ROUNDS} join pool_cycles using (g, i)",
    "cluster_elbow": f"select g as dev_id, k, round(sum(d), 4) as cost from sweep_label_{ROUNDS} group by 1, 2",
    "cluster_silhouette": """
        select g as dev_id, k,
               round(avg(case when size < 2 or far is null or greatest(near, far) <= 0 then 0 else (far - near) / greatest(near, far) end), 4) as silhouette
        from score_scores group by 1, 2""",
    "appliance_summary": f"""
        select dev_id, cluster, round_even(ws / 1000, 0) as kws, round(ws / 3600000, 4) as kwh
        from (select dev_id, cluster, sum(cast(watts as decimal(28, 9)))::double / count(distinct cycle_start) as ws
              from profiles join ({LAST}) using (dev_id, cycle_start) group by 1, 2)""",
    # payloads
    "parse_power_flow": f"""
        select date_trunc('second', ts) as timestamp, round(value, 2) as p_battery,
               1.5::double as p_grid, round(-value, 2) as p_local,
               case when event_type <> 'view' then round(value * 20, 4) else 0 end as p_solar,
               100.0::double as pct_selfsufficient, 50.5::double as pct_autonomy,
               round(value, 4) as p_total,
               case when event_type <> 'signup' then n.battery_state else 0 end as battery_state,
               case when event_type <> 'signup' then {_LEVEL.format('a')} else 0 end
                 as battery_state_norm,
               event_id::double as e_day, event_id * 2::double as e_year, 7.25::double as e_total, event_id
        from events join norm n using (event_id) where event_type <> 'error' and event_id % 11 <> 0""",
    "parse_power_flow_rejects": """
        select event_id from events where event_type = 'error' or event_id % 11 = 0""",
    "parse_reject_reasons": """
        select event_id, case when event_type = 'error' then 'unreadable' else 'no P_Grid' end as reason
        from events where event_type = 'error' or event_id % 11 = 0
        union all
        select -event_id - 1, case when hour(ts) % 3 = 0 then 'unreadable' else 'no rows' end
        from events where hour(ts) % 3 <> 2""",
    "parse_weather_current": """
        select date_trunc('second', ts) + interval 1 hour as dt, date_trunc('second', ts) as sunrise,
               date_trunc('second', ts) + interval 2 hour as sunset, round(value, 4) as temp,
               w.id, w.main, w.description, w.icon
        from (select *, unnest(case when event_type = 'error' then [] else
                [{'id': 800, 'main': event_type, 'description': 'sky', 'icon': '01d'}]
                || case when event_type = 'view' then [{'id': 701, 'main': 'Mist', 'description': 'mist', 'icon': '50d'}] else [] end end) as w
              from events)""",
    "parse_plug_status": """
        select date_trunc('second', ts) as timestamp, (user_id % 3)::int as dev_id,
               'plug' || (user_id % 3) as device_id, round(amps, 4) as amps,
               round(case when watts = 0 then amps * volts else watts end, 4) as watts, volts,
               '' as device_location, '' as comment, event_id
        from (select *,
                case when event_type = 'view' or event_id = 0 then 0.5 else event_id / 1000 end as amps,
                case when event_type in ('view', 'click') then 0 else floor(value * 100) / 10 end
                  as watts,
                case when event_type = 'view' then 231.0::double else 230.0::double end as volts
              from events)""",
    "parse_prices": """
        select timestamp, round(price / 1000, 4) as price, 'DKK' as currency from prices_raw""",
    "parse_solar_forecast": """
        select timestamp, round(pv_estimate, 6) as pv_estimate,
               round(pv_estimate10, 6) as pv_estimate10, round(pv_estimate90, 6) as pv_estimate90
        from forecast""",
    "parse_weather_hourly": """
        select date, date + interval 1 hour as local_time, temp, 800 as id,
               case when temp > 10 then 'Clear' else 'Clouds' end as main, 'sky' as description,
               '01d' as icon, case when temp > 12 then round(temp / 10, 4) else 0 end as rain,
               0.0::double as snow
        from hourly""",
    "parse_weather_daily": """
        select s.date, sunrise, sunset, summary,
               case when max(temp) > 10 then 'Clear' else 'Clouds' end as main,
               min(temp) as temp_min, max(temp) as temp_max, min(temp) as feels_like_night
        from sun s join hourly h on cast(h.date as date) = s.date group by 1, 2, 3, 4""",
    "parse_sun_times": "select date, sunrise, sunset from sun",
    # streams
    "stream_ingest": """
        select date_trunc('second', e.ts) as timestamp,
               case when event_type <> 'view' then round(e.value * 20, 4) else 0 end as p_solar,
               case when event_type <> 'signup' then battery_state_norm else 0 end
                 as battery_state_norm,
               event_id::double as e_day
        from events e join battery b on b.timestamp = e.ts where event_type <> 'error' and event_id % 11 <> 0
        qualify row_number() over (partition by date_trunc('second', e.ts) order by event_id) = 1""",
    "stream_dedupe": f"""
        select distinct {SLOT} as timestamp, cast(user_id % 3 as int) as dev_id from events""",
    "stream_day_summary": "select * from diary",
}

QUERIES["conform_daily"] = f"""
    with days as ({QUERIES["daily_job"]})
    select date, min_battery, max_battery, min_battery_raw, max_battery_raw, first_1kw, last_1kw,
           first_2kw, last_2kw, first_prod, last_prod, round(peak_solar, 2) as peak_solar,
           daily_total::double as daily_total, round(daily_solar_est, 0) as daily_solar_est,
           battery_at_1am, battery_at_5am, night_grid_charge
    from days"""


def _needed(sql: str) -> list[str]:
    """The views a statement uses, in the order they are declared."""
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
    found: set[str] = set()
    todo = [v for v in VIEWS if v in words]
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            inner = set(VIEWS[name].removeprefix(KEPT).replace("(", " ").replace(")", " ").replace(",", " ").split())
            todo += [v for v in VIEWS if v in inner and v != name]
    return [v for v in VIEWS if v in found]


def statement(name: str) -> str:
    """The query with the views it needs as common table expressions."""
    sql = QUERIES[name].strip()
    ctes = [
        f"{v} as {'materialized ' if VIEWS[v].startswith(KEPT) else ''}({VIEWS[v].removeprefix(KEPT).strip()})" for v in _needed(sql)
    ]
    if not ctes:
        return sql
    head = "with " + ",\n".join(ctes)
    if sql.startswith("with "):
        return f"{head},\n{sql[5:]}"
    return f"{head}\n{sql}"
