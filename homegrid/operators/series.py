"""Time-series operators over ordered rows, cut into time buckets.

A window ordered by time alone, or by a key that holds most rows, would run in one
task. So rows are first reduced to one per key and time cell (which combines map-side),
then windowed by (key, bucket). A day bucket of one-second cells has at most 86,400 rows
however many readings there were. What a bucket needs from its neighbours is carried
over from a table with one row per key and bucket.

Rows are unique by (keys, ts), as the keyed sinks store them. Keys are not NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from homegrid.functions.clock import (
    DAY,
    UTC,
    day_start_seconds,
    epoch_micros,
    epoch_seconds,
    floor_div,
    from_seconds,
    local_date,
    span_seconds,
)
from homegrid.functions.energy import finite
from homegrid.session import stored_copy

WATT_SECONDS_PER_KWH = 3_600_000
BUCKET = "_bucket"


def bucket_of(seconds: Column | str, width: int = DAY) -> Column:
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    return floor_div(seconds, width)


def in_buckets(df: DataFrame, seconds: Column, keys: Sequence[str], width: int = DAY) -> DataFrame:
    """Add the bucket, without rows that have no key or time.

    The join of a carry drops NULL keys on one side; dropped on both, the two sides read
    the same exchange.
    """
    rows = df.withColumn(BUCKET, bucket_of(seconds, width))
    for name in (*keys, BUCKET):
        rows = rows.filter(F.col(name).isNotNull())
    return rows


def with_neighbours(
    df: DataFrame, order: str, keys: Sequence[str], prev: str | None = None, next: str | None = None
) -> DataFrame:
    """Add the previous and/or next row of the key, as structs named ``prev`` and ``next``.

    ``df`` has a ``_bucket`` column. The whole edge row of a bucket is carried, so that
    both branches of the join read the same columns and share one exchange.
    """
    row = F.struct(*df.columns)
    inside = Window.partitionBy(*keys, BUCKET).orderBy(order)
    buckets = Window.partitionBy(*keys).orderBy(BUCKET)
    wanted = [(name, *how) for name, how in ((prev, (F.lag, F.max_by)), (next, (F.lead, F.min_by))) if name]
    edges = df.groupBy(*keys, BUCKET).agg(
        *[edge_of(row, F.col(order)).alias(f"_edge{name}") for name, _, edge_of in wanted]
    )
    carry = edges.select(
        *keys, BUCKET, *[shift(f"_edge{name}").over(buckets).alias(f"_carry{name}") for name, shift, _ in wanted]
    )
    near = df.withColumns({f"_near{name}": shift(row).over(inside) for name, shift, _ in wanted})
    return (
        near.join(carry, [*keys, BUCKET], "left")
        .withColumns({name: F.coalesce(f"_near{name}", f"_carry{name}") for name, _, _ in wanted})
        .drop(*[f"_{kind}{name}" for name, _, _ in wanted for kind in ("near", "carry")])
    )


def with_bucket_carry(
    df: DataFrame, order: Sequence[str], keys: Sequence[str], carries: Callable[[Column, WindowSpec], dict[str, Column]]
) -> DataFrame:
    """Add what ``carries`` says of the earlier buckets, computed over one row per key and bucket.

    ``carries`` gets the last row of a bucket, a struct, and the window of the key's buckets. The row
    is carried whole, so that both branches of the join read the same exchange.
    """
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    rows = df.withColumn("_final", F.lead(F.lit(1)).over(inside).isNull())
    ends = (
        rows.filter("_final").groupBy(*keys, BUCKET).agg(F.first(F.struct(*rows.columns)).alias("_end"))
    )
    columns = carries(F.col("_end"), Window.partitionBy(*keys).orderBy(BUCKET))
    carry = ends.select(*keys, BUCKET, *[c.alias(name) for name, c in columns.items()])
    return rows.join(carry, [*keys, BUCKET]).drop("_final")


def with_row_numbers(df: DataFrame, order: Sequence[str], keys: Sequence[str], alias: str = "_row") -> DataFrame:
    """Number the rows of each key from 0, over all its buckets.

    ``df`` has a ``_bucket`` column. Rows are numbered within their bucket, and the buckets before
    it add their counts.
    """
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    rows = df.withColumn("_inside", F.row_number().over(inside) - 1)
    carried = with_bucket_carry(rows, order, keys, lambda end, buckets: {"_before": rows_before(end, buckets)})
    return carried.withColumn(alias, F.col("_inside") + F.col("_before")).drop("_inside", "_before")


def rows_before(end: Column, buckets: WindowSpec) -> Column:
    earlier = buckets.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(end["_inside"] + 1).over(earlier), F.lit(0))


def later_rows(df: DataFrame, offset: int | Column, keys: Sequence[str], **columns: str) -> DataFrame:
    """Add ``name=column`` of the row ``offset`` rows on.

    Each row is sent to its own number and, with the wanted columns only, to that of the row it
    is looked for from; equal numbers meet. The work is the same for any offset.
    """
    own = F.struct(*df.columns)
    values = F.struct(*[F.col(column).alias(name) for name, column in columns.items()])
    none_own, none_values = F.when(F.lit(False), own), F.when(F.lit(False), values)
    sent = F.array(
        F.struct(F.col("_row").alias("_at"), F.lit(0).alias("_kind"), own.alias("_own"), none_values.alias("_ahead")),
        F.struct((F.col("_row") - offset).alias("_at"), F.lit(1).alias("_kind"), none_own.alias("_own"), values.alias("_ahead")),
    )
    meeting = Window.partitionBy(*keys, "_at").orderBy("_kind")
    return (
        df.select(*keys, F.inline(sent))
        .withColumn("_found", F.lead("_ahead").over(meeting))
        .filter("_kind = 0")
        .select("_own.*", *[F.col("_found")[name].alias(name) for name in columns])
    )


# -- energy ---------------------------------------------------------------------------


def energy_daily(
    df: DataFrame,
    value: str = "p_solar",
    keys: Sequence[str] = (),
    tz: str = UTC,
    ts: str = "timestamp",
) -> DataFrame:
    """kWh per local day on a one-second grid where each second has the next reading.

    Between two readings the later one holds, so a reading counts for the seconds since
    the one before it and no grid has to be built. One row per day carries the gap that
    crosses midnight.
    """
    keys = list(keys)
    per_second = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys, epoch_seconds(ts).alias("_sec"))
        .agg(F.min_by(F.col(value).cast("double"), F.col(ts)).alias("_watts"))
        .withColumn("_day", local_date(F.timestamp_seconds("_sec"), tz))
    )
    inside = Window.partitionBy(*keys, "_day").orderBy("_sec")
    per_day = (
        per_second.withColumn("_span", F.col("_sec") - F.lag("_sec").over(inside))
        .groupBy(*keys, "_day")
        .agg(
            F.coalesce(F.sum(F.col("_watts") * F.col("_span")), F.lit(0.0)).alias("_inner"),
            F.min("_sec").alias("_first"),
            F.max("_sec").alias("_last"),
            F.coalesce(F.min_by("_watts", "_sec"), F.lit(0.0)).alias("_head"),
        )
    )
    days = Window.partitionBy(*keys).orderBy("_day")
    gaps = per_day.withColumn(
        "_from", F.coalesce(F.lag("_last").over(days) + 1, F.col("_first"))
    )

    def part(day: Column) -> Column:
        start = F.greatest(F.col("_from"), day_start_seconds(day, tz))
        end = F.least(F.col("_first"), day_start_seconds(F.date_add(day, 1), tz) - 1)
        return F.struct(day.alias("date"), (F.col("_head") * (end - start + 1)).alias("ws"))

    first_day = local_date(F.timestamp_seconds("_from"), tz)
    parts = F.concat(
        F.array(F.struct(F.col("_day").alias("date"), F.col("_inner").alias("ws"))),
        F.transform(F.sequence(first_day, F.col("_day"), F.expr("interval 1 day")), part),
    )
    return (
        gaps.select(*keys, F.inline(parts))
        .groupBy(*keys, "date")
        .agg((F.sum("ws") / WATT_SECONDS_PER_KWH).alias("kwh"))
    )


# -- resampling -----------------------------------------------------------------------


def explode_range(df: DataFrame, lo: str, hi: str, alias: str, chunk: int = DAY) -> DataFrame:
    """One row per integer in ``lo``..``hi``; two steps keep each generated array short."""
    width = F.lit(chunk)
    low, high = floor_div(F.col(lo), chunk), floor_div(F.col(hi), chunk)
    chunks = df.withColumn("_chunk", F.explode(F.sequence(low, high)))
    start = F.greatest(F.col(lo), F.col("_chunk") * width)
    end = F.least(F.col(hi), F.col("_chunk") * width + width - 1)
    return chunks.withColumn(alias, F.explode(F.sequence(start, end))).drop("_chunk", lo, hi)


def bfill_intervals(
    df: DataFrame,
    ts: str,
    value: str,
    keys: Sequence[str] = (),
    step: str | int | timedelta = 1,
    skip_null: bool = True,
) -> DataFrame:
    """Backward fill as intervals: grid cells ``lo``..``hi`` (inclusive) have ``value``.

    Cell c is the grid label at c·step seconds. With ``skip_null`` a NULL reading is
    filled from the next one, else it ends the gap and stays NULL.
    """
    keys, step = list(keys), span_seconds(step)
    readings = df.filter(F.col(ts).isNotNull())
    if skip_null:
        readings = readings.filter(F.col(value).isNotNull())
    # cell of the last label at or before the reading
    cells = readings.groupBy(*keys, floor_div(epoch_seconds(ts), step).alias("hi")).agg(
        F.min_by(value, ts).alias(value)
    )
    rows = in_buckets(cells, F.col("hi") * step, keys)
    return with_neighbours(rows, "hi", keys, prev="_prev").select(
        *keys, F.coalesce(F.col("_prev.hi") + 1, F.col("hi")).alias("lo"), "hi", value
    )


def resample_bfill(
    df: DataFrame,
    ts: str,
    value: str,
    keys: Sequence[str] = (),
    step: str | int | timedelta = 1,
    skip_null: bool = True,
) -> DataFrame:
    """Regular grid from the first to the last reading, each label filled from the next one."""
    seconds = span_seconds(step)
    intervals = bfill_intervals(df, ts, value, keys, step, skip_null)
    return explode_range(intervals, "lo", "hi", "_label").select(
        *keys, from_seconds(F.col("_label") * seconds).alias(ts), value
    )


def resample_ffill(
    df: DataFrame,
    ts: str,
    value: str | Sequence[str],
    step: str | int | timedelta,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Regular grid where a label has the last row at or before it.

    The grid runs from the step at or before the first row to that of the last row: a
    first row off the grid leaves its own label NULL, a last row off it is not seen.
    """
    keys, seconds = list(keys), span_seconds(step)
    values = [value] if isinstance(value, str) else list(value)
    width = seconds * 1_000_000
    low = floor_div(epoch_micros(ts), width)
    cell = floor_div(epoch_micros(ts) + F.lit(width - 1), width)
    cells = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys, cell.alias("_cell"))
        .agg(
            *[F.max_by(v, ts).alias(v) for v in values],
            F.min(low).alias("_low"),
            F.max(low).alias("_high"),
        )
    )
    buckets = in_buckets(cells, F.col("_cell") * seconds, keys)
    rows = with_neighbours(buckets, "_cell", keys, prev="_prev", next="_next")
    held = F.struct(
        F.col("_cell").alias("_lo"),
        F.coalesce(F.col("_next._cell") - 1, F.col("_high")).alias("_hi"),
        *values,
    )
    lead_in = F.struct(
        F.col("_low").alias("_lo"),
        F.when(F.col("_prev").isNull(), F.col("_cell") - 1).alias("_hi"),
        *[F.lit(None).cast(df.schema[v].dataType).alias(v) for v in values],
    )
    spans = rows.select(*keys, F.inline(F.array(lead_in, held))).filter("_lo <= _hi")
    return explode_range(spans, "_lo", "_hi", "_label").select(
        *keys, from_seconds(F.col("_label") * seconds).alias(ts), *values
    )


# -- rolling sums ---------------------------------------------------------------------


BINS = 1 << 16


def _narrowed(counted: DataFrame, value: str, keys: Sequence[str], targets: DataFrame) -> DataFrame:
    """Each target's range cut down to the one of ``BINS`` equal parts that holds its rank."""
    width = F.ceil((F.col("_high") - F.col("_low") + 1) / F.lit(BINS))
    by = [*keys, "_side"]
    bins = (
        counted.join(targets.withColumn("_width", width), list(keys))
        .filter(F.col(value).between(F.col("_low"), F.col("_high")))
        .withColumn("_bin", F.call_function("div", F.col(value) - F.col("_low"), F.col("_width")))
        .groupBy(*by, "_low", "_high", "_rank", "_width", "_bin")
        .agg(F.sum("_n").alias("_n"))
    )
    until = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    low = F.col("_low") + F.col("_bin") * F.col("_width")
    return (
        bins.withColumn("_until", F.sum("_n").over(until))
        .filter(F.col("_rank").between(F.col("_until") - F.col("_n") + 1, F.col("_until")))
        .select(
            *by,
            low.alias("_low"),
            F.least(low + F.col("_width") - 1, F.col("_high")).alias("_high"),
            (F.col("_rank") - F.col("_until") + F.col("_n")).alias("_rank"),
        )
    )


def counted_median(counted: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Median per key of whole numbers that come ``_n`` times each, under the name of the value.

    The two middle ranks are looked for in ranges that shrink to one part in 65,536 each time,
    so that no task holds more than that many counts of a key. At most four rounds.
    """
    ends = counted.groupBy(*keys).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"), F.sum("_n").alias("_total")
    )
    sides = F.array(
        F.struct(F.lit(0).alias("_side"), F.call_function("div", F.col("_total") + 1, F.lit(2)).alias("_rank")),
        F.struct(F.lit(1).alias("_side"), (F.call_function("div", F.col("_total"), F.lit(2)) + 1).alias("_rank")),
    )
    targets = ends.select(*keys, "_low", "_high", F.inline(sides))
    while True:
        targets = stored_copy(targets, "ranks")
        if targets.filter("_low < _high").isEmpty():
            return targets.groupBy(*keys).agg(F.avg("_low").alias(value))
        targets = _narrowed(counted, value, keys, targets)


def sampling_step(
    df: DataFrame,
    ts: str,
    window: str | timedelta = "3 hours",
    keys: Sequence[str] = (),
    bucket: str | timedelta = "1 day",
) -> DataFrame:
    """Median step between rows in microseconds, and how many such steps fill ``window``.

    Equal steps are counted first; the counts are a stored table that the rounds of
    :func:`counted_median` read. Without two rows there is no step, and for no key a NULL one.
    """
    micros = df.filter(F.col(ts).isNotNull()).select(*keys, epoch_micros(ts).alias("_us"))
    named = list(keys) or ["_all"]
    micros = micros if keys else micros.withColumn("_all", F.lit(0))
    rows = in_buckets(micros, floor_div(F.col("_us"), 1_000_000), named, span_seconds(bucket))
    counted = stored_copy(
        with_neighbours(rows, "_us", named, prev="_prev")
        .select(*named, (F.col("_us") - F.col("_prev._us")).alias("_step"))
        .filter("_step is not null")
        .groupBy(*named, "_step")
        .agg(F.count("*").alias("_n")),
        "steps",
    )
    median = counted_median(counted, "_step", named)
    if not keys:
        median = median.agg(F.max("_step").alias("_step"))
    return median.select(
        *keys,
        F.col("_step").alias("step_us"),
        F.floor(F.lit(span_seconds(window) * 1_000_000) / F.col("_step")).alias("rows_in_window"),
    )


def _parts(span: int, bucket: int) -> int:
    """The least number of equal whole parts of ``span`` that are no longer than ``bucket``."""
    parts = -(-span // bucket)
    while span % parts:
        parts += 1
    return parts


def rolling_time_sum(
    df: DataFrame,
    ts: str,
    value: str,
    window: str | timedelta,
    n: int | str,
    divisor: float = 4,
    keys: Sequence[str] = (),
    alias: str = "rolling_sum",
    bucket: str | timedelta = "1 day",
    arrival: str | None = None,
) -> DataFrame:
    """Sum over the trailing ``(t - window, t]`` of the row ``n - 1`` rows ahead.

    The sum is NULL where the window has no value; NULL, NaN and ±inf are missing values. Rows
    of one time count in the order of ``arrival``: none sees a later one. ``n`` may name a column, with
    one number for all rows of a key.

    Buckets are equal parts of the window, at most ``bucket`` long, so a window begins a fixed
    number of buckets before its row. Its sum has three parts: the row's bucket up to the row, whole
    buckets in between, and the end of the bucket where it begins. For the last part the row is sent
    to that bucket, once, however long the window is. Nothing is subtracted.
    """
    keys, span = list(keys), span_seconds(window) * 1_000_000
    parts = _parts(span, span_seconds(bucket) * 1_000_000)
    order = ["_us", *([arrival] if arrival else [])]
    timed = df.filter(F.col(ts).isNotNull()).withColumns(
        {"_us": epoch_micros(ts), "_value": finite(F.col(value).cast("double"))}
    )
    timed = timed.withColumn(BUCKET, floor_div(F.col("_us"), span // parts))
    for name in (*keys, BUCKET):  # the carry's join drops them too, see in_buckets
        timed = timed.filter(F.col(name).isNotNull())

    until = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    rows = timed.withColumns(
        {
            "_inside": F.row_number().over(until) - 1,
            "_head": F.sum("_value").over(until.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )

    def carries(end: Column, buckets: WindowSpec) -> dict[str, Column]:
        between = F.sum(end["_head"]).over(buckets.rangeBetween(1 - parts, -1)) if parts > 1 else F.lit(None)
        return {"_between": between.cast("double"), "_before": rows_before(end, buckets)}

    rows = with_bucket_carry(rows, order, keys, carries).withColumn("_row", F.col("_inside") + F.col("_before"))

    own = F.struct(*rows.columns)
    start = F.struct(
        (F.col(BUCKET) - parts).alias("_home"), (F.col("_us") - span).alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast("double").alias("_gain"), own.alias("_own"),
    )
    gain = F.struct(
        F.col(BUCKET).alias("_home"), F.col("_us").alias("_at"), F.lit(1).alias("_kind"),
        F.col("_value").alias("_gain"), F.when(F.lit(False), own).alias("_own"),
    )
    since = Window.partitionBy(*keys, "_home").orderBy(F.desc("_at"), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    rolled = (
        rows.select(*keys, F.inline(F.array(start, gain)))
        .withColumn("_tail", F.sum("_gain").over(since))
        .filter("_kind = 0")
        .select("_own.*", "_tail")
    )
    pieces = [F.col("_head"), F.col("_between"), F.col("_tail")]
    total = sum((F.coalesce(p, F.lit(0.0)) for p in pieces[1:]), F.coalesce(pieces[0], F.lit(0.0)))
    rolled = rolled.withColumn("_sum", F.when(F.coalesce(*pieces).isNotNull(), total / divisor))
    if n == 1:
        lead = rolled.withColumn(alias, F.col("_sum"))
    else:
        lead = later_rows(rolled, (F.col(n) if isinstance(n, str) else n) - 1, keys, **{alias: "_sum"})
    return lead.select(*df.columns, alias)


def rolling_row_sum(
    df: DataFrame,
    ts: str,
    value: str,
    n: int,
    divisor: float = 4,
    keys: Sequence[str] = (),
    alias: str = "rolling_sum",
    bucket: str | timedelta = "1 day",
) -> DataFrame:
    """Sum of the row and the ``n - 1`` after it; NULL unless all ``n`` have a value.

    Rows are numbered and cut into blocks of ``n``. A window is the end of one block, summed
    backward, and the beginning of the next, summed forward; the row ``n - 1`` on brings the
    latter by an equal join of row numbers. So the work does not grow with ``n``, and nothing
    is subtracted.
    """
    keys = list(keys)
    timed = df.filter(F.col(ts).isNotNull())
    rows = in_buckets(timed, epoch_seconds(ts), keys, span_seconds(bucket)).withColumns(
        {"_us": epoch_micros(ts), "_value": F.col(value).cast("double")}
    )
    numbered = with_row_numbers(rows, ["_us"], keys).withColumn("_block", floor_div(F.col("_row"), n))
    # both are running sums; a frame that ends with its block would be summed anew for every row
    block = Window.partitionBy(*keys, "_block").rowsBetween(Window.unboundedPreceding, 0)
    head, tail = block.orderBy("_row"), block.orderBy(F.desc("_row"))
    summed = numbered.withColumns(
        {
            "_head": F.sum("_value").over(head),
            "_known_head": F.count("_value").over(head),
            "_tail": F.sum("_value").over(tail),
            "_known_tail": F.count("_value").over(tail),
        }
    )
    whole = F.pmod(F.col("_row"), F.lit(n)) == 0  # the window is its block
    total = F.when(whole, F.col("_tail")).otherwise(F.col("_tail") + F.col("_head_on"))
    known = F.when(whole, F.col("_known_tail")).otherwise(F.col("_known_tail") + F.col("_known_on"))
    return (
        later_rows(summed, n - 1, keys, _head_on="_head", _known_on="_known_head")
        .withColumn(alias, F.when(known == n, total / divisor))
        .select(*df.columns, alias)
    )


# -- duplicates -----------------------------------------------------------------------


def dedupe_last(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The row of each key that arrived last; copies of a key combine before the shuffle."""
    return _pick(df, keys, arrival, F.max_by)


def dedupe_first(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The row of each key that arrived first."""
    return _pick(df, keys, arrival, F.min_by)


def _pick(df: DataFrame, keys: Sequence[str], arrival: str, choose) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(choose(F.struct(*rest), F.col(arrival)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def dst_repair(
    df: DataFrame, ts: str, arrival: str, keys: Sequence[str] = ()
) -> DataFrame:
    """All but the last arrival of equal timestamps move one hour back (one pass).

    ``arrival`` is unique within a timestamp. Only repeated timestamps are joined back.
    """
    keys = [*keys, ts]
    repeated = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"), F.max(arrival).alias("_last"))
        .filter("_n > 1")
        .drop("_n")
    )
    earlier = F.col("_last").isNotNull() & (F.col(arrival) < F.col("_last"))
    return (
        df.join(repeated, keys, "left")
        .withColumn(ts, F.when(earlier, F.col(ts) - F.expr("interval 1 hour")).otherwise(F.col(ts)))
        .select(*df.columns)
    )
