"""Views that look back along a device's rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from breathline.functions import times as T
from breathline.functions.numbers import round_stat
from breathline.plans import frames
from breathline.plans.chunks import with_lags, with_ordinal, with_states, with_time_buckets
from breathline.plans.sizing import broadcast_if_small
from breathline.schema import KEY
from breathline.session import frozen

WINDOW_S = 20
WARMUP = 5
# A bucket spans this many windows, so one row in so many is copied.
BUCKET_WINDOWS = 64


def _halves(df: DataFrame, keys: list[str], window_s: int, time: str):
    """Rows with times, and what builds an aggregate of each half of the trailing frame ``[t - window, t]``.

    Time is cut into buckets of one window, and a bucket holds copies (``_halo``) of the rows
    of the one before. A frame is then the last rows of the halo and the first ones of the
    bucket; both halves come from running aggregates, so a row costs the same however many
    rows its frame has. Rows without a time are in no frame and give no rows.
    """
    us = window_s * 1_000_000
    timed = df.withColumn("_us", T.micros(F.col(time))).filter(F.col("_us").isNotNull())
    own = F.expr(f"(_us - pmod(_us, {us}L)) div {us}L")
    rows = timed.withColumn("_bucket", F.explode(F.array(own, own + 1))).withColumn("_halo", F.col("_bucket") != own)
    within = Window.partitionBy(*keys, "_bucket")
    starts = F.when(F.col("_halo"), F.col("_us")).otherwise(F.col("_us") - F.lit(us))
    back = within.orderBy(starts.desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    forth = within.orderBy("_us").rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def halves(of, v: Column) -> tuple[Column, Column]:
        return of(F.when(F.col("_halo"), v)).over(back), of(F.when(~F.col("_halo"), v)).over(forth)

    return rows, halves


def trailing_stats(
    arrivals: DataFrame, window_s: int = WINDOW_S, time: str = "ts", value: str = "v"
) -> DataFrame:
    """Newest value, mean and population sd over the trailing window, rounded to three digits."""
    rows, halves = _halves(arrivals, KEY, window_s, time)
    v, parts = F.col(value), {}
    for name, of in (("n", F.count), ("sum", F.sum), ("mean", F.avg), ("var", F.var_pop)):
        parts[f"_{name}0"], parts[f"_{name}1"] = halves(of, v)
    n0, n1, n = F.col("_n0"), F.col("_n1"), F.col("_n0") + F.col("_n1")
    some = lambda c: F.coalesce(c, F.lit(0))
    apart = F.col("_mean0") - F.col("_mean1")
    squares = some(n0 * F.col("_var0")) + some(n1 * F.col("_var1")) + some(apart * apart * n0 * n1 / F.when(n > 0, n))
    total = some(F.col("_sum0")) + some(F.col("_sum1"))
    return rows.withColumns(parts).filter(~F.col("_halo")).select(
        *KEY, "id", time, v.alias("latest"), round_stat(total / F.when(n > 0, n)).alias("mean"),
        round_stat(F.sqrt(squares / F.when(n > 0, n))).alias("sd"), n.alias("n")
    )


def _bucketed_groups(df: DataFrame, keys: list[str], window_s: int, time: str):
    """Rows grouped by key and time bucket, a bounded stretch of time with its halo; and the frame's width."""
    us = window_s * 1_000_000
    timed = df.withColumn("_us", T.micros(F.col(time)))
    return with_time_buckets(timed, "_us", us, BUCKET_WINDOWS * us).groupBy(*keys, "_bucket"), us


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values with NaN for null, whether there is one)."""
    return column.cast(pa.float64()).fill_null(np.nan).to_numpy(), column.is_valid().to_numpy()


def trailing_stats_dense(
    arrivals: DataFrame, window_s: int = WINDOW_S, time: str = "ts", value: str = "v"
) -> DataFrame:
    """``trailing_stats`` in time that doesn't hang on the rows of a frame, for frames of hundreds and more.

    A task holds a sensor's rows of ``BUCKET_WINDOWS`` windows.
    """
    groups, us = _bucketed_groups(arrivals.select(*KEY, "id", time, F.col(value).cast("double").alias("latest")), KEY, window_s, time)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_us")
        values, there = _numbers(rows.column("latest"))
        n, mean, sd = frames.mean_and_sd(values, there, *frames.bounds(rows.column("_us").to_numpy(), us))
        out = rows.select([*KEY, "id", time, "latest"])
        for name, figures in (("mean", mean), ("sd", sd)):
            out = out.append_column(name, pa.array(figures, mask=n == 0))
        return out.append_column("n", pa.array(n.astype(np.int64))).filter(pa.array(~rows.column("_halo").to_numpy()))

    kept = arrivals.select(*KEY, "id", time).schema
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.fields)
    done = groups.applyInArrow(run, f"{names}, latest double, mean double, sd double, n long")
    return done.withColumn("mean", round_stat(F.col("mean"))).withColumn("sd", round_stat(F.col("sd")))


def trailing_minmax_scale_dense(
    lines: DataFrame, window_s: int = WINDOW_S, time: str = "arrival_ts"
) -> DataFrame:
    """``trailing_minmax_scale`` in time that doesn't hang on the rows of a frame, for any number of channels."""
    groups, us = _bucketed_groups(lines.select("device_id", "line_id", time, F.col("values").cast("array<double>").alias("vs")), ["device_id"], window_s, time)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_us").combine_chunks()
        first, end = frames.bounds(rows.column("_us").to_numpy(), us)
        lists = rows.column("vs").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy()), 0)
        flat, valid = _numbers(pa.chunked_array([lists.flatten()]))
        starts = np.cumsum(sizes) - sizes
        channels = int(sizes.max()) if len(sizes) else 0
        constant, scaled = np.zeros(len(rows), dtype=bool), []
        for c in range(channels):
            has = np.flatnonzero(sizes > c)
            v, there = np.full(len(rows), np.nan), np.zeros(len(rows), dtype=bool)
            v[has], there[has] = flat[starts[has] + c], valid[starts[has] + c]
            low = frames.extreme(v, first, end, np.fmin)
            high = frames.extreme(np.where(there, v, -np.inf), first, end, np.maximum)
            span = high - low
            constant |= span == 0
            with np.errstate(invalid="ignore", divide="ignore"):
                scaled.append((there, 1.0 - (v - low) / span))
        shown = ~constant & ~rows.column("_halo").to_numpy()
        device, line = rows.column("device_id"), rows.column("line_id")
        out = []
        for c, (there, x) in enumerate(scaled):
            at = np.flatnonzero(shown & there)
            out.append(pa.table({"device_id": device.take(at), "line_id": line.take(at), "channel": pa.array(np.full(len(at), c, np.int32)), "scaled": x[at]}))
        return pa.concat_tables(out) if out else pa.table(
            {"device_id": pa.array([], pa.string()), "line_id": pa.array([], pa.int64()), "channel": pa.array([], pa.int32()), "scaled": pa.array([], pa.float64())})

    return groups.applyInArrow(run, "device_id string, line_id long, channel int, scaled double")


def trailing_minmax_scale(
    lines: DataFrame, channels: int, window_s: int = WINDOW_S, time: str = "arrival_ts"
) -> DataFrame:
    """Newest value of each channel scaled to its trailing window, highest = 0, lowest = 1.

    A line gives no rows when any of its channels is constant over the window. The
    channels of a line stay together, so one frame serves all of them, and the work hangs on
    the lines, not on how many a window has. ``channels`` is
    the most that a device has (``ingest.most_channels``); a longer line fails the job.
    """
    complaint = F.concat(F.lit(f"more than {channels} values in line "), F.col("line_id").cast("string"))
    lines = lines.withColumn("values", F.when(
        F.size("values") > channels, F.raise_error(complaint).cast("array<double>")).otherwise(F.col("values")))
    rows, halves = _halves(lines, ["device_id"], window_s, time)
    limits = {}
    for c in range(channels):
        v = F.get("values", F.lit(c))
        limits[f"_low{c}"] = F.least(*halves(F.min, v))
        limits[f"_high{c}"] = F.greatest(*halves(F.max, v))
    rows = rows.withColumns(limits)
    scaled: list[Column] = []
    spans = []
    for c in range(channels):
        low, span = F.col(f"_low{c}"), F.col(f"_high{c}") - F.col(f"_low{c}")
        spans.append(span)
        scaled.append(F.lit(1.0) - (F.get("values", F.lit(c)) - low) / F.when(span != 0, span))
    constant = F.exists(F.array(*spans), lambda s: s == 0)
    return (
        rows.filter(~F.col("_halo") & ~F.coalesce(constant, F.lit(False)))
        .select("device_id", "line_id", F.posexplode(F.array(*scaled)).alias("channel", "scaled"))
        .filter(F.col("scaled").isNotNull())
    )


def trailing_warmup_gate(
    lines: DataFrame, window_s: int = WINDOW_S, warmup: int = WARMUP,
    pos: str = "line_id", time: str = "arrival_ts", min_elapsed_s: float | None = None,
    fold_width: int | None = None, bucket_windows: int = BUCKET_WINDOWS,
) -> DataFrame:
    """``emitted``: whether the live view draws a frame at this line.

    It draws once its buffer holds ``warmup`` rows, and drops old rows only when it
    draws, so after a long gap it has to fill up again. The state is the number of rows
    left in the buffer, up to ``warmup - 1``. Lines come in ``pos`` order, which is also
    their time order. ``min_elapsed_s`` also asks for that much time since the device's
    first line, which only holds drawing back at the start.
    """
    enough = warmup - 1
    us = window_s * 1_000_000
    timed = lines.select("device_id", pos, T.micros(F.col(time)).alias("_us"))
    early = F.lit(False)
    if min_elapsed_s is not None:
        starts = timed.groupBy("device_id").agg(F.min("_us").alias("_start"))
        timed = timed.join(broadcast_if_small(frozen(starts)), "device_id")
        early = F.col("_us") - F.col("_start") < F.lit(int(min_elapsed_s * 1_000_000))
    bucketed = with_time_buckets(timed.withColumn("_early", early), "_us", us, bucket_windows * us)

    # Only rows within the window count, and the bucket's copies hold all of those.
    arrival = Window.partitionBy("device_id", "_bucket").orderBy("_us", pos)
    before = {k: F.lag("_us", k).over(arrival) for k in range(1, warmup + 1)}
    rows_in_frame: Column = F.lit(1)
    for k in range(1, warmup):
        rows_in_frame = rows_in_frame + F.when(F.col("_us") - before[k] <= us, 1).otherwise(0)
    previous_full = (
        (before[1] - before[warmup] <= us) & (F.col("_us") - before[1] <= us) & ~F.lag("_early", 1).over(arrival)
    )
    followed = F.lead("_us", 1).over(arrival) - F.col("_us") <= us
    framed = bucketed.withColumns({
        "_n": rows_in_frame,
        "_known": F.coalesce(previous_full, F.lit(False)),
        "_followed": F.coalesce(followed, F.lit(False)),
    }).filter(~F.col("_halo"))

    # A full frame leaves a full buffer whatever came before, so the line after it draws.
    # The rest is folded: stretches of short frames, from the full one before them.
    full = (F.col("_n") > enough) & ~F.col("_early")
    plain = F.col("_known") & full & F.col("_followed")
    after_full = F.lit(warmup + 1)
    code = (
        F.when(F.col("_early"), F.lit(0))
        .when(F.col("_known"), after_full + F.col("_n")).otherwise(F.col("_n"))
    )

    def next_rows(rows: Column, c: Column) -> Column:
        known = c > after_full
        n = F.when(known, c - after_full).otherwise(c)
        draws = known | ((rows >= enough) & (c > 0)) | (n > enough)
        return F.least(F.when(draws, n).otherwise(rows + 1), F.lit(enough))

    states = with_states(
        framed.filter(~plain).withColumn("_code", code), ["device_id"], pos, "_code", warmup, next_rows,
        **({} if fold_width is None else {"width": fold_width}),
    )
    c = F.col("_code")
    draws = (c > after_full) | ((F.col("state") >= enough) & (c > 0)) | (c > enough)
    return (
        framed.filter(plain).select("device_id", pos, F.lit(True).alias("emitted"))
        .unionByName(states.select("device_id", pos, draws.alias("emitted")))
    )


def elapsed_seconds(
    arrivals: DataFrame, window_s: int = WINDOW_S, time: str = "ts"
) -> DataFrame:
    """Seconds since the device's first row, and since the first row of the trailing window."""
    starts = arrivals.groupBy("device_id").agg(F.min(time).alias("_start"))
    rows, halves = _halves(arrivals, ["device_id"], window_s, time)
    timed = rows.withColumn("_first_us", F.least(*halves(F.min, F.col("_us")))).filter(~F.col("_halo"))
    return timed.join(broadcast_if_small(frozen(starts)), "device_id").select(
        "device_id", "id",
        T.seconds_between(F.col(time), F.col("_start")).alias("since_start"),
        ((F.col("_us") - F.col("_first_us")) / F.lit(1e6)).alias("in_window"),
    )


def diff_time(readings: DataFrame, width: int | None = None) -> DataFrame:
    """Seconds since the previous stored row of the sensor, NULL for its first."""
    rows = readings.select(*KEY, "id", "T")
    sizes = {} if width is None else {"width": width}
    return with_lags(rows, KEY, "id", F.col("T"), **sizes).select(
        *KEY, "id", "T", T.seconds_between(F.col("T"), F.col("lag_1")).alias("gap")
    )


def series_order(readings: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Rows in drawing order with ``row_no`` per series (``keys`` may be the sensor alone).

    Rows are numbered in cells of an hour, after the counts of the hours before, and
    sorted last: one range sort spreads even a single hot series over all tasks.
    """
    within = ["T", *[c for c in ("device_id",) if c not in keys], "id"]
    numbered = with_ordinal(readings, keys, F.date_trunc("hour", "T"), within, "row_no")
    return numbered.orderBy(*keys, *within)
