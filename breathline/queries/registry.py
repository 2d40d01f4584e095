"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from breathline.functions import lines as L
from breathline.functions import numbers as N
from breathline.functions import times as T
from breathline.operators import enrich, filters, ingest, publish, reshape, sketches, summary, sync, trailing
from breathline.plans import selection
from breathline.queries import fixtures as fx
from breathline.schema import KEY, READING
from breathline.session import scratch, streaming_session, utc
from breathline.sinks import lines as line_sink
from breathline.sinks import onefile
from breathline.sinks import readings as sink
from breathline.sinks import send as sender
from breathline.sources import feed as line_feed
from breathline.sources import lines as line_source
from breathline.sources import readings as source
from breathline.streaming import late as late_rows
from breathline.streaming import live as live_view
from breathline.streaming import partials
from breathline.streaming import publish as live_publish
from breathline.streaming import store
from breathline.streaming import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

START, END = "2024-01-08 00:00:00", "2024-01-15 12:00:00"
HOUR, DAY = 3600, 86400
LINE = ["device_id", "line_id"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf: fn(utc(spark), sf)
    return fn


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


# Stored inputs ---------------------------------------------------------------------


def stored_readings(spark: SparkSession, rows: DataFrame, name: str) -> str:
    path = scratch(spark, name)
    sink.append_readings(rows, path)
    return path


def stored_lines(spark: SparkSession, sf: str) -> str:
    path = scratch(spark, "raw-lines")
    fx.raw_lines(spark, sf).write.parquet(path)
    return path


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.classify_lines(fx.raw_lines(spark, sf), fx.lut(spark, sf))


def accepted(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.accepted(classified(spark, sf))


def long_readings(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.wide_to_long(accepted(spark, sf), fx.lut(spark, sf))


def masked_readings(spark: SparkSession, sf: str) -> DataFrame:
    lines = ingest.accepted(ingest.classify_lines(fx.mostly_valid_lines(spark, sf), fx.lut(spark, sf)))
    return ingest.wide_to_long(lines, fx.lut(spark, sf), mask=True)


def decoded(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.decode_readings(fx.readings(spark, sf))


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.flag_readings(fx.readings(spark, sf), fx.ranges(spark, sf))


def summarised(spark: SparkSession, sf: str) -> DataFrame:
    rows = summary.device_summary(flagged(spark, sf), fx.AS_OF)
    for name in ("min", "max", "mean", "sd", "median", "avg_sampling_period"):
        rows = rows.withColumn(name, r6(name))
    return rows


def calibrated(spark: SparkSession, sf: str) -> DataFrame:
    means = reshape.oversample_mean(fx.adc_samples(spark, sf))
    return means.withColumn("ppm", N.calibrate(F.col("mean_adc")))


# Sources ---------------------------------------------------------------------------


@query
def scan_raw_lines(spark, sf):
    path = scratch(spark, "text-lines")
    bare = fx.raw_lines(spark, sf).withColumn("line", L.trim_line(F.col("line")))
    line_sink.write_lines(bare, path)
    return line_source.scan_text_lines(spark, path).select("device_id", "line")


@query
def scan_text_feed(spark, sf):
    """The same text files cut by bytes; ``own_id`` says that no other line has the line's id."""
    path = scratch(spark, "text-feed")
    bare = fx.raw_lines(spark, sf).withColumn("line", L.trim_line(F.col("line")))
    line_sink.write_lines(bare, path)
    lines = line_feed.scan_text_feed(spark, path, split_bytes=1 << 16)
    same = lines.groupBy("line_id").agg(F.count("*").alias("lines"))
    return lines.join(same, "line_id").select("device_id", "line", (F.col("lines") == 1).alias("own_id"))


@query
def scan_adc_samples(spark, sf):
    path = scratch(spark, "samples")
    fx.adc_samples(spark, sf).write.parquet(path)
    return line_source.scan_adc_samples(spark, path)


@query
def scan_ranges(spark, sf):
    """Limits of as many sensors as there are parts."""
    path = scratch(spark, "ranges")
    centre = F.col("p_retailprice")
    fx.table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("sensor_id"), centre.alias("set"),
        (centre - F.col("p_size")).alias("min"), (centre + F.col("p_size")).alias("max"),
    ).write.option("header", True).csv(path)
    rows = source.scan_ranges(spark, path)
    return rows.select("sensor_id", *[r6(c).alias(c) for c in ("set", "min", "max")])


@query
def scan_device_range(spark, sf):
    path = stored_readings(spark, fx.readings(spark, sf), "readings")
    return source.scan_device_range(source.scan_readings(spark, path), "click", START, END)


@query
def discover_devices(spark, sf):
    devices = source.discover_devices(fx.readings(spark, sf))
    others = source.discover_devices(fx.readings(spark, sf), own=fx.OWN).withColumn("other", F.lit(True))
    return devices.join(others, "device_id", "left").select(
        "device_id", F.coalesce("other", F.lit(False)).alias("other")
    )


# Sinks -----------------------------------------------------------------------------


@query
def sink_create_table(spark, sf):
    location = scratch(spark, "readings-table")
    name = f"readings_{location[-8:]}"
    for _ in range(2):
        sink.create_table(spark, name, location)
    sink.append_to_table(fx.readings(spark, sf), name)
    spark.sql(f"DROP TABLE {name}")  # external, the rows stay
    return source.scan_readings(spark, location).select(*source.COLUMNS)


@query
def sink_append_readings(spark, sf):
    path = stored_readings(spark, fx.sync_target(spark, sf), "readings")
    published = publish.publish_median(
        decoded(spark, sf).withColumnRenamed("CO2_ppm", "v"), DAY, time="T", keys=KEY
    )
    sink.write_published(publish.encode_published(published), path)
    return source.scan_readings(spark, path).select(*source.COLUMNS)


@query
def sink_raw_log(spark, sf):
    path = scratch(spark, "raw-log")
    parsed = ingest.accepted(ingest.classify_lines(fx.raw_lines(spark, sf)))
    line_sink.write_lines(line_sink.log_lines(parsed), path)
    return line_source.scan_text_lines(spark, path).select("device_id", "line")


@query
def replay_recorded_log(spark, sf):
    """What a log publishes when it is read back; equal to ``publish_median`` of the feed."""
    path, lut = scratch(spark, "replay"), fx.lut(spark, sf)
    parsed = ingest.accepted(ingest.classify_lines(fx.raw_lines(spark, sf)))
    line_sink.write_lines(line_sink.log_lines(parsed), path)
    lines = ingest.accepted(ingest.classify_lines(line_source.scan_recorded_log(spark, path), lut))
    published = publish.publish_median(ingest.wide_to_long(lines, lut), DAY)
    return published.select(*publish.CHANNEL, "T", N.round_tenths(F.col("tenths")).alias("tenths"), "n")


@query
def sink_export_csv(spark, sf):
    stored = source.scan_readings(spark, stored_readings(spark, fx.readings(spark, sf), "export-store"))
    rows = enrich.flag_readings(filters.filter_time_between(stored, START, END), fx.ranges(spark, sf))
    path = sink.export_csv(rows, scratch(spark, "export"), "readings", START, END)
    back = spark.read.schema(rows.schema).option("header", True).csv(path)
    return back.withColumn("file_name", F.lit(path.rsplit("/", 1)[1]))


@query
def sink_export_one_csv(spark, sf):
    stored = source.scan_readings(spark, stored_readings(spark, fx.readings(spark, sf), "export-store"))
    rows = enrich.flag_readings(filters.filter_time_between(stored, START, END), fx.ranges(spark, sf))
    path = onefile.export_one_csv(rows, scratch(spark, "one-export"), "readings", START, END, ["device_id", "id"])
    back = spark.read.schema(rows.schema).option("header", True).csv(path)
    return back.withColumn("file_name", F.lit(path.rsplit("/", 1)[1]))


@query
def sink_wide_lines(spark, sf):
    path = scratch(spark, "wide-lines")
    wide = reshape.long_to_wide(calibrated(spark, sf), ["device_id", "block"], "ppm")
    line_sink.write_lines(line_sink.encoded_lines(wide), path)
    return line_source.scan_text_lines(spark, path).select("device_id", "line")


# Line ingest -----------------------------------------------------------------------


@query
def line_trim(spark, sf):
    return fx.raw_lines(spark, sf).select(*LINE, L.trim_line(F.col("line")).alias("text"))


@query
def line_skip_comments(spark, sf):
    lines = fx.raw_lines(spark, sf)
    return lines.filter(~L.is_comment(F.col("line"))).select(*LINE, L.trim_line(F.col("line")).alias("text"))


@query
def line_split(spark, sf):
    fields = L.split_fields(L.trim_line(F.col("line")))
    return fx.raw_lines(spark, sf).select(*LINE, F.posexplode(fields).alias("position", "field"))


@query
def line_parse_floats(spark, sf):
    parsed = ingest.classify_lines(fx.raw_lines(spark, sf))
    return parsed.filter(~L.has_bad_field(F.col("values"))).select(
        *LINE, F.posexplode("values").alias("position", "v")
    )


@query
def line_check_arity(spark, sf):
    kept = classified(spark, sf).filter(F.coalesce("reason", F.lit("")) != "wrong_arity")
    return kept.select(*LINE, F.size("values").alias("n_values"))


@query
def line_quarantine(spark, sf):
    return ingest.quarantined(classified(spark, sf)).select(*LINE, "reason")


@query
def range_flag(spark, sf):
    long = long_readings(spark, sf)
    bad = N.out_of_range(F.col("v"))
    return long.groupBy("device_id", "sensor_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("n_outside"),
        r6(F.sum(F.when(bad, F.col("v")))).alias("sum_outside"),
    )


@query
def range_mask(spark, sf):
    return masked_readings(spark, sf).select(*LINE, "sensor_id", "v")


@query
def filter_time_between(spark, sf):
    return filters.filter_time_between(fx.readings(spark, sf), START, END)


@query
def filter_local_dates(spark, sf):
    return filters.filter_local_dates(fx.readings(spark, sf), "2024-01-10", "2024-01-20", "2024-01-30 20:15:30")


@query
def filter_zoom(spark, sf):
    rows = fx.readings(spark, sf)
    brushed = filters.filter_zoom(rows, START, END, 1704844800.0, 1705017600.0)
    full = filters.filter_zoom(rows, START, END)
    return brushed.withColumn("brush", F.lit(True)).unionByName(full.withColumn("brush", F.lit(False)))


@query
def filter_newer_than(spark, sf):
    marks = sync.marks(fx.readings(spark, sf), fx.sync_target(spark, sf))
    return filters.filter_newer_than(fx.readings(spark, sf), marks)


@query
def drop_missing_sensor(spark, sf):
    published = publish.publish_median(masked_readings(spark, sf), DAY)
    return publish.drop_missing_sensor(published).select(*publish.CHANNEL, "T", "n")


# Scalar columns --------------------------------------------------------------------


@query
def calibrate_linear(spark, sf):
    rows = fx.adc_samples(spark, sf)
    return rows.select(
        "device_id", "channel", "sample_no", r6(N.calibrate(F.col("adc").cast("double"))).alias("ppm")
    )


@query
def encode_tenths(spark, sf):
    rows = long_readings(spark, sf)
    return rows.select(
        *LINE, "sensor_id", N.encode_tenths(F.col("v")).alias("PPM_10X"),
        N.tenths_status(F.col("v") * F.lit(10.0)).alias("status"),
    )


@query
def decode_tenths(spark, sf):
    return decoded(spark, sf).select("device_id", "id", "CO2_ppm", "sensor_id")


@query
def tag_device(spark, sf):
    """Files that hold no device, tagged by their folders in one scan."""
    return source.scan_device_folders(spark, stored_readings(spark, fx.readings(spark, sf), "tagged")).select(*source.COLUMNS)


@query
def stamp_utc_seconds(spark, sf):
    return fx.arrivals(spark, sf).select("device_id", "id", T.stamp_seconds(F.col("ts")).alias("T"))


@query
def elapsed_seconds(spark, sf):
    rows = trailing.elapsed_seconds(fx.arrivals(spark, sf), HOUR)
    return rows.select("device_id", "id", r6("since_start").alias("since_start"), r6("in_window").alias("in_window"))


@query
def in_range_flag(spark, sf):
    rows = flagged(spark, sf)
    strict = enrich.in_range(F.col("CO2_ppm"), F.col("min"), F.col("max"), "null")
    return rows.select("device_id", "id", "in_range", strict.alias("in_range_or_null"))


@query
def to_local_time(spark, sf):
    return fx.readings(spark, sf).select("device_id", "id", T.to_local(F.col("T")).alias("local_t"))


@query
def label_last_point(spark, sf):
    last = summary.last_per_key(decoded(spark, sf))
    label = L.last_point_label(F.col("sensor_id"), F.col("device_id"), F.col("CO2_ppm"), T.clock_text(F.col("T")))
    return last.select("device_id", "sensor_id", label.alias("label"))


@query
def age_text(spark, sf):
    return fx.readings(spark, sf).select("device_id", "id", T.age_text(F.col("T"), fx.AS_OF).alias("age"))


# Reshape and joins -----------------------------------------------------------------


@query
def wide_to_long(spark, sf):
    return long_readings(spark, sf).select(*LINE, "arrival_ts", "channel", "sensor_id", "v")


@query
def long_to_wide(spark, sf):
    wide = reshape.long_to_wide(fx.adc_samples(spark, sf), ["device_id", "sample_no"], "adc")
    return wide.select("device_id", "sample_no", F.array_join("values", ",").alias("adcs"))


@query
def join_ranges(spark, sf):
    return enrich.join_ranges(decoded(spark, sf), fx.ranges(spark, sf))


@query
def join_lut(spark, sf):
    joined = ingest.join_lut(fx.adc_samples(spark, sf), fx.lut(spark, sf))
    return joined.select("device_id", "sample_no", "channel", "sensor_id", "adc")


@query
def setpoint_overlay(spark, sf):
    return enrich.setpoint_overlay(decoded(spark, sf), fx.ranges(spark, sf))


# Aggregations ----------------------------------------------------------------------


@query
def oversample_mean(spark, sf):
    return calibrated(spark, sf).select(
        "device_id", "channel", "block", r6("mean_adc").alias("mean_adc"), r6("ppm").alias("ppm")
    )


@query
def publish_median(spark, sf):
    published = publish.publish_median(long_readings(spark, sf), DAY)
    return published.select(*publish.CHANNEL, "T", N.round_tenths(F.col("tenths")).alias("tenths"), "n")


@query
def publish_median_masked(spark, sf):
    published = publish.drop_missing_sensor(publish.publish_median(masked_readings(spark, sf), DAY // 4))
    return publish.encode_published(published)


@query
def publish_median_carry(spark, sf):
    lines, lut = accepted(spark, sf), fx.lut(spark, sf)
    published = publish.publish_median_carry(lines, ingest.wide_to_long(lines, lut), 2 * HOUR)
    return published.select(*publish.CHANNEL, "T", r6("tenths").alias("tenths"), "n")


@query
def summary_min_max(spark, sf):
    return summarised(spark, sf).select("device_id", "sensor_id", "min", "max")


@query
def summary_mean_sd(spark, sf):
    return summarised(spark, sf).select("device_id", "sensor_id", "mean", "sd")


@query
def summary_median(spark, sf):
    return summarised(spark, sf).select("device_id", "sensor_id", "median")


@query
def median_by_selection(spark, sf):
    """Exact medians of groups of any number of different values; few settle, so that rounds run."""
    rows = selection.exact_quantile(fx.arrivals(spark, sf), KEY, "v", settle=64, name="median")
    return rows.withColumn("median", r6("median"))


@query
def median_by_sketch(spark, sf):
    """Medians from stored hourly sketches, and whether their exact rank is within the stated error."""
    path, rows = scratch(spark, "sketches"), fx.arrivals(spark, sf)
    sketches.write_sketches(sketches.hourly_sketches(rows, time="ts"), path)
    medians = sketches.sketched_quantiles(spark.read.parquet(path), {"median": 0.5})
    errors = sketches.rank_errors(rows, medians, "median", 0.5)
    return errors.select(*KEY, "n", (F.col("rank_error") <= sketches.RANK_ERROR).alias("within"))


@query
def summary_count(spark, sf):
    return summarised(spark, sf).select("device_id", "sensor_id", "N")


@query
def summary_last_point(spark, sf):
    return summarised(spark, sf).select("device_id", "sensor_id", "last_T", "last_point")


@query
def summary_sampling_period(spark, sf):
    return summarised(spark, sf).select("device_id", "sensor_id", "avg_sampling_period")


@query
def device_summary(spark, sf):
    return summarised(spark, sf)


@query
def high_water_mark(spark, sf):
    devices = source.discover_devices(fx.readings(spark, sf))
    return summary.high_water_mark(devices, fx.sync_target(spark, sf))


# Looking back ----------------------------------------------------------------------


@query
def trailing_stats(spark, sf):
    return trailing.trailing_stats(fx.arrivals(spark, sf), 2 * HOUR)


@query
def trailing_minmax_scale(spark, sf):
    channels = ingest.most_channels(fx.lut(spark, sf))
    rows = trailing.trailing_minmax_scale(accepted(spark, sf), channels, window_s=DAY)
    return rows.withColumn("scaled", r6("scaled"))


@query
def trailing_stats_dense(spark, sf):
    return trailing.trailing_stats_dense(fx.arrivals(spark, sf), 2 * HOUR)


@query
def trailing_minmax_scale_dense(spark, sf):
    return trailing.trailing_minmax_scale_dense(accepted(spark, sf), DAY).withColumn("scaled", r6("scaled"))


@query
def trailing_warmup_gate(spark, sf):
    return trailing.trailing_warmup_gate(fx.arrival_lines(spark, sf), 2 * HOUR)


@query
def diff_time(spark, sf):
    return trailing.diff_time(decoded(spark, sf))


@query
def first_per_key(spark, sf):
    return summary.first_per_key(decoded(spark, sf))


@query
def last_per_key(spark, sf):
    return summary.last_per_key(decoded(spark, sf))


@query
def series_order(spark, sf):
    return trailing.series_order(decoded(spark, sf).select("device_id", "sensor_id", "id", "T", "CO2_ppm"))


@query
def union_devices(spark, sf):
    """One scan of the table that all devices share; a filter on ``device_id`` prunes folders."""
    return source.scan_readings(spark, stored_readings(spark, fx.readings(spark, sf), "per-device")).select(*source.COLUMNS)


@query
def distinct_device_sensor(spark, sf):
    return summary.distinct_device_sensor(decoded(spark, sf))


# Replication -----------------------------------------------------------------------


@query
def sync_incremental(spark, sf):
    own = stored_readings(spark, fx.readings(spark, sf), "source")
    path = stored_readings(spark, fx.sync_target(spark, sf), "target")
    sink.sync_stores(spark, own, path)
    return source.scan_readings(spark, path).select(*source.COLUMNS)


@query
def sync_chunks(spark, sf):
    own = stored_readings(spark, fx.readings(spark, sf), "source")
    path = stored_readings(spark, fx.sync_target(spark, sf), "target")
    return sink.sync_stores_in_chunks(spark, own, path)


@query
def sync_send(spark, sf):
    """Chunks of the lower half of the ids, then a second send of the rest; what counts as sent."""
    root, rows = scratch(spark, "sent"), fx.readings(spark, sf)
    half = rows.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY id)")).first()[0]
    sender.send_in_chunks(rows.filter(F.col("id") <= half), root, 1001)
    sender.send_in_chunks(rows, root, 1001)
    return sender.scan_sent(spark, root)


@query
def mirror_two_way(spark, sf):
    """The local store has its own rows only, the central one lags behind."""
    rows = fx.readings(spark, sf)
    local = stored_readings(spark, rows.filter(F.col("device_id") == fx.OWN), "local")
    central = stored_readings(spark, fx.sync_target(spark, sf), "central")
    sink.mirror(spark, fx.OWN, local, central)
    return (
        source.scan_readings(spark, local).withColumn("store", F.lit("local"))
        .unionByName(source.scan_readings(spark, central).withColumn("store", F.lit("central")))
        .select("store", *source.COLUMNS)
    )


# Streams ---------------------------------------------------------------------------


def run_to_parquet(spark: SparkSession, stream: DataFrame, name: str, out: str | None = None) -> DataFrame:
    """Drain the stream into a table, a new one or that of an earlier run, and read that."""
    out = out or scratch(spark, name)
    (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def live_lines(spark: SparkSession, sf: str) -> DataFrame:
    feed = line_source.scan_raw_lines(spark, stored_lines(spark, sf), streaming=True)
    return ingest.accepted(ingest.classify_lines(feed, fx.lut(spark, sf)))


@query
def stream_ingest(spark, sf):
    long = ingest.wide_to_long(live_lines(spark, sf), fx.lut(spark, sf))
    return run_to_parquet(spark, long.select(*LINE, "arrival_ts", "channel", "sensor_id", "v"), "ingest")


@query
def stream_publish_tumbling(spark, sf):
    live = streaming_session(spark)
    long = ingest.wide_to_long(live_lines(live, sf), fx.lut(live, sf))
    published = live_publish.stream_publish_tumbling(long, "1 hour", DAY)
    rows = run_to_parquet(spark, published, "tumbling")
    return rows.withColumn("tenths", r6("tenths"))


@query
def stream_publish_accounted(spark, sf):
    """Windows of a feed in which every seventh line comes ten days late; a run of the stream per part."""
    live = live_view.with_state_store(streaming_session(spark))
    feed, out = scratch(spark, "late-feed"), scratch(spark, "accounted")
    part = F.least(F.lit(2), F.floor((F.dayofmonth("arrival_ts") - 1) / 10)) + (F.col("line_id") % 7 == 0).cast("int")
    raw, rows = fx.raw_lines(spark, sf).withColumn("part", part), None
    for number in range(4):
        raw.filter(F.col("part") == number).drop("part").write.mode("append").parquet(feed)
        lines = ingest.accepted(ingest.classify_lines(line_source.scan_raw_lines(live, feed, streaming=True), fx.lut(live, sf)))
        stream = late_rows.stream_publish_accounted(ingest.wide_to_long(lines, fx.lut(live, sf)), "1 hour", DAY)
        rows = run_to_parquet(spark, stream, "accounted", out)
    return rows.withColumn("tenths", r6("tenths"))


@query
def stream_publish_carry(spark, sf):
    """The feed comes in files in arrival order, one to a micro-batch (the rate limit)."""
    feed, out, checkpoint = (scratch(spark, n) for n in ("feed", "carry", "carry-checkpoint"))
    fx.arriving_files(fx.raw_lines(spark, sf), feed)
    arrived = ingest.accepted(ingest.classify_lines(
        line_source.scan_raw_lines(spark, feed, streaming=True, files_per_batch=1), fx.lut(spark, sf)))
    sink_of = live_publish.carry_sink(out, live_publish.to_folder(f"{out}/rows"), 4 * HOUR)
    store.start_store(arrived, sink_of, checkpoint, availableNow=True).awaitTermination()
    rows = spark.read.parquet(f"{out}/rows").drop("batch")
    return rows.withColumn("tenths", r6("tenths"))


@query
def stream_trailing(spark, sf):
    arrivals = fx.arrivals(streaming_session(spark), sf, streaming=True)
    view = views.stream_trailing(arrivals, "1 hour", "6 hours", "1 hour")
    return run_to_parquet(spark, view, "trailing")


@query
def stream_trailing_rows(spark, sf):
    """The live view of every drawn line; the feed comes in files, one to a micro-batch."""
    live = live_view.with_state_store(streaming_session(spark))
    feed = scratch(spark, "live-feed")
    fx.arriving_files(fx.raw_lines(spark, sf), feed)
    lines = ingest.accepted(ingest.classify_lines(
        line_source.scan_raw_lines(live, feed, streaming=True, files_per_batch=1), fx.lut(live, sf)))
    rows = run_to_parquet(spark, live_view.stream_trailing_rows(lines, 6 * HOUR), "live")
    return rows.filter("not late").drop("late").withColumn("scaled", r6("scaled"))


@query
def stream_join_ranges(spark, sf):
    rows = enrich.flag_readings(fx.readings(spark, sf, streaming=True), fx.ranges(spark, sf))
    return run_to_parquet(spark, rows, "join-ranges")


@query
def stream_refresh_summary(spark, sf):
    """The summary that the last tick leaves, of a range of local dates."""
    root, out, checkpoint = (scratch(spark, n) for n in ("refresh-store", "summary", "refresh-checkpoint"))
    store.seed_store(fx.sync_target(spark, sf), root)
    views.start_refresh_summary(
        fx.readings(spark, sf, streaming=True), fx.ranges(spark, sf), root, out, checkpoint,
        lambda: fx.AS_OF, ("2024-01-05", "2024-01-25"), availableNow=True,
    ).awaitTermination()
    back = views.latest_refresh(spark, out)
    figures = ("min", "max", "mean", "sd", "median", "avg_sampling_period")
    return back.select("device_id", "sensor_id", "last_T", "last_point", "N", *[r6(c).alias(c) for c in figures])


@query
def stream_refresh_counts(spark, sf):
    """The same from hourly counts, with a feed of files, one to a tick."""
    root, out, checkpoint, feed = (scratch(spark, n) for n in ("counts-store", "counts-summary", "counts-checkpoint", "counts-feed"))
    target = fx.sync_target(spark, sf)
    store.seed_store(target, root)
    partials.seed_counts(target, root)
    fx.arriving_files(fx.readings(spark, sf), feed, 5, "id")
    arriving = spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(feed)
    sink_of = partials.refresh_sink(root, fx.ranges(spark, sf), out, lambda: fx.AS_OF, ("2024-01-05", "2024-01-25"), merge_every=2)
    store.start_store(arriving, sink_of, checkpoint, availableNow=True).awaitTermination()
    back = views.latest_refresh(spark, out)
    figures = ("min", "max", "mean", "sd", "median", "avg_sampling_period")
    return back.select("device_id", "sensor_id", "last_T", "last_point", "N", *[r6(c).alias(c) for c in figures])


@query
def stream_sync_sink(spark, sf):
    root, checkpoint = scratch(spark, "store"), scratch(spark, "store-checkpoint")
    store.seed_store(fx.sync_target(spark, sf), root)
    store.start_store(
        fx.readings(spark, sf, streaming=True), store.sync_sink(root), checkpoint, availableNow=True
    ).awaitTermination()
    return store.stored_rows(spark, root).select(*READING.fieldNames())
