"""The same results in SQL, stated on their own terms, for DuckDB over the given tables."""

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
START, END = "TIMESTAMP '2024-01-08 00:00:00'", "TIMESTAMP '2024-01-15 12:00:00'"
NUMBER = (
    r"^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
)

RD = """rd AS (
    SELECT event_type AS device_id, event_id AS id, date_trunc('second', ts) AS "T",
           CAST(user_id % 12 + 1 AS INT) AS "SENSOR",
           CAST(round_even(value * 8 + 400, 0) * 10 AS INT) AS "PPM_10X"
    FROM events)"""

RANGES = """ranges AS (
    SELECT CAST(s_suppkey + CASE WHEN s_suppkey >= 11 THEN 2 ELSE 0 END AS INT) AS sensor_id,
           round(abs(s_acctbal) / 4 + 400, 2) AS "set",
           CASE WHEN s_suppkey % 7 = 3 THEN NULL ELSE round(abs(s_acctbal) / 4 + 400 - 150, 2) END AS "min",
           CASE WHEN s_suppkey % 5 = 4 THEN NULL ELSE round(abs(s_acctbal) / 4 + 400 + 250, 2) END AS "max"
    FROM supplier)"""

LUT = """lut AS (
    SELECT 'dev_' || n_regionkey AS device_id, CAST(n_nationkey // 5 AS INT) AS channel,
           CAST(CASE WHEN n_regionkey = 4 AND n_nationkey // 5 = 4 THEN 4 ELSE n_nationkey // 5 + 1 END
                + CASE WHEN n_regionkey IN (1, 3) THEN 5 ELSE 0 END AS INT) AS sensor_id
    FROM nation)"""

DECODED = RD + """,
dec AS (SELECT *, "PPM_10X" / 10.0::DOUBLE AS "CO2_ppm", "SENSOR" AS sensor_id FROM rd)"""

DASH = DECODED + ",\n" + RANGES + """,
dash AS (
    SELECT dec.*, "set", "min", "max",
           CASE WHEN "min" IS NULL AND "max" IS NULL THEN TRUE
                WHEN "min" IS NULL THEN "CO2_ppm" <= "max"
                WHEN "max" IS NULL THEN "CO2_ppm" >= "min"
                ELSE "CO2_ppm" BETWEEN "min" AND "max" END AS in_range
    FROM dec LEFT JOIN ranges USING (sensor_id))"""

ARRIVALS = """arrivals AS (
    SELECT event_type AS device_id, event_id AS id, ts, CAST(user_id % 12 + 1 AS INT) AS sensor_id, value AS v
    FROM events)"""

SAMPLES = """samples AS (
    SELECT 'dev_' || ((event_id // 5) % 5) AS device_id, CAST(event_id % 5 AS INT) AS channel,
           event_id // 25 AS sample_no, CAST(least(1023, floor(value * 8)) AS INT) AS adc
    FROM events)"""

TARGET = RD + """,
dst AS (
    SELECT * FROM rd
    WHERE id % 7 <> 0
      AND (device_id IN ('purchase', 'signup')
           OR (device_id = 'click' AND "T" < TIMESTAMP '2024-01-16')
           OR (device_id = 'error' AND "T" < TIMESTAMP '2024-01-08')))"""

MISSING = TARGET + """,
missing AS (
    SELECT * FROM rd
    WHERE id > coalesce((SELECT max(d.id) FROM dst d WHERE d.device_id = rd.device_id), -1))"""


def _lines(gain: str, base: str, line: str) -> str:
    return f"""good AS (
    SELECT event_id // 5 AS line_id, min(ts) AS arrival_ts,
           string_agg(printf('%.2f', round(value * {gain}::DOUBLE + {base}::DOUBLE, 2)), ',' ORDER BY event_id) || ',' AS ln
    FROM events GROUP BY ALL),
raw AS (
    SELECT 'dev_' || (line_id % 5) AS device_id, line_id, arrival_ts, {line} AS line
    FROM (SELECT *, chr(13) || chr(10) AS eol FROM good))"""


RAW = _lines("60", "0", """CASE line_id % 97
        WHEN 3 THEN '#' || ln || eol
        WHEN 5 THEN 't,1,2' || eol
        WHEN 7 THEN ''
        WHEN 11 THEN ln || '9.00,' || eol
        WHEN 13 THEN ln || 'x1' || eol
        WHEN 17 THEN ',' || ln || eol
        WHEN 19 THEN ln || '1d' || eol
        ELSE ln || eol END""")

VALID = _lines("20", "290", "ln || eol")

PARSED = f"""{LUT},
parsed AS (
    SELECT *, list_transform(fields, lambda f:
               CASE WHEN regexp_matches(f, '{NUMBER}') THEN TRY_CAST(replace(trim(f), '_', '') AS DOUBLE) END) AS vs
    FROM (SELECT *, list_filter(string_split(text, ','), lambda f: f <> '') AS fields
          FROM (SELECT *, rtrim(line, chr(13) || chr(10) || chr(9) || ' ') AS text FROM raw))),
judged AS (
    SELECT parsed.*, len(vs) AS n_values,
           CASE WHEN line = '' THEN 'empty'
                WHEN text LIKE '#%' OR text LIKE 't%' THEN 'comment'
                WHEN len(list_filter(vs, lambda v: v IS NULL)) > 0 THEN 'not_float'
                WHEN len(vs) <> (SELECT count(*) FROM lut WHERE lut.device_id = parsed.device_id) THEN 'wrong_arity'
           END AS reason
    FROM parsed),
good_lines AS (SELECT * FROM judged WHERE reason IS NULL),
long AS (
    SELECT device_id, line_id, arrival_ts, channel, sensor_id, vs[channel + 1] AS v
    FROM good_lines JOIN lut USING (device_id))"""

LONG = RAW + ",\n" + PARSED
MASKED = VALID + ",\n" + PARSED + """,
masked AS (SELECT * EXCLUDE (v), CASE WHEN v >= 300 AND v <= 5000 THEN v END AS v FROM long)"""

LONG_COLUMNS = "device_id, line_id, arrival_ts, channel, sensor_id, v"


def _windows(rows: str, seconds: int, time: str, tenths: str, keys: str = "device_id, channel, sensor_id") -> str:
    """Median per epoch-aligned period of at least three rows."""
    return f"""
    SELECT {keys},
           make_timestamp((period + 1) * {seconds} * 1000000::BIGINT) AS "T", {tenths} AS tenths, count(*) AS n
    FROM (SELECT *, epoch_us({time}) // ({seconds} * 1000000::BIGINT) AS period FROM {rows})
    GROUP BY {keys}, period HAVING count(*) >= 3"""


MEDIAN = "median(v * 10)"
STRICT_MEDIAN = "CASE WHEN count(v) = count(*) THEN median(v * 10) END"

FIGURES = f""",
gaps AS (
    SELECT *, epoch_us("T") - epoch_us(lag("T") OVER (PARTITION BY device_id, sensor_id ORDER BY id)) AS gap_us
    FROM shown),
grouped AS (
    SELECT device_id, sensor_id, min("CO2_ppm") AS lo, max("CO2_ppm") AS hi, avg("CO2_ppm") AS mu,
           stddev_samp("CO2_ppm") AS sd, median("CO2_ppm") AS med, max_by("T", id) AS last_t,
           min_by("T", id) AS first_t, count(*) AS n, avg(gap_us) / 1e6 AS gap
    FROM gaps GROUP BY device_id, sensor_id),
summary AS (
    SELECT device_id, sensor_id, round(lo, 6) AS "min", round(hi, 6) AS "max", round(mu, 6) AS mean,
           round(sd, 6) AS sd, round(med, 6) AS median, last_t AS "last_T", first_t AS "first_T",
           printf('%02d:%02d:%02d ago', age // 3600, age // 60 % 60, age % 60) AS last_point,
           n AS "N", round(gap, 6) AS avg_sampling_period
    FROM (SELECT *, (epoch_us({AS_OF}) - epoch_us(last_t)) // 1000000 AS age FROM grouped))"""


# The local dates of the refreshed view, at the local time of day of AS_OF, and an hour.
REFRESHED = TARGET + """,
filled AS (
    SELECT * FROM dst UNION ALL
    SELECT * FROM rd WHERE id > coalesce((SELECT max(d.id) FROM dst d WHERE d.device_id = rd.device_id), -1)),
dec AS (SELECT *, "PPM_10X" / 10.0::DOUBLE AS "CO2_ppm", "SENSOR" AS sensor_id FROM filled
        WHERE "T" BETWEEN TIMESTAMP '2024-01-06 00:00:00' AND TIMESTAMP '2024-01-26 01:00:00'),
shown AS (SELECT * FROM dec)""" + FIGURES
SUMMARY = DASH + """,
shown AS (SELECT * FROM dash)""" + FIGURES


def _summary(*columns: str) -> str:
    return f"WITH {SUMMARY} SELECT device_id, sensor_id, {', '.join(columns)} FROM summary"


def _refreshed(*columns: str) -> str:
    return f"WITH {REFRESHED} SELECT device_id, sensor_id, {', '.join(columns)} FROM summary"


# A period joins the next one until three lines are together.
CARRY = LONG + """,
periods AS (
    SELECT device_id, tick, count(*) AS n, row_number() OVER (PARTITION BY device_id ORDER BY tick) AS rn
    FROM (SELECT *, epoch_us(arrival_ts) // 7200000000 AS tick FROM good_lines) GROUP BY device_id, tick),
run AS (
    SELECT device_id, 0::BIGINT AS rn, 0::BIGINT AS carried, NULL::BIGINT AS tick, FALSE AS emit, 0::BIGINT AS grp
    FROM (SELECT DISTINCT device_id FROM periods)
    UNION ALL
    SELECT p.device_id, p.rn, CASE WHEN run.carried + p.n >= 3 THEN 0 ELSE run.carried + p.n END,
           p.tick, run.carried + p.n >= 3, run.grp + CASE WHEN run.emit THEN 1 ELSE 0 END
    FROM run JOIN periods p ON p.device_id = run.device_id AND p.rn = run.rn + 1),
closed AS (
    SELECT device_id, grp, max(tick) AS close_tick FROM run WHERE rn > 0
    GROUP BY device_id, grp HAVING bool_or(emit))"""

# A line fills the buffer; five lines draw a frame, and only then old ones are dropped.
GATE = ARRIVALS + """,
numbered AS (
    SELECT device_id, id, row_number() OVER (PARTITION BY device_id ORDER BY id) AS rn,
           count(*) OVER (PARTITION BY device_id ORDER BY ts RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW) AS n
    FROM arrivals),
run AS (
    SELECT device_id, NULL::BIGINT AS id, 0::BIGINT AS rn, 0::BIGINT AS kept, FALSE AS emitted
    FROM (SELECT DISTINCT device_id FROM arrivals)
    UNION ALL
    SELECT r.device_id, r.id, r.rn, CASE WHEN run.kept + 1 >= 5 THEN r.n ELSE run.kept + 1 END, run.kept + 1 >= 5
    FROM run JOIN numbered r ON r.device_id = run.device_id AND r.rn = run.rn + 1)"""

# A push is due four hours after the last one, whether or not that one published.
PUSHES = LONG + """,
numbered AS (
    SELECT device_id, line_id, epoch_us(arrival_ts) AS us,
           row_number() OVER (PARTITION BY device_id ORDER BY arrival_ts, line_id) AS rn
    FROM good_lines),
run AS (
    SELECT device_id, 1::BIGINT AS rn, line_id, us AS last_push, 1::BIGINT AS held, FALSE AS published, 0::BIGINT AS grp
    FROM numbered WHERE rn = 1
    UNION ALL
    SELECT l.device_id, l.rn, l.line_id,
           CASE WHEN l.us - run.last_push >= 14400000000 THEN l.us ELSE run.last_push END,
           CASE WHEN run.published THEN 1 ELSE run.held + 1 END,
           l.us - run.last_push >= 14400000000 AND CASE WHEN run.published THEN 1 ELSE run.held + 1 END >= 3,
           run.grp + CASE WHEN run.published THEN 1 ELSE 0 END
    FROM run JOIN numbered l ON l.device_id = run.device_id AND l.rn = run.rn + 1),
pushed AS (
    SELECT device_id, grp, max(last_push) AS push_us, count(*) AS n FROM run
    GROUP BY device_id, grp HAVING bool_or(published))"""

# The same buffer over accepted lines, six hours wide, and the figures of what it holds.
DRAWN = LONG + """,
held AS (
    SELECT device_id, line_id, row_number() OVER (PARTITION BY device_id ORDER BY arrival_ts) AS rn,
           count(*) OVER (PARTITION BY device_id ORDER BY arrival_ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS n
    FROM good_lines),
run AS (
    SELECT device_id, NULL::BIGINT AS line_id, 0::BIGINT AS rn, 0::BIGINT AS kept, FALSE AS drawn
    FROM (SELECT DISTINCT device_id FROM held)
    UNION ALL
    SELECT h.device_id, h.line_id, h.rn, CASE WHEN run.kept + 1 >= 5 THEN h.n ELSE run.kept + 1 END, run.kept + 1 >= 5
    FROM run JOIN held h ON h.device_id = run.device_id AND h.rn = run.rn + 1),
figures AS (
    SELECT device_id, line_id, arrival_ts, channel, v AS latest, avg(v) OVER w AS mean, stddev_pop(v) OVER w AS sd,
           count(*) OVER w AS n, min(v) OVER w AS low, max(v) OVER w AS high
    FROM long WINDOW w AS (PARTITION BY device_id, channel ORDER BY arrival_ts
        RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW))"""

CHANNELS = [f"vs[{c + 1}]" for c in range(5)]
LIMITS = ", ".join(
    f"min({v}) OVER w AS lo{c}, max({v}) OVER w AS hi{c}" for c, v in enumerate(CHANNELS)
)
SCALED = " UNION ALL ".join(
    f"SELECT device_id, line_id, {c}::INT AS channel, round(1 - ({v} - lo{c}) / (hi{c} - lo{c}), 6) AS scaled FROM moving"
    for c, v in enumerate(CHANNELS)
)

ORACLE: dict[str, str] = {
    # Sources
    "scan_raw_lines": f"""WITH {RAW}
        SELECT device_id, rtrim(line, chr(13) || chr(10)) AS line FROM raw WHERE line <> ''""",
    "scan_text_feed": f"""WITH {RAW}
        SELECT device_id, rtrim(line, chr(13) || chr(10)) AS line, TRUE AS own_id FROM raw WHERE line <> ''""",
    "scan_adc_samples": f"WITH {SAMPLES} SELECT * FROM samples",
    "scan_ranges": """SELECT CAST(p_partkey AS INT) AS sensor_id, round(p_retailprice, 6) AS "set",
        round(p_retailprice - p_size, 6) AS "min", round(p_retailprice + p_size, 6) AS "max" FROM part""",
    "scan_device_range": f"""WITH {RD} SELECT * FROM rd WHERE device_id = 'click' AND "T" BETWEEN {START} AND {END}""",
    "discover_devices": "SELECT DISTINCT event_type AS device_id, event_type <> 'click' AS other FROM events",
    # Sinks
    "sink_create_table": f"WITH {RD} SELECT * FROM rd",
    "sink_append_readings": f"""WITH {TARGET},
        pub AS ({_windows('(SELECT *, "SENSOR" AS sensor_id, "PPM_10X" / 10::DOUBLE AS v FROM rd)', 86400, '"T"', MEDIAN, 'device_id, sensor_id')}),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY "T", sensor_id) AS no FROM pub
            WHERE round_even(tenths, 0) BETWEEN 0 AND 65535)
        SELECT * FROM dst UNION ALL
        SELECT device_id, no + coalesce((SELECT max(d.id) FROM dst d WHERE d.device_id = numbered.device_id), 0) AS id,
               "T", sensor_id AS "SENSOR", CAST(round_even(tenths, 0) AS INT) AS "PPM_10X" FROM numbered""",
    "sink_raw_log": f"""WITH {RAW}, {PARSED}
        SELECT device_id, printf('%.6f,%s', epoch_us(arrival_ts) / 1e6, text) AS line
        FROM judged WHERE reason IS NULL OR reason = 'wrong_arity'""",
    "sink_export_csv": f"""WITH {DASH} SELECT *, 'readings_2024-01-08-00-00-00_2024-01-15-12-00-00.csv' AS file_name
        FROM dash WHERE "T" BETWEEN {START} AND {END}""",
    "sink_wide_lines": f"""WITH {SAMPLES},
        blocks AS (
            SELECT device_id, channel, sample_no // 32 AS block, (avg(adc) * 1127 / 1024 - 400) * 50 / 16 AS ppm
            FROM samples GROUP BY ALL HAVING count(*) = 32)
        SELECT device_id, string_agg(printf('%.2f', ppm), ',' ORDER BY channel) || ',' AS line
        FROM blocks GROUP BY device_id, block""",
    "replay_recorded_log": f"""WITH {LONG}, pub AS ({_windows('long', 86400, 'arrival_ts', MEDIAN)})
        SELECT * EXCLUDE (tenths), CAST(round_even(tenths, 0) AS INT) AS tenths FROM pub""",
    # Line ingest
    "line_trim": f"WITH {RAW} SELECT device_id, line_id, rtrim(line, chr(13) || chr(10)) AS text FROM raw",
    "line_skip_comments": f"""WITH {RAW} SELECT device_id, line_id, rtrim(line, chr(13) || chr(10)) AS text
        FROM raw WHERE left(line, 1) NOT IN ('#', 't')""",
    "line_split": f"""WITH {RAW}, {PARSED}
        SELECT device_id, line_id, CAST(i - 1 AS INT) AS position, fields[i] AS field
        FROM (SELECT *, unnest(range(1, len(fields) + 1)) AS i FROM parsed)""",
    "line_parse_floats": f"""WITH {RAW}, {PARSED}
        SELECT device_id, line_id, CAST(i - 1 AS INT) AS position, vs[i] AS v
        FROM (SELECT *, unnest(range(1, len(vs) + 1)) AS i FROM parsed
              WHERE len(list_filter(vs, lambda v: v IS NULL)) = 0)""",
    "line_check_arity": f"""WITH {RAW}, {PARSED}
        SELECT device_id, line_id, CAST(n_values AS INT) AS n_values FROM judged
        WHERE reason IS NULL OR reason <> 'wrong_arity'""",
    "line_quarantine": f"WITH {RAW}, {PARSED} SELECT device_id, line_id, reason FROM judged WHERE reason IS NOT NULL",
    "range_flag": f"""WITH {LONG} SELECT device_id, sensor_id, count(*) AS n,
        count(*) FILTER (v NOT BETWEEN 300 AND 5000) AS n_outside,
        round(sum(v) FILTER (v NOT BETWEEN 300 AND 5000), 6) AS sum_outside FROM long GROUP BY ALL""",
    "range_mask": f"WITH {MASKED} SELECT device_id, line_id, sensor_id, v FROM masked",
    "filter_time_between": f"""WITH {RD} SELECT * FROM rd WHERE "T" BETWEEN {START} AND {END}""",
    "filter_local_dates": f"""WITH {RD} SELECT * FROM rd WHERE "T" BETWEEN
        (TIMESTAMP '2024-01-10 12:15:30' AT TIME ZONE 'America/Vancouver') AT TIME ZONE 'UTC' AND
        (TIMESTAMP '2024-01-20 13:15:30' AT TIME ZONE 'America/Vancouver') AT TIME ZONE 'UTC'""",
    "filter_zoom": f"""WITH {RD}
        SELECT *, TRUE AS brush FROM rd WHERE epoch_us("T") BETWEEN 1704844800000000 AND 1705017600000000
        UNION ALL SELECT *, FALSE AS brush FROM rd WHERE "T" BETWEEN {START} AND {END}""",
    "filter_newer_than": f"WITH {MISSING} SELECT * FROM missing",
    "drop_missing_sensor": f"""WITH {MASKED}, pub AS ({_windows('masked', 86400, 'arrival_ts', STRICT_MEDIAN)})
        SELECT device_id, channel, sensor_id, "T", n FROM pub WHERE tenths IS NOT NULL""",
    # Scalar columns
    "calibrate_linear": f"""WITH {SAMPLES} SELECT device_id, channel, sample_no,
        round((adc * 1127 / 1024::DOUBLE - 400) * 50 / 16, 6) AS ppm FROM samples""",
    "encode_tenths": f"""WITH {LONG} SELECT device_id, line_id, sensor_id,
        CASE WHEN round_even(v * 10, 0) BETWEEN 0 AND 65535 THEN CAST(round_even(v * 10, 0) AS INT) END AS "PPM_10X",
        CASE WHEN round_even(v * 10, 0) BETWEEN 0 AND 65535 THEN 'ok' ELSE 'overflow' END AS status FROM long""",
    "decode_tenths": f'WITH {DECODED} SELECT device_id, id, "CO2_ppm", sensor_id FROM dec',
    "tag_device": f"WITH {RD} SELECT * FROM rd",
    "stamp_utc_seconds": f"""WITH {ARRIVALS} SELECT device_id, id, date_trunc('second', ts) AS "T" FROM arrivals""",
    "elapsed_seconds": f"""WITH {ARRIVALS} SELECT device_id, id,
        round((epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY device_id))) / 1e6, 6) AS since_start,
        round((epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY device_id ORDER BY ts
            RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW))) / 1e6, 6) AS in_window FROM arrivals""",
    "in_range_flag": f"""WITH {DASH} SELECT device_id, id, in_range,
        "CO2_ppm" >= "min" AND "CO2_ppm" <= "max" AS in_range_or_null FROM dash""",
    "to_local_time": f"""WITH {RD} SELECT device_id, id,
        ("T" AT TIME ZONE 'UTC') AT TIME ZONE 'America/Vancouver' AS local_t FROM rd""",
    "label_last_point": f"""WITH {DECODED} SELECT device_id, sensor_id,
        sensor_id || '@' || device_id || ', ' || CAST(round_even("CO2_ppm", 0) AS BIGINT) || ' PPM' || chr(10)
        || strftime("T", '%Y-%m-%d %H:%M:%S') AS label
        FROM dec WHERE id IN (SELECT max(id) FROM dec GROUP BY device_id, sensor_id)""",
    "age_text": f"""WITH {RD} SELECT device_id, id,
        printf('%02d:%02d:%02d ago', age // 3600, age // 60 % 60, age % 60) AS age
        FROM (SELECT *, (epoch_us({AS_OF}) - epoch_us("T")) // 1000000 AS age FROM rd)""",
    # Reshape and joins
    "wide_to_long": f"WITH {LONG} SELECT {LONG_COLUMNS} FROM long",
    "long_to_wide": f"""WITH {SAMPLES} SELECT device_id, sample_no, string_agg(adc, ',' ORDER BY channel) AS adcs
        FROM samples GROUP BY ALL""",
    "join_ranges": f"WITH {DECODED}, {RANGES} SELECT * FROM dec LEFT JOIN ranges USING (sensor_id)",
    "join_lut": f"""WITH {SAMPLES}, {LUT} SELECT device_id, sample_no, channel, sensor_id, adc
        FROM samples JOIN lut USING (device_id, channel)""",
    "setpoint_overlay": f"""WITH {DECODED}, {RANGES} SELECT sensor_id, "set",
        sensor_id IN (SELECT sensor_id FROM dec) AS has_readings
        FROM (SELECT sensor_id FROM dec UNION SELECT sensor_id FROM ranges) LEFT JOIN ranges USING (sensor_id)""",
    # Aggregations
    "oversample_mean": f"""WITH {SAMPLES} SELECT device_id, channel, sample_no // 32 AS block,
        round(avg(adc), 6) AS mean_adc, round((avg(adc) * 1127 / 1024 - 400) * 50 / 16, 6) AS ppm
        FROM samples GROUP BY ALL HAVING count(*) = 32""",
    "publish_median": f"""WITH {LONG}, pub AS ({_windows('long', 86400, 'arrival_ts', MEDIAN)})
        SELECT * EXCLUDE (tenths), CAST(round_even(tenths, 0) AS INT) AS tenths FROM pub""",
    "publish_median_masked": f"""WITH {MASKED}, pub AS ({_windows('masked', 21600, 'arrival_ts', STRICT_MEDIAN)})
        SELECT device_id, channel, "T", n, CAST(round_even(tenths, 0) AS INT) AS "PPM_10X", sensor_id AS "SENSOR"
        FROM pub WHERE tenths IS NOT NULL AND round_even(tenths, 0) BETWEEN 0 AND 65535""",
    "publish_median_carry": f"""WITH RECURSIVE {CARRY}
        SELECT device_id, channel, sensor_id, make_timestamp((close_tick + 1) * 7200000000) AS "T",
               round(median(v * 10), 6) AS tenths, count(*) AS n
        FROM (SELECT *, epoch_us(arrival_ts) // 7200000000 AS tick FROM long)
        JOIN run USING (device_id, tick) JOIN closed USING (device_id, grp)
        GROUP BY device_id, channel, sensor_id, close_tick""",
    "summary_min_max": _summary('"min"', '"max"'),
    "summary_mean_sd": _summary("mean", "sd"),
    "summary_median": _summary("median"),
    "median_by_selection": f"""WITH {ARRIVALS}
        SELECT device_id, sensor_id, round(median(v), 6) AS median, count(*) AS n FROM arrivals GROUP BY ALL""",
    "median_by_sketch": f"""WITH {ARRIVALS}
        SELECT device_id, sensor_id, count(*) AS n, TRUE AS within FROM arrivals GROUP BY ALL""",
    "summary_count": _summary('"N"'),
    "summary_last_point": _summary('"last_T"', "last_point"),
    "summary_sampling_period": _summary("avg_sampling_period"),
    "device_summary": _summary(
        '"min"', '"max"', "mean", "sd", "median", '"last_T"', "last_point", '"N"', "avg_sampling_period"
    ),
    "high_water_mark": f"""WITH {TARGET} SELECT device_id,
        coalesce((SELECT max(d.id) FROM dst d WHERE d.device_id = all_devices.device_id), -1) AS last_id
        FROM (SELECT DISTINCT device_id FROM rd) all_devices""",
    # Looking back
    "trailing_stats": f"""WITH {ARRIVALS} SELECT device_id, sensor_id, id, ts, v AS latest,
        round_even(round(avg(v) OVER w * 1000, 6), 0) / 1000 AS mean, round_even(round(stddev_pop(v) OVER w * 1000, 6), 0) / 1000 AS sd, count(*) OVER w AS n
        FROM arrivals WINDOW w AS (PARTITION BY device_id, sensor_id ORDER BY ts
            RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW)""",
    "trailing_minmax_scale": f"""WITH {LONG},
        moving AS (
            SELECT * FROM (
                SELECT device_id, line_id, vs, {LIMITS} FROM good_lines
                WINDOW w AS (PARTITION BY device_id ORDER BY arrival_ts
                    RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW))
            WHERE hi0 > lo0 AND hi1 > lo1 AND hi2 > lo2 AND hi3 > lo3 AND hi4 > lo4)
        {SCALED}""",
    "trailing_warmup_gate": f"""WITH RECURSIVE {GATE}
        SELECT device_id, id AS line_id, emitted FROM run WHERE rn > 0""",
    "diff_time": f"""WITH {DECODED} SELECT device_id, sensor_id, id, "T",
        (epoch_us("T") - epoch_us(lag("T") OVER (PARTITION BY device_id, sensor_id ORDER BY id))) / 1e6 AS gap
        FROM dec""",
    "first_per_key": f"""WITH {DECODED} SELECT device_id, sensor_id, id, "T", "CO2_ppm"
        FROM dec WHERE id IN (SELECT min(id) FROM dec GROUP BY device_id, sensor_id)""",
    "last_per_key": f"""WITH {DECODED} SELECT device_id, sensor_id, id, "T", "CO2_ppm"
        FROM dec WHERE id IN (SELECT max(id) FROM dec GROUP BY device_id, sensor_id)""",
    "series_order": f"""WITH {DECODED} SELECT device_id, sensor_id, id, "T", "CO2_ppm",
        row_number() OVER (PARTITION BY device_id, sensor_id ORDER BY "T", id) AS row_no FROM dec""",
    "union_devices": f"WITH {RD} SELECT * FROM rd",
    "distinct_device_sensor": f"WITH {DECODED} SELECT DISTINCT device_id, sensor_id FROM dec",
    # Replication
    "sync_incremental": f"WITH {MISSING} SELECT * FROM dst UNION ALL SELECT * FROM missing",
    "sync_chunks": f"""WITH {MISSING} SELECT *,
        (row_number() OVER (PARTITION BY device_id ORDER BY id) - 1) // 101 AS chunk_no FROM missing""",
    "sync_send": f"WITH {RD} SELECT * FROM rd",
    "mirror_two_way": f"""WITH {MISSING}
        SELECT 'local' AS store, * FROM rd WHERE device_id = 'click'
        UNION ALL SELECT 'local', * FROM dst WHERE device_id <> 'click'
        UNION ALL SELECT 'central', * FROM dst
        UNION ALL SELECT 'central', * FROM missing WHERE device_id = 'click'""",
    # Streams
    "stream_ingest": f"WITH {LONG} SELECT {LONG_COLUMNS} FROM long",
    "stream_publish_tumbling": f"""WITH {LONG}, pub AS ({_windows('long', 86400, 'arrival_ts', MEDIAN)})
        SELECT * EXCLUDE (tenths), round(tenths, 6) AS tenths FROM pub
        WHERE "T" <= (SELECT max(arrival_ts) FROM long) - INTERVAL 1 HOUR""",
    "stream_publish_accounted": f"""WITH {LONG},
        fed AS (
            SELECT *, least(2, (day(arrival_ts) - 1) // 10) + CASE WHEN line_id % 7 = 0 THEN 1 ELSE 0 END AS part,
                   (epoch_us(arrival_ts) // 86400000000 + 1) * 86400000000 AS end_us
            FROM long),
        parts AS (SELECT p.part, (SELECT max(epoch_ms(arrival_ts)) FROM fed WHERE fed.part < p.part) - 3600000 AS mark FROM range(5) AS p(part)),
        timed AS (SELECT fed.*, coalesce(end_us // 1000 <= mark, FALSE) AS late FROM fed JOIN parts USING (part))
        SELECT device_id, channel, sensor_id, make_timestamp(end_us) AS "T",
               CASE WHEN count(*) >= 3 THEN 'published' ELSE 'short' END AS status, count(*) AS n,
               CASE WHEN count(*) >= 3 THEN round(median(v * 10), 6) END AS tenths,
               NULL::BIGINT AS line_id, NULL::TIMESTAMP AS arrival_ts, NULL::DOUBLE AS v
        FROM timed WHERE NOT late AND end_us // 1000 <= (SELECT mark FROM parts WHERE part = 4)
        GROUP BY device_id, channel, sensor_id, end_us
        UNION ALL
        SELECT device_id, channel, sensor_id, make_timestamp(end_us), 'late', 1, NULL, line_id, arrival_ts, v FROM timed WHERE late""",
    "stream_publish_carry": f"""WITH RECURSIVE {PUSHES}
        SELECT device_id, date_trunc('second', make_timestamp(push_us)) AS "T", channel,
               round(median(v * 10), 6) AS tenths, count(*) AS n
        FROM run JOIN pushed USING (device_id, grp) JOIN long USING (device_id, line_id)
        GROUP BY device_id, push_us, channel""",
    "stream_trailing": f"""WITH {ARRIVALS},
        slides AS (
            SELECT *, unnest(range(1, 7)) + epoch_us(ts) // 3600000000 AS hour_end FROM arrivals)
        SELECT device_id, sensor_id, make_timestamp(hour_end * 3600000000) AS "T", round_even(round(avg(v) * 1000, 6), 0) / 1000 AS mean,
               round_even(round(stddev_pop(v) * 1000, 6), 0) / 1000 AS sd, max_by(v, ts) AS latest, count(*) AS n
        FROM slides GROUP BY device_id, sensor_id, hour_end
        HAVING make_timestamp(hour_end * 3600000000) <= (SELECT max(ts) FROM arrivals) - INTERVAL 1 HOUR""",
    "stream_trailing_rows": f"""WITH RECURSIVE {DRAWN}
        SELECT device_id, line_id, arrival_ts, channel, latest, round_even(round(mean * 1000, 6), 0) / 1000 AS mean,
               round_even(round(sd * 1000, 6), 0) / 1000 AS sd, n,
               CASE WHEN min(high - low) OVER (PARTITION BY device_id, line_id) > 0 THEN round(1 - (latest - low) / (high - low), 6) END AS scaled
        FROM figures SEMI JOIN (SELECT * FROM run WHERE drawn) USING (device_id, line_id)""",
    "stream_join_ranges": f"WITH {DASH} SELECT * FROM dash",
    "stream_refresh_summary": _refreshed(
        '"min"', '"max"', "mean", "sd", "median", '"last_T"', "last_point", '"N"', "avg_sampling_period"
    ),
    "stream_sync_sink": f"WITH {MISSING} SELECT * FROM dst UNION ALL SELECT * FROM missing",
}
# Other plans of the same operators.
ORACLE |= {f"{name}_dense": ORACLE[name] for name in ("trailing_stats", "trailing_minmax_scale")}
ORACLE["stream_refresh_counts"] = ORACLE["stream_refresh_summary"]
ORACLE["sink_export_one_csv"] = ORACLE["sink_export_csv"]
