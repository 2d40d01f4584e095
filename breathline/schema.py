"""Column layouts shared by every source, operator and sink."""

from pyspark.sql import types as T

# One stored reading. ``id`` rises per device, ``T`` is zone-less UTC in seconds and
# ``PPM_10X`` is ppm times ten, 0..65535 (wider than Spark's signed smallint).
READING = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("T", T.TimestampNTZType()),
    T.StructField("SENSOR", T.IntegerType()),
    T.StructField("PPM_10X", T.IntegerType()),
])

# Limits of one sensor.
RANGES = T.StructType([
    T.StructField("sensor_id", T.IntegerType()),
    T.StructField("set", T.DoubleType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
])

# Channel position on a device -> sensor id.
LUT = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("channel", T.IntegerType()),
    T.StructField("sensor_id", T.IntegerType()),
])

# One text line as it arrived. ``line_id`` rises per device in arrival order.
RAW_LINE = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("line_id", T.LongType()),
    T.StructField("arrival_ts", T.TimestampNTZType()),
    T.StructField("line", T.StringType()),
])

# One analogue sample. ``sample_no`` counts per device and channel from 0.
ADC_SAMPLE = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("channel", T.IntegerType()),
    T.StructField("sample_no", T.LongType()),
    T.StructField("adc", T.IntegerType()),
])

KEY = ["device_id", "sensor_id"]
