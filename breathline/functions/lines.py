"""Column functions over one device line."""

from pyspark.sql import Column, functions as F

from breathline.functions.numbers import parse_number


def trim_line(line: Column) -> Column:
    """Drop trailing white space, line ends included."""
    return F.regexp_replace(line, r"\s+$", "")


def is_comment(line: Column) -> Column:
    """Comment lines start with ``#``, headers with ``t``."""
    return line.rlike("^[#t]")


def split_fields(line: Column) -> Column:
    """Non-blank fields in order; later fields move up past a blank one."""
    return F.filter(F.split(line, ","), lambda field: field != "")


# A line of these characters alone holds no suffix, underscore, blank or word, and there
# a cast of the whole array accepts just what the field-by-field grammar does.
PLAIN = "^[-+0-9.,eE]*$"


def parse_line(text: Column) -> Column:
    """Non-blank fields as doubles, NULL for each field that is not a number."""
    fields = split_fields(text)
    return F.when(text.rlike(PLAIN), fields.try_cast("array<double>")).otherwise(
        F.transform(fields, parse_number)
    )


def has_bad_field(values: Column) -> Column:
    return F.exists(values, lambda v: v.isNull())


def encode_line(values: Column) -> Column:
    """Values as one line: two decimals each, a comma after every field."""
    return F.concat(
        F.array_join(F.transform(values, lambda v: F.format_string("%.2f", v)), ","), F.lit(",")
    )


def log_line(epoch_seconds: Column, line: Column) -> Column:
    return F.format_string("%.6f,%s", epoch_seconds, line)


def last_point_label(sensor: Column, device: Column, ppm: Column, at: Column) -> Column:
    """``<sensor>@<device>, <ppm> PPM`` over a second line with the time."""
    return F.format_string("%s@%s, %d PPM\n%s", sensor, device, F.bround(ppm, 0).cast("bigint"), at)
