"""Quote times of unknown form to naive UTC timestamps.

The results are TIMESTAMP_NTZ and none of the arithmetic looks at the session time zone.
The functions mention their argument several times, so pass plain columns, not long expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Above this a number is epoch milliseconds, up to and including it epoch seconds.
MILLIS_ABOVE = 1e10
# Epoch seconds of the years 1 to 9999.
MIN_SECOND = -62135596800.0
END_SECOND = 253402300800.0

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
_MICROSECOND = "interval '0.000001' second"

# The ISO 8601 forms that Python 3.13 reads, calendar dates.
#   date       2024-12-06 or 20241206
#   separator  any one character
#   time       15, 15:30, 15:30:00, 1530, 153000, each with an optional fraction after . or ,
#              (after 153000 a fraction of two digits or more needs no mark, after 15:30:00 : will do)
#   offset     +05, +05:30, +0530, +05:30:15 and so on, below 24 hours
#   junk       before an offset: one ASCII character, or any text after six fraction digits
ISO_CALENDAR = (
    r"(?s)^(?<y>(?!0000)\d{4})(?<ds>-?)(?<m>\d\d)\k<ds>(?<d>\d\d)"
    r"(?:."
    r"(?<h>\d\d)(?:(?<ts>:?)(?<i>\d\d)(?:\k<ts>(?<s>\d\d)(?:(?<basic>(?<!:\d\d))|(?<ext>(?<=:\d\d))))?)?"
    r"(?:(?:[.,]|\k<ext>:|\k<basic>(?=\d\d))(?:(?<f>\d{1,5})|(?<g>\d{6})(?:\d*|[^+\-]*(?=[+\-])))"
    r"|[\x00-\x7F&&[^+\-]](?=[+\-]))?"
    r"(?:[+\-](?!2[4-9]|[3-9]\d|23:?(?:[6-9]\d|59:?[6-9]\d))"
    r"\d\d(?:(?<os>:?)\d\d(?:\k<os>\d\d(?:(?<ob>(?<!:\d\d))|(?<oe>(?<=:\d\d))))?)?"
    r"(?:(?:[.,]|\k<oe>:|\k<ob>(?=\d\d))\d+)?)?"
    r")?$"
)
# ISO 8601 week dates, 2024-W49, 2024-W49-5, 2024W49, 2024W495; a digit or hyphen
# that can only be the separator before the time is left to the rest.
ISO_WEEK = (
    r"(?s)^(?!0000)\d{4}"
    r"(?:-W(?<ew>\d\d)(?:-(?<ed>\d)(?!\d))?|W(?<bw>\d\d)(?<bd>\d(?=(?:\d(?:\d\d)*)?(?!\d)))?)"
    r"(?<rest>.*)$"
)


def epoch_to_timestamp(number: Column) -> Column:
    """Epoch milliseconds or seconds (DOUBLE) to a timestamp; NULL outside the years 1 to 9999."""
    seconds = F.when(number > MILLIS_ABOVE, number / F.lit(1000.0)).otherwise(number)
    seconds = F.when((seconds >= MIN_SECOND) & (seconds < END_SECOND), seconds)
    whole = seconds.cast("bigint")
    # rint is half-even, on the fraction alone: no digits are lost to the size of the number.
    micros = whole * F.lit(1000000) + F.rint((seconds - whole) * F.lit(1e6)).cast("bigint")
    return F.expr(_EPOCH) + F.expr(_MICROSECOND) * micros


def micros_since_epoch(ts: Column) -> Column:
    """The reverse for TIMESTAMP_NTZ: microseconds since 1970 as BIGINT."""
    seconds = (ts - F.expr(_EPOCH)).cast("interval second").cast("decimal(18,6)")
    return (seconds * F.lit(1000000)).cast("bigint")


def time_order(ts: Column, number: Column) -> Column:
    """One number that grows with ``ts`` and then with the BIGINT ``number``; NULL comes before all others.

    Aggregations by hashing can keep it, unlike a struct of both. Times take 18 digits, numbers 20.
    """
    time = F.coalesce(micros_since_epoch(ts), F.lit(-(10**17))).cast("decimal(18,0)")
    rest = F.coalesce(number.cast("bigint"), F.lit(-(2**63))).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    return (time * F.lit(str(10**20)).cast("decimal(21,0)") + rest).cast("decimal(38,0)")


def _week_to_calendar(text: Column) -> Column:
    """Text that starts with an ISO week date, with the calendar date in its place."""
    week = F.regexp_replace(text, ISO_WEEK, "${ew}${bw}").try_cast("int")
    day = F.rpad(F.regexp_replace(text, ISO_WEEK, "${ed}${bd}"), 1, "1").try_cast("int")
    first_monday = F.trunc(F.make_date(F.left(text, F.lit(4)).try_cast("int"), F.lit(1), F.lit(4)), "WEEK")
    monday = F.date_add(first_monday, (week - 1) * 7)
    date = F.when((F.weekofyear(monday) == week) & day.between(1, 7), F.date_add(monday, day - 1))
    return F.concat(date.cast("string"), F.regexp_replace(text, ISO_WEEK, "${rest}"))


def _calendar_form(text: Column) -> Column:
    """Rewrite a leading ISO week date to the calendar date it means; other text stays."""
    # Week dates are rare. As a lambda they stay out of the generated code, which is compiled to
    # machine code only while it is small.
    rewritten = F.get(F.transform(F.array(text), _week_to_calendar), F.lit(0))
    return F.when(text.rlike(ISO_WEEK), rewritten).otherwise(text)


def parse_iso(text: Column) -> Column:
    """ISO 8601 text to a timestamp, NULL for anything else. Offsets are dropped, not applied."""
    text = _calendar_form(F.replace(text, F.lit("Z"), F.lit("+00:00")))
    # Absent parts leave gaps, text of another form leaves nothing at all.
    spread = F.regexp_replace(text, ISO_CALENDAR + "|(?s)^.*$", "${y}-${m}-${d} ${h}:${i}:${s}.${f}${g}0")
    filled = F.regexp_replace(spread, r"(?<=[ :])(?=[:.])", "00")
    return filled.try_cast("timestamp_ntz")


def _as_number(value: Column, kind: Column) -> Column:
    """A VARIANT that holds no text as DOUBLE. Integers, the usual case, need no general cast."""
    integer = F.try_variant_get(value, "$", "bigint").cast("double")
    return F.when(kind == "BIGINT", integer).when(kind != "STRING", F.try_variant_get(value, "$", "double"))


def is_falsy(value: Column) -> Column:
    """Truthiness of a VARIANT: absent, null, false, 0, '', {} and [] are falsy."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "STRING", F.try_variant_get(value, "$", "string") == "")
        .when(kind.contains("<"), F.to_json(value).isin("{}", "[]"))
        .otherwise(F.coalesce(_as_number(value, kind) == 0, F.lit(True)))
    )


def truthy_or(value: Column, fallback: Column) -> Column:
    """The value unless it is falsy. Unlike coalesce, 0 and '' fall back too."""
    return F.when(is_falsy(value), fallback).otherwise(value)


def with_quote_time(df: DataFrame, raw: str, name: str) -> DataFrame:
    """Add the timestamp that the VARIANT column ``raw`` means, be it epoch milliseconds, epoch
    seconds or ISO 8601 text.

    Booleans count as the numbers 0 and 1; numbers inside text, containers and null give NULL. Type,
    text and number are columns of their own on the way, so that each is worked out once per row.
    """
    kind, text, number = F.col("_kind"), F.col("_text"), F.col("_number")
    parts = df.withColumn("_kind", F.schema_of_variant(raw)).withColumns(
        {
            "_text": F.when(kind == "STRING", F.try_variant_get(raw, "$", "string")),
            "_number": _as_number(F.col(raw), kind),
        }
    )
    time = F.when(kind == "STRING", parse_iso(text)).otherwise(epoch_to_timestamp(number))
    # As the output of a generator, a later filter on the time does not have it worked out again.
    return parts.withColumn(name, F.explode(F.array(time))).drop("_kind", "_text", "_number")
