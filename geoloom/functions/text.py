"""Scalar functions of the documents: sanitising, escaping, and rendering of values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Units of a fixed-point coordinate in a degree.
SCALE = 10_000_000
EPOCH_1970 = "timestamp_ntz'1970-01-01 00:00:00'"
#: The first and the last second that a dump may hold.
EARLIEST, LATEST = "2004-01-01 00:00:00", "2140-02-07 06:28:15"


def sanitize(text: Column) -> Column:
    """Control characters that XML cannot hold, as question marks; TAB, LF and CR stay."""
    return F.regexp_replace(text, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "?")


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape_attribute(text: Column) -> Column:
    return _replaced(text, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#9;")])


def escape_text(text: Column) -> Column:
    return _replaced(text, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")])


def iso_time(ts: Column) -> Column:
    """``YYYY-MM-DDThh:mm:ssZ`` of a wall-clock time; null is the empty string."""
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))


def degrees(coordinate: Column) -> Column:
    """A fixed-point coordinate in degrees with seven decimals; null stays null."""
    return F.when(coordinate.isNotNull(), F.format_string("%.7f", coordinate / F.lit(float(SCALE))))


def epoch_seconds(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", F.expr(EPOCH_1970), ts)


def member_type_name(kind: Column) -> Column:
    return F.lower(kind)


def member_type_code(kind: Column) -> Column:
    """0, 1 or 2; another type is an error."""
    return F.when(kind == "Node", 0).when(kind == "Way", 1).when(kind == "Relation", 2).otherwise(F.raise_error(F.concat(F.lit("unknown member type "), F.coalesce(kind, F.lit("null")))).cast("int"))


def until_nul(text: Column) -> Column:
    """What precedes the first NUL character."""
    return F.call_function("substring_index", text, F.char(F.lit(0)), F.lit(1))


def checked_time(ts: Column) -> Column:
    """The time cut to the second; outside of the range of a dump it is an error."""
    cut = F.date_trunc("second", ts).cast("timestamp_ntz")
    outside = (cut < F.expr(f"timestamp_ntz'{EARLIEST}'")) | (cut > F.expr(f"timestamp_ntz'{LATEST}'"))
    return F.when(outside, F.raise_error(F.concat(F.lit("time out of range: "), ts.cast("string"))).cast("timestamp_ntz")).otherwise(cut)


def attribute(name: str, value: Column) -> Column:
    """`` name="value"``, or nothing if the value is null. The value must be escaped."""
    return F.coalesce(F.concat(F.lit(f' {name}="'), value.cast("string"), F.lit('"')), F.lit(""))


def text_attribute(name: str, value: Column) -> Column:
    return attribute(name, escape_attribute(sanitize(value)))
