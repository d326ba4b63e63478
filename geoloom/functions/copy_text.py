"""Decoding of fields in COPY text form, as native expressions.

Strict decoding fails on what the form does not allow. ``compat`` instead reproduces lenient
readings of malformed fields: a null marker in a string that cannot be null is its letter,
numbers read as far as they have digits, optional fields may be empty for null, member types
match by their first letters, and hexadecimal escapes vanish.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MEMBER_TYPES
from . import text as X

NULL = "\\N"
#: Single-letter escapes.
ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
#: One escape, or a run without any.
_TOKEN = r"(?s)\\x[0-9A-Fa-f]{1,2}|\\[0-7]{3}|\\.|[^\\]+"


def fail(message: Column, kind: str) -> Column:
    return F.raise_error(message).cast(kind)


def unescape(field: Column, compat: bool = False) -> Column:
    """The text of a field. Octal and hexadecimal escapes are bytes of UTF-8; a backslash at
    the end is an error. Fields without a backslash are passed through."""
    token_hex = F.hex(F.encode(F.lit(""), "utf-8"))

    def bytes_of(token: Column) -> Column:
        """A token's bytes, as hex digits."""
        escaped = F.substring(token, 2, 10)
        plain = F.hex(F.encode(F.when(token.startswith("\\"), escaped).otherwise(token), "utf-8"))
        octal = F.lpad(F.conv(escaped, 8, 16), 2, "0").substr(-2, 2)
        hexed = F.lit("") if compat else F.lpad(F.upper(F.substring(token, 3, 2)), 2, "0")
        out = F.when(token.rlike(r"^\\[0-7]{3}$"), octal).when(token.rlike(r"^\\x[0-9A-Fa-f]"), hexed)
        for letter, char in ESCAPES.items():
            out = out.when(token == f"\\{letter}", F.lit(char.encode().hex().upper()))
        return out.otherwise(plain)

    tokens = F.regexp_extract_all(field, F.lit(_TOKEN), 0)
    decoded = F.decode(F.unhex(F.concat(token_hex, F.array_join(F.transform(tokens, bytes_of), ""))), "utf-8")
    dangling = (F.length(field) - F.length(F.rtrim(field, F.lit("\\")))) % 2 == 1
    return F.when(~field.contains("\\"), field).when(dangling, fail(F.concat(F.lit("a backslash ends the field "), field), "string")).otherwise(decoded)


def _strict(value: Column, field: Column, kind: str, spark_type: str) -> Column:
    """``value``, or an error where it is null although the field is not."""
    return F.coalesce(value, fail(F.concat(F.lit(f"not a {kind}: "), F.coalesce(field, F.lit("null"))), spark_type))


def decode(field: Column, kind: str, nullable: bool, compat: bool = False) -> Column:
    """A field of the given kind of column."""
    absent = field == NULL
    if nullable and compat:
        absent = absent | field.isin("", "\\")
    if kind == "string":
        out = X.until_nul(unescape(field, compat))
        if not nullable and not compat:
            out = F.when(absent, fail(F.lit("null in a column that has none"), "string")).otherwise(out)
    elif kind in ("long", "int"):
        sql = "bigint" if kind == "long" else "int"
        if compat:
            out = F.coalesce(F.regexp_extract(field, r"^\s*([+-]?\d+)", 1).try_cast("bigint"), F.lit(0)).cast(sql)
        else:
            out = _strict(field.try_cast(sql), field, kind, sql)
    elif kind == "boolean":
        known = F.when(field.startswith("t"), True).when(field.startswith("f"), False) if compat else F.when(field == "t", True).when(field == "f", False)
        out = _strict(known, field, kind, "boolean")
    elif kind == "timestamp":
        out = X.checked_time(_strict(F.when(F.length(field) >= 19, F.substring(field, 1, 19).try_cast("timestamp_ntz")), field, kind, "timestamp_ntz"))
    elif kind == "member_type":
        if compat:
            known = F.lit(None).cast("string")
            for name in reversed(MEMBER_TYPES):
                known = F.when(F.lit(name).startswith(field), name).otherwise(known)
        else:
            known = F.when(field.isin(*MEMBER_TYPES), field)
        out = _strict(known, field, kind, "string")
    else:
        raise ValueError(f"no such kind of column: {kind}")
    return F.when(~absent, out) if nullable else out
