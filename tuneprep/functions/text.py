"""Text columns: whitespace normalisation, stringification, templates."""

from __future__ import annotations

import string
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuneprep.runtime import column

# The characters Python's str.strip() removes, and the ones str.splitlines()
# breaks at. Regular expression class bodies that Java and RE2 both read.
WHITESPACE_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
LINE_BREAK_CLASS = r"\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}"
# Java tests a class range by range; ruling out visible ASCII first saves a third of the time.
_NOT_VISIBLE_ASCII = r"(?![\x21-\x7e])"
# The same characters spelled out, for the trim functions.
LINE_BREAK_CHARS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"
BLANK_CHARS = (
    "\t\x1f\x20\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
WHITESPACE_CHARS = LINE_BREAK_CHARS + BLANK_CHARS


def normalize_text(text: Column) -> Column:
    """Strip the text, end every line with ``\\n`` and no trailing whitespace.

    Interior blank lines and the indentation of later lines stay. Linear in the text: a split, a
    trim per line and a join, where a regular expression with look-behinds takes several times as
    long. Most texts break lines with ``\\n`` only; a byte search finds that out and they are split
    without a regular expression.
    """
    trimmed = F.btrim(text, F.lit(WHITESPACE_CHARS))
    other_breaks = reduce(
        or_, [F.contains(text, F.lit(c)) for c in LINE_BREAK_CHARS if c != "\n"]
    )
    lines = F.when(
        other_breaks,
        F.split(trimmed, rf"{_NOT_VISIBLE_ASCII}(?:\r\n|[{LINE_BREAK_CLASS}])", -1),
    ).otherwise(F.split(trimmed, "\n", -1))
    return F.array_join(F.transform(lines, lambda line: F.rtrim(line, F.lit(BLANK_CHARS))), "\n")


def words(text: Column) -> Column:
    """Runs of non-whitespace; whitespace at either end adds an empty first or last word."""
    return F.split(text, rf"{_NOT_VISIBLE_ASCII}[{WHITESPACE_CLASS}]+", -1)


def has_text(text: Column) -> Column:
    """True iff the text is not null and not empty once normalised.

    Looks at the raw text and stops at its first visible character, so a filter on it runs at the
    scan and does not repeat the normalisation.
    """
    return text.rlike(rf"[^{WHITESPACE_CLASS}]")


def _float_text(value: Column) -> Column:
    """Shortest digits that read back as the value; the JVM prints others for some."""

    @F.arrow_udf("string")
    def shortest(values: pa.Array) -> pa.Array:
        return pa.array([None if x is None else repr(x) for x in values.to_pylist()], pa.string())

    return shortest(value)


def _timestamp_text(value: Column) -> Column:
    """Six digits of a fraction, or none."""
    fraction = F.date_format(value, "SSSSSS")
    return F.concat(
        F.date_format(value, "yyyy-MM-dd HH:mm:ss"),
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
    )


def _decimal_text(value: Column, scale: int) -> Column:
    """Plain digits, or an exponent where six zeros would follow the point."""
    plain = value.cast("string")
    if scale <= 6:
        return plain
    # The digits without sign, point and leading zeros; a zero keeps one.
    digits = F.regexp_replace(F.format_string("%s", F.abs(value).cast("string")), r"[.]", "")
    digits = F.regexp_replace(F.replace(digits, F.lit("E"), F.lit("")), r"^0+(?=\d)", "")
    shown = F.concat(
        F.when(value < 0, F.lit("-")).otherwise(F.lit("")),
        F.substring(digits, 1, 1),
        F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, 2, 64))).otherwise(F.lit("")),
        F.lit("E-"),
        (F.lit(scale + 1) - F.length(digits)).cast("string"),
    )
    return F.when(F.length(digits) - 1 - scale < -6, shown).otherwise(plain)


def stringify(df: DataFrame, name: str) -> Column:
    """Column ``name`` as text, written the way Python's ``str()`` writes the value.

    Timestamps are shown in the time zone of the session, without its offset.
    """
    kind = df.schema[name].dataType
    value = column(name)
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return value
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.NullType, T.DateType)):
        return value.cast("string")
    if isinstance(kind, T.BooleanType):
        return F.initcap(value.cast("string"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return _timestamp_text(value)
    if isinstance(kind, T.DecimalType):
        return _decimal_text(value, kind.scale)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _float_text(value)
    raise ValueError(
        f"column {name!r} is {kind.simpleString()}: Spark would not write it as Python does; "
        "cast it to string first"
    )


def render_template(df: DataFrame, template: str) -> Column:
    """``template.format(**row)`` as one ``concat``: ``{name}`` fields and ``{{``/``}}`` escapes."""
    parts: list[Column] = []
    for literal, field, spec, conversion in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is None:
            continue
        if spec or conversion:
            raise ValueError(f"format specs and conversions are not supported: {template!r}")
        if not field or not set(".[").isdisjoint(field) or field.isdigit():
            raise ValueError(f"a field must be a plain column name, got {field!r}")
        if field not in df.columns:
            raise KeyError(field)
        parts.append(F.coalesce(stringify(df, field), F.lit("None")))
    return F.concat(*parts) if parts else F.lit("")
