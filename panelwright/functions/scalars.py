"""Column expressions: parsing, flags, percent scaling. All stay inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.specs import VENDOR_DATE


def quoted(name: str) -> Column:
    """A column by exact name; vendor names hold ``!``, ``%`` and may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def parse_date(column: Column, strict: bool = True, layout: str = VENDOR_DATE) -> Column:
    """``yyyyMMdd`` text or integer to date. Strict: bad text fails the job; else it gives null."""
    text = column.cast("string")
    return F.to_date(text, layout) if strict else F.try_to_date(text, layout)


def replace_first(column: Column, pattern: str, replacement: str = "") -> Column:
    """Replace the first match only; ``regexp_replace`` alone replaces every match."""
    return F.regexp_replace(column, f"(?s)^(.*?)(?:{pattern})", "$1" + replacement.replace("\\", "\\\\").replace("$", "\\$"))


def contains(column: Column, pattern: str) -> Column:
    """Regex containment; plain text takes the cheaper substring test."""
    return column.contains(pattern) if re.escape(pattern) == pattern else column.rlike(pattern)


def padded_double(column: Column) -> Column:
    return F.trim(column).cast("double")


def is_yes(column: Column) -> Column:
    """``"Y"`` flag to boolean; null stays null."""
    return column == F.lit("Y")


def to_percent(column: Column) -> Column:
    return column * F.lit(100)


def from_percent(column: Column) -> Column:
    return column / F.lit(100)


def from_percent_squared(column: Column) -> Column:
    return column / F.lit(100**2)


def squared(column: Column) -> Column:
    return column * column


def fill_null(column: Column, value) -> Column:
    return F.coalesce(column, F.lit(value))


def in_force(on_date, start: Column, end: Column) -> Column:
    """``start <= on_date <= end``."""
    return (on_date if isinstance(on_date, Column) else F.lit(on_date)).between(start, end)


def literal(value, data_type: T.DataType | str) -> Column:
    return F.lit(value).cast(data_type)


def ordinal(column: Column, data_type: T.DataType) -> Column | None:
    """A double that grows with the column, or None for types without an even scale."""
    if isinstance(data_type, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(data_type, T.TimestampNTZType):
        return distance(F.expr("timestamp_ntz'1970-01-01 00:00:00'"), column, data_type).cast("double")
    if isinstance(data_type, T.NumericType):
        return column.cast("double")
    return None


def distance(start: Column, end: Column, data_type: T.DataType) -> Column | None:
    """``end - start``, exact for all but binary fractions and in any session zone; None for types without distances."""
    if isinstance(data_type, T.DateType):
        return F.date_diff(end, start)
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(end) - F.unix_micros(start)
    if isinstance(data_type, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", start, end)
    if isinstance(data_type, T.IntegralType):
        return end.cast("decimal(20,0)") - start.cast("decimal(20,0)")
    if isinstance(data_type, T.NumericType):
        return end - start
    return None


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order, cast to its types; a missing column is an error."""
    return df.select([quoted(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def rounded(value: Column, digits: int) -> Column:
    """``round`` of a double, the same to the last bit, mostly without decimal numbers of any length.

    Away from a half of the last digit the next whole number is the same however the value is scaled, and a quotient of whole
    numbers is the double next to the decimal number; all others go to ``round``.
    """
    scale = 10.0**digits
    size = F.abs(value) * F.lit(scale)
    whole = F.floor(size)
    plain = (size < F.lit(float(1 << 40))) & (F.abs(size - whole - F.lit(0.5)) > F.lit(1e-3))
    near = F.floor(size + F.lit(0.5)).cast("double") / F.lit(scale)
    # plus 0.0, since there is no negative zero among decimal numbers
    return F.when(plain, F.when(value < 0, -near).otherwise(near) + F.lit(0.0)).otherwise(F.round(value, digits))
