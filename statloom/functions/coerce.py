"""Lenient coercion: a value that does not parse becomes null, never an error."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed pattern: decimal or exponent notation, or a signed infinity. Excludes
# the type suffixes ('12d', '12f') that Spark's own cast accepts.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """Missing is always null inside the library; NaN would win every max and mean."""
    c = column(c)
    return F.when(~F.isnan(c), c)


def to_number(c: Column | str) -> Column:
    """Text or number to double; anything that is not a number becomes null."""
    text = column(c).cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def to_timestamp(c: Column | str) -> Column:
    """ISO text to a zone-less timestamp; anything else becomes null."""
    return column(c).cast("string").try_cast("timestamp_ntz")


def quoted(name: str) -> str:
    """Protect a column name that contains dots."""
    return name if name.startswith("`") else f"`{name}`"


def as_double(df: DataFrame, name: str) -> Column:
    """A column as a null-safe double: native numbers are cast, text is parsed."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return nan_to_null(F.col(quoted(name)).cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        number = F.col(quoted(name))
        return (number.cast("int") if isinstance(kind, T.BooleanType) else number).cast("double")
    return to_number(quoted(name))


def numbers_or_zero(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Coerce the named columns to double and fill what is missing with 0."""
    return df.withColumns({n: F.coalesce(as_double(df, n), F.lit(0.0)) for n in names})
