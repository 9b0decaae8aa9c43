"""Column expressions for feature building. All stay in generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.coerce import column, quoted


def flag(condition: Column) -> Column:
    """0/1 flag; an undecided (null) condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def date_parts(c: Column | str) -> dict[str, Column]:
    """Month, quarter, weekday (Monday = 0), day and year of a timestamp."""
    c = column(c)
    return {
        "month": F.month(c),
        "quarter": F.quarter(c),
        "weekday": F.weekday(c),
        "day": F.dayofmonth(c),
        "year": F.year(c),
    }


def list_size(c: Column | str) -> Column:
    """Length of a nested list; a missing list has length 0."""
    return F.coalesce(F.array_size(column(c)), F.lit(0))


def list_field_sum(c: Column | str, field: str) -> Column:
    """Sum of one field over a list of structs; missing values and lists count as 0."""
    total = F.aggregate(
        column(c),
        F.lit(0.0),
        lambda acc, e: acc + F.coalesce(e[field].cast("double"), F.lit(0.0)),
    )
    return F.coalesce(total, F.lit(0.0))


def list_field_mean(c: Column | str, field: str) -> Column:
    """Mean of one field over the non-null structs of a list; null for an empty list."""
    present = F.filter(column(c), lambda e: e.isNotNull())
    return F.try_divide(list_field_sum(present, field), F.array_size(present).cast("double"))


def ratio(numerator: Column | str, denominator: Column | str, absolute: bool = True) -> Column:
    """numerator / (|denominator| + 1), or without the absolute value; null on zero."""
    d = column(denominator)
    return F.try_divide(column(numerator), (F.abs(d) if absolute else d) + F.lit(1.0))


def log1p_floor0(c: Column | str) -> Column:
    """log(1 + x) with x clipped below at 0; null stays null."""
    c = column(c)
    return F.when(c.isNotNull(), F.log1p(F.greatest(c, F.lit(0.0))))


def optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The named column if the table has it, else typed nulls."""
    if name in df.columns:
        return F.col(quoted(name)).cast(kind)
    return F.lit(None).cast(kind)


def with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Names of the columns that start with ``prefix``, in table order."""
    return [c for c in df.columns if c.startswith(prefix)]


def unique_sorted(*groups: Iterable[str]) -> list[str]:
    """One sorted list of names without repeats."""
    return sorted({name for group in groups for name in group})


def snake_name(name: str) -> str:
    """Lower-case name with dashes and blanks turned to underscores."""
    return name.lower().replace("-", "_").replace(" ", "_")


def reorder(df: DataFrame, first: Sequence[str] = (), last: Sequence[str] = ()) -> DataFrame:
    """Put some columns first and some last; the others keep their order between."""
    moved = {*first, *last}
    middle = [c for c in df.columns if c not in moved]
    return df.select(*(quoted(c) for c in [*first, *middle, *last]))


def all_positive(c: Column | str) -> Column:
    """Aggregate: is every present value > 0?"""
    return F.bool_and(column(c) > 0)


def all_non_negative(c: Column | str) -> Column:
    """Aggregate: is every present value >= 0?"""
    return F.bool_and(column(c) >= 0)
