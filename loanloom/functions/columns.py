"""Scalar column functions used across the jobs. All stay inside JVM codegen."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_number(text: Column) -> Column:
    """First run of digits as a double; NULL when there is none ("10+ years" -> 10)."""
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("double")


def percent_number(text: Column) -> Column:
    """ "13.5%" or "13.5" as a double."""
    return F.trim(F.rtrim(text.cast("string"), F.lit("%"))).try_cast("double")


def month_year_date(text: Column) -> Column:
    """ "Mar-2015" as the first day of that month; anything else is NULL."""
    return F.try_to_date(text, "MMM-yyyy")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that yields NULL on a zero or NULL denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(safe_ratio(numerator, denominator), F.lit(0.0))


def clip(value: Column, lower: Column | float | None = None, upper: Column | float | None = None) -> Column:
    """Bound ``value``; NULL stays NULL, unlike bare ``least``/``greatest``."""
    bounded = value
    if upper is not None:
        bounded = F.least(bounded, upper if isinstance(upper, Column) else F.lit(upper))
    if lower is not None:
        bounded = F.greatest(bounded, lower if isinstance(lower, Column) else F.lit(lower))
    return F.when(value.isNotNull(), bounded)


def quarter_label(date: Column) -> Column:
    """2015-05-20 -> "2015-Q2"."""
    return F.concat(F.year(date).cast("string"), F.lit("-Q"), F.quarter(date).cast("string"))


def month_start_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-01")


def whole_months(start: Column, end: Column) -> Column:
    """Complete months from ``start`` to ``end``, cut toward zero in both directions."""
    return F.timestamp_diff("MONTH", start, end).cast("int")


def position_in(value: Column, ordered: Sequence[str]) -> Column:
    """1-based position of ``value`` in a fixed list, 0 when it is not listed."""
    return F.array_position(F.array(*[F.lit(v) for v in ordered]), value).cast("int")


def by_magnitude(pairs: Column) -> Column:
    """Sort an array of structs with a ``value`` by \\|value\\| descending, earlier position first on ties."""
    keyed = F.transform(
        pairs, lambda p, i: F.struct((-F.abs(p["value"])).alias("rank"), i.alias("pos"), p.alias("pair"))
    )
    return F.transform(F.array_sort(keyed), lambda k: k["pair"])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once a row however often ``body`` reads it."""
    return F.transform(F.array(value), body)[0]
