"""Numeric column rules. NULL is missing; NaN never leaves these functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that mean "no value".
PLACEHOLDERS = ["", "-", "--", "n/a", "na", "nan", "none", "null", "#n/a", "."]


def finite(value: Column) -> Column:
    """Finite doubles only; NaN and infinities become NULL."""
    number = value.cast("double")
    bad = F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    return F.when(~bad, number)


def strict_number(text: Column) -> Column:
    """A cell counts as a number only if its whole text is a plain decimal; 'true', '12%' or '1,000' do not."""
    plain = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(plain, finite(text.try_cast("double")))


def lenient_number(text: Column) -> Column:
    """Accept thousands separators and a percent sign; placeholders are missing."""
    tidy = F.trim(F.regexp_replace(text, "[,%]", ""))
    return F.when(~F.lower(F.trim(text)).isin(PLACEHOLDERS), finite(tidy.try_cast("double")))


def quantise5(value: Column) -> Column:
    """Five decimals, half away from zero, through DECIMAL so binary noise cannot flip a tie."""
    return F.round(value.try_cast("decimal(38,12)"), 5).cast("decimal(38,5)")


def steady_sum(value: Column, places: int = 10) -> Column:
    """Sum of doubles that does not depend on the order of the rows: added as decimals of so many places.

    A group with a value that no such decimal holds (NaN, infinite or beyond 30 digits in all) gets the plain sum.
    """
    fixed = F.round(value, places).try_cast(f"decimal(30,{places})")
    return F.when(F.count(value) == F.count(fixed), F.sum(fixed).cast("double")).otherwise(F.sum(value))


def safe_div(top: Column, bottom: Column, positive_only: bool = False) -> Column:
    allowed = bottom > 0 if positive_only else bottom != 0
    return F.when(allowed, finite(F.try_divide(top.cast("double"), bottom.cast("double"))))


def inverse_positive(value: Column) -> Column:
    return F.when(value > 0, F.try_divide(F.lit(1.0), value.cast("double")))


def natural_log(value: Column) -> Column:
    return F.when(value > 0, F.ln(value.cast("double")))


def signed_log(value: Column) -> Column:
    return F.signum(value.cast("double")) * F.log1p(F.abs(value.cast("double")))


def percent_to_decimal(value: Column) -> Column:
    return value.cast("double") / 100.0


def clamp(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def growth_with_reason(base: Column, target: Column) -> tuple[Column, Column]:
    """(target/base - 1)*100 when the base is positive, with the reason for every gap."""
    missing = base.isNull() | target.isNull()
    value = F.when(~missing & (base > 0), (F.try_divide(target, base) - 1) * 100.0)
    reason = (
        F.when(missing, F.lit("MISSING_INPUT"))
        .when(base == 0, F.lit("ZERO_BASE"))
        .when(base < 0, F.lit("NONPOSITIVE_BASE"))
    )
    return value, reason


def equal_within(a: Column, b: Column) -> Column:
    """Absolute 1e-9, or within max(1e-4, 1e-8 of scale); two NULLs are equal."""
    scale = F.greatest(F.abs(a), F.abs(b))
    gap = F.abs(a - b)
    close = (gap <= 1e-9) | (gap <= F.greatest(F.lit(1e-4), scale * 1e-8))
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(close)


def close_to(a: Column, b: Column, relative: float = 1e-9, absolute: float = 1e-10) -> Column:
    """|a-b| <= absolute + relative*|b|; two NULLs are equal."""
    near = F.abs(a - b) <= F.lit(absolute) + F.lit(relative) * F.abs(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(near)


def present_mean(*values: Column) -> Column:
    """Mean of the non-NULL arguments; NULL when none is present."""
    held = reduce(lambda a, b: a + b, [v.isNotNull().cast("double") for v in values])
    total = reduce(lambda a, b: a + b, [F.coalesce(v.cast("double"), F.lit(0.0)) for v in values])
    return F.when(held > 0, total / held)


def joined_reasons(*tests: tuple[Column, str], sep: str = " | ") -> Column:
    """Text of every reason whose test is true; tests that are NULL do not fire."""
    found = F.array(*[F.when(test, F.lit(text)) for test, text in tests])
    return F.array_join(F.array_compact(found), sep)
