"""Exact numbers.

Prices and quantities are staged and published as DECIMAL(38,8), rounded half
away from zero. Spark would cut decimals off a product or quotient of such wide
operands. Operands that fit DECIMAL(18,8) are therefore multiplied and divided as
such, which is exact; larger ones are multiplied by whole and fractional parts
and divided digit by digit, which gives the same rounding. Sums and differences have room up to 10^29; what
is larger raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAGED = PUBLISHED = "decimal(38,8)"
# Two of these have an exact product, DECIMAL(37,16).
NARROW = "decimal(18,8)"
NARROW_SUM = "decimal(28,8)"
# Room to add and subtract published numbers without losing the eighth decimal.
EXACT = "decimal(37,8)"
# A sum of products that still divides with sixteen decimals.
PRODUCT = "decimal(30,16)"


def published(value: Column) -> Column:
    return value.cast(PUBLISHED)


def narrow_product(a: Column, b: Column) -> Column:
    """Exact product of operands that fit NARROW, with sixteen decimals; NULL for others."""
    return a.try_cast(NARROW) * b.try_cast(NARROW)


def wide_product(a: Column, b: Column) -> Column:
    """Product of operands of any size, with eight decimals."""
    whole, part = "decimal(29,0)", "decimal(8,8)"

    def parts(x: Column) -> tuple[Column, Column]:
        cut = F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast(whole)
        return cut, (x.cast(EXACT) - cut).cast(part)

    (a1, a2), (b1, b2) = parts(a), parts(b)
    # the first three have eight decimals at most, so only the last is rounded
    terms = [(a1 * b1).cast(EXACT), (a1 * b2).cast(EXACT), (a2 * b1).cast(EXACT), (a2 * b2).cast(EXACT)]
    return published(((terms[0] + terms[1]).cast(EXACT) + (terms[2] + terms[3]).cast(EXACT)))


def product(a: Column, b: Column) -> Column:
    """Published product."""
    return F.coalesce(published(narrow_product(a, b)), wide_product(a, b))


def ratio(numerator: Column, denominator: Column) -> Column:
    """DOUBLE quotient; NULL for a zero or missing denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def difference(a: Column, b: Column) -> Column:
    """``a - b`` of published decimals, exact."""
    return a.cast(EXACT) - b.cast(EXACT)


def total(a: Column, b: Column) -> Column:
    """``a + b`` of published decimals, exact."""
    return a.cast(EXACT) + b.cast(EXACT)


def quotient(
    numerator: Column, denominator: Column, kind: str = NARROW, by: str = NARROW, scale: int = 1
) -> Column:
    """Published ``scale * numerator / denominator``, rounded half away from zero; NULL for a zero or missing denominator.

    The rule is the same at every size: a result half-way between two eighth
    decimals is rounded as on paper. Operands of the given kinds are divided at
    once; others, as published numbers, by long division.
    """
    exact = numerator.try_cast(kind) / F.nullif(denominator.try_cast(by), F.lit(0).cast(by))
    scaled = exact * F.lit(scale).cast("decimal(5,0)") if scale != 1 else exact
    return F.coalesce(published(scaled), long_quotient(numerator, denominator, scale))


# Whole numbers of the greatest width.
WHOLE = "decimal(38,0)"
UNIT = 100_000_000


def negative(x: Column) -> Column:
    """``-x`` of a published number; Spark's own negation and ``abs`` keep 34 digits only."""
    return (F.lit(0).cast("decimal(1,0)") - x.cast(EXACT)).cast(EXACT)


def _units(x: Column) -> Column:
    """How many eighth decimals a published number below 10^29 has, as a whole number without its sign."""
    size = F.when(x < 0, negative(x)).otherwise(x.cast(EXACT))
    whole = F.floor(size).cast("decimal(29,0)")
    part = (size - whole).cast("decimal(8,8)")
    return (whole * F.lit(UNIT).cast("decimal(9,0)")).cast(WHOLE) + (part * F.lit(UNIT).cast("decimal(9,0)")).cast("decimal(9,0)")


def long_quotient(numerator: Column, denominator: Column, scale: int = 1) -> Column:
    """``quotient`` of published numbers of any size below 10^29: digit by digit, with an exact remainder.

    A trailing power of ten in ``scale`` is taken as further digits. NULL where the result has no place in a published number.
    """
    shift = 0
    while scale % 10 == 0:
        scale, shift = scale // 10, shift + 1
    ten, none = F.lit(10).cast("decimal(2,0)"), F.lit(0).cast(WHOLE)

    def digit(rest: Column, by: Column) -> tuple[Column, Column]:
        guess = F.floor(F.try_divide(rest, by)).cast(WHOLE)
        left = (rest - (guess * by).cast(WHOLE)).cast(WHOLE)
        # the quotient's few decimals may have been rounded up to the next whole number
        over = left < 0
        return F.when(over, guess - 1).otherwise(guess).cast(WHOLE), F.when(over, left + by).otherwise(left).cast(WHOLE)

    def step(acc: Column, _: Column) -> Column:
        found, rest = digit((acc["rest"] * ten).cast(WHOLE), acc["by"])
        return F.struct(((acc["found"] * ten).cast(WHOLE) + found).cast(WHOLE).alias("found"), rest.alias("rest"), acc["by"].alias("by"))

    def rounded(acc: Column) -> Column:
        up = (acc["rest"] * F.lit(2).cast("decimal(1,0)")).cast(WHOLE) >= acc["by"]
        return (acc["found"] + F.when(up, 1).otherwise(0)).cast(WHOLE)

    by = F.nullif(_units(denominator), none)
    found, rest = digit((_units(numerator) * F.lit(scale).cast("decimal(5,0)")).cast(WHOLE), by)
    start = F.struct(found.alias("found"), rest.alias("rest"), by.cast(WHOLE).alias("by"))
    units = F.aggregate(F.sequence(F.lit(1), F.lit(8 + shift)), start, step, rounded)
    # the array binds the result once
    both = F.transform(F.array(units), lambda u: ((u - (u % UNIT)) / UNIT).try_cast("decimal(29,0)") + ((u % UNIT).cast("decimal(9,0)") / F.lit(UNIT).cast("decimal(9,0)")).cast("decimal(8,8)"))
    size = published(F.get(both, F.lit(0)))
    return F.when((numerator < 0) != (denominator < 0), published(negative(size))).otherwise(size)
