"""Numeric helpers: half-even rounding and division/log without ANSI errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, digits: int = 0) -> Column:
    """R's ``round``: ties to even (2.5 -> 2). ``+ 0.0`` folds -0.0 into 0.0."""
    return F.bround(_col(c).cast("double"), digits) + F.lit(0.0)


def round_decimal(c, digits: int) -> Column:
    """Half-even rounding of x * 10^digits, in steps that IEEE arithmetic fixes.

    Multiply, floor and compare give the same digits in every engine, whereas
    library rounding functions differ on values next to a tie. A tie is a
    scaled value whose fractional part is exactly one half. Non-finite values
    and those beyond exact integers pass through unchanged.
    """
    scale = float(10 ** digits)
    x = _col(c).cast("double")
    y = x * scale
    f = F.floor(y).cast("double")
    r = y - f
    k = (F.when(r == 0.5, F.when(F.pmod(f, F.lit(2.0)) == 0, f).otherwise(f + 1))
          .when(r < 0.5, f).otherwise(f + 1))
    return F.when(F.abs(y) < 1e15, k / F.lit(scale) + F.lit(0.0)).otherwise(x)


def settle(c, digits: int = 12) -> Column:
    """``x`` to 12 decimals: exponentials and logarithms of different libraries differ in the last bit,
    and a geometric mean that should lie on a tie would round either way."""
    scale = float(10 ** digits)
    x = _col(c)
    return F.when(F.abs(x) < 1e3, F.floor(x * scale + 0.5) / F.lit(scale)).otherwise(x)


def ordered_sum(x, *order) -> Column:
    """Sum of the non-missing ``x`` of a group in the order of ``order``, then ``x``.

    Floating-point sums depend on the order of their terms; this one does not
    depend on how the rows arrive. For groups whose size the hub bounds (members of
    an ensemble cell, horizons, partners of a model).
    """
    x = _col(x).cast("double")
    terms = F.array_sort(F.collect_list(F.when(x.isNotNull(), F.struct(*[_col(o).alias(f"o{i}") for i, o in enumerate(order)],
                                                                     x.alias("x")))))
    return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t["x"])


def ordered_mean(x, *order) -> Column:
    """Mean of the non-missing values by ``ordered_sum``; NULL without any."""
    n = F.count(_col(x))
    return F.when(n > 0, ordered_sum(x, *order) / n)


def safe_div(num, den) -> Column:
    """``num / den`` with NULL instead of an error when ``den`` is 0."""
    return F.try_divide(_col(num), _col(den))


def log_ratio(num, den) -> Column:
    """ln(num/den) with R's limits: 0/x -> -Inf, x/0 -> +Inf, 0/0 -> NULL (trap T7).

    Spark's ``ln(0)`` is NULL, which an average would silently skip; R gives
    -Inf, which drives a geometric mean to 0. Scores are non-negative.
    """
    n, d = _col(num), _col(den)
    return (F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
            .when((n == 0) & (d == 0), F.lit(None).cast("double"))
            .when(n == 0, F.lit(float("-inf")))
            .when(d == 0, F.lit(float("inf")))
            .otherwise(F.ln(n / d)))
