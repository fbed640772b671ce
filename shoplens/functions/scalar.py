"""Scalar encodings and guards used by cleaning and feature operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: Column | str, den: Column | str, default: float = 0.0) -> Column:
    """num / den, with a zero or null denominator giving ``default``."""
    return F.coalesce(F.try_divide(_col(num), _col(den)), F.lit(default))


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 int (null stays null)."""
    return cond.cast("int")


def ordinal_encode(c: Column | str, order: Sequence[str]) -> Column:
    """Position of the value in ``order`` (0-based); unknown values give null."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), _col(c))
    return F.when(pos > 0, (pos - 1).cast("int"))


def map_encode(c: Column | str, mapping: Mapping[str, int], default: int | None = 0) -> Column:
    """Literal lookup table; unknown values take ``default``."""
    expr = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    looked = F.try_element_at(expr, _col(c))
    return F.coalesce(looked, F.lit(default)) if default is not None else looked


def clip_upper(c: Column | str, upper: Column) -> Column:
    """Upper winsorising that leaves nulls null (``least`` would return the cap)."""
    col = _col(c)
    return F.when(col > upper, upper).otherwise(col)


def age_group(age: Column | str) -> Column:
    """Right-closed bins (17,25], (25,35], (35,50], (50,71]; outside -> null."""
    a = _col(age)
    return (
        F.when((a > 17) & (a <= 25), "18-25")
        .when((a > 25) & (a <= 35), "26-35")
        .when((a > 35) & (a <= 50), "36-50")
        .when((a > 50) & (a <= 71), "51+")
    )


def exact_terms(c: Column | str) -> list[Column]:
    """Three terms whose sums, added up, are the sum of ``c``: millionths as a
    decimal, what is left of the value in steps of 1e-30 as a decimal, and the rest
    (below 1e-30, beyond 1e20, infinite or NaN) as double.

    Decimals are added exactly, so the sum does not depend on the order in which
    partitions are combined, and no digit of a value is cut off.  Values with at
    most six decimals have only the first term.  Nulls stay null.
    """
    x = _col(c)
    d = x.cast("double")
    zero = F.lit(0).cast("decimal(38,6)")
    high = F.when(d.isNotNull(), F.when(F.abs(d) < F.lit(1e20), F.coalesce(x.try_cast("decimal(38,6)"), zero)).otherwise(zero))
    left = d - high.cast("double")
    fine = F.lit(0).cast("decimal(38,30)")
    low = F.when(left == 0, fine).otherwise(F.when(F.abs(left) < F.lit(1e-5), left.try_cast("decimal(38,30)")).otherwise(fine))
    return [high, low, left - low.cast("double")]


def exact_total(high: Column, low: Column, rest: Column) -> Column:
    """The sum as double from the summed ``exact_terms``."""
    return high.cast("double") + (low.cast("double") + rest)


def exact_sum(c: Column | str) -> Column:
    """Sum of a measure that does not depend on the order of the rows: see ``exact_terms``."""
    return exact_total(*[F.sum(t) for t in exact_terms(c)])


#: Types whose values add up exactly as long.
SMALL_INTEGERS = ("byte", "short", "integer")


def exact_avg(c: Column | str, kind: str = "double") -> Column:
    """Mean with an order-independent numerator; nulls ignored.

    ``kind`` is the column's type name.  Small integers are added as long, which is
    as exact as the decimals of ``exact_sum`` and needs none of them.
    """
    total = F.sum(_col(c)).cast("double") if kind in SMALL_INTEGERS else exact_sum(c)
    return F.try_divide(total, F.count(_col(c)).cast("double"))
