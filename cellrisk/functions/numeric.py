"""Column helpers for rounding, clipping, binning, flags and lookups.

Everything returns a built-in `Column` expression, so the work stays in the JVM and inside
whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def np_round(c: Column | str, digits: int = 0) -> Column:
    """Round half to even after scaling; Spark's own `round` is half-up on the decimal text."""
    x = col_of(c)
    if digits == 0:
        return F.rint(x)
    scale = float(10**digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def clip(c: Column | str, lower: float | None = None, upper: float | None = None) -> Column:
    """Clip that keeps NULL as NULL (`least` and `greatest` would skip it); NaN, which Spark puts above all, becomes NULL."""
    x = col_of(c)
    out = x
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(x.isNotNull() & ~F.isnan(x), out)


def flag(condition: Column) -> Column:
    """0/1 integer, with an unknown condition counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def cut(
    c: Column | str,
    edges: Sequence[float],
    labels: Sequence[str],
    missing: str = "nan",
    include_lowest: bool = False,
) -> Column:
    """Right-closed interval labels; values outside every interval, NULL and NaN become `missing`.

    An edge of minus or plus infinity leaves that side open.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is required")
    x = nan_to_null(c)
    out = None
    for i, label in enumerate(labels):
        low, high = edges[i], edges[i + 1]
        inside = F.lit(True)
        if low != float("-inf"):
            above = (x >= F.lit(low)) if include_lowest and i == 0 else (x > F.lit(low))
            inside = above
        if high != float("inf"):
            below = x <= F.lit(high)
            inside = below if low == float("-inf") else inside & below
        elif low == float("-inf"):
            inside = x.isNotNull()
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out.otherwise(F.lit(missing))


def ratio(numerator: Column | str, denominator: Column | str, digits: int) -> Column:
    """numerator / max(denominator, 1), rounded."""
    return np_round(col_of(numerator) / clip(denominator, lower=1.0), digits)


def lookup(c: Column | str, table: Mapping[str, object], default: object | None = None) -> Column:
    """Literal map lookup; absent keys and NULL take `default`."""
    entries = [F.lit(v) for pair in table.items() for v in pair]
    found = F.try_element_at(F.create_map(*entries), col_of(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def money_sum(c: Column | str) -> Column:
    """Sum of a two-decimal amount, exact and independent of the order of addition."""
    return F.sum(col_of(c).cast("decimal(18,2)")).cast("double")


def nan_to_null(c: Column | str) -> Column:
    x = col_of(c)
    return F.when(~F.isnan(x), x)


def finite(c: Column | str) -> Column:
    """NULL for NaN and both infinities."""
    x = col_of(c)
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def steady_mean(c: Column | str, digits: int = 6) -> Column:
    """Mean from whole-number sums of the value scaled by 10^digits.

    The result does not depend on the order in which partial sums arrive, so a rerun, another
    partitioning or a lost executor cannot move a later rounding step. Sums have 38 digits. Values that are
    NULL or not finite do not count.
    """
    x = finite(c)
    scale = float(10**digits)
    total = F.sum(F.rint(x * F.lit(scale)).cast("decimal(28,0)")).cast("double")
    return F.try_divide(total / F.lit(scale), F.count(x))
