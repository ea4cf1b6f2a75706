"""Column helpers shared by every operator (all JVM-side expressions).

Money is summed exactly: every line amount is a decimal quantity of at most
4 decimals (prices and rates have 2), so it is cast to DECIMAL(18,4) before
``sum``. Decimal sums do not depend on summation order, hence not on the
partitioning or the number of executors; double sums would change in their
last bits from run to run and flip values sitting on a rounding boundary.
Ratios and statistics (shares, rates, averages, z-scores) are computed in
DOUBLE from those exact sums.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Line amount (double of at most 4 decimals) -> exact DECIMAL(18,4)."""
    return _c(c).cast(MONEY)


def msum(c: Column | str) -> Column:
    """Exact sum of line amounts (DECIMAL(28,4) result)."""
    return F.sum(money(c))


def dec(v: float | str) -> Column:
    """Exact decimal literal (e.g. a multiplier applied to money)."""
    return F.lit(Decimal(str(v)))


def rnd(c: Column | str, digits: int) -> Column:
    """Round a DOUBLE half away from zero after scaling, like ``ROUND(double, n)``.

    Spark's ``round(x, n)`` on a double rounds its decimal text (1.005 -> 1.01);
    the reports are defined on binary doubles scaled by 10**n first
    (1.005 -> 1.0). Scaling and rounding to an integer keeps the arithmetic
    identical to that definition.
    """
    c = _c(c)
    if digits == 0:
        return F.round(c)
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale)) / F.lit(scale)


def dround(c: Column | str, digits: int) -> Column:
    """Round an exact DECIMAL half away from zero, then report it as DOUBLE."""
    return F.round(_c(c), digits).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)`` in DOUBLE: a zero denominator yields NULL, never an error."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """``ROUND(num / NULLIF(den, 0) * 100, digits)``."""
    return rnd(safe_div(num, den) * F.lit(100.0), digits)


def millions(c: Column, digits: int | None = None) -> Column:
    """Exact decimal amount -> millions (decimal shift), optionally rounded, as DOUBLE."""
    out = c * F.lit(Decimal("0.000001"))
    return out.cast("double") if digits is None else dround(out, digits)


def thousands(c: Column, digits: int | None = None) -> Column:
    out = c * F.lit(Decimal("0.001"))
    return out.cast("double") if digits is None else dround(out, digits)


def no_negative_zero(c: Column) -> Column:
    """Normalise -0.0 to 0.0 (residuals of exact differences)."""
    return c + F.lit(0.0)


def units(c: Column, scale: int) -> Column:
    """Amount -> LONG units of 10**-scale; an amount with more decimals raises instead of being rounded."""
    raw = c.cast("double") * F.lit(float(10 ** scale))
    whole = F.round(raw)
    fits = F.abs(raw - whole) <= F.lit(1e-3) + F.abs(raw) * F.lit(1e-12)
    return F.when(fits | raw.isNull(), whole.cast("long")).otherwise(
        F.raise_error(F.lit(f"an amount has more than {scale} decimals")).cast("long"))


def agg_exact(df, keys: list, scale: int = 4, **aggs):
    """``groupBy(keys).agg(...)`` with exact money sums at long-integer speed.

    ``aggs``: name -> (kind, column) with kind ``money`` (exact sum of line
    amounts), ``sum`` or ``count`` (column ``None`` counts rows).

    Level 1 groups by the keys and the task's partition id: each task sums
    its money as LONG units of 10**-scale (an amount with more decimals
    raises). Filters must stand below: the partition id keeps them from moving
    through. A
    task reads a bounded slice of the input, so the long cannot overflow
    whatever the size of a group - a hot key is spread over many tasks.
    Level 2 adds the per-task partials (a few rows per key) in DECIMAL, so
    the total is exact and order independent like a plain decimal sum, for
    a fraction of the cost of decimal accumulation on every line.
    """
    lvl1 = []
    for name, (kind, c) in aggs.items():
        c = _c(c) if c is not None else None
        if kind == "money":
            lvl1.append(F.sum(units(c, scale)).alias(name))
        elif kind == "sum":
            lvl1.append(F.sum(c).alias(name))
        elif kind == "count":
            lvl1.append(F.count(c if c is not None else F.lit(1)).alias(name))
        else:
            raise ValueError(f"unknown aggregate kind {kind!r}")
    part = df.groupBy(*keys, F.spark_partition_id().alias("_task")).agg(*lvl1)
    names = [c for c in part.columns if c not in aggs and c != "_task"]
    lvl2 = []
    for name, (kind, _) in aggs.items():
        if kind == "money":
            lvl2.append((F.sum(F.col(name).cast("decimal(38,0)")) * F.lit(Decimal(1).scaleb(-scale)))
                        .cast(f"decimal(38,{max(4, scale)})").alias(name))
        else:
            lvl2.append(F.sum(name).alias(name))
    return part.groupBy(*names).agg(*lvl2)
