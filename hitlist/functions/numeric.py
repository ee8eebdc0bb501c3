"""A mean rounded to two decimals, half away from zero, computed exactly.

Averages are computed on whole units of a fixed scale so that no binary double or
intermediate decimal rounding can move a value across a .xx5 boundary; only the mean is
rounded, once:

    mean_2dp = sign(S) * ((2*|S| + n*u) div (2*n*u)) / 100,   S = sum(100 * u * x), n = count(x)

Integers are scaled by 100 (u = 1) and summed as longs; money doubles are fixed to eight
decimals (u = 10**6) and summed decimal(38)-wide. An empty or all-NULL group gives NULL.

The helpers return aggregate Columns for ``groupBy().agg(...)``; Catalyst shares the
repeated ``sum``/``count`` so each is computed once, with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Units of a hundredth that money is summed in: eight decimals.
MONEY_UNITS = 1_000_000


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _whole(column: str) -> str:
    """Integer inputs (ratings, chart positions, weeks) are small, so the scaled sum is a
    long: a fixed-width hash-aggregate buffer. An overflow would raise under ANSI mode."""
    return f"CAST({_ident(column)} AS BIGINT) * 100"


def _money(column: str) -> str:
    return f"CAST(CAST({_ident(column)} AS DECIMAL(24,8)) * {100 * MONEY_UNITS} AS DECIMAL(28,0))"


def _rounded(total: str, count: str, units: int = 1) -> Column:
    n = f"({count} * {units})"
    return F.expr(f"CAST(sign({total}) * ((2 * abs({total}) + {n}) div nullif(2 * {n}, 0)) / 100D AS DOUBLE)")


def avg2(column: str) -> Column:
    """ROUND(AVG(int_column)::numeric, 2) as a DOUBLE."""
    x = _whole(column)
    return _rounded(f"sum({x})", f"count({x})")


def avg2_money(column: str) -> Column:
    """ROUND(AVG(money_double)::numeric, 2) as a DOUBLE."""
    x = _money(column)
    return _rounded(f"sum({x})", f"count({x})", MONEY_UNITS)


def mean_parts(column: str, prefix: str = "_m") -> list[Column]:
    """Partial form of the integer mean: scaled sum and count, to be summed again later
    (e.g. aggregate first, join a small dimension, then finish)."""
    x = _whole(column)
    return [F.expr(f"sum({x})").alias(f"{prefix}_sum"), F.expr(f"count({x})").alias(f"{prefix}_cnt")]


def finish_mean(sum_col: str, cnt_col: str) -> Column:
    """N1 rounding over already-aggregated scaled sum and count columns."""
    return _rounded(_ident(sum_col), _ident(cnt_col))
