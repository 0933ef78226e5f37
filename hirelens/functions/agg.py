"""Exact, engine-independent aggregate helpers.

Money averages: salaries are summed exactly in cents (BIGINT: exact up to
9.2e16 currency units per group, and ANSI mode fails loudly beyond; no
floating-point order effects) and the mean is rounded half-up to 4 places
with integer arithmetic. Ratios are one division of two exact counts. Both
give the same double in any engine and any partitioning, so results are
reproducible across reruns and partial / final aggregation splits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cents(col) -> Column:
    return F.round(_c(col) * 100).cast("bigint")


def money_mean(cents_sum: Column, n: Column) -> Column:
    """Mean of ``n`` values with total ``cents_sum`` (cents), half-up at 4
    places, as DOUBLE; NULL when ``n`` = 0. Values are non-negative."""
    s = cents_sum.cast("decimal(38,0)")
    a = s * 200 + n
    b = n * 2
    q = (a - F.pmod(a, b)) / b
    return F.when(n > 0, (q / 10000).cast("double"))


def money_avg(col) -> Column:
    """Aggregate: exact mean of a money column (see module doc)."""
    c = cents(col)
    return money_mean(F.sum(c), F.count(c))


def ratio(cond: Column) -> Column:
    """Aggregate: share of rows where ``cond`` holds (NULL counts as false)."""
    return F.count_if(cond) / F.count(F.lit(1))


def money_avg_sql(x: str) -> str:
    """The same mean in DuckDB SQL (oracle side)."""
    c = f"CAST(round({x} * 100) AS BIGINT)"
    return (f"CAST((sum({c}) * 200 + count({c})) // NULLIF(2 * count({c}), 0) AS DOUBLE) / 10000.0")


def ratio_sql(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond}) / count(*)"
