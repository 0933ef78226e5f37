"""Skew-safe ranking.

``rank() OVER (PARTITION BY p ORDER BY v DESC)`` puts every row of a
partition key into one task; with a hot key (one day or city holding a third
of the rows) that task is the whole job. Rank only depends on how many rows
have a larger value, so it is computed on the (p, v) histogram instead:

1. ``groupBy(p, v).count()`` — partial + final aggregate, rows = distinct
   values per key (at most sqrt(2 * rows) distinct counts per key);
2. a running sum over that small histogram gives 1 + rows with a larger v;
3. join the rank back on (p, v) (null-safe); AQE splits skewed join keys.

Results equal SQL ``rank()`` (ties share a rank, gaps after ties, NULL
order values last).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _ranked(hist: DataFrame, partition_cols: list[str], order_col: str, out_col: str) -> DataFrame:
    """The histogram ``_n`` of ``order_col`` with 1 + rows of a larger value."""
    w = Window.partitionBy(*partition_cols) if partition_cols else Window.partitionBy(F.lit(0))
    w = w.orderBy(F.col(order_col).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return hist.withColumn(out_col, (F.coalesce(F.sum("_n").over(w), F.lit(0)) + 1).cast("int"))


def _joined(df: DataFrame, ranks: DataFrame, on: list[str], out_cols: list[str]) -> DataFrame:
    """``df`` with the ranks of its rows, by null-safe ``on``."""
    ranks = ranks.select(*[F.col(c).alias(f"_k_{c}") for c in on], *out_cols)
    return df.join(ranks, [df[c].eqNullSafe(ranks[f"_k_{c}"]) for c in on], "inner").drop(*[f"_k_{c}" for c in on])


def rank_desc(df: DataFrame, partition_cols: list[str], order_col: str, out_col: str) -> DataFrame:
    on = [*partition_cols, order_col]
    hist = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return _joined(df, _ranked(hist, partition_cols, order_col, out_col), on, [out_col])


def ranks_desc(df: DataFrame, partition_cols: list[str], within: str, order_col: str, out_col: str, out_within: str) -> DataFrame:
    """Two ranks: among the rows of ``partition_cols``, and among those of them
    that share ``within``. The wider histogram is added up from the narrower
    one, so that the rows themselves are joined once."""
    on = [*partition_cols, within, order_col]
    hist = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    whole = hist.groupBy(*partition_cols, order_col).agg(F.sum("_n").alias("_n"))
    whole = _ranked(whole, partition_cols, order_col, out_col).drop("_n")
    ranks = _joined(_ranked(hist, [*partition_cols, within], order_col, out_within), whole, [*partition_cols, order_col], [out_col])
    return _joined(df, ranks, on, [out_col, out_within])
