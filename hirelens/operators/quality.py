"""Quality rules, flags and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.constants import SKILL_NOISE


def not_null_rules(df: DataFrame, cols: list[str], skills_col: str = "skills") -> DataFrame:
    """V8: one aggregate pass with a ``count_if`` per rule -> (rule,
    violations). Includes "no noise token in silver skills"."""
    noise = F.array(*[F.lit(n) for n in SKILL_NOISE])
    aggs = [F.count_if(F.col(c).isNull()).alias(f"{c}_not_null") for c in cols]
    aggs.append(F.count_if(F.size(F.filter(skills_col, lambda x: F.array_contains(noise, F.lower(x)))) > 0)
                .alias("no_noise_skill"))
    wide = df.agg(*aggs)
    names = [f"{c}_not_null" for c in cols] + ["no_noise_skill"]
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).cast("bigint").alias("violations"))
                                  for n in names]))
    return wide.select(stacked.alias("r")).select("r.rule", "r.violations")


def layer_profile(df: DataFrame, columns: dict[str, Column] | list[str], types: dict[str, str] | None = None,
                  by: list[str] | None = None) -> DataFrame:
    """One row a column: ``field, rows, filled, coverage, distinct_estimate,
    type_faults`` (per group of ``by``), from one aggregate pass.

    Filled: not null, and not an empty text or list. ``distinct_estimate`` is
    a sketch's (a few per cent off); ``type_faults`` counts filled values that
    can't be read as the column's type in ``types``."""
    columns = columns if isinstance(columns, dict) else {c: F.col(c) for c in columns}
    typed = df.select(*(by or []), *[v.alias(k) for k, v in columns.items()])
    told, types = [], types or {}
    for name, kind in typed.select(*columns).dtypes:
        value = F.col(name)
        filled = F.size(value) > 0 if kind.startswith(("array", "map")) else \
            F.trim(value) != "" if kind == "string" else value.isNotNull()
        filled = F.coalesce(filled, F.lit(False))
        fault = filled & value.try_cast(types[name]).isNull() if name in types else F.lit(False)
        told.append(F.struct(F.lit(name).alias("field"), F.count(F.lit(1)).alias("rows"), F.count_if(filled).alias("filled"),
                             F.approx_count_distinct(F.when(filled, F.to_json(F.struct(value)))).alias("distinct_estimate"),
                             F.count_if(fault).alias("type_faults")))
    wide = typed.groupBy(*(by or [])).agg(F.array(*told).alias("p"))
    return wide.select(*(by or []), F.inline("p")).withColumn(
        "coverage", F.when(F.col("rows") > 0, F.col("filled") / F.col("rows")))


def coverage_change(before: DataFrame, after: DataFrame, same: dict[str, str]) -> DataFrame:
    """Two profiles side by side: ``field, before_field, before_filled,
    after_filled, before_coverage, after_coverage, coverage_gain``; ``same``
    names the earlier layer's field of each later one."""
    pairs = F.create_map(*[F.lit(x) for pair in same.items() for x in pair])
    a = after.where(F.col("field").isin(list(same))).withColumn("before_field", F.try_element_at(pairs, "field"))
    b = before.select(F.col("field").alias("before_field"), F.col("filled").alias("before_filled"),
                      F.col("coverage").alias("before_coverage"))
    return a.join(b, "before_field").select(
        "field", "before_field", "before_filled", F.col("filled").alias("after_filled"), "before_coverage",
        F.col("coverage").alias("after_coverage"), (F.col("coverage") - F.col("before_coverage")).alias("coverage_gain"))


def raw_quality_flags(flags: dict[str, Column]) -> Column:
    """Named boolean checks -> ``map<string, boolean>``."""
    return F.map_from_arrays(F.array(*[F.lit(k) for k in flags]), F.array(*flags.values()))


def quality_score(flags: dict[str, Column]) -> tuple[Column, Column]:
    """N23 (O): score = share of passed flags; notes = names of failed flags
    joined by ','."""
    n = len(flags)
    passed = sum((F.when(c, 1).otherwise(0) for c in flags.values()), F.lit(0))
    score = F.round(passed / F.lit(float(n)), 10)
    notes = F.concat_ws(",", *[F.when(~F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in flags.items()])
    return score, notes
