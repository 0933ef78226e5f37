"""Gold tables and features over a silver-shaped DataFrame.

Input columns (silver names): job_id, source, company_name, city, job_title,
level_normalized, employment_type, category_level_1..3, skills,
salary_min, salary_max, posting_date, record_version, status,
experience_months_min, english_required, has_benefits.

Money averages are exact cent sums rounded half-up to 4 places and ratios are
one division of exact counts (:mod:`hirelens.functions.agg`); percentiles are
rounded to 4 places. Results are the same in any engine and partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.functions import enums
from hirelens.functions.agg import cents, money_avg, money_mean, ratio
from hirelens.operators.ranking import rank_desc, ranks_desc
from hirelens.session import scratch_path
from hirelens.sinks.steps import written
from hirelens.streaming.runs import fresh_name

PERCENTILE_PLACES = 4


def _r(col: Column, places: int = PERCENTILE_PLACES) -> Column:
    return F.round(col, places)


_ratio = ratio


class Profile:
    """Exact statistics of groups from value histograms: counts, averages,
    interpolated percentiles, shares and distinct counts.

    Equal rows are counted first, in part before the shuffle, so a hot group
    arrives as its distinct rows; these are dealt by group. Only there each
    gives a value per column, counted per (group, column, value). A running
    count over a column's values, in order, then finds the two around any rank.
    Counting and sorting spill; no group is kept as a map in memory, and the
    input is read once for all statistics."""

    def __init__(self, df: DataFrame, keys: list[str], numbers: list[str], texts: list[str] | None = None):
        self.keys, self.columns, texts = keys, [*numbers, *(texts or [])], texts or []
        values = [F.struct(F.lit(i).alias("m"),
                           (F.lit(None) if c in texts else F.col(c)).cast("double").alias("v"),
                           (F.col(c) if c in texts else F.lit(None)).cast("string").alias("s"))
                  for i, c in enumerate(self.columns)]
        # One column to deal by: a key that is a constant would not be seen to be dealt by.
        rows = (df.groupBy(*keys, *self.columns).agg(F.count(F.lit(1)).alias("n"))
                .withColumn("_dealt", F.xxhash64(*keys)).repartition("_dealt"))
        hist = (rows.select("_dealt", *keys, "n", F.explode(F.array(*values)).alias("x")).select("_dealt", *keys, "n", "x.*")
                .groupBy("_dealt", *keys, "m", "v", "s").agg(F.sum("n").alias("n")))
        group = Window.partitionBy("_dealt", *keys, "m")
        run = group.orderBy(F.col("v").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        self.ranked = hist.withColumn("hi", F.sum("n").over(run)) \
            .withColumn("known", F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).over(group))

    def _of(self, column: str, value: Column) -> Column:
        return F.when(F.col("m") == self.columns.index(column), value)

    def count(self) -> Column:
        return F.sum(self._of(self.columns[0], F.col("n")))

    def distinct(self, text: str) -> Column:
        return F.count(self._of(text, F.col("s")))

    def share(self, flag: str) -> Column:
        return F.coalesce(F.sum(self._of(flag, F.when(F.col("v") == 1, F.col("n")))), F.lit(0)) / self.count()

    def money(self, number: str) -> Column:
        known = F.when(F.col("v").isNotNull(), F.col("n"))
        return money_mean(F.sum(self._of(number, cents("v") * F.col("n"))), F.coalesce(F.sum(self._of(number, known)), F.lit(0)))

    def percentile(self, number: str, p: float) -> Column:
        at = F.lit(p) * (F.col("known") - 1)

        def value_at(rank: Column) -> Column:
            return F.max(self._of(number, F.when((F.col("hi") - F.col("n") <= rank) & (rank < F.col("hi")), F.col("v"))))

        low, high, part = value_at(F.floor(at)), value_at(F.ceil(at)), F.max(self._of(number, at - F.floor(at)))
        return _r(F.when(low == high, low).otherwise(low * (1 - part) + high * part))

    def agg(self, **columns: Column) -> DataFrame:
        return self.ranked.groupBy("_dealt", *self.keys).agg(*[c.alias(name) for name, c in columns.items()]).drop("_dealt")


def _money() -> list[Column]:
    return [money_avg("salary_min").alias("avg_salary_min"), money_avg("salary_max").alias("avg_salary_max")]


def _rank_in(df: DataFrame, partition_cols: list[str], order_col: str, out_col: str) -> DataFrame:
    """SQL ``rank()`` (ties share a rank) over already-aggregated gold rows:
    a partition holds at most one row per dimension value (skill, company,
    ...), never raw postings, so its size is bounded by dimension
    cardinality, not by data volume."""
    w = Window.partitionBy(*partition_cols).orderBy(F.col(order_col).desc())
    return df.withColumn(out_col, F.rank().over(w))


def exploded_skills(silver: DataFrame, *cols: str) -> DataFrame:
    """One row per (posting, distinct non-empty skill); only the needed
    columns are carried (narrow select before explode)."""
    return silver.select(*cols, F.explode(F.array_distinct("skills")).alias("skill")) \
        .filter((F.col("skill").isNotNull()) & (F.col("skill") != ""))


def job_facts_daily(silver: DataFrame) -> DataFrame:
    """A6 gold_job_facts_daily, with exact medians."""
    keys = ["date_key", "source", "city", "category_level_1", "category_level_2",
            "category_level_3", "level_normalized", "employment_type"]
    p = Profile(silver.withColumn("date_key", enums.date_key("posting_date")), keys,
                ["salary_min", "salary_max", "english_required", "has_benefits"], ["company_name"])
    return p.agg(job_count=p.count(), distinct_company_count=p.distinct("company_name"),
                 avg_salary_min=p.money("salary_min"), avg_salary_max=p.money("salary_max"),
                 median_salary_min=p.percentile("salary_min", 0.5), median_salary_max=p.percentile("salary_max", 0.5),
                 english_required_ratio=p.share("english_required"), benefit_coverage_ratio=p.share("has_benefits"))


def skill_counts_daily(silver: DataFrame) -> DataFrame:
    """A7 gold_skill_counts_daily with W1 ranks (ties share a rank)."""
    keys, cols = ["_day", "source", "city", "category_level_3"], ["company_name", "salary_min", "salary_max"]
    # Postings are dealt by what they share with all their skills: these multiply no shuffle.
    dealt = silver.withColumn("_day", F.to_date("posting_date")).select(*keys, *cols, "skills") \
        .withColumn("_dealt", F.xxhash64(*keys)).repartition("_dealt")
    agg = exploded_skills(dealt, "_dealt", *keys, *cols).groupBy("_dealt", "_day", "source", "skill", "city", "category_level_3").agg(
        F.count(F.lit(1)).alias("job_count"),
        F.count_distinct("company_name").alias("distinct_company_count"), *_money()).drop("_dealt")
    # Written once: read twice below, with other columns, it would be worked out twice.
    agg = written(agg, scratch_path(silver.sparkSession, fresh_name("skill_counts")))
    ranked = ranks_desc(agg, ["_day", "source"], "city", "job_count", "skill_rank_in_day", "skill_rank_in_city")
    return ranked.select(enums.date_key("_day").alias("date_key"), *ranked.drop("_day").columns)


def salary_stats_by_skill_month(silver: DataFrame) -> DataFrame:
    """A8 gold_salary_stats_by_skill_month, with exact percentiles."""
    ex = exploded_skills(silver.withColumn("month_key", enums.month_key("posting_date")),
                         "month_key", "city", "category_level_3", "salary_min", "salary_max")
    p = Profile(ex, ["month_key", "skill", "city", "category_level_3"], ["salary_min", "salary_max"])
    return p.agg(job_count=p.count(), avg_salary_min=p.money("salary_min"), avg_salary_max=p.money("salary_max"),
                 median_salary_min=p.percentile("salary_min", 0.5), median_salary_max=p.percentile("salary_max", 0.5),
                 p25_salary_min=p.percentile("salary_min", 0.25), p75_salary_max=p.percentile("salary_max", 0.75))


def company_hiring_by_month(silver: DataFrame) -> DataFrame:
    """A9 gold_company_hiring_by_month with the hiring rank in (month, city)."""
    agg = (silver.withColumn("month_key", enums.month_key("posting_date"))
           .groupBy("month_key", "company_name", "city")
           .agg(F.count(F.lit(1)).alias("job_count"),
                F.count_distinct("job_title").alias("distinct_job_title_count"),
                *_money()))
    return rank_desc(agg, ["month_key", "city"], "job_count", "hiring_rank_in_city")


def skill_pairs(silver: DataFrame, *cols: str) -> DataFrame:
    """Unordered skill pairs (a < b) of each posting, generated per row from
    its own deduplicated, sorted skill list (no self-join)."""
    arr = F.array_sort(F.array_distinct(F.filter("skills", lambda x: x.isNotNull() & (x != ""))))
    pairs = F.flatten(F.transform(arr, lambda a, i: F.transform(
        F.slice(arr, i + 2, F.size(arr)), lambda b: F.struct(a.alias("skill_a"), b.alias("skill_b")))))
    return silver.select(*cols, F.explode(pairs).alias("p")).select(*cols, "p.skill_a", "p.skill_b")


def skill_cooccurrence_weekly(silver: DataFrame) -> DataFrame:
    """A10 gold_skill_cooccurrence_weekly: count, lift = n*n_ab/(n_a*n_b),
    Jaccard = n_ab/(n_a+n_b-n_ab); n = postings in the week."""
    wk = silver.select("job_id", enums.week_key("posting_date").alias("week_key"), "skills")
    pairs = skill_pairs(wk, "week_key").groupBy("week_key", "skill_a", "skill_b") \
        .agg(F.count(F.lit(1)).alias("cooccurrence_count"))
    marg = exploded_skills(wk, "week_key").groupBy("week_key", "skill").agg(F.count(F.lit(1)).alias("n"))
    weeks = wk.groupBy("week_key").agg(F.count(F.lit(1)).alias("n_week"))
    ma = marg.withColumnRenamed("skill", "skill_a").withColumnRenamed("n", "n_a")
    mb = marg.withColumnRenamed("skill", "skill_b").withColumnRenamed("n", "n_b")
    j = pairs.join(ma, ["week_key", "skill_a"]).join(mb, ["week_key", "skill_b"]).join(weeks, "week_key")
    nab = F.col("cooccurrence_count")
    return j.select(
        "week_key", "skill_a", "skill_b", "cooccurrence_count",
        (F.col("n_week") * nab / (F.col("n_a") * F.col("n_b"))).alias("lift_score"),
        (nab / (F.col("n_a") + F.col("n_b") - nab)).alias("jaccard_score"))


def skill_rank_overall(silver: DataFrame) -> DataFrame:
    """W2 top_skill_rank over the whole period, overall and by city."""
    ex = exploded_skills(silver, "city", "company_name")
    by_city = ex.groupBy("skill", "city").agg(F.count(F.lit(1)).alias("skill_job_count_city"))
    overall = ex.groupBy("skill").agg(
        F.count(F.lit(1)).alias("skill_job_count"),
        F.count_distinct("company_name").alias("skill_distinct_company_count"))
    # A global rank has no partition key: the histogram rank keeps only the
    # distinct counts in one task instead of every skill row.
    overall = rank_desc(overall, [], "skill_job_count", "skill_rank_overall")
    by_city = _rank_in(by_city, ["city"], "skill_job_count_city", "skill_rank_by_city")
    return by_city.join(overall, "skill")


def demand_trend(silver: DataFrame, by: str = "city") -> DataFrame:
    """W3 demand trend: postings in the last 7 / 30 calendar days against the
    7 / 30 days before (range frames over the day number); growth =
    cur / prev - 1, NULL when prev = 0.

    The window runs over the daily aggregate (rows = days per key), never
    over raw rows."""
    daily = silver.groupBy(by, "posting_date").agg(F.count(F.lit(1)).alias("job_count"))
    daily = daily.withColumn("_d", F.unix_date("posting_date"))
    w = Window.partitionBy(by).orderBy("_d")

    def span(lo, hi):
        return F.coalesce(F.sum("job_count").over(w.rangeBetween(lo, hi)), F.lit(0)).cast("bigint")

    def growth(cur, prev):
        return F.when(F.col(prev) == 0, F.lit(None).cast("double")) \
            .otherwise(F.col(cur) / F.col(prev) - 1.0)

    out = daily.select(by, enums.date_key("posting_date").alias("date_key"), "job_count",
                       span(-6, 0).alias("jobs_7d"), span(-13, -7).alias("jobs_prev_7d"),
                       span(-29, 0).alias("jobs_30d"), span(-59, -30).alias("jobs_prev_30d"))
    return out.withColumn("demand_trend_7d", growth("jobs_7d", "jobs_prev_7d")) \
        .withColumn("demand_trend_30d", growth("jobs_30d", "jobs_prev_30d"))


def skill_trend(silver: DataFrame) -> DataFrame:
    """W3 for skills: growth of postings that ask for a skill, 7 and 30 days."""
    return demand_trend(exploded_skills(silver, "posting_date"), "skill")


def version_activity(silver_latest: DataFrame, as_of=None) -> DataFrame:
    """A12 (O): per posting date, new (version 1) / updated (version > 1) /
    active (status 'O') counts and ratios."""
    return (silver_latest.withColumn("date_key", enums.date_key("posting_date"))
            .groupBy("date_key")
            .agg(F.count(F.lit(1)).alias("job_count"),
                 F.count_if(F.col("record_version") == 1).alias("new_job_count"),
                 F.count_if(F.col("record_version") > 1).alias("updated_job_count"),
                 F.count_if(F.col("status") == "O").alias("active_job_count"),
                 _ratio(F.col("record_version") == 1).alias("new_job_ratio"),
                 _ratio(F.col("record_version") > 1).alias("updated_job_ratio")))


def experience_mix(silver: DataFrame) -> DataFrame:
    """Per city, bucket counts and junior / mid / senior / English ratios."""
    b = enums.experience_bucket("experience_months_min")
    return (silver.withColumn("experience_bucket", b)
            .groupBy("city")
            .agg(F.count(F.lit(1)).alias("job_count"),
                 F.count_if(F.col("experience_bucket") == "junior").alias("junior_job_count"),
                 F.count_if(F.col("experience_bucket") == "mid").alias("mid_job_count"),
                 F.count_if(F.col("experience_bucket") == "senior").alias("senior_job_count"),
                 _ratio(F.col("experience_bucket") == "junior").alias("junior_ratio"),
                 _ratio(F.col("experience_bucket") == "mid").alias("mid_ratio"),
                 _ratio(F.col("experience_bucket") == "senior").alias("senior_ratio"),
                 _ratio(F.col("english_required")).alias("english_required_ratio")))


def company_hiring_intensity(silver: DataFrame) -> DataFrame:
    """A15 / W6 (O): company postings / all postings of its (month, city).

    The share-of-total window runs over the (month, city, company) aggregate."""
    agg = (silver.withColumn("month_key", enums.month_key("posting_date"))
           .groupBy("month_key", "city", "company_name")
           .agg(F.count(F.lit(1)).alias("company_job_count")))
    tot = F.sum("company_job_count").over(Window.partitionBy("month_key", "city"))
    return agg.withColumn("city_month_job_count", tot.cast("bigint")) \
        .withColumn("company_hiring_intensity",
                    F.col("company_job_count") / F.col("city_month_job_count"))


def coverage_metrics(silver: DataFrame) -> DataFrame:
    """A11 (per city): salary disclosed ratio, structured company coverage,
    location parse rate."""
    return silver.groupBy("city").agg(
        F.count(F.lit(1)).alias("job_count"),
        _ratio(F.col("salary_min").isNotNull()).alias("salary_disclosed_ratio"),
        _ratio(F.col("company_name").isNotNull() & (F.col("company_name") != "")).alias("company_coverage"),
        _ratio(F.col("city").isNotNull()).alias("location_parse_rate"))
