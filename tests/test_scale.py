"""Plans that must hold as tables grow: who is broadcast, how work is dealt."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from hirelens.operators import dictionary, gold, realtime
from hirelens.plans import jobs_view, state_queries
from hirelens.session import checkpoint_dir
from hirelens.sinks import steps
from hirelens.sources.messages import read_message_files
from hirelens.streaming import live_layer

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dictionary_broadcasts_counted_terms_and_never_the_runs(spark, scratch):
    spark.createDataFrame([(1, "red bolt"), (2, "blue ring"), (3, None)], "k int, text string").write.parquet(f"{scratch}/texts")
    texts = spark.read.parquet(f"{scratch}/texts")
    # By its statistics this dictionary is larger than the file of the texts.
    terms = spark.range(100_000).where("id < 2").select(F.when(F.col("id") == 0, "bolt").otherwise("Blue Ring").alias("term"))
    found = dictionary.match_terms(texts, "k", "text", terms)
    assert "BuildRight" in _plan(found) and "BuildLeft" not in _plan(found)
    rows = sorted((r["k"], r["pos"], r["n_words"], r["term"]) for r in found.collect())
    assert rows == [(1, 1, 1, "bolt"), (2, 0, 2, "Blue Ring")]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")     # less than the terms have
    try:
        found = dictionary.match_terms(texts, "k", "text", terms)
        assert "SortMergeJoin" in _plan(found) and "BroadcastHashJoin" not in _plan(found)
        assert sorted((r["k"], r["pos"], r["n_words"], r["term"]) for r in found.collect()) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@pytest.mark.parametrize("name", ["n10_silver_groups_part", "n10_conflict_log_part", "n7_n21_silver_fields_part",
                                  "p1_flat_events_part"])
def test_postings_are_dealt_whatever_the_files(spark, name):
    assert E.queries()[name](spark, SF_SMALL).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_versions_from_state_keep_no_copy_of_the_table_a_delivery(spark):
    root = checkpoint_dir(spark)
    before = set(os.listdir(root))
    rows = E.queries()["k5_versions_from_state"](spark, SF_SMALL)
    (made,) = [d for d in os.listdir(root) if d.startswith("versions-") and d not in before]
    assert sorted(os.listdir(f"{root}/{made}")) == ["late1", "late2", "new0", "new1", "new2", "state2"]
    assert {"posting", "content"} <= set(spark.read.parquet(f"{root}/{made}/new0").columns)
    same = E.queries()["k5_record_versions"](spark, SF_SMALL)
    assert rows.exceptAll(same).count() == same.exceptAll(rows).count() == 0


def test_versions_from_state_are_shuffled_on_their_way_to_the_first_table_only(spark, monkeypatch):
    plans = {}

    def dealt(df, path, *a):
        plans[path.split("/")[-1]] = _plan(df)
        return steps.dealt(df, path, *a)

    monkeypatch.setattr(state_queries, "dealt", dealt)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans["table"] = _plan(E.queries()["k5_versions_from_state"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert sorted(plans) == ["bronze", "late1", "late2", "new0", "new1", "new2", "state0", "state1", "state2", "table"]
    assert [name for name, plan in plans.items() if "Exchange" in plan] == ["bronze"]
    assert plans["bronze"].count("Exchange") == 1 and "SortMergeJoin" in plans["table"]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("step_")]


def test_latest_snapshot_is_dealt_once_and_postings_without_a_line_number_are_one(spark, scratch):
    os.makedirs(f"{scratch}/t")
    for name in ("orders", "part", "supplier", "nation"):
        os.symlink(f"{SF_SMALL}/{name}.parquet", f"{scratch}/t/{name}.parquet")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    lines.withColumn("l_linenumber", F.when(F.col("l_orderkey") % 5 > 0, F.col("l_linenumber"))).write.parquet(f"{scratch}/t/lineitem.parquet")
    found = E.queries()["k6_latest_snapshot"](spark, f"{scratch}/t")
    assert "hashpartitioning(job_id" not in _plan(found)
    want = lines.where("l_orderkey % 5 > 0").select("l_orderkey", "l_linenumber").distinct().count()
    assert found.where("job_id IS NULL").count() == 1 and found.where("job_id IS NOT NULL").count() == want


def test_bronze_dedup_shuffles_no_hash_texts(spark):
    assert "hashpartitioning(job_id" not in _plan(E.queries()["k4_bronze_dedup"](spark, SF_SMALL))


def test_taxonomy_split_shuffles_no_hash_texts(spark):
    assert "hashpartitioning(job_id" not in _plan(E.queries()["n18_taxonomy_split_jobs"](spark, SF_SMALL))


def test_upsert_merge_shuffles_no_hash_texts(spark):
    assert "hashpartitioning(job_id" not in _plan(E.queries()["k8_upsert_merge"](spark, SF_SMALL))


def test_sliding_windows_multiply_no_shuffle_and_count_companies_once(spark):
    for name in ("a3_job_counts_sliding", "a4_skill_counts_sliding"):
        assert "hashpartitioning(_start" not in _plan(E.queries()[name](spark, SF_SMALL))
    at = [("a", 0), ("a", 3), ("a", 3), ("b", 3), (None, 4), ("a", 14), ("b", 50), ("b", 59), ("c", 60), ("a", None), ("a", None)]
    rows = [(str(i), c, m, "X", 1.0 + i) for i, (c, m) in enumerate(at)]
    df = spark.createDataFrame(rows, "job_id string, company_name string, m int, city string, salary_min double").select(
        "*", F.timestamp_seconds(F.col("m") * 60 + 1).alias("event_time"), F.lit(2.0).alias("salary_max"), F.array(F.lit("s")).alias("skills"))
    got = {r["time_bucket"]: (r["job_count"], r["distinct_company_count"], r["avg_salary_min"]) for r in realtime.skill_counts_sliding(df).collect()}
    want = {None: (20, 1, 10.5)}
    for w in range(-9, 61):
        inside = [(c, v) for _, c, m, _, v in rows if m is not None and w <= m < w + 10]
        if inside:
            key = f"{'1969-12-31T23' if w < 0 else f'1970-01-01T{w // 60:02d}'}:{w % 60:02d}:00Z"
            want[key] = (len(inside), len({c for c, _ in inside if c}), round(sum(v for _, v in inside) / len(inside), 4))
    assert got == want


def test_skill_counts_are_worked_out_once_and_ranked_by_one_join(spark):
    plan = _plan(E.queries()["a7_skill_counts_daily"](spark, SF_SMALL))
    assert "lineitem" not in plan and "skill_counts-" in plan and "hashpartitioning(date_key" not in plan


def test_profile_deals_rows_by_group_and_no_values(spark):
    found = E.queries()["a6_job_facts_daily"](spark, SF_SMALL)
    plan = _plan(found)
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(_dealt" in x]) == 1
    assert not [x for x in plan.splitlines() if "Exchange" in x and ", m#" in x]
    same = found.select(F.sum("job_count")).first()[0]
    assert same == E.queries()["k6_latest_snapshot"](spark, SF_SMALL).count()


def _odd_keys(spark, to: str) -> str:
    """Tables of sf0.001 of which some lines have no part, supplier or order,
    parts and orders come twice and a nation is gone."""
    os.makedirs(to)
    t = {n: spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in ("lineitem", "orders", "part", "supplier", "nation")}
    li = t["lineitem"].withColumn("l_partkey", F.when(F.col("l_quantity") % 7 == 1, 10**9).when(F.col("l_quantity") % 7 != 2, F.col("l_partkey"))) \
        .withColumn("l_linenumber", F.when(F.col("l_orderkey") % 5 > 0, F.col("l_linenumber")))
    li.write.parquet(f"{to}/lineitem.parquet")
    t["orders"].where("o_orderkey % 11 > 0").unionByName(t["orders"].where("o_orderkey % 11 = 1")).write.parquet(f"{to}/orders.parquet")
    t["part"].where("p_partkey % 13 > 0").unionByName(t["part"].where("p_partkey % 13 = 1")).write.parquet(f"{to}/part.parquet")
    t["supplier"].where("s_suppkey % 3 > 0").unionByName(t["supplier"].where("s_suppkey % 3 = 1")).write.parquet(f"{to}/supplier.parquet")
    t["nation"].where("n_nationkey <> 4").write.parquet(f"{to}/nation.parquet")
    return to


@pytest.mark.parametrize("name, operator", [("a6_job_facts_daily", gold.job_facts_daily), ("a7_skill_counts_daily", gold.skill_counts_daily)])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_latest_postings_are_stored_before_they_are_counted(spark, scratch, monkeypatch, name, operator, broadcast):
    path, plans = _odd_keys(spark, f"{scratch}/t"), {}

    def written(df, to):
        plans[to.split("/")[-1].split("-")[0]] = _plan(df)
        return steps.written(df, to)

    monkeypatch.setattr(jobs_view, "written", written)
    monkeypatch.setattr(gold, "written", written)
    want = operator(jobs_view.jobs_latest(spark, path))
    plans.clear()
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = E.queries()[name](spark, path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "lineitem" not in _plan(found) and "part.parquet" not in plans["lines"] and "lineitem" not in plans["rows"]
    assert want.count() > 100 and want.exceptAll(found).count() == found.exceptAll(want).count() == 0


def test_skills_multiply_no_shuffle(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(gold, "written", lambda df, to: (plans.append(_plan(df)), steps.written(df, to))[1])
    rows = [("t", "c", "3", "x", 1.0, 2.0, d, ["a", "b", "a", ""]) for d in (None, "2020-01-01", "2020-01-01")]
    df = spark.createDataFrame(rows, "source string, city string, category_level_3 string, company_name string, salary_min double, "
                                     "salary_max double, posting_date string, skills array<string>").withColumn("posting_date", F.to_date("posting_date"))
    found = sorted((r["date_key"] or "", r["skill"], r["job_count"], r["distinct_company_count"], r["skill_rank_in_day"])
                   for r in gold.skill_counts_daily(df).collect())
    assert found == [("", "a", 1, 1, 1), ("", "b", 1, 1, 1), ("2020-01-01", "a", 2, 1, 1), ("2020-01-01", "b", 2, 1, 1)]
    (plan,) = plans
    assert plan.count("Exchange ") == 1 and "skill#" not in plan[plan.index("Exchange "):].splitlines()[0]


def test_versions_are_dealt_without_skills(spark):
    plan = _plan(E.queries()["v8_layer_not_null_rules"](spark, SF_SMALL)).splitlines()
    assert min(i for i, x in enumerate(plan) if "split(" in x) < min(i for i, x in enumerate(plan) if "Exchange hashpartitioning(l_orderkey" in x)
    assert max(i for i, x in enumerate(plan) if "split(" in x) < min(i for i, x in enumerate(plan) if "Exchange hashpartitioning(l_orderkey" in x)


def test_streams_have_a_state_partition_a_core_and_retain_two_batches(spark, scratch):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        spark.createDataFrame([("1", '{"job_id": "1", "event_ts": "2024-01-01 00:00:00", "skills_text": "x"}')], "k string, v string").select(
            F.col("k").cast("binary").alias("key"), F.col("v").cast("binary").alias("value"), F.lit("t").alias("topic"),
            F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp")) \
            .write.parquet(f"{scratch}/src")
        for q in live_layer.start(read_message_files(spark, f"{scratch}/src"), f"{scratch}/out", f"{scratch}/ck", trigger={"availableNow": True}):
            q.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    for state in ("silver", "job_counts_10m", "skill_counts_30m"):
        assert len([x for x in os.listdir(f"{scratch}/ck/{state}/state/0") if x.isdigit()]) == 8
