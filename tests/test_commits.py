"""Pointer-switched versions: crashes, readers, folding, lookups."""

import datetime

import pytest
from pyspark.sql import functions as F

from hirelens.operators import keys
from hirelens.sinks import keyed
from hirelens.sinks.commits import CommitLog, Lake, children


def _keys(df):
    return sorted(tuple(r) for r in df.collect())


def test_staged_tables_show_together_and_a_crash_changes_nothing(spark, scratch):
    lake = Lake(spark, scratch)
    lake.stage("a", spark.createDataFrame([(1, "x"), (2, "y")], "n int, p string"), ["p"])
    lake.stage("b", spark.createDataFrame([(10,)], "n int"), [])
    lake.commit("one")
    reader = Lake(spark, scratch).read("a")
    crashed = Lake(spark, scratch)                       # writes its folders and dies before its commit
    crashed.stage("a", spark.createDataFrame([(9, "x")], "n int, p string"), ["p"], {"p=x"})
    assert _keys(crashed.read("a")) == [(2, "y"), (9, "x")]
    assert _keys(Lake(spark, scratch).read("a")) == [(1, "x"), (2, "y")]
    again = Lake(spark, scratch)
    again.stage("a", spark.createDataFrame([(3, "z")], "n int, p string"), ["p"], {"p=x", "p=z"})
    again.commit("two")
    with pytest.raises(RuntimeError):                    # the other one wakes up: its commit has been made
        crashed.commit("two")
    last = Lake(spark, scratch)
    assert _keys(last.read("a")) == [(2, "y"), (3, "z")] and _keys(last.read("b")) == [(10,)]
    assert _keys(last.read("a", {"p=z"})) == [(3, "z")] and last.done == {"one": 1, "two": 2}
    assert _keys(reader) == [(1, "x"), (2, "y")]         # a reader keeps the version that it began with
    last.clean(keep=1)
    assert _keys(last.read("a")) == [(2, "y"), (3, "z")]
    assert len([f for f in children(spark, f"{scratch}/a") if f.startswith("v=")]) == 2


def test_fold_is_incremental_and_readers_are_safe(spark, scratch):
    def write(n, rows, second):
        at = F.lit(f"2024-01-01 00:00:{second:02d}").cast("timestamp")
        keyed.write_delta(spark.createDataFrame(rows, "k string, v int"), scratch, n, "r", at)

    def view(**kw):
        return sorted((r["k"], r["v"]) for r in keyed.current_view(spark, scratch, ["k"], **kw).collect())

    write(0, [("a", 1), ("b", 1)], 1)
    write(1, [("a", 2)], 2)
    reader = keyed.current_view(spark, scratch, ["k"])
    assert keyed.fold(spark, scratch, ["k"]) == 1 and view() == [("a", 2), ("b", 1)]
    assert sorted((r["k"], r["v"]) for r in reader.collect()) == [("a", 2), ("b", 1)]
    write(2, [("b", 3), ("c", 1)], 3)
    assert view() == [("a", 2), ("b", 3), ("c", 1)]
    base = CommitLog(spark, scratch).latest()[1]
    assert base == {"base": "_base/v=1", "folded": {"r": 1}}
    assert keyed.fold(spark, scratch, ["k"]) == 2 and view() == [("a", 2), ("b", 3), ("c", 1)]
    # the first fold's deltas are gone, the second's stay for readers of the version before
    assert [f for f in children(spark, f"{scratch}/run=r") if f.startswith("batch")] == ["batch_id=2"]
    write(0, [("a", 99)], 1)                              # a retried old batch: folded already
    assert view() == [("a", 2), ("b", 3), ("c", 1)] and keyed.fold(spark, scratch, ["k"]) == 2
    write(3, [("d", 1)], 50)
    expired = {"ttl_seconds": 10, "as_of": F.lit("2024-01-01 00:00:55").cast("timestamp")}
    keyed.fold(spark, scratch, ["k"], **expired)
    assert view() == [("d", 1)]


def test_an_unfinished_delta_is_not_read(spark, scratch):
    keyed.write_delta(spark.createDataFrame([("a", 1)], "k string, v int"), scratch, 0, "r")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch}/run=r/batch_id=1/part-0.parquet")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()
    assert keyed.current_view(spark, scratch, ["k"]).count() == 1


def test_lookups_read_few_row_groups(spark, scratch):
    rows = spark.range(400_000).select(F.concat(F.lit("skill "), (F.col("id") % 2000)).alias("skill"), F.col("id").alias("job_id"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("filler"), F.lit("2024-01").alias("month_key"))
    lake = Lake(spark, scratch)
    lake.stage("jobs_by_skill", rows, ["month_key"], None, ["skill", "job_id"])
    lake.commit("one")
    found = Lake(spark, scratch).read("jobs_by_skill").where("skill = 'skill 77'")
    assert found.count() == 200
    found.write.format("noop").mode("overwrite").save()
    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    read = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    assert 200 <= read <= 400_000 / 5                     # of the rows in the table


def test_continued_versions_scan_their_batch_only(spark):
    rows = [("j", d, h) for d, h in [(1, "A"), (2, "A"), (3, "B"), (4, "B"), (5, "A"), (6, "C")]] + [("k", 9, "X")]
    df = spark.createDataFrame([(j, datetime.datetime(2024, 1, d), h) for j, d, h in rows],
                               "job_id string, ingest_ts timestamp, hash_content string")
    whole = {(r["job_id"], r["ingest_ts"]): r["record_version"] for r in keys.versioned(df).collect()}
    state, seen = keys.version_state(keys.versioned(df.where("day(ingest_ts) < 4"))), {}
    for low, high in ((4, 4), (5, 9)):
        batch = df.where(F.dayofmonth("ingest_ts").between(low, high))
        new, late = keys.continue_versions(batch, state)
        assert late.count() == 0
        seen |= {(r["job_id"], r["ingest_ts"]): r["record_version"] for r in new.collect()}
        state = state.join(new.select("job_id"), "job_id", "left_anti").unionByName(keys.version_state(new))
    assert all(whole[k] == v for k, v in seen.items()) and len(seen) == 4
    new, late = keys.continue_versions(df.where("job_id = 'j' AND day(ingest_ts) = 2"), state)
    assert new.count() == 0 and [r["job_id"] for r in late.collect()] == ["j"]


def test_late_and_repeated_rows_in_the_lake(spark, scratch):
    """A late row renumbers its job; a copy of a row of the last day is none."""
    from hirelens.plans import medallion_job

    from .test_medallion import _parsed, _posting
    lake = scratch + "/lake"

    def silver(postings, batch):
        medallion_job.run(spark, _parsed(spark, postings), lake, as_of="2026-05-01", batch_id=batch)
        rows = medallion_job.table(spark, lake, "silver").orderBy("source_url", "ingest_ts").collect()
        return [(r["source_url"][-1], str(r["ingest_ts"])[8:13], r["record_version"], r["is_latest"]) for r in rows]

    first = [_posting(1), _posting(2, day="2026-04-12", title="b"), _posting(2, day="2026-04-12", title="c", hour=10)]
    assert silver(first, "a") == [("1", "10 08", 1, True), ("2", "12 08", 1, False), ("2", "12 10", 2, True)]
    copy = _posting(2, day="2026-04-12", title="b", hour=12)
    late = _posting(1, day="2026-04-09", title="older")
    assert silver([copy], "b") == [("1", "10 08", 1, True), ("2", "12 08", 1, False), ("2", "12 10", 2, True)]
    assert silver([late], "c") == [("1", "09 08", 1, False), ("1", "10 08", 2, True), ("2", "12 08", 1, False), ("2", "12 10", 2, True)]
    assert silver([_posting(1, day="2026-04-08", title="oldest")], "c") == [
        ("1", "08 08", 1, False), ("1", "10 08", 2, True), ("2", "12 08", 1, False), ("2", "12 10", 2, True)]
    skills = medallion_job.table(spark, lake, "jobs_by_skill")
    assert skills.where("skill = 'Python'").count() == 2
    assert medallion_job.table(spark, lake, "jobs_silver_v1").count() == 2
