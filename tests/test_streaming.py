"""Stream = batch, restart, late data and dedup tests on a file source."""

import os

from pyspark.sql import functions as F

from hirelens.operators import messages, realtime
from hirelens.plans import adapters
from hirelens.sinks import keyed
from hirelens.sources.messages import read_message_files
from hirelens.sources.tables import read_table
from hirelens.streaming import aggregator, live_layer
from hirelens.streaming.runs import state_settings

from .conftest import SF_SMALL


def _write_message_files(spark, msgs, path, n_files=4):
    """Split messages into n files in event-time order (one micro-batch each
    with maxFilesPerTrigger=1)."""
    w = msgs.withColumn("_b", F.ntile(n_files).over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("timestamp", "offset")))
    for b in range(1, n_files + 1):
        w.filter(F.col("_b") == b).drop("_b").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(path, f"part{b:03d}"))
    return [os.path.join(path, f"part{b:03d}") for b in range(1, n_files + 1)]


def _stage_files(spark, msgs, root, n_files=4):
    src = os.path.join(root, "src")
    dirs = _write_message_files(spark, msgs, os.path.join(root, "stage"), n_files)
    os.makedirs(src, exist_ok=True)
    for i, d in enumerate(dirs):
        for f in os.listdir(d):
            if f.endswith(".parquet"):
                dst = os.path.join(src, f"{i:03d}-{f}")
                os.link(os.path.join(d, f), dst)
                os.utime(dst, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    return src


def test_stream_c_equals_batch(spark, scratch):
    msgs = adapters.clean_messages(spark, SF_SMALL)
    src = _stage_files(spark, msgs, scratch)
    stream = read_message_files(spark, src, max_files_per_trigger=1)
    qs = aggregator.start(stream, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"),
                          trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination()
    batch = realtime.job_counts_sliding(messages.parse_clean(msgs))
    cur = keyed.current_view(spark, os.path.join(scratch, "out", "realtime_job_counts_10m"),
                             aggregator.KEYS["realtime_job_counts_10m"])
    cols = ["time_bucket", "window_end", "city", "employment_type", "job_count", "distinct_company_count"]
    assert sorted(cur.select(*cols).collect()) == sorted(batch.select(*cols).collect())
    bs = realtime.skill_counts_sliding(messages.parse_clean(msgs))
    cs = keyed.current_view(spark, os.path.join(scratch, "out", "realtime_skill_counts"),
                            aggregator.KEYS["realtime_skill_counts"])
    cols = ["time_bucket", "skill", "city", "job_count", "distinct_company_count", "avg_salary_min",
            "avg_salary_max"]
    assert sorted(cs.select(*cols).collect()) == sorted(bs.select(*cols).collect())


def test_stream_a_restart_no_double_count(spark, scratch):
    ev = read_table(spark, SF_SMALL, "events")
    msgs = adapters.events_as_raw_messages(ev.withColumn("props", F.concat(F.lit('{"k": '), F.col("event_id"), F.lit("}"))))
    src = _stage_files(spark, msgs, scratch, n_files=4)
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    # first run: only the first two files
    stream = read_message_files(spark, src, max_files_per_trigger=1)
    files = sorted(os.listdir(src))
    hidden = os.path.join(scratch, "hidden")
    os.makedirs(hidden)
    for f in files[2:]:
        os.rename(os.path.join(src, f), os.path.join(hidden, f))
    for q in live_layer.start(stream, out, ck, trigger={"availableNow": True}):
        q.awaitTermination()
    for f in files[2:]:
        os.rename(os.path.join(hidden, f), os.path.join(src, f))
    # restart from the same checkpoint: the remaining files only
    stream = read_message_files(spark, src, max_files_per_trigger=1)
    for q in live_layer.start(stream, out, ck, trigger={"availableNow": True}):
        q.awaitTermination()
    cur = keyed.current_view(spark, os.path.join(out, "job_counts_10m"), ["view", "window_start", "window_end", "field"])
    norm = messages.normalize_events(messages.clean_events(messages.parse_messages(msgs, ingest_time=F.col("kafka_ts"))))
    batch = realtime.job_counts_10m(norm)
    got = {(r["window_start"], r["field"]): r["value"] for r in cur.collect()}
    exp = {(r["window_start"], r["location_city"]): r["job_count"] for r in batch.collect()}
    assert got == exp


def test_dedup_within_watermark_and_late_drop(spark, scratch):
    rows = [  # (job_id, event time)
        ("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:05:00"),   # duplicate inside the horizon
        ("b", "2024-01-01 00:01:00"),
        ("c", "2024-01-01 03:00:00"),                                  # advances the watermark
        ("a", "2024-01-01 03:30:00"),                                  # same key, after state expired
        ("d", "2024-01-01 00:02:00"),                                  # older than the watermark: late
    ]
    df = spark.createDataFrame(rows, "job_id string, ts string").select(
        "job_id", F.to_timestamp("ts").alias("event_ts"), F.lit("x").alias("source_url"))
    src = os.path.join(scratch, "src")
    stage = os.path.join(scratch, "stage")
    os.makedirs(src)
    for i, chunk in enumerate([rows[:3], rows[3:4], rows[5:6], rows[4:5]]):
        spark.createDataFrame(chunk, "job_id string, ts string").select(
            "job_id", F.to_timestamp("ts").alias("event_ts"), F.lit("x").alias("source_url")) \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(stage, f"b{i}"))
        for f in os.listdir(os.path.join(stage, f"b{i}")):
            if f.endswith(".parquet"):
                dst = os.path.join(src, f"{i}-{f}")
                os.rename(os.path.join(stage, f"b{i}", f), dst)
                os.utime(dst, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = realtime.dedup_jobs(stream, watermark="30 minutes").writeStream.format("memory") \
        .queryName("dedup_test").option("checkpointLocation", os.path.join(scratch, "ck")) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r["job_id"], str(r["event_ts"])) for r in spark.table("dedup_test").collect())
    # the in-horizon duplicate of 'a' is dropped; after its state expired a
    # new 'a' is kept. The dedup operator does not filter late rows ('d').
    assert got == [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 03:30:00"), ("b", "2024-01-01 00:01:00"),
                   ("c", "2024-01-01 03:00:00"), ("d", "2024-01-01 00:02:00")]
    # (Spark guarantees to keep rows within the watermark delay; dropping
    # later rows is allowed but not promised, so it is not asserted here.)
    # batch dedup: earliest per key over the whole input
    b = sorted(r["job_id"] for r in realtime.dedup_jobs(df).collect())
    assert b == ["a", "b", "c", "d"]


def test_malformed_messages_go_to_dead_letter(spark):
    from hirelens import schemas
    bad = [(None,), ("{oops",), ('{"source": "topcv"}',),
           ('{"source": "topcv", "source_url": "https://www.topcv.vn/x.html", "event_ts": "bad", '
            '"payload": {"title": "", "salary": "123456789012 triệu"}}',),
           ('{"source": "topcv", "source_url": "https://www.topcv.vn/y.html", "event_ts": "2026-04-07T10:00:00", '
            '"payload": {"title": "Dev", "salary": "20 - 35 triệu", "location": "hn", "skills": ["Python", "python", "HCM"]}}',)]
    raw = spark.createDataFrame([(f"k{i}", v[0]) for i, v in enumerate(bad)], "k string, v string").select(
        F.col("k").cast("binary").alias("key"), F.col("v").cast("binary").alias("value"),
        F.lit("jobs_raw").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"))
    tr = messages.consumer_transform(messages.parse_envelope(raw)).cache()
    docs = messages.job_documents(tr).collect()
    dl = messages.dead_letters(tr).collect()
    assert len(docs) == 1 and len(dl) == 4
    d = docs[0]
    assert (d["city"], d["salary_min"], d["salary_max"], d["currency"], d["skills"], d["event_date"]) == \
        ("Hà Nội", 20.0, 35.0, "VND", ["Python"], "2026-04-07")
    assert sorted(r["error_type"] for r in dl) == ["PARSE_ERROR", "PARSE_ERROR", "VALIDATION_ERROR", "VALIDATION_ERROR"]
    assert set(docs[0].asDict()) == set(schemas.JOB_DOCUMENT_FIELDS)
    # flat-event parser: bad event_ts falls back to the message time instead of failing
    flat = spark.createDataFrame([('{"job_id": "j", "event_ts": "bad"}',)], "v string").select(
        F.lit(None).cast("binary").alias("key"), F.col("v").cast("binary").alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"))
    c = messages.clean_events(messages.parse_messages(flat)).collect()
    assert len(c) == 1 and c[0]["event_ts"] is not None


def test_delimited_short_line(spark):
    df = spark.createDataFrame([("job_1|Data Engineer|Ha Noi",), ("job_2|Analyst",)], "value string")
    r = messages.parse_delimited(df).orderBy("job_id").collect()
    assert (r[0]["city"], r[1]["city"], r[1]["job_title"]) == ("Ha Noi", None, "Analyst")


def test_consumer_four_outputs_and_metrics(spark, scratch):
    import json as _json
    from hirelens.sources.messages import read_json_records
    from hirelens.streaming import consumer
    env = [{"source": "topcv", "source_url": f"https://www.topcv.vn/viec-lam/job-{i}.html?utm_source=x",
            "ingest_ts": "2026-04-10T08:00:00", "event_ts": "2026-04-10T08:00:00",
            "payload": {"title": f"Job {i}" if i != 2 else "", "company_name": "ACME", "salary": "20 - 35 triệu",
                        "location": "hcm", "skills": ["Python", "python", "Xem thêm", "SQL"]}} for i in range(4)]
    values = [_json.dumps(e, ensure_ascii=False) for e in env] + ["{oops"]
    msgs = spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(values)], "k string, v string").select(
        F.col("k").cast("binary").alias("key"), F.col("v").cast("binary").alias("value"),
        F.lit("jobs_raw").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
        F.to_timestamp(F.lit("2026-04-10 08:00:00")).alias("timestamp"))
    src = os.path.join(scratch, "src")
    msgs.coalesce(1).write.parquet(src)
    out = os.path.join(scratch, "out")
    q = consumer.start(read_message_files(spark, src), out, os.path.join(scratch, "ck"),
                       trigger={"availableNow": True})
    q.awaitTermination()
    metrics = [p["observedMetrics"].get("consumer_metrics") for p in q.recentProgress if p["numInputRows"]]
    assert metrics and metrics[0]["batch_count"] == 5 and metrics[0]["ok_count"] == 3
    assert metrics[0]["dead_letter_count"] == 2
    lines = spark.read.text(os.path.join(out, "documents", "*", "*")).collect()
    assert len(lines) == 6 and '"_index":"jobs_realtime_v1"' in lines[0]["value"]
    jobs = keyed.current_view(spark, os.path.join(out, "jobs_streaming"), ["job_id"]).collect()
    assert len(jobs) == 3 and all(r["city"] == "Hồ Chí Minh" and r["skills"] == ["Python", "SQL"] for r in jobs)
    assert spark.read.parquet(os.path.join(out, "jobs_clean")).count() == 3
    dl = spark.read.parquet(os.path.join(out, "dead_letter")).collect()
    assert sorted(r["error_type"] for r in dl) == ["PARSE_ERROR", "VALIDATION_ERROR"]
    # SR3: the same records as a JSON array and as NDJSON (bare payload or wrapped)
    arr = os.path.join(scratch, "arr.json")
    with open(arr, "w", encoding="utf-8") as f:
        _json.dump([{"source_url": env[0]["source_url"], "payload": env[0]["payload"]},
                    {"source_url": "https://x.vn/a", "title": "Bare"}], f, ensure_ascii=False)
    recs = read_json_records(spark, arr, multiline=True).collect()
    assert [r["payload"]["title"] for r in recs] == ["Job 0", "Bare"]


def test_console_memory_debug_sink(spark, scratch):
    msgs = adapters.raw_messages(spark, SF_SMALL)
    src = _stage_files(spark, msgs, scratch, n_files=2)
    q = live_layer.start_console(read_message_files(spark, src), os.path.join(scratch, "ck"), fmt="memory",
                                  name="speed_main_test")
    q.processAllAvailable()
    q.stop()
    assert spark.table("speed_main_test").count() > 0


def test_keyed_table_last_write_wins_and_ttl(spark, scratch):
    root = os.path.join(scratch, "keyed")
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    keyed.write_delta(rows, root, 0, "r1", updated_at=F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    keyed.write_delta(rows.filter("k = 'a'").withColumn("v", F.lit(2)), root, 1, "r1",
                      updated_at=F.to_timestamp(F.lit("2024-01-01 01:00:00")))
    # a retried batch rewrites its own folder: still one row per key
    keyed.write_delta(rows.filter("k = 'a'").withColumn("v", F.lit(2)), root, 1, "r1",
                      updated_at=F.to_timestamp(F.lit("2024-01-01 01:00:00")))
    cur = {r["k"]: r["v"] for r in keyed.current_view(spark, root, ["k"]).collect()}
    assert cur == {"a": 2, "b": 1}
    live = keyed.current_view(spark, root, ["k"], ttl_seconds=1800,
                              as_of=F.to_timestamp(F.lit("2024-01-01 01:10:00"))).collect()
    assert [r["k"] for r in live] == ["a"]


def test_batch_and_stream_share_schemas(spark, scratch):
    import re as _re
    import __spark_entry__ as E
    msgs = adapters.clean_messages(spark, SF_SMALL)
    src = _stage_files(spark, msgs, scratch, n_files=1)
    stream = messages.parse_clean(read_message_files(spark, src))
    batch = messages.parse_clean(msgs)
    def names_types(df):  # nullability is inferred differently through aggregates
        return [(f.name, f.dataType) for f in df.schema.fields]

    for build in (realtime.job_counts_sliding, realtime.skill_counts_sliding):
        assert build(stream).schema == build(batch).schema
    raw = adapters.raw_messages(spark, SF_SMALL)
    s_main = live_layer.main_stream(read_message_files(spark, _stage_files(spark, raw, scratch + "/a", 1)))
    b_main = live_layer.main_stream(raw)
    for build in (realtime.job_counts_10m, realtime.skill_counts_30m):
        assert names_types(build(s_main)) == names_types(build(b_main))
    # naming rule: every registered output column is snake_case
    for name, fn in E.queries().items():
        for col in fn(spark, SF_SMALL).columns:
            assert _re.fullmatch(r"[a-z][a-z0-9_]*", col), (name, col)


def test_stream_approx_distinct_option(spark, scratch):
    msgs = adapters.clean_messages(spark, SF_SMALL)
    src = _stage_files(spark, msgs, scratch, n_files=1)
    agg = realtime.job_counts_sliding(messages.parse_clean(read_message_files(spark, src)), approx_distinct=True)
    q = agg.writeStream.outputMode("update").format("memory").queryName("approx_test") \
        .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r["time_bucket"], r["city"], r["employment_type"]): r["distinct_company_count"]
           for r in spark.table("approx_test").collect()}
    exact = {(r["time_bucket"], r["city"], r["employment_type"]): r["distinct_company_count"]
             for r in realtime.job_counts_sliding(messages.parse_clean(msgs)).collect()}
    assert got.keys() == exact.keys()
    assert all(abs(got[k] - exact[k]) <= max(1, 0.1 * exact[k]) for k in exact)


def test_lost_checkpoint_overwrites_nothing(spark, scratch):
    """Batches of a run without the old checkpoint start at 0 again, beside the old ones."""
    root = os.path.join(scratch, "keyed")
    row = lambda k, v: spark.createDataFrame([(k, v)], "k string, v int")
    keyed.write_delta(row("a", 1), root, 0, "r1", updated_at=F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    keyed.write_delta(row("b", 1), root, 0, "r2", updated_at=F.to_timestamp(F.lit("2024-01-01 01:00:00")))
    keyed.write_delta(row("a", 5), root, 1, "r2", updated_at=F.to_timestamp(F.lit("2024-01-01 02:00:00")))
    view = lambda r: {x["k"]: x["v"] for x in keyed.current_view(spark, r, ["k"]).collect()}
    assert view(root) == {"a": 5, "b": 1}
    out = os.path.join(scratch, "small")
    keyed.compact(spark, root, ["k"], out, ttl_seconds=3600, as_of=F.to_timestamp(F.lit("2024-01-01 02:30:00")))
    assert view(out) == {"a": 5}                       # the expired row is gone for good
    keyed.write_delta(row("a", 6), out, 0, "r3", updated_at=F.to_timestamp(F.lit("2024-01-01 03:00:00")))
    keyed.write_delta(row("c", 7), out, 1, "r3", updated_at=F.to_timestamp(F.lit("2024-01-01 03:00:00")))
    assert view(out) == {"a": 6, "c": 7}
    none = keyed.current_view(spark, os.path.join(scratch, "none"), ["k"], schema=row("a", 1).schema)
    assert none.count() == 0 and none.columns[:2] == ["k", "v"]


def _messages(spark, rows, path):
    df = spark.createDataFrame(rows, "k string, v string, t string").select(
        F.col("k").cast("binary").alias("key"), F.col("v").cast("binary").alias("value"), F.lit("topic").alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"), F.to_timestamp("t").alias("timestamp"))
    df.coalesce(1).write.mode("append").parquet(path)


def test_consumer_restarts_and_feeds_the_aggregator(spark, scratch):
    """Stream B stopped and started with its checkpoint, then without it; its
    clean events keep the time of day, and stream C's windows follow it."""
    import json as _json
    from hirelens.streaming import consumer
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    job = lambda i, ts: ("k%d" % i, _json.dumps({
        "source": "s", "source_url": f"https://x.example/{i}", "event_ts": ts,
        "payload": {"title": f"Job {i}", "company_name": "ACME", "location": "hcm", "skills": ["Python"]}}),
        "2026-04-10 08:00:00")

    def run(ck):
        q = consumer.start(read_message_files(spark, src), out, os.path.join(scratch, ck), trigger={"availableNow": True})
        q.awaitTermination()

    _messages(spark, [job(1, "2026-04-10T10:37:21")], src)
    run("ck")
    _messages(spark, [job(2, "2026-04-10T10:39:00"), ("k", "{oops", "2026-04-10 08:00:00")], src)
    run("ck")                                                     # kept: only the new file
    clean = spark.read.parquet(os.path.join(out, "jobs_clean"))
    assert clean.count() == 2 and clean.select("run").distinct().count() == 1
    run("ck2")                                                    # lost: all again, beside the rest
    clean = spark.read.parquet(os.path.join(out, "jobs_clean"))
    assert clean.count() == 4 and clean.select("run").distinct().count() == 2
    view = keyed.current_view(spark, os.path.join(out, "jobs_streaming"), ["job_id"])
    assert sorted(r["job_title"] for r in view.collect()) == ["Job 1", "Job 2"]
    assert spark.read.parquet(os.path.join(out, "dead_letter")).count() == 2
    times = sorted(_json.loads(r["value"])["event_ts"] for r in clean.collect())
    assert times == ["2026-04-10T10:37:21"] * 2 + ["2026-04-10T10:39:00"] * 2
    # B -> C
    src2 = os.path.join(scratch, "clean")
    _messages(spark, [(r["key"], r["value"], "2026-04-10 08:00:00") for r in clean.collect()]
              + [("x", "{bad", "2026-04-10 08:00:00"), ("x", '{"city": "A"}', "2026-04-10 08:00:00")], src2)
    for q in aggregator.start(read_message_files(spark, src2), os.path.join(scratch, "agg"), os.path.join(scratch, "ck3"),
                              trigger={"availableNow": True}):
        q.awaitTermination()
    rows = keyed.current_view(spark, os.path.join(scratch, "agg", "realtime_job_counts_10m"),
                              ["time_bucket", "city", "employment_type"]).collect()
    assert rows and {str(r["time_bucket"])[:13].replace("T", " ") for r in rows} == {"2026-04-10 10"}
    dead = spark.read.parquet(os.path.join(scratch, "agg", "dead_letter")).collect()
    assert sorted(r["error_message"] for r in dead) == ["PARSE_ERROR", "job_id missing"]


def test_live_layer_dead_letters(spark, scratch):
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    _messages(spark, [("a", '{"job_id": "1", "event_ts": "2024-01-01 00:00:00", "skills_text": "x"}', "2024-01-01 00:00:00"),
                      ("b", "{oops", "2024-01-01 00:00:00"), ("c", None, "2024-01-01 00:00:00"),
                      ("d", '{"title": "no id"}', "2024-01-01 00:00:00")], src)
    for q in live_layer.start(read_message_files(spark, src), out, os.path.join(scratch, "ck"),
                              trigger={"availableNow": True}):
        q.awaitTermination()
    dead = spark.read.parquet(os.path.join(out, "dead_letter")).collect()
    assert sorted((r["error_type"], r["error_message"]) for r in dead) == [
        ("PARSE_ERROR", "PARSE_ERROR"), ("PARSE_ERROR", "PARSE_ERROR"), ("VALIDATION_ERROR", "job_id missing")]
    assert spark.read.parquet(os.path.join(out, "silver")).count() == 1


def test_closed_windows_keep_companies_once_and_count_them_exactly(spark, scratch):
    """No state has a row for each company and window. Rows come out of order,
    companies again in the next slices, some across a restart; some fields are null."""
    at = lambda i: i * 7 % 20 + 15 * (i // 60)  # noqa: E731  minutes; each third of the rows comes after some later ones
    rows = [(str(i), None if i % 50 == 7 else f"c{i % 97}", None if i % 40 == 3 else "city",
             None if i % 6 == 0 else float(i), f"2024-01-01 {at(i) // 60:02d}:{at(i) % 60:02d}:{i % 60:02d}.250") for i in range(600)]
    df = spark.createDataFrame(rows, "job_id string, company_name string, city string, salary_min double, t string").select(
        "job_id", "company_name", "city", "salary_min", (F.col("salary_min") * 2).alias("salary_max"),
        F.array(F.lit("sql"), F.lit("")).alias("skills"), F.to_timestamp("t").alias("event_time"))
    out, ck, src = (os.path.join(scratch, d) for d in ("out", "ck", "src"))
    updated = 0
    for part in range(3):
        df.where(F.floor(F.col("job_id").cast("int") / 240) == part).coalesce(1).write.mode("append").parquet(src)
        with state_settings(spark):
            q = realtime.skill_counts_sliding(spark.readStream.schema(df.schema).parquet(src), output_mode="append") \
                .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()
        updated += sum(s["numRowsUpdated"] for p in q.recentProgress for s in p["stateOperators"])
    batch = realtime.skill_counts_sliding(df)
    closed = df.select(F.max("event_time") - F.expr("interval 10 minutes")).first()[0].strftime("%Y-%m-%d %H:%M:%S")
    key = lambda r: tuple(str(x) for x in r)
    want = sorted(batch.where(F.col("window_end") <= closed).collect(), key=key)
    assert sorted(spark.read.parquet(out).select(*batch.columns).collect(), key=key) == want and len(want) > 100
    assert updated < 4 * len(rows)
