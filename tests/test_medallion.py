"""Bronze -> silver on sample postings and the contract's golden record."""

import json

from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.operators import gold, medallion, messages

# The contract's golden record, its URL and what its fields must become.
GOLDEN_URL = ("https://www.topcv.vn/viec-lam/tour-operator-dieu-hanh-tour-inbound-thu-nhap-tu-us-700-us-1500-thang/"
              "2111673.html?ta_source=JobSearchList&u_sr_id=xyz")
GOLDEN_LD = {
    "@type": "JobPosting", "title": "Tour Operator",
    "datePosted": "2026-04-07", "validThrough": "2026-05-07T23:59:59+07:00",
    "employmentType": "FULL_TIME", "totalJobOpenings": "1",
    "hiringOrganization": {"name": "Công ty TNHH Du Lịch Authentic Asia"},
    "baseSalary": {"currency": "USD", "value": {"minValue": "700", "maxValue": "1500", "unitText": "MONTH"}},
    "jobLocation": {"address": {"addressRegion": "Hà Nội", "addressLocality": "Phường Hoàng Mai",
                                "addressCountry": "VN"}},
}

POSTINGS = [
    ("https://viec.example/ky-su-du-lieu-881.html", {
        "domain": "www.viec.example", "fetch_method": "requests", "title": "Kỹ sư dữ liệu (Spark)",
        "company_name": "Sao Mai Data", "salary": "20 - 35 triệu", "location": "Hà Nội",
        "experience": "2 năm", "deadline": "Còn 30 ngày", "job_type": "Toàn thời gian",
        "requirements": "Thành thạo Spark và SQL", "benefits": "Thưởng tháng 13, bảo hiểm sức khỏe",
        "skills": ["Spark", "Airflow", "Kafka", "Docker", "Hà Nội"], "categories": ["Công nghệ / Dữ liệu"],
        "json_ld": [], "meta_tags": {}}),
    (GOLDEN_URL, {
        "domain": "www.topcv.vn", "fetch_method": "requests",
        "title": "Tour Operator/ Điều Hành Tour Inbound (Thu Nhập Từ $US 700 – $US 1500/Tháng)",
        "company_name": "HA TRAVEL", "salary": "Mức lương 700 - 1,500 USD", "location": "Hà Nội",
        "job_type": "Trả phí", "skills": [], "json_ld": [json.dumps(GOLDEN_LD, ensure_ascii=False)]}),
]


def _envelopes(spark):
    rows = [(json.dumps({"source": "topcv", "source_url": u, "crawl_version": 1,
                         "ingest_ts": "2026-04-10T08:00:00", "event_ts": "2026-04-10T08:00:00", "payload": p},
                        ensure_ascii=False),) for u, p in POSTINGS]
    raw = spark.createDataFrame(rows, "v string").select(
        F.lit("k").cast("binary").alias("key"), F.col("v").cast("binary").alias("value"),
        F.lit("jobs_raw").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"))
    env = messages.parse_envelope(raw).withColumn("crawl_version", F.lit(1))
    return env


def test_bronze_silver_golden(spark):
    b = medallion.bronze(_envelopes(spark))
    s = medallion.silver_latest(medallion.silver(b)).cache()
    g = s.filter(F.col("source_url") == GOLDEN_URL).first()
    assert g["job_id"] == "678bd9b075bde10570f67fefdef1f94c8ff169ee7732f95a533a5ca15e4b0d15"
    assert g["company_name"] == "Công ty TNHH Du Lịch Authentic Asia" and g["company_name_source"] == "json_ld"
    assert g["company_name_display"] == "HA TRAVEL"
    assert g["job_title"] == "Tour Operator/ Điều Hành Tour Inbound"
    assert (g["salary_min"], g["salary_max"], g["currency"], g["salary_period"]) == (700.0, 1500.0, "USD", "month")
    assert (g["employment_type"], g["employment_type_vi"]) == ("FULL_TIME", "Toàn thời gian")
    assert str(g["posting_date"]) == "2026-04-07"
    assert g["valid_through_ts"] is not None and g["valid_through_source"] == "structured"
    assert (g["city"], g["ward"], g["openings"], g["country_code"]) == ("Hà Nội", "Phường Hoàng Mai", 1, "VN")
    assert g["record_version"] == 1
    assert "HA TRAVEL" in g["company_aliases"]
    flags = b.filter(F.col("source_url") == GOLDEN_URL).first()["quality_issue_flags"]
    assert flags["has_json_ld"] and flags["has_structured_salary"] and flags["has_structured_company_name_conflict"]
    assert flags["has_noisy_job_type"]
    p = s.filter(F.col("source_url") != GOLDEN_URL).first()
    assert (p["salary_min"], p["salary_max"], p["currency"]) == (20.0, 35.0, "VND")
    assert p["skills"] == ["Spark", "Airflow", "Kafka", "Docker"]
    assert {"Spark", "Docker"} <= set(p["hard_skills"])
    assert p["soft_skills"] == [] and isinstance(p["quality_notes"], list) and "event_ts" in s.columns
    contract = {"crawl_domain", "level_raw", "quantity_raw", "description_items_raw_count", "requirement_items_raw_count",
                "benefit_items_raw_count", "skills_raw_count", "categories_raw_count", "json_ld_present",
                "meta_tags_present", "sections_by_heading_present", "page_text_present"}
    assert contract <= set(b.columns)
    assert {"salary_is_negotiable", "experience_months_max", "education_min", "education_display", "work_schedule_text",
            "other_language_preference", "level_conflict", "openings_conflict", "employment_type_conflict"} <= set(s.columns)
    assert p["experience_months_min"] == 24 and p["experience_bucket"] == "mid"
    assert p["valid_through_source"] == "relative_text" and "bonus_13th_month" in p["benefits_tags"]
    assert p["city_slug"] == "ha_noi"
    assert g["location_display"] == "Phường Hoàng Mai, Hà Nội" and g["salary_source"] == "json_ld"
    assert p["industry_primary"] == "Công nghệ / Dữ liệu" and p["salary_source"] == "salary_text"
    cov = medallion.silver_coverage(s).first()
    assert cov["job_count"] == 2 and cov["structured_company_coverage"] == 0.5
    assert cov["company_conflict_rate"] == 0.5 and cov["skill_parse_confidence"] == 4 / 5
    # gold builders accept silver directly
    assert gold.job_facts_daily(s.filter(F.col("posting_date").isNotNull())).count() == 1


def test_job_documents_and_flat_event(spark):
    tr = messages.consumer_transform(_envelopes(spark))
    docs = messages.job_documents(tr).collect()
    assert len(docs) == 2 and set(docs[0].asDict()) == set(schemas.JOB_DOCUMENT_FIELDS)
    flat = messages.to_flat_event(
        spark.createDataFrame([(POSTINGS[0][0], POSTINGS[0][1]["domain"], "Dev", None, ["A", "B"], "d", "r", "")],
                              "source_url string, domain string, title string, company_name string, "
                              "skills array<string>, description string, requirements string, benefits string")
        .withColumn("salary", F.lit(None).cast("string")).withColumn("location", F.lit(None).cast("string")),
        crawled_at=F.lit("2026-04-10T08:00:00"), ingest_ts=F.lit("2026-04-10T08:00:01")).first()
    assert flat["source"] == "viec.example" and flat["skills_text"] == "A, B" and flat["company_name"] == ""
    assert flat["description_text"] == "d\n\nYêu cầu công việc:\nr"


def test_versions_prefix_scan_equals_plain_window(spark):
    from hirelens.plans import jobs_view
    from .conftest import SF_SMALL
    cols = ["job_id", "ingest_ts", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
            "record_version", "is_latest"]
    a = jobs_view.jobs_versioned(spark, SF_SMALL).select(*cols)
    b = jobs_view.jobs_versioned(spark, SF_SMALL, split_by_day=True).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_versions_hot_key_across_days(spark):
    from hirelens.operators import keys
    rows = [("j", f"2024-01-0{d} 0{h}:00:00", hsh) for d, h, hsh in
            [(1, 1, "A"), (1, 2, "A"), (1, 3, "B"), (2, 1, "B"), (2, 2, "A"), (3, 1, "A"), (3, 2, "C"), (5, 1, "C")]]
    df = spark.createDataFrame(rows, "job_id string, ts string, hash_content string") \
        .withColumn("ingest_ts", F.to_timestamp("ts"))
    got = keys.versioned(df, bucket=F.to_date("ingest_ts")).orderBy("ingest_ts").collect()
    assert [r["record_version"] for r in got] == [1, 1, 2, 2, 3, 3, 4, 4]
    assert [r["is_latest"] for r in got] == [False] * 7 + [True]


def test_layer_write_read_and_projections(spark, scratch):
    import os
    from hirelens.sinks import documents
    from hirelens.sources.messages import read_layer
    b = medallion.bronze(_envelopes(spark))
    s = medallion.silver_latest(medallion.silver(b)).filter(F.col("posting_date").isNotNull()
                                                           | F.col("posting_date").isNull())
    path = os.path.join(scratch, "silver")
    medallion.write_layer(s.withColumn("posting_date", F.coalesce("posting_date", F.to_date("ingest_ts"))),
                          path, ["posting_date", "city_slug"])
    parts = sorted(d for d in os.listdir(path) if d.startswith("posting_date="))
    assert parts == ["posting_date=2026-04-07", "posting_date=2026-04-10"]
    one = read_layer(spark, path, posting_date="2026-04-07", city_slug="ha_noi")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(posting_date" in plan and "city_slug" in plan
    # dynamic partition overwrite replaces only the partitions present in the new data
    medallion.write_layer(one, path, ["posting_date", "city_slug"])
    assert read_layer(spark, path).count() == 2
    qt = medallion.query_tables(read_layer(spark, path).withColumn("has_benefits", F.lit(False)))
    assert set(qt) == {"jobs_by_day", "jobs_by_skill", "salary_by_skill_month", "company_by_month"}
    assert qt["jobs_by_skill"].count() == 4
    proj = documents.search_projection(read_layer(spark, path), "jobs_silver_v1")
    assert proj.columns == documents.SEARCH_FIELDS["jobs_silver_v1"]


def _lake(spark, paths):
    from hirelens.plans import medallion_job
    return {n: medallion_job.table(spark, p.removesuffix(f"/{n}"), n) for n, p in paths.items()}


def _posting(i, day="2026-04-10", title="Job", posted="2026-04-01", city="Hà Nội", hour=8):
    ld = json.dumps({"@type": "JobPosting", "datePosted": posted})
    return {"source": "boards", "source_url": f"https://jobs.example/{i}", "crawl_version": 1,
            "ingest_ts": f"{day}T{hour:02d}:00:00", "event_ts": f"{day}T{hour:02d}:00:00",
            "payload": {"domain": "jobs.example", "title": title, "company_name": "ACME", "location": city,
                        "skills": ["Python", "Kafka"], "json_ld": [ld]}}


def _parsed(spark, postings):
    raw = spark.createDataFrame([(json.dumps(p, ensure_ascii=False),) for p in postings], "v string").select(
        F.lit("k").cast("binary").alias("key"), F.col("v").cast("binary").alias("value"),
        F.lit("jobs_raw").alias("topic"), F.current_timestamp().alias("timestamp"))
    return messages.parse_envelope(raw).withColumn("crawl_version", F.lit(1))


def test_medallion_job_takes_batch_after_batch(spark, scratch):
    from hirelens.plans import medallion_job
    lake = scratch + "/lake"

    def run(postings, batch):
        return _lake(spark, medallion_job.run(spark, _parsed(spark, postings), lake, as_of="2026-05-01", batch_id=batch))

    def counts(t):
        return t["raw"].count(), t["bronze"].count(), t["silver"].count()

    facts = lambda t: {r["date_key"]: r["n"] for r in t["gold_job_facts_daily"]
                       .groupBy("date_key").agg(F.sum("job_count").alias("n")).collect()}
    t = run([_posting(1), _posting(2)], "a")
    assert counts(t) == (2, 2, 2) and {str(k): v for k, v in facts(t).items()} == {"2026-04-01": 2}
    t = run([_posting(3)], "b")                                   # a second batch on the same day
    assert counts(t) == (3, 3, 3) and list(facts(t).values()) == [3]
    before = sorted(map(str, t["silver"].collect()))
    t = run([_posting(3)], "b")                                   # the batch again
    assert counts(t) == (3, 3, 3) and sorted(map(str, t["silver"].collect())) == before
    # a later version moves a posting to another day (and city): no partition counts it twice
    t = run([_posting(2, day="2026-04-12", title="Job new", posted="2026-04-05", city="Huế")], "c")
    assert counts(t) == (4, 4, 4) and {str(k): v for k, v in facts(t).items()} == {"2026-04-01": 2, "2026-04-05": 1}
    versions = t["silver"].where("source_url like '%/2'").orderBy("record_version").collect()
    assert [(r["record_version"], r["is_latest"]) for r in versions] == [(1, False), (2, True)]
    # and the two that are left move as well: the old day has no row and no folder any more
    t = run([_posting(1, day="2026-04-13", posted="2026-04-05"), _posting(3, day="2026-04-13", posted="2026-04-05")], "d")
    assert {str(k): v for k, v in facts(t).items()} == {"2026-04-05": 3}
    assert t["gold_company_hiring_by_month"].agg(F.sum("job_count")).first()[0] == 3
    # the same postings in one batch give the same lake
    one = medallion_job.run(spark, _parsed(spark, [
        _posting(1), _posting(2), _posting(3),
        _posting(2, day="2026-04-12", title="Job new", posted="2026-04-05", city="Huế"),
        _posting(1, day="2026-04-13", posted="2026-04-05"), _posting(3, day="2026-04-13", posted="2026-04-05")]),
        scratch + "/one", as_of="2026-05-01")
    for name, path in one.items():
        if name not in ("raw", "bronze", "versions"):
            a, b = t[name], _lake(spark, {name: path})[name].select(t[name].columns)
            assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name


def test_medallion_job_writes_every_layer(spark, scratch):
    from hirelens.plans import medallion_job
    paths = medallion_job.run(spark, _envelopes(spark), scratch + "/lake", as_of="2026-05-01")
    tables = _lake(spark, paths)
    for name, rows in tables.items():
        assert rows.count() > 0, name
    g = tables["gold_job_facts_daily"]
    assert g.filter("date_key = '2026-04-07'").first()["job_count"] == 1
