"""Golden values for the column rules (URL cases, text rules, golden record)."""

from pyspark.sql import functions as F

from hirelens.functions import enums, html, salary, text, urls


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(col(F.col("v")).alias("o")).first()["o"]


# The given URL cases and what they become.
URL_CASES = [
    ("https://www.topcv.vn/job/123.html?ta_source=x&u_sr_id=y&utm_source=google", "https://www.topcv.vn/job/123.html"),
    ("https://www.topcv.vn/job/123.html#details", "https://www.topcv.vn/job/123.html"),
    ("HTTPS://WWW.TOPCV.VN/Job/123.html", "https://www.topcv.vn/Job/123.html"),
    ("  https://www.topcv.vn/job/123.html  ", "https://www.topcv.vn/job/123.html"),
    ("https://x.vn/a?b=1&a=2&b=3&c=&d&REF=z", "https://x.vn/a?b=1&b=3&a=2"),
    ("https://x.vn/a?q=a b~*&fbclid=1", "https://x.vn/a?q=a+b~%2A"),
]


def test_normalize_url(spark):
    rows = spark.createDataFrame(URL_CASES, "u string, e string") \
        .select(urls.normalize_url("u").alias("o"), "e").collect()
    for r in rows:
        assert r["o"] == r["e"]


def test_ensure_scheme(spark):
    assert one(spark, urls.ensure_scheme, "www.topcv.vn/x") == "https://www.topcv.vn/x"
    assert one(spark, urls.ensure_scheme, "http://a.b") == "http://a.b"
    assert one(spark, urls.ensure_scheme, "   ") is None


def test_golden_job_id(spark):
    url = ("https://www.topcv.vn/viec-lam/tour-operator-dieu-hanh-tour-inbound-thu-nhap-tu-us-700-us-1500-thang/"
           "2111673.html?ta_source=JobSearchList&u_sr_id=abc")
    jid = spark.createDataFrame([(url,)], "u string").select(urls.job_id(F.lit(" TopCV "), "u")).first()[0]
    assert jid == "678bd9b075bde10570f67fefdef1f94c8ff169ee7732f95a533a5ca15e4b0d15"


def test_salary_rules(spark):
    cases = [("Thỏa thuận", (None, None, "VND")), ("20 - 35 triệu", (20.0, 35.0, "VND")),
             ("1000 USD", (1000.0, None, "USD")), ("Mức lương 700 - 1,500 USD", (700.0, 1500.0, "USD")),
             ("", (None, None, "VND")), (None, (None, None, "VND")), ("$1,500,000", (1500000.0, None, "USD")),
             ("123456789012 triệu", (123456789012.0, None, "VND")), ("35 - 20 triệu", (20.0, 35.0, "VND"))]
    df = spark.createDataFrame(cases, "t string, e struct<a:double,b:double,c:string>")
    for r in df.select(salary.parse_salary("t").alias("o"), "e").collect():
        assert tuple(r["o"]) == tuple(r["e"]), r


def test_salary_vnd_overflow_is_null(spark):
    r = spark.createDataFrame([("99999999999999 - 1 triệu",), ("20 - 35 usd",)], "t string") \
        .select(salary.salary_vnd("t").alias("o")).collect()
    assert r[0]["o"]["salary_min"] is None
    assert tuple(r[1]["o"]) == (500000, 875000)


def test_city_rules(spark):
    cases = [("hn", "Hà Nội"), ("Quận 1, TP HCM", "Hồ Chí Minh"), ("Huế", "Huế"), (None, ""),
             ("  Đà Nẵng ", "Đà Nẵng"), ("Làm việc Remote", "Remote")]
    df = spark.createDataFrame(cases, "t string, e string")
    for r in df.select(text.normalize_city("t").alias("o"), "e").collect():
        assert r["o"] == r["e"]
    assert one(spark, lambda c: text.normalize_city(c, "exact"), "ha noi") == "Hà Nội"
    assert one(spark, lambda c: text.normalize_city(c, "exact"), "vung tau") == "Vung Tau"
    assert one(spark, text.city_slug, "Hà Nội") == "ha_noi"


def test_skills(spark):
    arr = spark.createDataFrame([(["Python", " python ", "Xem thêm", "R", "Docker"],)], "a array<string>")
    assert arr.select(text.filter_skills("a")).first()[0] == ["Python", "Docker"]
    assert len(one(spark, text.split_skills, "Python , Spark,,Kafka")) == 3
    assert one(spark, text.split_skills, None) == []


def test_experience(spark):
    assert one(spark, enums.experience_months, "2 năm")["experience_months_min"] == 24
    r = one(spark, enums.experience_months, "1-3 năm")
    assert (r["experience_months_min"], r["experience_months_max"]) == (12, 36)
    assert one(spark, enums.experience_months, "1.5 năm")["experience_months_min"] == 18
    assert one(spark, enums.experience_months, "6 tháng")["experience_months_min"] == 6


def test_enums_and_dates(spark):
    assert one(spark, enums.employment_type, "Toàn thời gian") == "FULL_TIME"
    assert one(spark, enums.employment_type, "Full-time") == "FULL_TIME"
    assert one(spark, enums.employment_type, "whatever") == "OTHER"
    assert one(spark, enums.employment_type_vi, "FULL_TIME") == "Toàn thời gian"
    assert one(spark, enums.level_normalized, "Trưởng nhóm") == "lead"
    import datetime as dt
    assert one(spark, enums.week_key, dt.date(2026, 4, 7), "date") == "2026-W15"
    assert one(spark, enums.month_key, dt.date(2026, 4, 7), "date") == "2026-04"


def test_title_cleanup(spark):
    t = "Tour Operator/ Điều Hành Tour Inbound (Thu Nhập Từ $US 700 – $US 1500/Tháng)"
    assert one(spark, text.clean_title, t) == "Tour Operator/ Điều Hành Tour Inbound"
    assert one(spark, text.clean_title, "Dev (Remote)") == "Dev (Remote)"


def test_clean_text(spark):
    assert one(spark, text.clean_text, "  a\r\r\n \n b\t\t c  ") == "a\n\n b c"
    assert one(spark, text.clean_text, None) == ""


def test_html_title_and_text(spark):
    h = "<html><head><title>T &amp; x</title><script>var a='<p>';</script></head><body><h1> Hello <b>World</b></h1><p>x</p></body></html>"
    assert one(spark, html.page_title, h) == "Hello World"
    assert one(spark, html.page_text, h) == "T & x\nHello\nWorld\nx"


def test_blocked_page_flags(spark):
    long_ok = "<html><head><title>Tuyển dụng</title></head><body>" + "<p>" + "nội dung việc làm " * 80 + "</p></body></html>"
    pages = spark.createDataFrame([
        (1, "<html><head><title>Access Denied</title></head><body>x</body></html>"),
        (2, long_ok),
        (3, long_ok.replace("Tuyển dụng", "Attention Required! | Cloudflare")),
        (4, "<html><body>" + "<script>" + "x" * 2000 + "</script>" + "<p>short</p></body></html>"),
    ], "page_id long, html string")
    got = {r["page_id"]: r["looks_blocked"] for r in html.blocked_flags(pages).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True}


def test_salary_flags(spark):
    r = spark.createDataFrame([("Thỏa thuận", None), ("  20 - 35 triệu ", "MONTH"), ("", None)], "t string, u string") \
        .select(salary.salary_flags("t", F.col("u")).alias("f")).collect()
    assert tuple(r[0]["f"]) == (True, "Thỏa thuận", "month")
    assert tuple(r[1]["f"]) == (False, "20 - 35 triệu", "month")
    assert tuple(r[2]["f"]) == (False, "Thỏa thuận", "month")


def test_free_text_salary_and_experience(spark):
    from hirelens.functions.salary import salary_in_text
    money = [("Thưởng tháng 13, 12 ngày phép", (None, None, "VND")), ("Lương 20 - 35 triệu, 12 ngày phép", (20.0, 35.0, "VND")),
             ("từ 15 triệu", (15.0, None, "VND")), ("$700 - $1,500 a month", (700.0, 1500.0, "USD")),
             ("12 trang, 3 năm", (None, None, "VND")), (None, (None, None, "VND")), ("35 triệu đến 20 triệu", (20.0, 35.0, "VND"))]
    months = [("Độ tuổi 22-35, kinh nghiệm 1 năm", (12, None)), ("Tốt nghiệp năm 2020", (None, None)),
              ("Thành thạo 3 ngôn ngữ", (None, None)), ("Kinh nghiệm từ 6 tháng đến 2 năm", (6, 24)),
              ("2-3 years of experience", (24, 36)), ("18 tháng kinh nghiệm", (18, None)), ("", (None, None)),
              ("có kinh nghiệm, sinh năm 1990", (None, None))]
    for text, want in money:
        assert tuple(one(spark, salary_in_text, text)) == want, text
    for text, want in months:
        assert tuple(one(spark, enums.experience_in_text, text)) == want, text


def test_employment_type_of_json_arrays(spark):
    for text, want in (('["FULL_TIME"]', "FULL_TIME"), ('["PART_TIME", "INTERN"]', "PART_TIME"), ("[]", "OTHER"), ("[oops", "OTHER")):
        assert one(spark, enums.employment_type, text) == want


def test_job_posting_in_arrays_and_graphs(spark):
    from hirelens.operators.medallion import job_posting
    job = '{"@type": "JobPosting", "title": "T"}'
    other = '{"@type": "Organization", "title": "O"}'
    for blocks, want in ((f"[{other}, {job}]", "T"), ('{"@graph": [%s, %s]}' % (other, job), "T"), (job, "T"), (other, None),
                         ("{broken", None), ("[broken", None)):
        got = spark.createDataFrame([([blocks],)], "b array<string>").select(job_posting(F.col("b"))["title"].alias("t")).first()
        assert got["t"] == want, blocks
