"""Decomposed text, character references, salary and experience sources."""

import html as stdlib_html
import json
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirelens.functions import enums, html, salary, taxonomy, text, urls
from hirelens.operators import dictionary, medallion, quality, resolution

SYLLABLES = ["Hà Nội", "hồ chí minh", "Đà Nẵng", "thỏa thuận", "5 triệu", "$700", "kinh nghiệm", "6 tháng", "2 năm", "tiếng Anh",
             "Ưu đãi", "ỨNG tuyển", "du lịch", "x", " ", "\n", "nắng", "Quản lý", "é", "\U0001f600"]


def _eval(spark, values, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["o"] for r in rows.select("i", fn(F.col("t")).alias("o")).orderBy("i").collect()]


FUNCTIONS = (
    text.normalize_city, lambda c: text.normalize_city(c, "exact"), text.city_slug, text.clean_text,
    lambda c: text.filter_skills(F.split(c, " ")), salary.parse_salary, salary.salary_in_text, salary.salary_flags,
    enums.experience_months, enums.experience_in_text, enums.level_normalized, enums.employment_type,
    taxonomy.benefit_tags, taxonomy.language_requirements, lambda c: urls.content_hash(c, c, c, c, c))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(SYLLABLES), max_size=7).map(" ".join), min_size=10, max_size=40))
def test_decomposed_text_gives_what_composed_gives(spark, texts):
    rows = spark.createDataFrame([(unicodedata.normalize("NFC", t), unicodedata.normalize("NFD", t)) for t in texts],
                                 "plain string, apart string")
    told = rows.select(*[fn(F.col(c)).alias(f"{c}{i}") for i, fn in enumerate(FUNCTIONS) for c in ("plain", "apart")]).collect()
    for r in told:
        for i in range(len(FUNCTIONS)):
            assert r[f"plain{i}"] == r[f"apart{i}"], (i, r[f"plain{i}"], r[f"apart{i}"])


def test_marks_in_any_order(spark):
    told = ["o\u0302\u0323", "o\u0323\u0302", "\u00f4\u0323", "\u1ecd\u0302", "O\u031b\u0301", "q\u0301", "plain", None]
    assert _eval(spark, told, text.nfc) == ["\u1ed9"] * 4 + ["\u1eda", "q\u0301", "plain", None]


REFERENCES = ["&amp;", "&lt;b&gt;", "&#7929;", "&#x1EF9;", "&#432", "&agrave;", "&ocirc", "&nbsp;", "&bogus;", "&#0;", "&#xD800;", "&#150;",
              "&#1114112;", "&", "&&", "&amp;lt;", "&notit;", "&CounterClockwiseContourIntegral;", "a b", "; x", "#", "é"]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(REFERENCES), max_size=8).map("".join), min_size=20, max_size=60))
def test_references_are_decoded_like_the_standard_librarys(spark, texts):
    assert _eval(spark, texts, html.unescape_entities) == [stdlib_html.unescape(t) for t in texts]


def test_titles_skip_comments_and_scripts(spark):
    pages = ["<!-- <h1>old</h1> --><h1>new</h1>", "<script>var a='<h1>no</h1>';</script><h1 class=x>K&#7929; s&#432; d&agrave;i</h1 >",
             "<title>T&amp;C</title><h1> <b></b> </h1>", "<header>x</header><p>none</p>", None]
    assert _eval(spark, pages, html.page_title) == ["new", "Kỹ sư dài", "T&C", None, None]


def test_experience_units_of_their_own(spark):
    got = _eval(spark, ["6 tháng - 2 năm", "1-3 năm", "2 năm", "1.5 năm", "6 tháng", "3 - 6 tháng", "Không yêu cầu", "5", "1 year - 18 months", ""],
                enums.experience_months)
    assert [tuple(r) for r in got] == [(6, 24), (12, 36), (24, None), (18, None), (6, None), (3, 6), (0, None), (60, None),
                                       (12, 18), (None, None)]


def _silver(spark, payloads):
    from hirelens import schemas
    rows = [(json.dumps({"source": "s", "source_url": f"https://x.example/{i}", "ingest_ts": "2024-03-10T08:00:00", "payload": p}),)
            for i, p in enumerate(payloads)]
    env = spark.createDataFrame(rows, "v string").select(F.from_json("v", schemas.ENVELOPE).alias("e")).select("e.*")
    return medallion.silver_fields(medallion.bronze(env.withColumn("crawl_version", F.lit(1)))).orderBy("source_url").collect()


def _posting(**fields):
    return json.dumps({"@type": "JobPosting", **fields})


def test_salary_fields_come_from_one_source(spark):
    got = _silver(spark, [
        {"title": "a", "salary": "Thỏa thuận", "benefits": "Lương $700 - $1,500"},
        {"title": "b", "salary": "15 - 20 triệu", "json_ld": [_posting(baseSalary={"currency": "USD", "value": {"minValue": 700}})]},
        {"title": "c", "salary": "Thỏa thuận"}])
    assert [(r["salary_min"], r["salary_max"], r["currency"], r["salary_source"]) for r in got] == [
        (700.0, 1500.0, "USD", "benefits_text"), (700.0, None, "USD", "json_ld"), (None, None, "VND", None)]
    assert [r["salary_conflict"] for r in got] == [False, True, False]


def test_a_conflict_needs_no_first_source(spark):
    got = _silver(spark, [{"title": "a", "level": "Nhân viên", "sections_by_heading": {"Cấp bậc": "Quản lý"}}])[0]
    assert (got["level"], got["level_source"], got["level_conflict"]) == ("Quản lý", "section", True)
    assert [(c["field_group"], c["rank"], c["source"], c["value"], c["used_value"]) for c in got["conflicts"]] == [
        ("level", 3, "page", "Nhân viên", "Quản lý")]
    val, used, conflict = medallion.first_present(("a", F.lit(None)), ("b", F.lit("x")), ("c", F.lit("y")))
    assert tuple(spark.range(1).select(val, used, conflict).first()) == ("x", "b", True)


def test_groups_keep_their_fields_together(spark):
    group = resolution.FieldGroup("g", {"a": "int", "b": "string"}, [
        ("one", {"a": F.col("a1")}), ("two", {"a": F.col("a2"), "b": F.col("b2")})], telling=["a"])
    df = spark.createDataFrame([(1, 2, "x"), (None, 2, "x"), (None, None, "x"), (2, 2, "y")], "a1 int, a2 int, b2 string")
    got = [(r["resolved"]["g"]["a"], r["resolved"]["g"]["b"], r["resolved"]["g"]["source"], len(r["conflicts"]))
           for r in resolution.resolve(df, [group]).collect()]
    assert got == [(1, None, "one", 1), (2, "x", "two", 0), (None, None, None, 0), (2, None, "one", 0)]


def test_dictionary_terms_are_whole_words_longest_first(spark):
    texts = spark.createDataFrame([(1, "Machine learning and C++, Java; JavaScript. Node.js"), (2, "machine  Learning machine"),
                                   (3, None), (4, "java java")], "id int, text string")
    terms = spark.createDataFrame([("machine learning", "m"), ("learning", "l"), ("java", "j"), ("c++", "c"), ("node.js", "n"), ("", "e"),
                                   ("Machine", "k")], "term string, code string")
    got = sorted((r["id"], r["pos"], r["code"]) for r in dictionary.match_terms(texts, "id", "text", terms).collect())
    assert got == [(1, 0, "m"), (1, 3, "c"), (1, 4, "j"), (1, 6, "n"), (2, 0, "m"), (2, 2, "k"), (4, 0, "j"), (4, 1, "j")]
    assert dictionary.match_terms(texts, "id", "text", terms.limit(0)).collect() == []


def test_profiles(spark):
    df = spark.createDataFrame([("1", [1], None), (" ", [], 2.0), ("x", None, 2.0)], "a string, b array<int>, c double")
    got = {r["field"]: (r["rows"], r["filled"], r["type_faults"], r["distinct_estimate"])
           for r in quality.layer_profile(df, ["a", "b", "c"], {"a": "int"}).collect()}
    assert got == {"a": (3, 2, 1, 2), "b": (3, 1, 0, 1), "c": (3, 2, 0, 1)}
    many = spark.range(20_000).select(F.pmod("id", F.lit(5000)).alias("k"))
    assert abs(quality.layer_profile(many, ["k"]).first()["distinct_estimate"] - 5000) < 500
