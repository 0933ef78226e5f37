"""Bronze and silver over postings derived from ``part`` (one a row).

The template has four kinds of postings, by the part's key: (0) a full
structured block that top-level fields contradict, (1) a block in a graph that
gives a minimum salary only, (2) sections and labelled page lines without a
block, (3) top-level fields only, with the salary in the benefits.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.functions import enums, salary, text
from hirelens.operators import dictionary, medallion, messages, quality, resolution
from hirelens.plans.registry import query
from hirelens.sources.tables import read_table

INGEST = "2024-03-10T08:00:00"


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _payload() -> Column:
    kind, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    low, high = (10 + F.col("p_size")).cast("string"), (15 + 2 * F.col("p_size")).cast("string")

    def of(**by_kind) -> Column:
        value = F.lit(None)
        for k, v in by_kind.items():
            value = F.when(kind == int(k[1:]), v).otherwise(value)
        return value

    def obj(**fields) -> Column:
        return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k.replace("at_", "@")) for k, v in fields.items()])

    full = F.to_json(obj(
        at_type="JobPosting", datePosted="2024-03-01", validThrough="2024-05-01T23:59:59", employmentType="PART_TIME",
        occupationalCategory="Nhân viên", totalJobOpenings=size, hiringOrganization=obj(name=_text("Org ", F.col("p_brand"))),
        baseSalary=obj(currency="usd", value=obj(minValue=_text(low, "00"), maxValue=_text(high, "00"), unitText="MONTH")),
        experienceRequirements=obj(monthsOfExperience=size),
        jobLocation=obj(address=obj(streetAddress="Quận Ba Đình", addressLocality="Phường Kim Mã", addressRegion="hn",
                                    postalCode="10000", addressCountry="VN"))))
    graph = _text('{"@graph": [{"@type": "Organization"}, {"@type": "JobPosting", "datePosted": "bad", "baseSalary": '
                  '{"currency": "USD", "value": {"minValue": "700"}}}]}')
    money = _text(low, " - ", high, " triệu")
    values = {
        "domain": F.lit("jobs.example"), "title": _text("Kỹ sư ", F.col("p_brand"), " (Lương ", low, " triệu)"),
        "company_name": F.col("p_name"), "location": of(k0=F.lit("Đà Nẵng"), k1=F.lit("Huế"), k3=F.lit("Phường 5, Quận 7, TP HCM")),
        "salary": of(k0=money, k1=F.lit("15 - 20 triệu"), k2=money, k3=F.lit("Thỏa thuận")),
        "benefits": of(k0=F.lit("Du lịch, thưởng tháng 13"), k3=_text("Lương $", low, "00 - $", high, "00")),
        "experience": of(k0=F.lit("2 năm"), k2=F.lit("6 tháng - 2 năm")),
        "requirements": of(k0=F.lit("Tiếng Anh, tiếng Nhật"), k1=F.lit("Thành thạo python, SQL; spark."),
                           k3=F.lit("Kinh nghiệm từ 1 đến 3 năm")),
        "deadline": of(k0=F.lit("Còn 10 ngày"), k2=F.lit("Hạn nộp: 30/04/2024"), k3=F.lit("Còn 5 ngày")),
        "level": of(k0=F.lit("Quản lý"), k2=F.lit("Nhân viên"), k3=F.lit("Giám đốc")), "quantity": of(k0=F.lit("7 người")),
        "job_type": F.lit("Trả phí"), "categories": F.array("p_type", "p_brand", F.lit("khác")),
        "skills": of(k0=F.array(F.lit("Xem thêm"), F.lit("Java"), F.lit(" java "), F.col("p_type")), k2=F.array(F.lit("Java"))),
        "json_ld": of(k0=F.array(full), k1=F.array(F.lit("{broken"), graph)),
        "sections_by_heading": of(k0=F.create_map(F.lit("Cấp bậc"), F.lit("nhân viên")),
                                  k2=F.create_map(F.lit("Cấp bậc"), F.lit("Quản lý"), F.lit("Kỹ năng"), F.lit("Python, SQL"),
                                                  F.lit("Hình thức làm việc"), F.lit("Bán thời gian"),
                                                  F.lit("Số lượng tuyển"), _text(size, " người"))),
        "page_text": of(k1=F.lit("Tin tuyển dụng\nNgày đăng: 05/03/2024"),
                        k2=_text("Công ty TNHH ", F.col("p_brand"), "\nĐịa điểm: Quận 1, Hồ Chí Minh\nĐăng ngày 2024-03-02")),
    }
    return F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.PAYLOAD.fields])


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly over the session's shuffle partitions. A posting
    takes far longer to work out than to read, so the few tasks that the size
    of a file gives would hold the whole job."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _bronze(spark, sf_dir) -> DataFrame:
    rows = _dealt(read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    return medallion.bronze(rows.select(
        F.lit("boards").alias("source"), _text("https://jobs.example/p/", F.col("p_partkey").cast("string")).alias("source_url"),
        F.lit(None).cast("string").alias("normalized_source_url"), F.lit(INGEST).alias("ingest_ts"), F.lit(INGEST).alias("event_ts"),
        F.lit(1).alias("crawl_version"), _payload().alias("payload")))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("p_partkey", F.regexp_extract("source_url", r"/p/(\d+)", 1).cast("bigint"))


_PART_SQL = """
WITH p AS (SELECT p_partkey, p_partkey % 4 AS kind, p_size, p_brand, p_name, p_type,
                  10 + p_size AS lo, 15 + 2 * p_size AS hi FROM part)"""


@query("p1_flat_events_part", _PART_SQL + """
SELECT p_partkey, md5('https://jobs.example/p/' || p_partkey) AS job_id, 'jobs.example' AS source,
  'https://jobs.example/p/' || p_partkey AS source_url, 'Kỹ sư ' || p_brand || ' (Lương ' || lo || ' triệu)' AS title,
  p_name AS company_name,
  CASE kind WHEN 1 THEN '15 - 20 triệu' WHEN 3 THEN 'Thỏa thuận' ELSE lo || ' - ' || hi || ' triệu' END AS salary_text,
  CASE kind WHEN 0 THEN 'Đà Nẵng' WHEN 1 THEN 'Huế' WHEN 3 THEN 'Phường 5, Quận 7, TP HCM' ELSE '' END AS location_text,
  CASE kind WHEN 0 THEN 'Xem thêm, Java,  java , ' || p_type WHEN 2 THEN 'Java' ELSE '' END AS skills_text,
  CASE kind WHEN 0 THEN 'Yêu cầu công việc:' || chr(10) || 'Tiếng Anh, tiếng Nhật' || chr(10) || chr(10) || 'Quyền lợi:' || chr(10)
                        || 'Du lịch, thưởng tháng 13'
            WHEN 1 THEN 'Yêu cầu công việc:' || chr(10) || 'Thành thạo python, SQL; spark.'
            WHEN 3 THEN 'Yêu cầu công việc:' || chr(10) || 'Kinh nghiệm từ 1 đến 3 năm' || chr(10) || chr(10) || 'Quyền lợi:' || chr(10)
                        || 'Lương $' || lo || '00 - $' || hi || '00'
            ELSE '' END AS description_text,
  '2024-03-10T08:00:00' AS event_ts, '2024-03-10T08:00:00' AS ingest_ts
FROM p""")
def q_flat(spark, sf_dir):
    """P1 with all its fields: payload -> flat event."""
    rows = _dealt(read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")).select(
        "p_partkey", _text("https://jobs.example/p/", F.col("p_partkey").cast("string")).alias("source_url"),
        _payload().alias("payload")).select("p_partkey", "source_url", "payload.*")
    return messages.to_flat_event(rows, crawled_at=F.lit(INGEST), ingest_ts=F.lit(INGEST), keep=("p_partkey",))


@query("n10_silver_groups_part", _PART_SQL + """
SELECT p_partkey,
  CASE kind WHEN 0 THEN 'Org ' || p_brand WHEN 2 THEN 'Công ty TNHH ' || p_brand ELSE p_name END AS company_name,
  CASE kind WHEN 0 THEN 'json_ld' WHEN 2 THEN 'page_block' ELSE 'page' END AS company_name_source,
  CAST(CASE kind WHEN 0 THEN 100 * lo WHEN 1 THEN 700 WHEN 2 THEN lo ELSE 100 * lo END AS DOUBLE) AS salary_min,
  CAST(CASE kind WHEN 0 THEN 100 * hi WHEN 2 THEN hi WHEN 3 THEN 100 * hi END AS DOUBLE) AS salary_max,
  CASE kind WHEN 2 THEN 'VND' ELSE 'USD' END AS currency, 'month' AS salary_period,
  CASE kind WHEN 2 THEN 'salary_text' WHEN 3 THEN 'benefits_text' ELSE 'json_ld' END AS salary_source,
  CASE WHEN kind IN (0, 2) THEN 'PART_TIME' ELSE 'OTHER' END AS employment_type,
  CASE kind WHEN 0 THEN 'json_ld' WHEN 2 THEN 'section' END AS employment_type_source,
  CASE kind WHEN 0 THEN '2024-03-01' WHEN 1 THEN '2024-03-05' WHEN 2 THEN '2024-03-02' END AS posting_date,
  CASE kind WHEN 0 THEN 'json_ld' WHEN 1 THEN 'page_text' WHEN 2 THEN 'page_text' END AS posting_date_source,
  CASE kind WHEN 0 THEN '2024-05-01 23:59:59' WHEN 2 THEN '2024-04-30 00:00:00' WHEN 3 THEN '2024-03-15 00:00:00' END AS valid_through,
  CASE kind WHEN 0 THEN 'structured' WHEN 2 THEN 'explicit_text' WHEN 3 THEN 'relative_text' END AS valid_through_source,
  CAST(CASE kind WHEN 0 THEN p_size WHEN 2 THEN 6 WHEN 3 THEN 12 END AS INTEGER) AS experience_months_min,
  CAST(CASE kind WHEN 2 THEN 24 WHEN 3 THEN 36 END AS INTEGER) AS experience_months_max,
  CASE kind WHEN 0 THEN 'json_ld' WHEN 2 THEN 'experience_text' WHEN 3 THEN 'requirements_text' END AS experience_source,
  CASE kind WHEN 0 THEN 'Hà Nội' WHEN 1 THEN 'Huế' ELSE 'Hồ Chí Minh' END AS city,
  CASE kind WHEN 0 THEN 'Quận Ba Đình' WHEN 2 THEN 'Quận 1' WHEN 3 THEN 'Quận 7' END AS district,
  CASE kind WHEN 0 THEN 'Phường Kim Mã' WHEN 3 THEN 'Phường 5' END AS ward,
  CASE kind WHEN 0 THEN '10000' END AS postal_code,
  CASE kind WHEN 0 THEN 'json_ld' WHEN 2 THEN 'page_text' ELSE 'page' END AS location_source,
  CASE kind WHEN 0 THEN 'Nhân viên' WHEN 2 THEN 'Quản lý' WHEN 3 THEN 'Giám đốc' END AS level,
  CASE kind WHEN 0 THEN 'staff' WHEN 2 THEN 'manager' WHEN 3 THEN 'director' END AS level_normalized,
  CASE kind WHEN 0 THEN 'json_ld' WHEN 2 THEN 'section' WHEN 3 THEN 'page' END AS level_source,
  CAST(CASE WHEN kind IN (0, 2) THEN p_size END AS INTEGER) AS openings,
  CASE kind WHEN 0 THEN 'json_ld' WHEN 2 THEN 'section' END AS openings_source,
  CASE kind WHEN 0 THEN 'Java, ' || p_type WHEN 1 THEN 'python, sql, spark' WHEN 2 THEN 'Python, SQL' ELSE '' END AS skills,
  CASE kind WHEN 0 THEN 'page' WHEN 1 THEN 'requirements_text' WHEN 2 THEN 'section' END AS skills_source
FROM p""")
def q_groups(spark, sf_dir):
    """All ten field groups of silver, each from one source."""
    s = _keyed(medallion.silver_fields(_bronze(spark, sf_dir)))
    return s.select(
        "p_partkey", "company_name", "company_name_source", "salary_min", "salary_max", "currency", "salary_period",
        "salary_source", "employment_type", "employment_type_source", F.col("posting_date").cast("string").alias("posting_date"),
        "posting_date_source", F.date_format("valid_through_ts", "yyyy-MM-dd HH:mm:ss").alias("valid_through"),
        "valid_through_source", "experience_months_min", "experience_months_max", "experience_source", "city", "district",
        "ward", "postal_code", "location_source", "level", "level_normalized", "level_source", "openings", "openings_source",
        F.array_join("skills", ", ").alias("skills"), "skills_source")


@query("n10_conflict_log_part", _PART_SQL + """,
c AS (
  SELECT p_partkey, 'company_name' AS field_group, 3 AS rank, 'page' AS source, p_name AS value, 'json_ld' AS used_source,
         'Org ' || p_brand AS used_value FROM p WHERE kind = 0
  UNION ALL SELECT p_partkey, 'company_name', 3, 'page', p_name, 'page_block', 'Công ty TNHH ' || p_brand FROM p WHERE kind = 2
  UNION ALL SELECT p_partkey, 'salary', 2, 'salary_text', '{"salary_min":' || CAST(CAST(lo AS DOUBLE) AS VARCHAR) || ',"salary_max":'
         || CAST(CAST(hi AS DOUBLE) AS VARCHAR) || ',"currency":"VND"}', 'json_ld', '{"salary_min":' || CAST(100.0::DOUBLE * lo AS VARCHAR)
         || ',"salary_max":' || CAST(100.0::DOUBLE * hi AS VARCHAR) || ',"currency":"USD","salary_period":"month"}' FROM p WHERE kind = 0
  UNION ALL SELECT p_partkey, 'salary', 2, 'salary_text', '{"salary_min":15.0,"salary_max":20.0,"currency":"VND"}', 'json_ld',
         '{"salary_min":700.0,"currency":"USD"}' FROM p WHERE kind = 1
  UNION ALL SELECT p_partkey, 'valid_through', 3, 'relative_text', '2024-03-20 00:00:00', 'structured', '2024-05-01 23:59:59'
         FROM p WHERE kind = 0
  UNION ALL SELECT p_partkey, 'experience', 2, 'experience_text', '{"experience_months_min":24}', 'json_ld',
         '{"experience_months_min":' || p_size || '}' FROM p WHERE kind = 0 AND p_size <> 24
  UNION ALL SELECT p_partkey, 'location', 3, 'page', '{"city":"Đà Nẵng"}', 'json_ld',
         '{"city":"Hà Nội","district":"Quận Ba Đình","ward":"Phường Kim Mã","postal_code":"10000"}' FROM p WHERE kind = 0
  UNION ALL SELECT p_partkey, 'skills', 2, 'page', 'Java', 'section', 'Python, SQL' FROM p WHERE kind = 2
  UNION ALL SELECT p_partkey, 'level', 3, 'page', 'Quản lý', 'json_ld', 'Nhân viên' FROM p WHERE kind = 0
  UNION ALL SELECT p_partkey, 'level', 3, 'page', 'Nhân viên', 'section', 'Quản lý' FROM p WHERE kind = 2
  UNION ALL SELECT p_partkey, 'openings', 3, 'page', '7', 'json_ld', CAST(p_size AS VARCHAR) FROM p WHERE kind = 0 AND p_size <> 7)
SELECT * FROM c""")
def q_conflicts(spark, sf_dir):
    """Every source that disagrees with the one used."""
    s = _keyed(medallion.silver_fields(_bronze(spark, sf_dir)))
    return resolution.conflict_log(s, "p_partkey")


@query("n7_n21_silver_fields_part", _PART_SQL + """
SELECT p_partkey, 'Kỹ sư ' || p_brand AS job_title, 'Kỹ sư ' || p_brand || ' (Lương ' || lo || ' triệu)' AS job_title_display,
  kind = 3 AS salary_is_negotiable,
  CASE kind WHEN 1 THEN '15 - 20 triệu' WHEN 3 THEN 'Thỏa thuận' ELSE lo || ' - ' || hi || ' triệu' END AS salary_display,
  CASE kind WHEN 0 THEN 'Phường Kim Mã, Quận Ba Đình, Hà Nội' WHEN 1 THEN 'Huế' WHEN 2 THEN 'Quận 1, Hồ Chí Minh'
            ELSE 'Phường 5, Quận 7, Hồ Chí Minh' END AS location_display,
  CASE kind WHEN 0 THEN 'ha_noi' WHEN 1 THEN 'hue' ELSE 'ho_chi_minh' END AS city_slug,
  p_type AS industry_primary, p_brand || ', khác' AS industry_secondary,
  CASE kind WHEN 0 THEN p_name || ', Org ' || p_brand ELSE p_name END AS company_aliases,
  CASE kind WHEN 0 THEN 'travel, bonus_13th_month' ELSE '' END AS benefits_tags,
  CASE kind WHEN 0 THEN 'english, japanese' ELSE '' END AS language_requirements, kind = 0 AS english_required,
  CASE WHEN kind = 1 THEN 'unknown' ELSE 'active' END AS status, kind = 3 AS is_deleted,
  CASE kind WHEN 0 THEN CASE WHEN p_size < 24 THEN 'junior' WHEN p_size < 60 THEN 'mid' ELSE 'senior' END
            WHEN 1 THEN 'unknown' ELSE 'junior' END AS experience_bucket
FROM p""")
def q_fields(spark, sf_dir):
    """N6, N7, N12–N17, N19–N21, K9 on postings with and without a block."""
    s = _keyed(medallion.silver_fields(_bronze(spark, sf_dir), as_of="2024-03-20T00:00:00"))
    joined = [F.array_join(c, ", ").alias(c) for c in ("industry_secondary", "company_aliases", "benefits_tags", "language_requirements")]
    return s.select("p_partkey", "job_title", "job_title_display", "salary_is_negotiable", "salary_display", "location_display",
                    "city_slug", "industry_primary", *joined, "english_required", "status", "is_deleted", "experience_bucket")


@query("p6_bronze_flags_part", _PART_SQL + """
SELECT p_partkey, kind IN (0, 1) AS has_json_ld, kind IN (1, 2) AS has_page_text, kind IN (0, 1) AS has_structured_salary,
  kind = 0 AS has_structured_company_name_conflict, kind = 0 AS has_noisy_skill_list, true AS has_noisy_job_type,
  kind = 0 AS has_valid_posting_date, kind = 0 AS has_valid_deadline,
  CAST(CASE kind WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS INTEGER) AS json_ld_count,
  CAST(CASE kind WHEN 0 THEN 4 WHEN 2 THEN 1 ELSE 0 END AS INTEGER) AS skills_raw_count
FROM p""")
def q_flags(spark, sf_dir):
    """The eight flags and the counts, with blocks in a graph and broken ones."""
    b = _keyed(_bronze(spark, sf_dir))
    flags = ("has_json_ld", "has_page_text", "has_structured_salary", "has_structured_company_name_conflict",
             "has_noisy_skill_list", "has_noisy_job_type", "has_valid_posting_date", "has_valid_deadline")
    return b.select("p_partkey", *[F.col("quality_issue_flags")[f].alias(f) for f in flags], "json_ld_count", "skills_raw_count")


@query("a11_silver_metrics_part", _PART_SQL + """
SELECT kind % 2 = 0 AS even_kind, count(*) AS job_count,
  count(*) FILTER (WHERE kind IN (0, 1)) / count(*) AS structured_salary_coverage,
  count(*) FILTER (WHERE kind = 0) / count(*) AS structured_company_coverage,
  count(*) / count(*) AS salary_disclosed_ratio, count(*) FILTER (WHERE kind IN (0, 2)) / count(*) AS company_conflict_rate,
  count(*) FILTER (WHERE kind <> 3) / count(*) AS conflict_rate, count(*) / count(*) AS location_parse_rate,
  CASE WHEN sum(CASE kind WHEN 0 THEN 4 WHEN 2 THEN 1 ELSE 0 END) > 0 THEN 2 * count(*) FILTER (WHERE kind = 0)
       / sum(CASE kind WHEN 0 THEN 4 WHEN 2 THEN 1 ELSE 0 END) END AS skill_parse_confidence
FROM p GROUP BY ALL""")
def q_metrics(spark, sf_dir):
    """The recommended metrics of silver, by kind of posting."""
    s = _keyed(medallion.silver_fields(_bronze(spark, sf_dir))).withColumn("even_kind", F.col("p_partkey") % 2 == 0)
    return medallion.silver_coverage(s, "even_kind").drop("data_quality_coverage")


COVERED = {"company_name": "company_name_raw", "salary_min": "salary_raw", "city": "location_raw", "level": "level_raw",
           "experience_months_min": "experience_raw", "openings": "quantity_raw", "skills": "skills_raw",
           "valid_through_ts": "deadline_raw"}


@query("a11_raw_to_silver_coverage_part", _PART_SQL + """,
n AS (SELECT count(*) AS n, count(*) FILTER (WHERE kind = 0) AS k0, count(*) FILTER (WHERE kind = 1) AS k1,
             count(*) FILTER (WHERE kind = 2) AS k2, count(*) FILTER (WHERE kind = 3) AS k3 FROM p),
f(field, before_field, b, a) AS (
  SELECT 'company_name', 'company_name_raw', n, n FROM n UNION ALL SELECT 'salary_min', 'salary_raw', n, n FROM n
  UNION ALL SELECT 'city', 'location_raw', k0 + k1 + k3, n FROM n UNION ALL SELECT 'level', 'level_raw', k0 + k2 + k3, k0 + k2 + k3 FROM n
  UNION ALL SELECT 'experience_months_min', 'experience_raw', k0 + k2, k0 + k2 + k3 FROM n
  UNION ALL SELECT 'openings', 'quantity_raw', k0, k0 + k2 FROM n UNION ALL SELECT 'skills', 'skills_raw', k0 + k2, k0 + k1 + k2 FROM n
  UNION ALL SELECT 'valid_through_ts', 'deadline_raw', k0 + k2 + k3, k0 + k2 + k3 FROM n)
SELECT field, before_field, b AS before_filled, a AS after_filled, b / n AS before_coverage, a / n AS after_coverage,
       a / n - b / n AS coverage_gain FROM f, n""")
def q_coverage(spark, sf_dir):
    """Raw-to-silver coverage of fields, from a profile of each layer."""
    bronze = _bronze(spark, sf_dir)
    raw = quality.layer_profile(bronze, list(COVERED.values()))
    return quality.coverage_change(raw, quality.layer_profile(medallion.silver_fields(bronze), list(COVERED)), COVERED)


@query("v8_layer_profile_orders", """
SELECT o_orderpriority, f.field, count(*) AS rows, count(*) FILTER (WHERE f.filled) AS filled,
       count(*) FILTER (WHERE f.fault) AS type_faults, count(*) FILTER (WHERE f.filled) / count(*) AS coverage
FROM (SELECT o_orderpriority, unnest([
        {'field': 'priority_code', 'filled': o_orderpriority <> '4-NOT SPECIFIED', 'fault': false},
        {'field': 'status_number', 'filled': true, 'fault': o_orderstatus <> 'F'},
        {'field': 'total', 'filled': true, 'fault': false}]) AS f FROM orders) GROUP BY ALL""")
def q_profile(spark, sf_dir):
    """Filled values and type faults of all columns, in one pass."""
    orders = read_table(spark, sf_dir, "orders")
    columns = {"priority_code": F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).otherwise(" "),
               "status_number": F.when(F.col("o_orderstatus") == "F", "1").otherwise(F.col("o_orderstatus")),
               "total": F.col("o_totalprice")}
    found = quality.layer_profile(orders, columns, {"status_number": "int"}, by=["o_orderpriority"])
    return found.drop("distinct_estimate")


@query("n18_dictionary_terms_part", """
WITH t AS (SELECT DISTINCT lower(p_name) AS term, 2 AS n FROM part
           UNION SELECT DISTINCT lower(split_part(p_name, ' ', 2)), 1 FROM part),
x AS (SELECT p_partkey, string_split(lower(p_type || ' ' || p_name || ' ' || split_part(p_name, ' ', 2) || ' '
             || split_part(p_name, ' ', 2) || 's'), ' ') AS w FROM part),
r AS (SELECT p_partkey, pos, n, array_to_string(w[pos + 1 : pos + n], ' ') AS run
      FROM x, range(0, 5) AS i(pos), range(1, 3) AS k(n) WHERE pos + n <= len(w)),
m AS (SELECT p_partkey, CAST(pos AS INTEGER) AS pos, CAST(r.n AS INTEGER) AS n_words, term FROM r JOIN t ON t.term = r.run AND t.n = r.n)
SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM m AS o WHERE o.p_partkey = m.p_partkey AND o.pos <= m.pos
  AND o.pos + o.n_words >= m.pos + m.n_words AND o.n_words > m.n_words)""")
def q_terms(spark, sf_dir):
    """N18 with a dictionary that grows with the data: names of parts and
    their nouns, as whole words, longest first."""
    part = read_table(spark, sf_dir, "part")
    noun = F.split("p_name", " ")[1]
    terms = part.select(F.lower("p_name").alias("term")).union(part.select(F.lower(noun))).distinct()
    texts = part.select("p_partkey", F.concat_ws(" ", "p_type", "p_name", noun, F.concat(noun, F.lit("s"))).alias("text"))
    return dictionary.match_terms(texts, "p_partkey", "text", terms)


# Letters of the documents, taken apart as a text in Unicode's decomposed form has them.
_APART = [("é", "e\u0301"), ("è", "e\u0300"), ("ê", "e\u0302"), ("à", "a\u0300"), ("ó", "o\u0301"), ("í", "i\u0301")]


@query("n1_n6_decomposed_documents", """
SELECT doc_id, md5(text) AS text_md5, 'Hà Nội' AS city, 'ha_noi_' || source AS slug, 'Đà Nẵng|' || source AS skills,
       CAST(NULL AS DOUBLE) AS salary_min, CAST(6 + doc_id % 5 AS INTEGER) AS experience_months_min
FROM documents""")
def q_decomposed(spark, sf_dir):
    """N1, N2, N5, N6, N11, X1 on decomposed text: the same as on composed."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    apart = F.col("text")
    for letter, pieces in _APART:
        apart = F.replace(apart, F.lit(letter), F.lit(pieces))
    ha_noi, da_nang = (unicodedata.normalize("NFD", x) for x in ("Hà Nội", "Đà Nẵng"))
    unsettled, months = (unicodedata.normalize("NFD", x) for x in ("Thỏa thuận, ", " tháng - 2 năm"))
    skills = text.filter_skills(F.array(F.lit(da_nang), F.lit(ha_noi), F.lit("Đà Nẵng "), F.col("source")), noise=["hà nội"])
    return d.select(
        "doc_id", F.md5(text.nfc(apart)).alias("text_md5"), text.normalize_city(F.lit(f" {ha_noi} ")).alias("city"),
        text.city_slug(F.concat(F.lit(f"{ha_noi} "), "source")).alias("slug"), F.array_join(skills, "|").alias("skills"),
        salary.parse_salary(F.concat(F.lit(unsettled), F.col("doc_id").cast("string"), F.lit(" triệu")))["salary_min"].alias("salary_min"),
        enums.experience_months(F.concat((6 + F.col("doc_id") % 5).cast("string"), F.lit(months)))["experience_months_min"]
        .alias("experience_months_min"))
