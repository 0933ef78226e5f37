"""Medallion layers: raw envelope -> bronze (P5, P6, K1–K4) -> silver (N1–N21,
N10 source priority, K5/K6) -> gold (:mod:`hirelens.operators.gold`).

Every step is a DataFrame -> DataFrame function; layers are written as
partitioned Parquet between jobs (SK7) and read back with partition filters
(SR4). Nothing reads the wall clock: the as-of time is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import schemas
from hirelens.functions import enums, taxonomy, text, urls
from hirelens.functions.constants import SKILL_NOISE
from hirelens.functions.salary import parse_salary, salary_flags, salary_in_text
from hirelens.operators import dictionary, keys, resolution
from hirelens.operators.quality import quality_score, raw_quality_flags


def _p(name: str) -> Column:
    return F.col(f"payload.{name}")


def job_posting(json_ld_col: Column) -> Column:
    """The first JSON-LD object whose @type is JobPosting, parsed with the
    JobPosting schema (NULL when there is none). Blocks hold an object, an
    array of objects, or objects under ``@graph``."""
    many = T.ArrayType(schemas.JOB_POSTING)
    graph = T.StructType([T.StructField("@graph", many)])

    def objects(x: Column) -> Column:
        return F.when(F.ltrim(x).startswith("["), F.from_json(x, many)) \
            .when(x.contains('"@graph"'), F.from_json(x, graph)["@graph"]) \
            .otherwise(F.array(F.from_json(x, schemas.JOB_POSTING)))

    parsed = F.flatten(F.transform(json_ld_col, lambda x: F.coalesce(objects(x), F.array().cast(many))))
    return F.get(F.filter(parsed, lambda s: s["@type"] == "JobPosting"), 0)


def bronze(envelopes: DataFrame) -> DataFrame:
    """P5 + P6 + K1–K3 over parsed envelopes (columns source, source_url,
    ingest_ts, event_ts, crawl_version, payload)."""
    jp = job_posting(F.coalesce(_p("json_ld"), F.array().cast("array<string>")))
    noise = F.array(*[F.lit(n) for n in SKILL_NOISE])
    skills_l = F.transform(F.coalesce(_p("skills"), F.array().cast("array<string>")), lambda x: F.lower(F.trim(x)))
    flags = {
        "has_json_ld": F.size(F.coalesce(_p("json_ld"), F.array())) > 0,
        "has_page_text": F.coalesce(_p("page_text"), F.lit("")) != "",
        "has_structured_salary": jp["baseSalary"].isNotNull(),
        "has_structured_company_name_conflict": F.coalesce(
            F.lower(F.trim(jp["hiringOrganization"]["name"])) != F.lower(F.trim(_p("company_name"))), F.lit(False)),
        "has_noisy_skill_list": F.arrays_overlap(skills_l, noise),
        "has_noisy_job_type": (F.coalesce(_p("job_type"), F.lit("")) != "")
        & (enums.employment_type(_p("job_type")) == "OTHER"),
        "has_valid_posting_date": F.try_to_date(jp["datePosted"]).isNotNull(),
        "has_valid_deadline": F.try_to_timestamp(jp["validThrough"]).isNotNull(),
    }
    ingest = F.try_to_timestamp(F.col("ingest_ts"))
    out = envelopes.select(
        F.col("source"), F.col("source_url"),
        F.coalesce(F.col("normalized_source_url"), urls.normalize_url("source_url")).alias("normalized_source_url"),
        urls.job_id(F.col("source"), F.col("source_url")).alias("job_id"),
        urls.content_hash(_p("title"), _p("company_name"), _p("location"), _p("salary"), _p("requirements"))
        .alias("hash_content"),
        ingest.alias("ingest_ts"), F.to_date(ingest).alias("ingest_date"),
        F.try_to_timestamp(F.col("event_ts")).alias("event_ts"),
        F.col("crawl_version"),
        _p("domain").alias("crawl_domain"), _p("fetch_method").alias("fetch_method"),
        _p("title").alias("job_title_raw"), _p("company_name").alias("company_name_raw"),
        _p("salary").alias("salary_raw"), _p("location").alias("location_raw"),
        _p("level").alias("level_raw"), _p("quantity").alias("quantity_raw"),
        _p("experience").alias("experience_raw"), _p("deadline").alias("deadline_raw"),
        _p("job_type").alias("job_type_raw"), _p("description").alias("description_raw"),
        _p("requirements").alias("requirements_raw"), _p("benefits").alias("benefits_raw"),
        _p("skills").alias("skills_raw"), _p("categories").alias("categories_raw"),
        _p("requirement_items").alias("requirement_items"), _p("benefit_items").alias("benefit_items"),
        _p("sections_by_heading").alias("sections_by_heading"), _p("meta_tags").alias("meta_tags"),
        _p("json_ld").alias("json_ld"), _p("page_text").alias("page_text"),
        *[F.size(F.coalesce(_p(c), F.array())).alias(f"{c}_raw_count")
          for c in ("skills", "categories", "description_items", "requirement_items", "benefit_items")],
        F.size(F.coalesce(_p("json_ld"), F.array())).alias("json_ld_count"),
        flags["has_json_ld"].alias("json_ld_present"), flags["has_page_text"].alias("page_text_present"),
        _p("meta_tags").isNotNull().alias("meta_tags_present"),
        _p("sections_by_heading").isNotNull().alias("sections_by_heading_present"),
        raw_quality_flags(flags).alias("quality_issue_flags"),
        F.lit(False).alias("is_deleted"),
    )
    return out


def bronze_dedup(b: DataFrame) -> DataFrame:
    """K4 on bronze rows."""
    return keys.bronze_dedup(b, order=("ingest_ts",)).drop("duplicate_count")


def first_present(*pairs: tuple[str, Column]) -> tuple[Column, Column, Column]:
    """Value from the highest-priority source that has one, which source
    was used, and a conflict flag (another source has a different one).
    Groups of fields with a log: :mod:`hirelens.operators.resolution`."""
    vals = [F.nullif(F.trim(c.cast("string")), F.lit("")) for _, c in pairs]
    val = F.coalesce(*vals)
    used = None
    for (name, _), v in zip(pairs, vals):
        used = F.when(v.isNotNull(), F.lit(name)) if used is None else used.when(v.isNotNull(), F.lit(name))
    conflict = F.lit(False)
    for v in vals[1:]:
        conflict = conflict | F.coalesce(v != val, F.lit(False))
    return val, used, conflict


def _section(heading: str) -> Column:
    return F.try_element_at(F.coalesce("sections_by_heading", F.create_map().cast("map<string,string>")), F.lit(heading))


def _page_line(pattern: str, group: int = 1) -> Column:
    """What a labelled line of the page text says (NULL: no such line)."""
    return F.nullif(F.trim(F.regexp_extract(F.coalesce("page_text", F.lit("")), rf"(?imU)^\s*{pattern}\s*$", group)), F.lit(""))


def _day(written: Column) -> Column:
    """A date written as 30/04/2026 or 2026-04-30."""
    return F.coalesce(F.try_to_date(written, "d/M/yyyy"), F.try_to_date(written, "yyyy-MM-dd"))


_DAY = r"(\d{1,2}/\d{1,2}/\d{4}|\d{4}-\d{2}-\d{2})"
_DISTRICT = r"(?iU)((?:quận|huyện|thị xã|district)\s+[^,;\n]+|q\.\s*[^,;\n]+)"
_WARD = r"(?iU)((?:phường|xã|thị trấn|ward)\s+[^,;\n]+|p\.\s*[^,;\n]+)"


def _named_part(address: Column, pattern: str) -> Column:
    return F.nullif(F.trim(F.regexp_extract(F.coalesce(address, F.lit("")), pattern, 1)), F.lit(""))


def _place(city: Column, address: Column) -> dict[str, Column]:
    return {"city": text.normalize_city(city), "district": _named_part(address, _DISTRICT), "ward": _named_part(address, _WARD)}


def field_groups(jp: Column) -> list[resolution.FieldGroup]:
    """The ten field groups of silver with their sources in rank order:
    JSON-LD block, then sections or labelled lines of the page, then top-level
    fields. The labels looked for in page text are our own (O)."""
    group = resolution.FieldGroup
    base, address = jp["baseSalary"], jp["jobLocation"]["address"]
    raw, benefits = parse_salary("salary_raw"), salary_in_text("benefits_raw")
    in_text = ("salary_min", "salary_max", "currency")
    stated, required = enums.experience_months("experience_raw"), enums.experience_in_text("requirements_raw")
    months = ("experience_months_min", "experience_months_max")
    locality = address["addressLocality"]
    part = F.concat_ws(", ", address["streetAddress"], locality)
    line = _page_line(r"(?:địa điểm làm việc|địa điểm|location)\s*:\s*([^\n]+)")
    section_skills = F.split(F.regexp_replace(_section("Kỹ năng"), r"\s*[,;\n•]\s*", ","), ",")
    words = dictionary.words(F.col("requirements_raw"))
    return [
        group("company_name", {"value": "string"}, [
            ("json_ld", {"value": jp["hiringOrganization"]["name"]}),
            ("page_block", {"value": _page_line(r"((?:công ty|tập đoàn|ngân hàng)\s+(?:tnhh|cổ phần|cp|tmcp|mtv|hợp danh)\s[^\n]{2,120}?)")}),
            ("page", {"value": F.col("company_name_raw")})]),
        group("salary", {"salary_min": "double", "salary_max": "double", "currency": "string", "salary_period": "string"}, [
            ("json_ld", {"salary_min": base["value"]["minValue"].try_cast("double"),
                         "salary_max": base["value"]["maxValue"].try_cast("double"),
                         "currency": F.upper(base["currency"]), "salary_period": F.lower(base["value"]["unitText"])}),
            ("salary_text", {f: raw[f] for f in in_text}),
            ("benefits_text", {f: benefits[f] for f in in_text})], telling=("salary_min", "salary_max")),
        # The page's own type field isn't used for the employment type (bronze usage policy).
        group("employment_type", {"value": "string"}, [
            ("json_ld", {"value": jp["employmentType"]}), ("section", {"value": _section("Hình thức làm việc")}),
            ("page_text", {"value": _page_line(r"(?:hình thức làm việc|employment type)\s*:\s*([^\n]+)")})]),
        group("posting_date", {"posting_date": "date"}, [
            ("json_ld", {"posting_date": F.try_to_date(jp["datePosted"])}),
            ("page_text", {"posting_date": _day(_page_line(rf"(?:ngày đăng|đăng ngày|posted)(?: on)?\s*:?\s*{_DAY}"))})]),
        group("valid_through", {"valid_through_ts": "timestamp"}, [
            ("structured", {"valid_through_ts": F.try_to_timestamp(jp["validThrough"])}),
            ("explicit_text", {"valid_through_ts": _day(F.regexp_extract(F.coalesce("deadline_raw", F.lit("")), _DAY, 1))}),
            ("relative_text", {"valid_through_ts": enums.deadline(F.lit(None), F.col("deadline_raw"),
                                                                  F.col("ingest_ts"))["valid_through_ts"]})]),
        group("experience", dict.fromkeys(months, "int"), [
            ("json_ld", {months[0]: jp["experienceRequirements"]["monthsOfExperience"].try_cast("int")}),
            ("experience_text", {f: stated[f] for f in months}),
            ("requirements_text", {f: required[f] for f in months})], telling=months[:1]),
        group("location", dict.fromkeys(("city", "district", "ward", "postal_code"), "string"), [
            ("json_ld", _place(address["addressRegion"], part) | {
                "postal_code": address["postalCode"],
                "ward": F.coalesce(_named_part(part, _WARD), F.when(_named_part(locality, _DISTRICT).isNull(), locality))}),
            ("page_text", _place(line, line)), ("page", _place(F.col("location_raw"), F.col("location_raw")))],
            telling=("city",)),
        group("skills", {"skills": "array<string>"}, [
            ("section", {"skills": text.filter_skills(section_skills)}),
            ("page", {"skills": text.filter_skills("skills_raw")}),
            ("requirements_text", {"skills": taxonomy.known_skills(F.array_distinct(words), "hard")})]),
        group("level", {"value": "string"}, [
            ("json_ld", {"value": jp["occupationalCategory"]}), ("section", {"value": _section("Cấp bậc")}),
            ("page", {"value": F.col("level_raw")})]),
        group("openings", {"openings": "int"}, [
            ("json_ld", {"openings": F.regexp_extract(jp["totalJobOpenings"], r"\d+", 0).try_cast("int")}),
            ("section", {"openings": F.regexp_extract(_section("Số lượng tuyển"), r"\d+", 0).try_cast("int")}),
            ("page", {"openings": F.regexp_extract("quantity_raw", r"\d+", 0).try_cast("int")})]),
    ]


SILVER_ORDER = ("ingest_ts", "hash_content")


def silver(b: DataFrame, as_of=None) -> DataFrame:
    """Bronze -> silver: :func:`silver_fields`, then K5 versions and K6 latest
    rows. Bronze is a written table, so the skew-safe day-bucketed prefix scan
    costs one extra sort, not a recomputation."""
    return keys.versioned(silver_fields(b, as_of), order=SILVER_ORDER, bucket=F.col("ingest_date"))


def silver_fields(b: DataFrame, as_of=None) -> DataFrame:
    """Bronze -> silver rows, with the source-priority rules (N10; the sources
    that disagree are in ``conflicts``) and the normalizations N1–N21."""
    # A generator keeps the parsed block as one column: the JSON is read once a row.
    b = b.select("*", F.explode_outer(F.array(job_posting(
        F.coalesce(F.col("json_ld"), F.array().cast("array<string>"))))).alias("_jp"))
    jp = F.col("_jp")
    b = resolution.resolve(b, field_groups(jp))
    r = F.col("resolved")
    section = _section
    emp_raw, level = r["employment_type"]["value"], r["level"]["value"]
    months = r["experience"]["experience_months_min"]
    city = r["location"]["city"]
    skills = r["skills"]["skills"]
    skills = F.coalesce(skills, F.array().cast("array<string>"))
    all_text = F.concat_ws("\n", "description_raw", "requirements_raw", "benefits_raw")
    flags = {k: F.col("quality_issue_flags")[k] for k in
             ("has_json_ld", "has_page_text", "has_structured_salary", "has_valid_posting_date",
              "has_valid_deadline")}
    score, notes = quality_score(flags)
    emp = enums.employment_type(emp_raw)
    out = b.select(
        "job_id", "source", "source_url", "normalized_source_url", "hash_content", "ingest_ts", "ingest_date", "event_ts",
        F.col("job_title_raw").alias("job_title_display"),
        text.clean_title("job_title_raw").alias("job_title"),
        r["company_name"]["value"].alias("company_name"), r["company_name"]["source"].alias("company_name_source"),
        resolution.has_conflict("company_name").alias("company_name_conflict"),
        F.col("company_name_raw").alias("company_name_display"),
        F.array_distinct(F.array_compact(F.array(F.trim("company_name_raw"),
                                                 F.trim(jp["hiringOrganization"]["name"])))).alias("company_aliases"),
        r["salary"]["salary_min"].alias("salary_min"), r["salary"]["salary_max"].alias("salary_max"),
        F.coalesce(r["salary"]["currency"], F.lit("VND")).alias("currency"), r["salary"]["source"].alias("salary_source"),
        resolution.has_conflict("salary").alias("salary_conflict"),
        salary_flags("salary_raw", r["salary"]["salary_period"]).alias("_sf"),
        emp.alias("employment_type"), enums.employment_type_vi(emp).alias("employment_type_vi"),
        r["employment_type"]["source"].alias("employment_type_source"),
        resolution.has_conflict("employment_type").alias("employment_type_conflict"),
        r["posting_date"]["posting_date"].alias("posting_date"), r["posting_date"]["source"].alias("posting_date_source"),
        r["valid_through"]["valid_through_ts"].alias("valid_through_ts"),
        r["valid_through"]["source"].alias("valid_through_source"),
        city.alias("city"), text.city_slug(city).alias("city_slug"),
        r["location"]["district"].alias("district"), r["location"]["ward"].alias("ward"),
        F.concat_ws(", ", r["location"]["ward"], r["location"]["district"], city).alias("location_display"),
        r["location"]["postal_code"].alias("postal_code"), r["location"]["source"].alias("location_source"),
        F.coalesce(jp["jobLocation"]["address"]["addressCountry"], F.lit("VN")).alias("country_code"),
        level.alias("level"), r["level"]["source"].alias("level_source"),
        resolution.has_conflict("level").alias("level_conflict"),
        enums.level_normalized(level).alias("level_normalized"),
        months.alias("experience_months_min"),
        r["experience"]["experience_months_max"].alias("experience_months_max"),
        r["experience"]["source"].alias("experience_source"), F.col("experience_raw").alias("experience_text"),
        enums.experience_bucket(months).alias("experience_bucket"),
        r["openings"]["openings"].alias("openings"), r["openings"]["source"].alias("openings_source"),
        resolution.has_conflict("openings").alias("openings_conflict"),
        skills.alias("skills"), r["skills"]["source"].alias("skills_source"), taxonomy.known_skills(skills, "hard").alias("hard_skills"),
        taxonomy.known_skills(skills, "soft").alias("soft_skills"),
        "skills_raw_count",
        F.get("categories_raw", 0).alias("category_level_1"),
        F.get("categories_raw", 1).alias("category_level_2"),
        F.get("categories_raw", 2).alias("category_level_3"),
        F.get("categories_raw", 0).alias("industry_primary"),
        F.slice(F.coalesce("categories_raw", F.array().cast("array<string>")), 2, 2).alias("industry_secondary"),
        taxonomy.benefit_tags(F.col("benefits_raw")).alias("benefits_tags"),
        taxonomy.weekend_rotation("benefits_raw").alias("requires_weekend_rotation"),
        taxonomy.language_requirements(F.col("requirements_raw")).alias("language_requirements"),
        taxonomy.english_required("requirements_raw").alias("english_required"),
        (F.size(F.array_except(taxonomy.language_requirements(F.col("requirements_raw")), F.array(F.lit("english")))) > 0)
        .alias("other_language_preference"),
        section("Thời gian làm việc").alias("work_schedule_text"),
        section("Học vấn").alias("education_display"), taxonomy.education_min(section("Học vấn")).alias("education_min"),
        text.clean_text("description_raw").alias("description_text"),
        text.clean_text("requirements_raw").alias("requirements_text"),
        text.clean_text("benefits_raw").alias("benefits_text"),
        F.col("conflicts"), score.alias("data_quality_score"), F.filter(F.split(notes, ","), lambda x: x != "").alias("quality_notes"),
        all_text.alias("_all_text"),
    )
    as_of_col = F.lit(as_of).cast("timestamp") if as_of is not None else F.col("ingest_ts")
    return out.select(
        "*", F.col("_sf.is_negotiable").alias("salary_is_negotiable"), F.col("_sf.salary_display").alias("salary_display"),
        F.col("_sf.salary_period").alias("salary_period"),
        (F.size("benefits_tags") > 0).alias("has_benefits"),
        enums.posting_status(F.col("valid_through_ts"), F.col("ingest_ts")).alias("status"),
        keys.deletion_flag(F.col("valid_through_ts"), as_of_col).alias("is_deleted"),
    ).drop("_sf", "_all_text")


def silver_latest(silver_versions: DataFrame) -> DataFrame:
    """K6 latest snapshot of silver."""
    return silver_versions.filter("is_latest").drop("is_latest")


def write_layer(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """SK7: partitioned Parquet with dynamic partition overwrite (only the
    partitions present in ``df`` are replaced)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*partition_by).parquet(path)


def jobs_by_day(latest: DataFrame) -> DataFrame:
    """SK8 (O): the postings of a day, for lookup by day."""
    return latest.select("posting_date", "job_id", "job_title", "company_name", "city", "salary_min", "salary_max")


def jobs_by_skill(latest: DataFrame) -> DataFrame:
    """SK8 (O): the postings that ask for a skill, for lookup by skill."""
    return latest.select(F.explode("skills").alias("skill"), "job_id", "posting_date", "city")


def query_tables(silver_latest_df: DataFrame) -> dict[str, DataFrame]:
    """SK8 (O): lookup projections: by day, by skill, salary by skill-month
    (A8), company by month (A9)."""
    from hirelens.operators import gold
    return {"jobs_by_day": jobs_by_day(silver_latest_df), "jobs_by_skill": jobs_by_skill(silver_latest_df),
            "salary_by_skill_month": gold.salary_stats_by_skill_month(silver_latest_df),
            "company_by_month": gold.company_hiring_by_month(silver_latest_df)}


def silver_coverage(silver_latest_df: DataFrame, by: str = "source") -> DataFrame:
    """A11 over silver: structured salary / company coverage, salary
    disclosed ratio, conflict rate (of the company, and of any field group),
    location parse rate, skill parse confidence (O: kept skills / raw skill
    chips; NULL without chips) and mean quality score."""
    from hirelens.functions.agg import ratio
    s = silver_latest_df
    chips = F.sum("skills_raw_count")
    return s.groupBy(by).agg(
        F.count(F.lit(1)).alias("job_count"),
        ratio(F.col("salary_source") == "json_ld").alias("structured_salary_coverage"),
        ratio(F.col("company_name_source") == "json_ld").alias("structured_company_coverage"),
        ratio(F.col("salary_min").isNotNull()).alias("salary_disclosed_ratio"),
        ratio(F.col("company_name_conflict")).alias("company_conflict_rate"),
        ratio(F.size("conflicts") > 0).alias("conflict_rate"),
        ratio(F.col("city").isNotNull()).alias("location_parse_rate"),
        F.when(chips > 0, F.sum(F.when(F.col("skills_source") == "page", F.size("skills")).otherwise(0)) / chips)
        .alias("skill_parse_confidence"),
        F.avg("data_quality_score").alias("data_quality_coverage"))
