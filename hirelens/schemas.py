"""Declared schemas. Nothing is inferred: every reader and parser uses these."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
ARR_S = T.ArrayType(T.StringType())


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, S, True) for n in names]


# Queue message columns (the Kafka source shape).
MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", S, True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# Flat raw event: eleven strings.
RAW_EVENT_FIELDS = [
    "job_id", "source", "source_url", "title", "company_name", "salary_text",
    "location_text", "skills_text", "description_text", "event_ts", "ingest_ts",
]
RAW_EVENT = T.StructType(_strings(*RAW_EVENT_FIELDS))

# Crawled payload inside the envelope.
PAYLOAD = T.StructType(
    _strings("domain", "fetch_method", "title", "company_name", "salary", "location",
             "level", "experience", "deadline", "job_type", "quantity", "description",
             "requirements", "benefits")
    + [T.StructField(n, ARR_S, True) for n in
       ("skills", "categories", "requirement_items", "benefit_items", "description_items")]
    + [T.StructField("meta_tags", T.MapType(S, S), True),
       T.StructField("json_ld", ARR_S, True),
       T.StructField("sections_by_heading", T.MapType(S, S), True),
       T.StructField("page_text", S, True)]
)

ENVELOPE = T.StructType(
    _strings("source", "source_url", "normalized_source_url")
    + [T.StructField("crawl_version", T.IntegerType(), True)]
    + _strings("ingest_ts", "event_ts")
    + [T.StructField("payload", PAYLOAD, True)]
)

# Clean event consumed by the realtime aggregator.
CLEAN_EVENT = T.StructType([
    T.StructField("job_id", S, True),
    T.StructField("company_name", S, True),
    T.StructField("city", S, True),
    T.StructField("employment_type", S, True),
    T.StructField("salary_min", T.DoubleType(), True),
    T.StructField("salary_max", T.DoubleType(), True),
    T.StructField("skills", ARR_S, True),
    T.StructField("event_ts", S, True),
])

DEAD_LETTER = T.StructType(_strings(
    "original_topic", "original_message", "error_type", "error_message", "failed_at"))

JOB_DOCUMENT_FIELDS = [
    "job_id", "job_url", "content_hash", "job_title", "company_name", "city",
    "employment_type", "salary_text", "salary_min", "salary_max", "currency", "skills",
    "event_date", "fetched_at",
]

# Historical document contract: required fields.
HISTORICAL_REQUIRED = [
    "job_id", "job_url", "content_hash", "job_title", "company_name", "city",
    "event_date", "fetched_at",
]

# Delimited demo line: job_id|job_title|city
DELIMITED_FIELDS = ["job_id", "job_title", "city"]

# JSON-LD JobPosting block (the fields the silver layer reads).
JOB_POSTING = T.StructType([
    T.StructField("@type", S, True),
    T.StructField("title", S, True),
    T.StructField("datePosted", S, True),
    T.StructField("validThrough", S, True),
    T.StructField("employmentType", S, True),
    T.StructField("occupationalCategory", S, True),
    T.StructField("totalJobOpenings", S, True),
    T.StructField("hiringOrganization", T.StructType(_strings("name")), True),
    T.StructField("baseSalary", T.StructType([
        T.StructField("currency", S, True),
        T.StructField("value", T.StructType(_strings("minValue", "maxValue", "value", "unitText")), True),
    ]), True),
    T.StructField("experienceRequirements", T.StructType(_strings("monthsOfExperience")), True),
    T.StructField("jobLocation", T.StructType([
        T.StructField("address", T.StructType(_strings(
            "streetAddress", "addressLocality", "addressRegion", "postalCode",
            "addressCountry")), True),
    ]), True),
])

# Extracted page record (output of the pages job).
PAGE_RECORD = T.StructType([
    T.StructField("page_id", T.LongType(), True),
    T.StructField("title", S, True),
    T.StructField("company_name", S, True),
    T.StructField("salary", S, True),
    T.StructField("location", S, True),
    T.StructField("level", S, True),
    T.StructField("experience", S, True),
    T.StructField("deadline", S, True),
    T.StructField("job_type", S, True),
    T.StructField("quantity", S, True),
    T.StructField("description", S, True),
    T.StructField("requirements", S, True),
    T.StructField("benefits", S, True),
    T.StructField("description_items", ARR_S, True),
    T.StructField("requirement_items", ARR_S, True),
    T.StructField("benefit_items", ARR_S, True),
    T.StructField("skills", ARR_S, True),
    T.StructField("categories", ARR_S, True),
    T.StructField("meta_tags", T.MapType(S, S), True),
    T.StructField("json_ld", ARR_S, True),
    T.StructField("sections_by_heading", T.MapType(S, S), True),
    T.StructField("page_text", S, True),
    T.StructField("parse_error", S, True),
])
