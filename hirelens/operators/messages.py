"""Message parsing, validation and projections (V1–V7, P1–P4, SK4 split).

Every step is a column expression: no row leaves the JVM, no batch is
collected to the driver. Failed rows carry an ``errors`` array and are routed
to the dead-letter output instead of being dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import schemas
from hirelens.functions import enums, text, urls
from hirelens.functions.salary import parse_salary, salary_vnd

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])


def parse_json(col: Column, schema: T.StructType) -> Column:
    """``from_json`` in PERMISSIVE mode with a corrupt-record column, so that
    malformed text is detectable (a plain ``from_json`` returns a struct of
    NULLs for garbage)."""
    return F.from_json(col, _with_corrupt(schema),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def parsed_columns(parsed: Column) -> Column:
    """Expand a parsed struct into top-level columns through a generator
    (``inline_outer`` of a one-element array).

    Downstream filters on the parsed fields cannot be pushed below a
    generator, so the JSON text is parsed once per row; pushed through a
    plain projection, every reference would re-run ``from_json``."""
    return F.inline_outer(F.array(parsed))


def parse_messages(df: DataFrame, schema: T.StructType = schemas.RAW_EVENT,
                   ingest_time: Column | None = None) -> DataFrame:
    """V1: cast key / value, keep the queue metadata, parse the JSON value,
    flag ``is_parse_ok`` and stamp the validation time (``ingest_time``;
    defaults to the processing time, batch callers pass a column)."""
    meta = ["kafka_key", "raw_json", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_ts"]
    parsed = df.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_ts"),
    ).select(*meta, parsed_columns(parse_json(F.col("raw_json"), schema)))
    ok = F.col("raw_json").isNotNull() & F.col(CORRUPT).isNull()
    return parsed.select(
        *meta, ok.alias("is_parse_ok"), *[F.col(f.name) for f in schema.fields],
    ).withColumn("validated_ingest_ts", ingest_time if ingest_time is not None else F.current_timestamp())


def clean_events(df: DataFrame) -> DataFrame:
    """V5: parsed rows with a job_id; event_ts falls back to the queue time,
    ingest_ts to the validation time; text fields trimmed with '' /
    'unknown' defaults; rows without event time dropped. Bad timestamps give
    NULL (``try_to_timestamp``), never a failed batch."""
    out = df.filter(F.col("is_parse_ok") & F.col("job_id").isNotNull())
    out = out.withColumn("event_ts", F.coalesce(F.try_to_timestamp("event_ts"), F.col("kafka_ts"))) \
        .withColumn("ingest_ts", F.coalesce(F.try_to_timestamp("ingest_ts"), F.col("validated_ingest_ts")))
    defaults = {"title": "", "company_name": "", "location_text": "unknown", "salary_text": "",
                "skills_text": "", "description_text": "", "source": "unknown"}
    for c, d in defaults.items():
        out = out.withColumn(c, F.trim(F.coalesce(F.col(c), F.lit(d))))
    return out.filter(F.col("event_ts").isNotNull())


NORMALIZED_FIELDS = ["job_id", "source", "source_url", "job_title", "company_name", "salary_text",
                     "salary_min", "salary_max", "location_text", "location_city", "skills_text",
                     "skills", "description_text", "event_ts", "ingest_ts", "raw_json"]


def normalize_events(df: DataFrame) -> DataFrame:
    """P4 live-layer normalization: city (exact rule), VND salary (N3),
    skills (N4), company initcap, source lower; final 16-column select."""
    vnd = salary_vnd("salary_text")
    return df.select(
        "job_id", text.source_case("source").alias("source"), "source_url",
        F.col("title").alias("job_title"), text.company_case("company_name").alias("company_name"),
        "salary_text", vnd["salary_min"].alias("salary_min"), vnd["salary_max"].alias("salary_max"),
        "location_text", text.normalize_city("location_text", "exact").alias("location_city"),
        "skills_text", text.split_skills("skills_text").alias("skills"),
        "description_text", "event_ts", "ingest_ts", "raw_json")


def parse_envelope(df: DataFrame) -> DataFrame:
    """V2: envelope JSON -> job_id (message key), urls, times, payload.
    Rows whose envelope does not parse or has no source_url are kept with an
    error so that they reach the dead-letter output."""
    p = df.select(F.col("key").cast("string").alias("kafka_key"),
                  F.col("value").cast("string").alias("raw_json"),
                  F.col("timestamp").alias("kafka_ts"), F.col("topic").alias("kafka_topic")) \
        .withColumn("env", parse_json(F.col("raw_json"), schemas.ENVELOPE))
    bad = F.col("env").isNull() | F.col(f"env.{CORRUPT}").isNotNull()
    return p.select(
        F.col("kafka_key").alias("job_id"), "kafka_topic", "kafka_ts", "raw_json",
        F.col("env.source").alias("source"),
        F.col("env.source_url").alias("source_url"),
        F.col("env.normalized_source_url").alias("normalized_source_url"),
        F.col("env.ingest_ts").alias("ingest_ts"),
        F.col("env.event_ts").alias("event_ts"),
        F.col("env.payload").alias("payload"),
        F.when(bad, F.lit("PARSE_ERROR"))
        .when(F.col("env.source_url").isNull(), F.lit("MISSING_SOURCE_URL")).alias("envelope_error"),
    )


def parse_clean(df: DataFrame, value_col: str = "value") -> DataFrame:
    """V3: clean-event JSON -> columns; event_time from event_ts, else the
    message time (replay-stable, unlike the wall clock); NULL job_id dropped."""
    p = df.select(F.col(value_col).cast("string").alias("raw_json"),
                  F.col("timestamp").alias("kafka_ts"))
    return p.select(parsed_columns(parse_json(F.col("raw_json"), schemas.CLEAN_EVENT)), "kafka_ts") \
        .withColumn("event_time", F.coalesce(F.try_to_timestamp("event_ts"), F.col("kafka_ts"))) \
        .filter(F.col("job_id").isNotNull() & F.col(CORRUPT).isNull()).drop("kafka_ts", CORRUPT)


def parse_clean_all(df: DataFrame, value_col: str = "value") -> DataFrame:
    """V3 without dropping rows: the columns of :func:`parse_clean`, and
    ``raw_json``, ``topic``, ``errors`` (empty for good rows) and ``ok``."""
    p = df.select(F.col(value_col).cast("string").alias("raw_json"), F.col("topic").cast("string").alias("topic"),
                  F.col("timestamp").alias("kafka_ts"))
    p = p.select("raw_json", "topic", "kafka_ts", parsed_columns(parse_json(F.col("raw_json"), schemas.CLEAN_EVENT)))
    bad = F.col("raw_json").isNull() | F.col(CORRUPT).isNotNull()
    errors = error_array((bad, "PARSE_ERROR"), (~bad & F.col("job_id").isNull(), "job_id missing"))
    return p.withColumns({"event_time": F.coalesce(F.try_to_timestamp("event_ts"), F.col("kafka_ts")), "errors": errors}) \
        .withColumn("ok", F.size("errors") == 0).drop("kafka_ts", CORRUPT)


def clean_failures(parsed: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """SK4 rows of :func:`parse_clean_all`."""
    return _failed(parsed, F.col("topic"), F.col("raw_json"), F.col("errors"), failed_at)


def _failed(df: DataFrame, topic: Column, raw: Column, errors: Column, failed_at: Column | None) -> DataFrame:
    """SK4 rows of those with an error."""
    fa = failed_at if failed_at is not None else F.current_timestamp()
    return df.withColumn("_errors", errors).filter(F.size("_errors") > 0).select(
        topic.cast("string").alias("original_topic"), raw.alias("original_message"),
        F.when(F.array_contains("_errors", "PARSE_ERROR"), F.lit("PARSE_ERROR"))
        .otherwise(F.lit("VALIDATION_ERROR")).alias("error_type"),
        F.array_join("_errors", "; ").alias("error_message"), fa.cast("string").alias("failed_at"))


def event_dead_letters(parsed: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """SK4 for stream A: what :func:`clean_events` leaves out of parsed
    messages, and why."""
    time = F.coalesce(F.try_to_timestamp("event_ts"), F.col("kafka_ts"))
    errors = error_array((~F.col("is_parse_ok"), "PARSE_ERROR"),
                         (F.col("is_parse_ok") & F.col("job_id").isNull(), "job_id missing"),
                         (F.col("is_parse_ok") & time.isNull(), "event time missing"))
    return _failed(parsed, F.col("kafka_topic"), F.col("raw_json"), errors, failed_at)


def clean_dead_letters(df: DataFrame, value_col: str = "value", failed_at: Column | None = None) -> DataFrame:
    """SK4 for stream C: clean-event messages that don't parse or have no
    job_id, which :func:`parse_clean` leaves out."""
    p = df.select(F.col(value_col).cast("string").alias("raw_json"),
                  (F.col("topic") if "topic" in df.columns else F.lit(None)).alias("_topic"))
    p = p.select("raw_json", "_topic", parsed_columns(parse_json(F.col("raw_json"), schemas.CLEAN_EVENT)))
    bad = F.col("raw_json").isNull() | F.col(CORRUPT).isNotNull()
    errors = error_array((bad, "PARSE_ERROR"), (~bad & F.col("job_id").isNull(), "job_id missing"))
    return _failed(p, F.col("_topic"), F.col("raw_json"), errors, failed_at)


def parse_delimited(df: DataFrame, col: str = "value", sep: str = "|",
                    names=tuple(schemas.DELIMITED_FIELDS)) -> DataFrame:
    """V4: positional split; a missing field is NULL (``get``), not an
    error; the raw text is kept."""
    raw = F.col(col).cast("string")
    parts = F.split(raw, "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep)
    return df.select(*[F.get(parts, i).alias(n) for i, n in enumerate(names)], raw.alias("raw_value"))


def error_array(*checks: tuple[Column, str]) -> Column:
    """Collect failed checks into an array column (empty when all pass)."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(msg)) for cond, msg in checks]))


def validate_required(df: DataFrame, cols=("title",), prefix: str = "payload.") -> DataFrame:
    """V6: required text fields must be non-empty; failures -> ``errors``."""
    checks = [(F.coalesce(F.col(prefix + c), F.lit("")) == "", f"{prefix}{c} empty") for c in cols]
    return df.withColumn("errors", error_array(*checks))


def document_contract_errors(df: DataFrame, required=tuple(schemas.HISTORICAL_REQUIRED)) -> DataFrame:
    """V7: historical document contract: required fields present, event_date
    is yyyy-MM-dd; the missing list is reported."""
    checks = [(F.col(c).isNull() | (F.col(c).cast("string") == ""), f"missing:{c}") for c in required]
    checks.append((F.col("event_date").isNotNull()
                   & ~F.col("event_date").cast("string").rlike(r"^\d{4}-\d{2}-\d{2}$"), "bad_format:event_date"))
    return df.withColumn("contract_errors", error_array(*checks))


def to_flat_event(df: DataFrame, crawled_at: Column | str = "crawled_at",
                  ingest_ts: Column | str = "ingest_ts", keep=()) -> DataFrame:
    """Crawled payload -> 11-string flat event. job_id = md5(url); source
    = domain without 'www.'; skills joined with ', '; description +
    requirements + benefits under headings; NULL -> ''."""
    def s(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    desc = F.concat(
        s("description"),
        F.when(s("requirements") != "", F.concat(F.lit("\n\nYêu cầu công việc:\n"), s("requirements")))
        .otherwise(F.lit("")),
        F.when(s("benefits") != "", F.concat(F.lit("\n\nQuyền lợi:\n"), s("benefits"))).otherwise(F.lit("")))
    ca = F.col(crawled_at) if isinstance(crawled_at, str) else crawled_at
    it = F.col(ingest_ts) if isinstance(ingest_ts, str) else ingest_ts
    return df.select(
        *keep,
        urls.legacy_job_id(s("source_url")).alias("job_id"),
        urls.source_from_domain(s("domain")).alias("source"),
        s("source_url").alias("source_url"), s("title").alias("title"),
        s("company_name").alias("company_name"), s("salary").alias("salary_text"),
        s("location").alias("location_text"),
        F.coalesce(F.array_join("skills", ", "), F.lit("")).alias("skills_text"),
        text.strip_ws(desc).alias("description_text"),
        F.coalesce(ca.cast("string"), F.lit("")).alias("event_ts"),
        F.coalesce(it.cast("string"), F.lit("")).alias("ingest_ts"))


def to_envelope(df: DataFrame, source: str, now: Column | None = None) -> DataFrame:
    """Payload -> envelope (constant source, normalized URL, crawl
    version 1, ingest_ts = event_ts = ``now``) plus the K2 message key."""
    ts = (now if now is not None else F.current_timestamp()).cast("string")
    env = F.struct(F.lit(source).alias("source"), F.col("source_url"),
                   urls.normalize_url("source_url").alias("normalized_source_url"),
                   F.lit(1).alias("crawl_version"), ts.alias("ingest_ts"), ts.alias("event_ts"),
                   F.col("payload"))
    return df.select(urls.job_id(F.lit(source), "source_url").alias("key"), env.alias("envelope"))


def consumer_transform(env: DataFrame) -> DataFrame:
    """Stream B row transform as columns: validation (V6), salary (N2), city
    (N1), skills (N5), employment type (N8), content hash (K3). Adds the
    ``errors`` array used to split good rows from dead letters."""
    pl = "payload"
    sal = parse_salary(F.col(f"{pl}.salary"))
    errs = F.concat(
        F.when(F.col("envelope_error").isNotNull(), F.array(F.col("envelope_error")))
        .otherwise(F.array().cast("array<string>")),
        error_array((F.col("envelope_error").isNull()
                     & (F.coalesce(F.col(f"{pl}.title"), F.lit("")) == ""), "payload.title empty")))
    return env.select(
        "job_id", "kafka_topic", "raw_json", "kafka_ts",
        F.col("source_url").alias("job_url"),
        urls.content_hash(F.col(f"{pl}.title"), F.col(f"{pl}.company_name"), F.col(f"{pl}.location"),
                          F.col(f"{pl}.salary"), F.col(f"{pl}.requirements")).alias("content_hash"),
        F.col(f"{pl}.title").alias("job_title"),
        F.coalesce(F.col(f"{pl}.company_name"), F.lit("")).alias("company_name"),
        text.normalize_city(F.col(f"{pl}.location")).alias("city"),
        enums.employment_type(F.col(f"{pl}.job_type")).alias("employment_type"),
        F.coalesce(F.col(f"{pl}.salary"), F.lit("")).alias("salary_text"),
        sal["salary_min"].alias("salary_min"), sal["salary_max"].alias("salary_max"),
        sal["currency"].alias("currency"),
        text.filter_skills(F.col(f"{pl}.skills")).alias("skills"),
        F.substring(F.coalesce(F.col("event_ts"), F.lit("")), 1, 10).alias("event_date"),
        F.coalesce(F.col("event_ts"), F.col("kafka_ts").cast("string")).alias("event_ts"),
        F.coalesce(F.col("ingest_ts"), F.col("kafka_ts").cast("string")).alias("fetched_at"),
        errs.alias("errors"))


def job_documents(tr: DataFrame) -> DataFrame:
    """Good rows -> the 14-column job document."""
    return tr.filter(F.size("errors") == 0).select(*schemas.JOB_DOCUMENT_FIELDS)


def dead_letters(tr: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """SK4 rows: failed rows with error type / message and the original text."""
    return _failed(tr, F.col("kafka_topic"), F.col("raw_json"), F.col("errors"), failed_at)
