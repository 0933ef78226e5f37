"""The ``J`` view: job postings over the driver tables.

lineitem x orders x part x supplier x nation. (l_orderkey, l_linenumber) is
the business key; repeated keys are versions of one posting. The same view is
written once as DataFrame code (the job) and once as SQL (the oracle).

| column | from |
|---|---|
| job_id | sha256(l_orderkey '-' l_linenumber) |
| ingest_ts | l_shipdate (ties: l_partkey, l_suppkey, l_extendedprice, l_quantity) |
| hash_content | sha256(p_name, s_name, n_name, price as DECIMAL(12,2)) |
| company_name, city, job_title | s_name, n_name, p_name |
| level_raw | o_orderpriority as a level label; level_normalized by N9 |
| employment_type | l_returnflag as a raw label; code by N8 |
| category_level_1..3 | p_type, p_brand, p_size |
| skills | words of lower(p_name) and lower(p_type) |
| salary_min / max | l_extendedprice, l_extendedprice * (1 + l_tax) cut to the cent; NULL when l_discount >= 0.09 |
| posting_date | o_orderdate as date |
| experience_months_min | p_size * 3 |
| english_required / has_benefits | l_linestatus = 'O' / l_quantity >= 25 |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions import enums
from hirelens.operators.keys import latest_flag, versioned
from hirelens.sinks.commits import remove
from hirelens.sinks.steps import written
from hirelens.sources.tables import read_table

ORDER_COLS = ("ingest_ts", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")

# Synthetic raw labels of the view (a fixed part of its definition).
PRIORITY_LEVEL = [("1-URGENT", "Giám đốc"), ("2-HIGH", "Quản lý"), ("3-MEDIUM", "Trưởng nhóm"),
                  ("4-NOT SPECIFIED", "Chuyên viên"), ("5-LOW", "Nhân viên")]
RETURNFLAG_EMPLOYMENT = [("A", "Full-time"), ("N", "Bán thời gian"), ("R", "contract")]


def _case(col, pairs):
    expr = None
    for k, v in pairs:
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


def _job_id(orderkey, linenumber):
    return F.sha2(F.concat(orderkey.cast("string"), F.lit("-"), linenumber.cast("string")), 256)


def _content():
    """The fields hashed into hash_content (equal struct <=> equal hash)."""
    return F.struct("p_name", "s_name", "n_name", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _jobs(spark, sf_dir, keyed=True)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def _of_line() -> dict[str, Column]:
    """The view's columns that lineitem and orders give."""
    undisclosed = F.col("l_discount") >= 0.09
    level_raw = _case(F.col("o_orderpriority"), PRIORITY_LEVEL)
    emp_raw = _case(F.col("l_returnflag"), RETURNFLAG_EMPLOYMENT)
    return {
        "source": F.lit("tpch"),
        "ingest_ts": F.col("l_shipdate"),
        "level_raw": level_raw,
        "level_normalized": enums.level_normalized(level_raw),
        "employment_type": enums.employment_type(emp_raw),
        "status": F.col("o_orderstatus"),
        "salary_min": F.when(undisclosed, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice")),
        "salary_max": F.when(undisclosed, F.lit(None).cast("double"))
        .otherwise(F.floor(F.col("l_extendedprice") * (F.lit(1.0) + F.col("l_tax")) * 100) / 100),
        "posting_date": F.col("o_orderdate").cast("date"),
        "english_required": F.col("l_linestatus") == "O",
        "has_benefits": F.col("l_quantity") >= 25,
    }


def _of_part_and_supplier() -> dict[str, Column]:
    """The view's columns that part, supplier and nation give."""
    return {
        "company_name": F.col("s_name"),
        "city": F.col("n_name"),
        "job_title": F.col("p_name"),
        "category_level_1": F.col("p_type"),
        "category_level_2": F.col("p_brand"),
        "category_level_3": F.col("p_size").cast("string"),
        "experience_months_min": F.col("p_size") * 3,
    }


_COLUMNS = ("source", "ingest_ts", "company_name", "city", "job_title", "level_raw", "level_normalized",
            "employment_type", "status", "category_level_1", "category_level_2", "category_level_3",
            "salary_min", "salary_max", "posting_date", "experience_months_min", "english_required", "has_benefits")


def _jobs(spark: SparkSession, sf_dir: str, keyed: bool) -> DataFrame:
    """J rows. ``keyed=False`` leaves out the two sha256 columns and keeps the
    integer key and the content struct instead (they are equivalent), so a
    shuffle / sort by key moves integers, not 64-character strings. It leaves
    out ``skills``, too: :func:`_skilled` gives them."""
    li, o = _lines(spark, sf_dir), _orders(spark, sf_dir)
    p, s = _parts(spark, sf_dir), _suppliers(spark, sf_dir)
    # nation is 25 rows by definition: a proven size bound, so broadcast.
    n = F.broadcast(_nations(spark, sf_dir))
    # part / supplier / orders: Spark picks broadcast vs. shuffle from size
    # statistics (autoBroadcastJoinThreshold) and AQE re-plans at runtime.
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(p, li.l_partkey == p.p_partkey)
         .join(s, li.l_suppkey == s.s_suppkey)
         .join(n, s.s_nationkey == n.n_nationkey))
    if keyed:
        ident = [_job_id(F.col("l_orderkey"), F.col("l_linenumber")).alias("job_id"),
                 F.sha2(F.concat_ws("|", "p_name", "s_name", "n_name",
                                    F.col("l_extendedprice").cast("decimal(12,2)").cast("string")), 256)
                 .alias("hash_content")]
    else:
        ident = ["l_orderkey", "l_linenumber", _content().alias("_content")]
    of = _of_line() | _of_part_and_supplier()
    rows = j.select(*ident, *[of[c].alias(c) for c in _COLUMNS], "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    return _skilled(rows) if keyed else rows


def _skilled(rows: DataFrame) -> DataFrame:
    """J rows with ``skills``, made of two texts of the row: a shuffle or sort
    before needn't move them."""
    return rows.withColumn("skills", F.split(F.concat(F.lower("job_title"), F.lit(" "), F.lower("category_level_1")), " "))


_IDENT = ("l_orderkey", "l_linenumber", "_content")


def _posting():
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def _sha():
    c = F.col("_content")
    return F.sha2(F.concat_ws("|", c["p_name"], c["s_name"], c["n_name"], c["price"].cast("string")), 256)


def _narrowed(rows: DataFrame) -> DataFrame:
    """``posting``, the text that job_id is the hash of, and ``content``, the
    bytes of hash_content, for the integer key and the content struct: rows to
    store and shuffle. :func:`named` gives the view's two columns for them."""
    return rows.select(_posting().alias("posting"), F.unhex(_sha()).alias("content"),
                       *[x for x in rows.columns if x not in _IDENT])


def jobs_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J rows with ``posting`` and ``content`` (:func:`_narrowed`)."""
    return _narrowed(_skilled(_jobs(spark, sf_dir, keyed=False)))


_NAMES = ("job_title", "company_name", "city")


def jobs_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J rows with ``posting`` and, in place of ``content``, the texts that it
    is made of: rows to store. :func:`narrow_of` gives ``content`` for them."""
    rows = _jobs(spark, sf_dir, keyed=False)
    return rows.select(_posting().alias("posting"), *[x for x in rows.columns if x not in _IDENT])


def narrow_of(rows: DataFrame) -> DataFrame:
    """``posting`` and ``content`` (:func:`_narrowed`) for :func:`jobs_texts`."""
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    content = F.unhex(F.sha2(F.concat_ws("|", *_NAMES, price), 256))
    return rows.select("posting", content.alias("content"), *[x for x in rows.columns if x not in ("posting", *_NAMES)])


def named(narrow: DataFrame) -> DataFrame:
    """``job_id`` and ``hash_content`` for ``posting`` and ``content``."""
    return narrow.select(F.sha2("posting", 256).alias("job_id"), F.lower(F.hex("content")).alias("hash_content"),
                         *[c for c in narrow.columns if c not in ("posting", "content")])


def jobs_numbered(spark: SparkSession, sf_dir: str, split_by_day: bool = False) -> DataFrame:
    """J with K5 record_version and the K6 latest flag (one window pass), by
    the integer key (l_orderkey, l_linenumber) and with the content struct.

    ``split_by_day`` runs the count as a prefix scan over ingest days (no
    single task holds a hot job_id's history). It reads its input twice, so
    on this lazy view it recomputes the upstream joins (2-2.5x at sf0.1);
    the medallion silver job, whose input is a written table, uses it."""
    bucket = F.to_date("ingest_ts") if split_by_day else None
    return versioned(_jobs(spark, sf_dir, keyed=False), key=["l_orderkey", "l_linenumber"], order=ORDER_COLS,
                     hash_col="_content", bucket=bucket)


def hashed(numbered: DataFrame) -> DataFrame:
    """``job_id`` and ``hash_content`` for the integer key and the content
    struct: the sha256 strings are computed after the shuffle."""
    return numbered.select(F.sha2(_posting(), 256).alias("job_id"), _sha().alias("hash_content"),
                           *[x for x in numbered.columns if x not in _IDENT])


def jobs_versioned(spark: SparkSession, sf_dir: str, split_by_day: bool = False, narrow: bool = False) -> DataFrame:
    """:func:`jobs_numbered` with job_id and hash_content, or ``narrow``."""
    v = _skilled(jobs_numbered(spark, sf_dir, split_by_day))
    return _narrowed(v) if narrow else hashed(v)


def jobs_latest(spark: SparkSession, sf_dir: str, narrow: bool = False) -> DataFrame:
    """J_latest: K6 over J, one row per job_id."""
    return jobs_versioned(spark, sf_dir, narrow=narrow).filter("is_latest").drop("is_latest")


def _having(lines: DataFrame, key: str, table: DataFrame, table_key: str, path: str) -> DataFrame:
    """The lines whose key the table has. The keys that it lacks, as a rule few
    or none, are stored: the lines needn't be dealt by this key to be rid of them."""
    lacking = lines.select(key).distinct().join(table, F.col(key) == F.col(table_key), "left_anti")
    return lines.where(F.col(key).isNotNull()).join(written(lacking, path), key, "left_anti")


def _one_each(table: DataFrame, key: str) -> DataFrame:
    """One row a key: rows of a line that differ in no order column are the
    same version of its posting, and one of them is the latest."""
    return table.groupBy(key).agg(F.max(F.struct(*[c for c in table.columns if c != key])).alias("_row")).select(key, "_row.*")


def jobs_latest_stored(spark: SparkSession, sf_dir: str, path: str, *columns: str) -> DataFrame:
    """These columns of :func:`jobs_latest`, stored below ``path``. Which line
    is a posting's latest one is found by lineitem's own columns, among those
    that have an order, a part and a supplier; the texts of part and supplier
    only come to the latest lines. Each step is stored and the shuffle files of
    the one before are gone by then."""
    li, o = _lines(spark, sf_dir), _orders(spark, sf_dir)
    p, n = _parts(spark, sf_dir), _nations(spark, sf_dir)
    s = _suppliers(spark, sf_dir).join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    lines = _having(li, "l_partkey", p, "p_partkey", f"{path}/without_part")
    lines = _having(lines, "l_suppkey", s, "s_suppkey", f"{path}/without_supplier")
    j = lines.join(o, lines.l_orderkey == o.o_orderkey).withColumn("ingest_ts", F.col("l_shipdate"))
    j = j.withColumn("is_latest", latest_flag(["l_orderkey", "l_linenumber"], ORDER_COLS)).where("is_latest")
    of_line = {c: v for c, v in _of_line().items() if c in columns}
    latest = written(j.select("l_partkey", "l_suppkey", *[v.alias(c) for c, v in of_line.items()]), f"{path}/lines")
    p, s, n = _one_each(p, "p_partkey"), _one_each(s, "s_suppkey"), F.broadcast(_one_each(n, "n_nationkey"))
    j = (latest.join(p, latest.l_partkey == p.p_partkey)
         .join(s, latest.l_suppkey == s.s_suppkey)
         .join(n, s.s_nationkey == n.n_nationkey))
    rows = _skilled(j.select(*of_line, *[v.alias(c) for c, v in _of_part_and_supplier().items()])).select(*columns)
    rows = written(rows, f"{path}/rows")
    remove(spark, f"{path}/lines")
    return rows


# ---------------------------------------------------------------- oracle SQL

J_SQL = """
j AS (
  SELECT sha256(CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)) AS job_id,
         'tpch' AS source,
         l.l_shipdate AS ingest_ts,
         sha256(p.p_name || '|' || s.s_name || '|' || n.n_name || '|'
                || CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)) AS hash_content,
         s.s_name AS company_name,
         n.n_name AS city,
         p.p_name AS job_title,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'director' WHEN '2-HIGH' THEN 'manager'
              WHEN '3-MEDIUM' THEN 'lead' WHEN '4-NOT SPECIFIED' THEN 'specialist'
              WHEN '5-LOW' THEN 'staff' END AS level_normalized,
         CASE l.l_returnflag WHEN 'A' THEN 'FULL_TIME' WHEN 'N' THEN 'PART_TIME'
              WHEN 'R' THEN 'CONTRACTOR' ELSE 'OTHER' END AS employment_type,
         o.o_orderstatus AS status,
         p.p_type AS category_level_1,
         p.p_brand AS category_level_2,
         CAST(p.p_size AS VARCHAR) AS category_level_3,
         string_split(lower(p.p_name) || ' ' || lower(p.p_type), ' ') AS skills,
         CASE WHEN l.l_discount >= 0.09 THEN NULL ELSE l.l_extendedprice END AS salary_min,
         CASE WHEN l.l_discount >= 0.09 THEN NULL ELSE floor(l.l_extendedprice * (1.0 + l.l_tax) * 100) / 100 END AS salary_max,
         CAST(o.o_orderdate AS DATE) AS posting_date,
         p.p_size * 3 AS experience_months_min,
         l.l_linestatus = 'O' AS english_required,
         l.l_quantity >= 25 AS has_benefits,
         l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
),
jv0 AS (
  SELECT *, CASE WHEN lag(hash_content) OVER w IS NOT NULL AND hash_content <> lag(hash_content) OVER w
                 THEN 1 ELSE 0 END AS chg,
         lead(1) OVER w IS NULL AS is_latest
  FROM j
  WINDOW w AS (PARTITION BY job_id ORDER BY ingest_ts, l_partkey, l_suppkey, l_extendedprice, l_quantity)
),
jv AS (
  SELECT * EXCLUDE (chg),
         CAST(1 + sum(chg) OVER (PARTITION BY job_id ORDER BY ingest_ts, l_partkey, l_suppkey,
              l_extendedprice, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER)
           AS record_version
  FROM jv0
),
jl AS (SELECT * EXCLUDE (is_latest) FROM jv WHERE is_latest)
"""


def with_j(sql_body: str) -> str:
    """Prefix an oracle query with the J / J_versioned / J_latest CTEs."""
    return "WITH " + J_SQL + sql_body
