"""Enum, experience, date and status column functions: N8, N9, N11–N14, N24."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.constants import EMPLOYMENT_TYPES, LEVELS
from hirelens.functions.text import let, nfc


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _chain(key: Column, pairs, default=None) -> Column:
    expr = None
    for k, v in pairs:
        cond = key == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def employment_type(col) -> Column:
    """Structured value or Vietnamese label -> one of 6 codes (OTHER when
    unknown). 'Full-time', 'FULL_TIME', 'full time' and 'Toàn thời gian' all
    give FULL_TIME; of a JSON array, the first value counts."""
    def coded(raw: Column) -> Column:
        word = F.regexp_replace(F.upper(F.trim(raw)), r"[^A-Z]+", "_")
        by_code = let(word, lambda code: _chain(code, [(c, c) for c, _ in EMPLOYMENT_TYPES]
                                                + [("FULLTIME", "FULL_TIME"), ("PARTTIME", "PART_TIME"),
                                                   ("CONTRACT", "CONTRACTOR"), ("INTERNSHIP", "INTERN")]))
        by_label = let(F.lower(F.trim(raw)), lambda x: _chain(x, [(lbl.lower(), c) for c, lbl in EMPLOYMENT_TYPES]))
        return F.coalesce(by_code, by_label, F.lit("OTHER"))

    raw = nfc(F.coalesce(_c(col), F.lit("")))
    return let(raw, lambda t: let(F.when(F.trim(t).startswith("["), F.coalesce(F.get(F.from_json(t, "array<string>"), 0), t))
                                  .otherwise(t), coded))


def employment_type_vi(code_col) -> Column:
    """Code -> Vietnamese label."""
    return _chain(_c(code_col), EMPLOYMENT_TYPES, default="Khác")


def level_normalized(col) -> Column:
    """Level label -> code (NULL when not in the table)."""
    return let(F.lower(F.trim(nfc(col))), lambda x: _chain(x, [(k.lower(), v) for k, v in LEVELS]))


def experience_months(col) -> Column:
    """struct(min, max) months. '2 năm' -> (24, NULL), '1-3 năm' ->
    (12, 36), '6 tháng - 2 năm' -> (6, 24), '1.5 năm' -> (18, NULL); no
    requirement -> (0, NULL). A number has its own unit, else the other
    number's, else years."""
    amount = F.lit(r"(\d+(?:[.,]\d+)?)\s*(năm|tháng|year|month)?")

    def months(lt: Column, numbers: Column, units: Column) -> Column:
        low, high = (F.replace(F.get(numbers, k), F.lit(","), F.lit(".")).try_cast("double") for k in (0, 1))
        first, second = (F.when(F.get(units, k).isin("năm", "year"), 12.0).when(F.get(units, k) != "", 1.0) for k in (0, 1))
        years = F.when(~lt.rlike("năm|year") & lt.rlike("tháng|month"), 1.0).otherwise(12.0)
        none = lt.rlike("không yêu cầu|no experience|chưa có kinh nghiệm")
        mn = F.when(none & low.isNull(), F.lit(0)).otherwise(F.round(low * F.coalesce(first, second, years)).cast("int"))
        mx = F.round(high * F.coalesce(second, first, years)).cast("int")
        return F.struct(mn.alias("experience_months_min"), mx.alias("experience_months_max"))

    found = let(F.lower(nfc(F.coalesce(_c(col), F.lit("")))), lambda lt: F.struct(
        lt.alias("lt"), F.regexp_extract_all(lt, amount, 1).alias("numbers"), F.regexp_extract_all(lt, amount, 2).alias("units")))
    return let(found, lambda x: months(x["lt"], x["numbers"], x["units"]))


_AMOUNT = r"(\d+(?:[.,]\d+)?)\s*(năm|tháng|years?|months?)?(?:\s*(?:-|–|đến|to)\s*(\d+(?:[.,]\d+)?)\s*(năm|tháng|years?|months?))?"


def experience_in_text(col) -> Column:
    """N11 for free text (requirements): struct(min, max) months from a number
    of years or months in a phrase about experience ('kinh nghiệm từ 6 tháng
    đến 2 năm', '2-3 years of experience'). Each number has its own unit, or
    that of the range's end; ages, years of graduation and counts give NULLs."""
    return let(F.lower(nfc(F.coalesce(_c(col), F.lit("")))), _experience_in)


def _experience_in(lt: Column) -> Column:
    shapes = [r"(?:kinh nghiệm|experience)[^\d.;,\n]{0,30}" + _AMOUNT,
              _AMOUNT + r"\s*(?:of\s+)?(?:kinh nghiệm|experience)"]
    found = []
    for pattern in shapes:
        part = [F.nullif(F.regexp_extract(lt, pattern, i), F.lit("")) for i in (1, 2, 3, 4)]
        low, high = (F.replace(part[i], F.lit(","), F.lit(".")).try_cast("double") for i in (0, 2))

        def months(unit: Column) -> Column:
            return F.when(unit.rlike("năm|year"), F.lit(12.0)).when(unit.isNotNull(), F.lit(1.0))

        a, b = low * months(F.coalesce(part[1], part[3])), high * months(part[3])
        found.append(F.when(a.isNotNull(), F.struct(
            F.round(F.least(a, F.coalesce(b, a))).cast("int").alias("experience_months_min"),
            F.when(b.isNotNull(), F.round(F.greatest(a, b)).cast("int")).alias("experience_months_max"))))
    none = F.lit(None).cast("int")
    return F.coalesce(*found, F.struct(none.alias("experience_months_min"), none.alias("experience_months_max")))


def experience_bucket(months_col) -> Column:
    """N12 (O): < 24 junior, < 60 mid, else senior; NULL -> unknown."""
    m = _c(months_col)
    return F.when(m.isNull(), F.lit("unknown")).when(m < 24, F.lit("junior")) \
        .when(m < 60, F.lit("mid")).otherwise(F.lit("senior"))


def deadline(structured_col, text_col, ingest_ts_col) -> Column:
    """struct(valid_through_ts, valid_through_source). Structured value
    first, else 'Còn X ngày' counted from the ingest date."""
    ts = F.try_to_timestamp(_c(structured_col))
    days = F.nullif(F.regexp_extract(F.lower(F.coalesce(_c(text_col), F.lit(""))),
                                     r"còn\s+(\d+)\s+ngày", 1), F.lit("")).try_cast("int")
    rel = F.to_timestamp(F.date_add(F.to_date(_c(ingest_ts_col)), days))
    return F.struct(
        F.coalesce(ts, rel).alias("valid_through_ts"),
        F.when(ts.isNotNull(), F.lit("structured")).when(rel.isNotNull(), F.lit("relative_text"))
        .alias("valid_through_source"))


def posting_status(valid_through_col, as_of_col) -> Column:
    """Active when valid_through >= as_of, expired before it, unknown
    without a deadline."""
    v, a = _c(valid_through_col), _c(as_of_col)
    return F.when(v.isNull(), F.lit("unknown")).when(v >= a, F.lit("active")).otherwise(F.lit("expired"))


def date_key(ts_col) -> Column:
    """N24: 'yyyy-MM-dd'."""
    return F.date_format(_c(ts_col), "yyyy-MM-dd")


def month_key(ts_col) -> Column:
    """N24: 'yyyy-MM'."""
    return F.date_format(_c(ts_col), "yyyy-MM")


def week_key(ts_col) -> Column:
    """ISO week 'YYYY-Www' (2026-04-07 -> 2026-W15)."""
    d = F.to_date(_c(ts_col))
    return F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"),
                    F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def time_bucket(ts_col) -> Column:
    """Window start as "yyyy-MM-dd'T'HH:mm:00'Z'" in session UTC."""
    return F.date_format(_c(ts_col), "yyyy-MM-dd'T'HH:mm:00'Z'")
