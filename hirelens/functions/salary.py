"""Salary column functions: N2 (original units + currency), N3 (VND),
N15 (negotiable flag, display, period)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.constants import NEGOTIABLE_WORDS, USD_TO_VND, VND_MILLION
from hirelens.functions.text import let, nfc

NUMBER_TOKEN = r"\d+(?:[.,]\d+)*"
THOUSANDS_TOKEN = r"^\d{1,3}(?:[.,]\d{3})+$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _token_value(tok: Column) -> Column:
    """'1,500,000' / '15.000.000' -> thousands groups read whole; otherwise
    commas are dropped ('1,5' -> 15, '1.5' -> 1.5)."""
    whole = F.replace(F.replace(tok, F.lit(","), F.lit("")), F.lit("."), F.lit(""))
    return F.when(~tok.contains(",") & ~tok.contains("."), tok) \
        .when(tok.rlike(THOUSANDS_TOKEN), whole) \
        .otherwise(F.replace(tok, F.lit(","), F.lit(""))).try_cast("double")


def _negotiable(lt: Column) -> Column:
    cond = F.lit(False)
    for w in NEGOTIABLE_WORDS:
        cond = cond | lt.contains(w)
    return cond


def parse_salary(col) -> Column:
    """Salary text -> struct(salary_min, salary_max, currency).

    NULLs for empty text or a negotiable phrase; USD when the text holds
    'usd' or '$', else VND; two numbers -> (least, greatest); one -> (n, NULL).
    """
    t = F.coalesce(_c(col), F.lit(""))
    nums = F.filter(F.transform(F.regexp_extract_all(t, F.lit(NUMBER_TOKEN), 0), _token_value),
                    lambda x: x.isNotNull())
    none = F.lit(None).cast("double")

    def told(lt: Column, nums: Column) -> Column:
        a, b = F.get(nums, 0), F.get(nums, 1)
        skip = (lt == "") | _negotiable(lt)
        return F.struct(F.when(skip, none).when(b.isNotNull(), F.least(a, b)).otherwise(a).alias("salary_min"),
                        F.when(skip, none).when(b.isNotNull(), F.greatest(a, b)).alias("salary_max"),
                        F.when(lt.contains("usd") | lt.contains("$"), F.lit("USD")).otherwise(F.lit("VND")).alias("currency"))

    # The numbers and the lower text are worked out once; every field comes from the same struct.
    return let(F.struct(F.lower(nfc(t)).alias("lt"), nums.alias("nums")), lambda x: told(x["lt"], x["nums"]))


_TO = r"\s*(?:-|–|đến|tới)\s*"
_UNIT = r"(triệu|tr|vnd|đồng|usd|\$)(?!\p{L})"
_SIGN = r"(\$|usd)\s*"


def salary_in_text(col) -> Column:
    """N2 for free text (benefits, descriptions): only a number with a money
    unit of its own next to it counts ('20 - 35 triệu', '$700 - $1,500',
    '15 triệu'); the first such range or amount is taken. Other numbers (days
    of leave, a 13th month, years) give NULLs."""
    return let(F.lower(nfc(F.coalesce(_c(col), F.lit("")))), _salary_in)


def _salary_in(lt: Column) -> Column:
    num = f"({NUMBER_TOKEN})"
    # (pattern, group of the first number, of the second, of the unit), the most telling first
    shapes = [(f"{_SIGN}{num}{_TO}(?:{_SIGN})?{num}", 2, 4, 1),
              (num + r"\s*(?:triệu|tr|vnd|đồng|usd|\$)?" + _TO + num + r"\s*" + _UNIT, 1, 2, 3),
              (f"{_SIGN}{num}", 2, None, 1),
              (num + r"\s*" + _UNIT, 1, None, 2)]
    found = []
    for pattern, first, second, unit in shapes:
        a = _token_value(F.nullif(F.regexp_extract(lt, pattern, first), F.lit("")))
        b = _token_value(F.nullif(F.regexp_extract(lt, pattern, second), F.lit(""))) if second \
            else F.lit(None).cast("double")
        usd = F.regexp_extract(lt, pattern, unit).isin("usd", "$")
        found.append(F.when(a.isNotNull(), F.struct(
            F.when(b.isNull(), a).otherwise(F.least(a, b)).alias("salary_min"),
            F.when(b.isNotNull(), F.greatest(a, b)).alias("salary_max"),
            F.when(usd, F.lit("USD")).otherwise(F.lit("VND")).alias("currency"))))
    return F.coalesce(*found, F.struct(F.lit(None).cast("double").alias("salary_min"),
                                       F.lit(None).cast("double").alias("salary_max"),
                                       F.lit("VND").alias("currency")))


def salary_vnd(col, usd_rate: int = USD_TO_VND, vnd_unit: int = VND_MILLION) -> Column:
    """struct(salary_min, salary_max) in VND as BIGINT.

    First number and the second number after a non-digit run, times
    ``usd_rate`` when the text holds 'usd', else ``vnd_unit``; max falls back
    to the first number. Overflow gives NULL instead of failing the batch.
    """
    lt = F.lower(F.coalesce(_c(col), F.lit("")))

    def told(lt: Column, runs: Column) -> Column:
        first, second = (F.get(runs, i).try_cast("bigint") for i in (0, 1))
        mult = F.when(lt.contains("usd"), F.lit(usd_rate).cast("bigint")).otherwise(F.lit(vnd_unit).cast("bigint"))
        return F.struct(F.try_multiply(first, mult).alias("salary_min"),
                        F.try_multiply(F.coalesce(second, first), mult).alias("salary_max"))

    # Digit runs are parted by other characters: the second one is the second number.
    return let(F.struct(lt.alias("lt"), F.regexp_extract_all(lt, F.lit(r"\d+"), 0).alias("runs")),
               lambda x: told(x["lt"], x["runs"]))


def salary_flags(text_col, unit_col=None) -> Column:
    """struct(is_negotiable, salary_display, salary_period)."""
    unit = F.lower(F.trim(_c(unit_col))) if unit_col is not None else F.lit(None).cast("string")
    period = F.coalesce(F.nullif(unit, F.lit("")), F.lit("month"))

    def flags(t: Column, lt: Column) -> Column:
        return F.struct((_negotiable(lt) | lt.contains("negotiable")).alias("is_negotiable"),
                        F.when(F.trim(t) == "", F.lit("Thỏa thuận")).otherwise(F.trim(t)).alias("salary_display"),
                        period.alias("salary_period"))

    return let(nfc(F.coalesce(_c(text_col), F.lit(""))), lambda t: let(F.lower(t), lambda lt: flags(t, lt)))
