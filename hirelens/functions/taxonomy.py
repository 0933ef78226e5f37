"""Dictionaries for skills, benefits and languages.

The reference names these taxonomies but does not list them; the entries
below are our own (O). Each is a small fixed table: its size does not grow
with the data, so joining it by broadcast is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions.text import let, nfc

HARD_SKILLS = [
    "python", "java", "javascript", "typescript", "sql", "spark", "kafka", "hadoop", "airflow",
    "docker", "kubernetes", "aws", "azure", "gcp", "linux", "git", "react", "node.js", "golang",
    "c++", "c#", ".net", "php", "excel", "power bi", "tableau", "machine learning", "etl",
    "postgresql", "mysql", "mongodb", "redis", "elasticsearch", "cassandra", "scala", "r",
]
SOFT_SKILLS = [
    "communication", "teamwork", "leadership", "problem solving", "english", "tiếng anh",
    "giao tiếp", "làm việc nhóm", "quản lý thời gian", "time management",
]

BENEFIT_TAGS = [
    ("social_insurance", ["bảo hiểm xã hội", "bhxh", "social insurance"]),
    ("training", ["đào tạo", "training"]),
    ("team_building", ["team building", "teambuilding", "du lịch công ty"]),
    ("travel", ["du lịch", "travel"]),
    ("bonus_13th_month", ["tháng 13", "lương tháng 13", "13th month"]),
]
# Patterns are matched against lower-cased text (no engine-specific flags).
ENGLISH_PATTERN = "(tiếng anh|english|toeic|ielts)"
WEEKEND_PATTERN = "(thứ 7|thứ bảy|cuối tuần|weekend|saturday)"
LANGUAGE_PATTERNS = [("english", ENGLISH_PATTERN), ("japanese", "(tiếng nhật|japanese|jlpt)"),
                     ("korean", "(tiếng hàn|korean|topik)"), ("chinese", "(tiếng trung|chinese|hsk)")]


def skill_taxonomy(spark: SparkSession) -> DataFrame:
    rows = [(s, "hard") for s in HARD_SKILLS] + [(s, "soft") for s in SOFT_SKILLS]
    return spark.createDataFrame(rows, "skill_key string, skill_kind string")


def split_skills_by_taxonomy(df: DataFrame, key: str, skills_col: str, taxonomy: DataFrame,
                             fixed_size: bool = True) -> DataFrame:
    """Keep skills found in the taxonomy (case-insensitive), split into
    hard / soft lists in their original order. explode -> join with the
    taxonomy (broadcast when it is a fixed-size table; otherwise Spark picks
    the strategy from its size) -> re-aggregate by key (``collect_list`` over
    one posting's skills, bounded by its chip count)."""
    ex = df.select(key, F.posexplode(skills_col).alias("pos", "skill")) \
        .withColumn("skill_key", F.lower(F.trim("skill")))
    j = ex.join(F.broadcast(taxonomy) if fixed_size else taxonomy, "skill_key", "inner")
    agg = j.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("pos", "skill", "skill_kind"))).alias("_s"))
    agg = agg.select(key,
                     F.transform("_s", lambda s: s["skill"]).alias("skills_taxonomy"),
                     F.transform(F.filter("_s", lambda s: s["skill_kind"] == "hard"), lambda s: s["skill"])
                     .alias("hard_skills"),
                     F.transform(F.filter("_s", lambda s: s["skill_kind"] == "soft"), lambda s: s["skill"])
                     .alias("soft_skills"))
    empty = F.array().cast("array<string>")
    out = df.join(agg, key, "left")
    for c in ("skills_taxonomy", "hard_skills", "soft_skills"):
        out = out.withColumn(c, F.coalesce(F.col(c), empty))
    return out


# Degrees from the lowest on (O): (code, pattern on lower-cased text).
EDUCATION_PATTERNS = [("high_school", "(trung học|thpt|high school)"), ("intermediate", "(trung cấp|intermediate)"),
                      ("college", "(cao đẳng|college)"), ("bachelor", "(đại học|cử nhân|bachelor|university)"),
                      ("master", "(thạc sĩ|master)"), ("doctor", "(tiến sĩ|phd|doctor)")]


def education_min(text_col) -> Column:
    """The lowest degree that the text names (NULL: none)."""
    return let(_lower(text_col), lambda t: F.coalesce(*[F.when(t.rlike(p), F.lit(code)) for code, p in EDUCATION_PATTERNS]))


def known_skills(skills: Column, kind: str) -> Column:
    """N18 on one row: the skills of the fixed taxonomy of this kind, in order."""
    words = F.array(*[F.lit(w) for w in (HARD_SKILLS if kind == "hard" else SOFT_SKILLS)])
    return F.filter(skills, lambda x: F.array_contains(words, F.lower(F.trim(x))))


def benefit_tags(text_col) -> Column:
    """Benefit tags whose keywords occur in the (lower-cased) text."""
    def tags(t: Column) -> Column:
        found = []
        for tag, words in BENEFIT_TAGS:
            cond = F.lit(False)
            for w in words:
                cond = cond | t.contains(w)
            found.append(F.when(cond, F.lit(tag)))
        return F.array_compact(F.array(*found))

    return let(_lower(text_col), tags)


def _lower(text_col) -> Column:
    return F.lower(nfc(F.coalesce(F.col(text_col) if isinstance(text_col, str) else text_col, F.lit(""))))


def english_required(text_col) -> Column:
    """English mentioned as a requirement."""
    return _lower(text_col).rlike(ENGLISH_PATTERN)


def weekend_rotation(text_col) -> Column:
    """Weekend / Saturday work mentioned."""
    return _lower(text_col).rlike(WEEKEND_PATTERN)


def language_requirements(text_col) -> Column:
    """Languages mentioned in the requirements text."""
    return let(_lower(text_col), lambda t: F.array_compact(F.array(*[F.when(t.rlike(p), F.lit(n)) for n, p in LANGUAGE_PATTERNS])))
