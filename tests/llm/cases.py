"""Inputs that every document operator must take without a fault."""

from pyspark.sql import functions as F

CLASHING = ("fp", "root", "component_id", "cell", "found", "_blob", "blob", "leak", "language", "pieces", "count",
            "licenses", "key", "h", "ids", "low", "n", "spans", "first", "near")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000)) + " token = abcdefghijklmnop"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 60),
    (1, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 60),   # a repeated row
    (2, None, "en", None, None),
    (3, "", None, "b", 0),
    (4, " \t\n\r ", "en", "b", 5),
    (None, "The quick brown fox jumps over the lazy dog again and again.", None, None, 60),
    (None, None, None, None, None),
    (5, LONG, "xx", "c", len(LONG)),
    (6, "12345 !!! ###", "en", "c", 13),
    (7, "été ça naïve \U0001f600 日本語 text", "fr", "d", 20),
    (8, "x", "fr", "d", 1),
    (9, "Released under the MIT License.\n\nkey: api_key=abcdefghijkl123 <|endoftext|>", "en", "d", 70),
]


def edge_docs(spark, clash=True):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit(f"{c}!").alias(c) for c in CLASHING]) if clash else df


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    """Rows as a sorted list of tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
