"""Dictionary terms found in texts by equi-join (N1, N18, N19 with large
dictionaries).

Texts and terms become lower-case words; every run of as many words as some
term has is joined with the terms. The dictionary is a table of any size: it is
broadcast only if its counted bytes are below Spark's threshold. The runs never
are: statistics tell the size of the texts' file, not of what comes of it.
Terms match whole words, never parts of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.functions.text import nfc

# What parts words: anything but letters, digits, marks and the signs of names such as C++, C# and node.js.
WORD_BREAK = r"(?U)[^\w+#.]+|\.(?!\w)"


def words(col: Column) -> Column:
    return F.filter(F.split(F.lower(nfc(F.coalesce(col, F.lit("")))), WORD_BREAK), lambda w: w != "")


def word_runs(df: DataFrame, text: str, lengths: list[int], *keep: str) -> DataFrame:
    """``keep``, ``pos``, ``n_words``, ``run``: all runs of the ``lengths``."""
    texts = df.select(*keep, words(F.col(text)).alias("_w"))
    w = F.col("_w")
    runs = F.flatten(F.transform(w, lambda _, i: F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: i + n <= F.size(w)),
        lambda n: F.struct(i.alias("pos"), n.alias("n_words"), F.array_join(F.slice(w, i + 1, n), " ").alias("run")))))
    return texts.select(*keep, F.inline(runs))


ROW_BYTES = 64     # of a term in a broadcast table, beside its text


def _broadcast_bytes(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def match_terms(df: DataFrame, key: str, text: str, terms: DataFrame, term: str = "term") -> DataFrame:
    """``key, pos, n_words, term`` and the other columns of ``terms``: the
    terms in each text, longest first: one that lies inside a longer one at
    its place is no match. Terms without a word are ignored; ones that are
    alike in lower case give a row each. Only the lengths that terms have, and
    their bytes, come to the driver."""
    listed = terms.withColumn("_run", F.array_join(words(F.col(term)), " ")).where("_run <> ''") \
        .withColumn("_n", F.size(F.split("_run", " ")))
    size = F.sum(F.octet_length(F.to_json(F.struct(*terms.columns))) + F.octet_length("_run") + ROW_BYTES)
    told = dict(listed.groupBy("_n").agg(size).collect())
    lengths = sorted(told) or [1]
    listed = listed.drop("_n").hint("broadcast" if sum(told.values()) <= _broadcast_bytes(df) else "merge")
    found = word_runs(df, text, lengths, key).join(listed, F.col("run") == F.col("_run")).drop("run", "_run")
    # In order of place, longer ones first: what ends no later than one before it lies inside that one.
    end, place = F.col("pos") + F.col("n_words"), F.col("pos") * (lengths[-1] + 1) - F.col("n_words")
    before = Window.partitionBy(key).orderBy(place).rangeBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("_reach", F.max(end).over(before))
    return found.where(F.col("_reach").isNull() | (F.col("_reach") < end)).drop("_reach")
