"""Quality rules by weak supervision, in DataFrame functions only.

Each rule votes for good or bad text, or abstains. Expectation-maximisation
over the counts of distinct vote patterns estimates how often each rule is
right on good and on bad texts; a document's posterior probability of being
good then replaces the demand that all rules pass.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import table, written

WINDOW = 8
LEAST_WORDS = 20
LEAST_POSTERIOR = 0.5
ROUNDS = 60             # of expectation-maximisation at most
CLOSE = 1e-4            # a round that moves no estimate further ends it
# The start: most texts are good; a good text passes nearly every rule, a bad one fails some.
SHARE, GOOD, BAD = 0.8, 0.95, 0.4
PSEUDO = 10.0           # votes that hold an estimate at its start
_SPACES = " \t\n\x0b\x0c\r"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _left(text: Column, other: str) -> Column:
    """The text without runs of ``other`` (a regular expression)."""
    return F.regexp_replace(text, f"{other}+", "")


def _window_hashes(words: Column, window: int) -> Column:
    """The 64-bit hash of every run of ``window`` words (a power of two):
    those of one word, of two from one, of four from two and so on."""
    def joined(hashes: Column, step: int) -> Column:
        return _let(hashes, lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step))))

    found, step = F.transform(words, lambda w: F.xxhash64(w)), 1
    while step < window:
        found, step = joined(found, step), step * 2
    return F.slice(found, 1, F.size(words) - (window - 1))


def _repeated_words(hashes: Column, window: int) -> Column:
    """Words inside windows (compared by 64-bit hashes) found twice or more.

    Only a text with a repeated window is sorted: its windows by hash, where
    equal neighbours give the repeated places, whose union is measured."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    again = _let(placed, lambda p: F.filter(
        p, lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"])))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    covered = F.aggregate(
        F.sort_array(F.transform(again, lambda x: x["i"])), zero,
        lambda acc, i: F.struct((acc["n"] + i + window - F.greatest(i, acc["reach"])).alias("n"),
                                (i + window).alias("reach")),
        lambda acc: acc["n"])
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(covered)


def measures(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without its text, with a struct ``m`` of what rules look at:
    ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    n_distinct, n_single, n_upper, n_letters, n_marks, n_cries, n_stops,
    n_digits`` (longs). Words are runs of anything but ASCII white space,
    lines are cut at newlines and count if they hold a word; marks are ASCII
    punctuation, upper and digits ASCII too, letters the rest of the words. A
    null text has none of all this."""
    # Steps that later ones use more than once stay columns of their own, so each is worked out once a row.
    found = docs.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    found = found.withColumns({
        "_w": F.filter(F.split("_t", r"[\x20\x09-\x0D]+"), lambda w: w != ""),
        "_lines": F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(_SPACES)) != ""),
        "_marks": _left(F.col("_t"), r"[^!-/:-@\[-`{-~]"), "_caps": _left(F.col("_t"), "[^A-Z0-9]")})
    w, marks, caps = F.col("_w"), F.col("_marks"), F.col("_caps")
    found = found.withColumn("_h", F.when(F.size(w) >= window, _window_hashes(w, window)).otherwise(F.array().cast("array<bigint>")))
    n_marks, n_upper = F.length(marks), F.length(_left(caps, "[0-9]"))
    chars, n_digits = F.length(F.array_join(w, "")), F.length(caps) - n_upper
    values = {
        "n_words": F.size(w), "word_chars": chars, "n_symbols": F.length(_left(marks, "[^#*$%&|<>]")),
        "n_lines": F.size("_lines"), "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": _repeated_words(F.col("_h"), window), "n_distinct": F.size(F.array_distinct(w)),
        "n_single": F.size(F.filter(w, lambda x: F.length(x) == 1)), "n_upper": n_upper,
        "n_letters": chars - n_marks - n_digits, "n_marks": n_marks, "n_cries": F.length(_left(marks, "[^!?]")),
        "n_stops": F.length(_left(marks, "[^.!?]")), "n_digits": n_digits,
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return found.select(*kept, F.struct(*[v.cast("long").alias(k) for k, v in values.items()]).alias("m"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules(m: Column) -> dict[str, Column]:
    """Name -> vote (1 good, -1 bad, 0 abstains) from the measures."""
    words, lines, letters = m["n_words"], m["n_lines"], m["n_letters"]
    some = words >= LEAST_WORDS

    def share(part: str, whole: str, most: float, least: float, when: Column) -> Column:
        """Bad above ``most``, good up to ``least`` of the whole."""
        return _vote(when & (m[part] > most * m[whole]), when & (m[part] <= least * m[whole]))

    return {
        "length": _vote(~some, words >= 40),
        "word_length": _vote(some & ~m["word_chars"].between(2 * words, 14 * words),
                             some & m["word_chars"].between(3 * words, 10 * words)),
        "symbols": share("n_symbols", "n_words", 0.3, 0.05, words > 0),
        "symbol_share": share("n_symbols", "word_chars", 0.05, 0.01, words > 0),
        "marks": share("n_marks", "n_words", 0.8, 0.4, words > 0),
        "cries": share("n_cries", "n_words", 0.3, 0.1, words > 0),
        "single": share("n_single", "n_words", 0.3, 0.15, some),
        "repeats": share("n_repeat_words", "n_words", 0.3, 0.1, some),
        "lines": share("n_dup_lines", "n_lines", 0.3, 0.05, lines >= 3),
        "vocabulary": _vote(some & (m["n_distinct"] * 10 < F.least(words, F.lit(1000))),
                            some & (m["n_distinct"] * 10 >= 3 * F.least(words, F.lit(1000)))),
        "case": share("n_upper", "n_letters", 0.5, 0.2, letters >= 20),
        "stops": share("n_stops", "n_words", 0.6, 0.3, some),
        "digits": share("n_digits", "word_chars", 0.4, 0.1, words > 0),
    }


@dataclass
class Model:
    """``share`` of good texts; how often each rule is right on good and on
    bad texts when it votes."""

    share: float
    good: dict[str, float]
    bad: dict[str, float]

    def posterior(self, vote: Callable[[str], Column]) -> Column:
        """P(good | votes); an abstention says nothing."""
        odds = F.lit(math.log(self.share / (1 - self.share)))
        for name, good in self.good.items():
            bad = self.bad[name]
            odds = odds + F.when(vote(name) > 0, math.log(good / (1 - bad))) \
                .when(vote(name) < 0, math.log((1 - good) / bad)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))

    def distance(self, other: Model) -> float:
        return max([abs(self.share - other.share),
                    *[abs(a[k] - b[k]) for a, b in ((self.good, other.good), (self.bad, other.bad)) for k in a]])


def fit(votes: DataFrame, names: list[str]) -> Model:
    """Expectation-maximisation over the patterns of the columns ``names``.

    All rows count: a grouped count reduces them to ``3 ** len(names)``
    patterns at most, which each round aggregates once. A few pseudo-votes
    keep every estimate off 0 and 1, and at its start if nothing votes; no row
    leaves the starting model. Patterns are summed in order, in one
    partition, so that a rerun gives the same model to the last digit."""
    patterns = votes.groupBy(*names).agg(F.count("*").cast("double").alias("_n"))
    patterns = written(patterns.coalesce(1).sortWithinPartitions(*names), "vote-patterns")
    start = {"good": GOOD, "bad": BAD}
    model = Model(SHARE, dict.fromkeys(names, GOOD), dict.fromkeys(names, BAD))
    for _ in range(ROUNDS):
        g = patterns.withColumn("_g", F.col("_n") * model.posterior(F.col)).withColumn("_b", F.col("_n") - F.col("_g"))
        sums = {"all": F.sum("_n"), "good": F.sum("_g")}
        for name in names:
            for side, weight, vote in (("good", "_g", 1), ("bad", "_b", -1)):
                sums[f"{side}:{name}"] = F.sum(F.when(F.col(name) == vote, F.col(weight)))
                sums[f"{side}_votes:{name}"] = F.sum(F.when(F.col(name) != 0, F.col(weight)))
        row = g.agg(*[F.coalesce(v, F.lit(0.0)).alias(k) for k, v in sums.items()]).first()
        rate = {side: {name: (row[f"{side}:{name}"] + start[side] * PSEUDO) / (row[f"{side}_votes:{name}"] + PSEUDO)
                       for name in names} for side in start}
        before, model = model, Model((row["good"] + SHARE * PSEUDO) / (row["all"] + PSEUDO), rate["good"], rate["bad"])
        if model.distance(before) < CLOSE:
            break
    return model


def assess(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``m`` (:func:`measures`), ``votes`` (a
    struct, one field a rule), ``base_failed``, ``posterior`` and ``kept``.

    ``base_failed``: under 20 words, or over 30 % of them in repeated windows.
    ``kept``: not that, and a posterior of one half at least. A null or empty
    text has no words, so it isn't kept. Rows that are repeated are judged
    alike and each counts in the fit. Columns of ``docs`` named like those
    made here are replaced. An empty table gives an empty result."""
    made = ("m", "votes", "base_failed", "posterior", "kept")
    rows = measures(docs.drop(*[c for c in made if c != text]), text)
    votes = rules(F.col("m"))
    rows = written(rows.withColumn("votes", F.struct(*[v.alias(k) for k, v in votes.items()])), "votes")
    model = fit(rows.select("votes.*"), list(votes))
    failed = (F.col("m.n_words") < LEAST_WORDS) | (100 * F.col("m.n_repeat_words") > 30 * F.col("m.n_words"))
    return (rows.withColumn("base_failed", failed)
            .withColumn("posterior", model.posterior(lambda name: F.col("votes")[name]))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= LEAST_POSTERIOR)))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assess(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[F.col("m")[k].alias(k) for k in
                                    ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                        "base_failed", "posterior", "kept")
