"""Regex-level page extraction as native columns.

Tree-level fields (class selectors, sections, meta tags, list items) are in
:mod:`hirelens.operators.pages`, one ``mapInPandas`` pass.
"""

from __future__ import annotations

import json
from html.entities import html5 as names

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.constants import (BLOCKED_HTML_SIGNALS, BLOCKED_MIN_HTML_CHARS,
                                          BLOCKED_MIN_TEXT_CHARS, BLOCKED_TITLE_SIGNALS)
from hirelens.functions.text import clean_text, let, strip_ws


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _references() -> dict[str, str]:
    """What follows ``&`` -> its characters: the HTML standard's names (as the
    standard library has them, most with a semicolon, some without too), and
    the numbers of the C1 range, which stand for Windows-1252 characters."""
    found = dict(names)
    for code in range(0x80, 0xA0):
        char = bytes([code]).decode("cp1252", "ignore")
        if char:
            found |= {f"#{code};": char}
    return found


_NAMED = json.dumps(_references())
# Names that need no semicolon, the longest first.
_BARE = "|".join(sorted((n for n in names if not n.endswith(";")), key=lambda n: (-len(n), n)))
_REFERENCE = r"^(#[0-9]{1,8};?|#[xX][0-9a-fA-F]{1,8};?|[A-Za-z][A-Za-z0-9]{0,31};)"


def _code_point(number: Column) -> Column:
    """The character of a code point; U+FFFD for those that can't be in a text."""
    bad = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    code = F.when(bad, 0xFFFD).otherwise(number)
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _decoded(after: Column, table: Column) -> Column:
    """Text that followed an ``&``, its reference (if it is one) decoded."""
    def of(ref: Column) -> Column:
        plain = F.replace(ref, F.lit(";"), F.lit(""))
        number = F.when(F.lower(ref).startswith("#x"), F.conv(F.substring(plain, 3, 8), 16, 10)) \
            .when(ref.startswith("#"), F.substring(plain, 2, 8)).try_cast("bigint")
        named = F.when(number.isNotNull(), F.try_element_at(table, F.concat(F.lit("#"), number.cast("string"), F.lit(";")))) \
            .otherwise(F.try_element_at(table, ref))
        char = F.coalesce(named, F.when(number.isNotNull(), _code_point(number)))
        return F.when(char.isNull(), F.concat(F.lit("&"), after)) \
            .otherwise(F.concat(char, F.substring(after, F.length(ref) + 1, F.length(after))))

    def told(ref: Column) -> Column:
        known = ref.startswith("#") | F.try_element_at(table, ref).isNotNull()
        return let(F.when(known, ref).otherwise(F.regexp_extract(after, f"^({_BARE})", 1)), of)

    return let(F.regexp_extract(after, _REFERENCE, 1), told)


def unescape_entities(col) -> Column:
    """Character references decoded: all names of the HTML standard and all
    numbers. A text without ``&`` is left alone."""
    t = _c(col)
    table = F.from_json(F.lit(_NAMED), "map<string,string>")
    parts = F.split(t, "&")
    rest = F.transform(F.slice(parts, 2, F.size(parts)), lambda x: _decoded(x, table))
    return F.when(t.contains("&"), F.concat(F.get(parts, 0), F.array_join(rest, ""))).otherwise(t)


def _visible(html_col) -> Column:
    """The page without comments, declarations and what isn't shown."""
    return F.regexp_replace(F.coalesce(_c(html_col), F.lit("")),
                            r"(?is)<!--.*?-->|<(script|style|template)\b.*?</\1\s*>|<!doctype[^>]*>", " ")


def element_text(html_col, tag: str) -> Column:
    """Text of the first ``<tag>`` element that is no comment's or script's:
    tags become spaces, references are decoded, whitespace collapsed and
    stripped."""
    inner = F.coalesce(F.regexp_extract(_visible(html_col), rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1), F.lit(""))
    t = unescape_entities(F.regexp_replace(inner, r"<[^>]*>", " "))
    return strip_ws(F.regexp_replace(t, r"(?U)\s+", " "))


def page_title(html_col) -> Column:
    """First non-empty of the h1 text and the <title> text."""
    return F.coalesce(F.nullif(element_text(html_col, "h1"), F.lit("")),
                      F.nullif(element_text(html_col, "title"), F.lit("")))


def page_text(html_col) -> Column:
    """Visible text of a page: comments / script / style / template
    removed; each text node decoded and stripped; non-empty nodes joined by
    newlines; then X1 cleanup of the whole text."""
    body = _visible(html_col)
    nodes = F.transform(F.split(body, r"<[^>]*>"), lambda x: strip_ws(unescape_entities(x)))
    return clean_text(F.array_join(F.filter(nodes, lambda x: x != ""), "\n"))


def json_ld_blocks(html_col) -> Column:
    """Text of every ``<script type="application/ld+json">`` block."""
    pat = r"(?is)<script[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"
    return F.transform(F.regexp_extract_all(_c(html_col), F.lit(pat), 1), strip_ws)


def _any_contains(col: Column, words) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | col.contains(w)
    return cond


def blocked_flags(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Blocked / empty page detection: short html, block signal words in
    the html or the title, or little visible text."""
    h = F.coalesce(F.col(html_col), F.lit(""))
    lower_html = F.lower(h)
    title = F.lower(element_text(h, "title"))
    text_len = F.length(page_text(h)).cast("bigint")
    return pages.select(
        "*",
        F.length(h).cast("bigint").alias("html_chars"),
        text_len.alias("page_text_chars"),
        _any_contains(lower_html, BLOCKED_HTML_SIGNALS).alias("has_block_signal"),
        _any_contains(title, BLOCKED_TITLE_SIGNALS).alias("has_title_signal"),
    ).withColumn("looks_blocked",
                 (F.col("html_chars") < BLOCKED_MIN_HTML_CHARS) | F.col("has_block_signal")
                 | F.col("has_title_signal") | (F.col("page_text_chars") < BLOCKED_MIN_TEXT_CHARS))
