"""Text, skill and city column functions (all JVM-side, no Python UDF)."""

from __future__ import annotations

import itertools
import json
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.constants import CITY_EXACT_ALIASES, CITY_MAP, SKILL_NOISE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Unicode white space (the White_Space property).
WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once (a lambda variable), however
    often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_ws(col) -> Column:
    """Strip leading / trailing whitespace of any kind (Python ``str.strip``).

    Spark's ``trim`` alone removes only the space character."""
    return F.btrim(_c(col), F.lit(WHITE_SPACE))


_MARKS = "\u0300\u0301\u0302\u0303\u0306\u0309\u031b\u0323"  # tones, circumflex, breve, horn
_VOWELS = "AaEeIiOoUuYy"
# Vowels, and those with one mark that make one letter.
_BASES = "".join(dict.fromkeys(x for x in (unicodedata.normalize("NFC", v + m) for m in ["", *_MARKS] for v in _VOWELS)
                               if len(x) == 1))


def _compositions() -> dict[str, str]:
    """Vietnamese letters by base letter and marks, in any order of two marks
    that Unicode composes to one letter."""
    found = {}
    for base in _BASES:
        for marks in [*_MARKS, *map("".join, itertools.permutations(_MARKS, 2))]:
            letter = unicodedata.normalize("NFC", base + marks)
            if len(letter) == 1:
                found[base + marks] = letter
    return found


_COMPOSED = json.dumps(_compositions())


def nfc(col) -> Column:
    """Vietnamese letters written as a base letter and combining marks, as one
    letter each (Unicode NFC for these). Other text stays as it is; a text
    without such marks is only looked through."""
    t = _c(col)
    table = F.from_json(F.lit(_COMPOSED), "map<string,string>")
    cluster = f"[{_BASES}][{_MARKS}]{{1,2}}"

    def composed(part: Column) -> Column:
        return let(F.regexp_extract(part, f"^{cluster}", 0), lambda x: F.when(x == "", part).otherwise(
            F.concat(F.coalesce(F.try_element_at(table, x), x), F.substring(part, F.length(x) + 1, F.length(part)))))

    parts = F.transform(F.split(t, f"(?={cluster})"), composed)
    marked = (F.octet_length(t) != F.length(t)) & t.rlike(f"[{_MARKS}]")
    return F.when(marked, F.array_join(parts, "")).otherwise(t)


def clean_text(col) -> Column:
    """Letters composed, CR -> LF, blank-line runs -> one blank line, space / tab runs -> one
    space, strip. NULL -> ''."""
    t = F.replace(nfc(F.coalesce(_c(col), F.lit(""))), F.lit("\r"), F.lit("\n"))
    t = F.regexp_replace(t, r"(?U)\n\s*\n+", "\n\n")
    t = F.regexp_replace(t, r"[ \t]{2,}|\t", " ")      # a single space stays as it is
    return strip_ws(t)


def split_skills(col) -> Column:
    """Comma list -> trimmed array without empty items."""
    t = F.regexp_replace(F.coalesce(_c(col), F.lit("")), r"\s*,\s*", ",")
    return F.filter(F.transform(F.split(t, ","), lambda x: F.trim(x)), lambda x: x != "")


def _empty_str_array() -> Column:
    return F.array().cast("array<string>")


def filter_skills(col, noise=SKILL_NOISE, min_len: int = 2, max_len: int = 60) -> Column:
    """Strip, keep length ``min_len..max_len``, drop noise tokens
    (case-insensitive), then case-insensitive dedup that keeps the first
    spelling and the input order. NULL -> [].

    By sorting (n log n): equal spellings come together in order of place,
    the first of each stays, and these are put back in order of place.
    """
    noise_arr = F.array(*[F.lit(n) for n in noise])
    arr = F.coalesce(_c(col), _empty_str_array())
    stripped = F.filter(F.transform(arr, lambda x: strip_ws(nfc(x))), lambda x: F.length(x).between(min_len, max_len))
    placed = F.transform(stripped, lambda x, i: F.struct(F.lower(x).alias("word"), i.alias("place"), x.alias("x")))
    kept = F.filter(placed, lambda s: ~F.array_contains(noise_arr, s["word"]))
    firsts = let(F.sort_array(kept), lambda by_word: F.filter(
        by_word, lambda s, i: F.coalesce(F.get(by_word, i - 1)["word"] != s["word"], F.lit(True))))
    in_place = F.sort_array(F.transform(firsts, lambda s: F.struct(s["place"].alias("place"), s["x"].alias("x"))))
    return F.transform(in_place, lambda s: s["x"])


def _city_lookup(key: Column, pairs) -> Column:
    expr = None
    for k, v in pairs:
        cond = key == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def normalize_city(col, mode: str = "lookup") -> Column:
    """N1 city normalization.

    ``lookup`` (consumer rule): exact dictionary match on the stripped lower
    text; else the longest dictionary key contained in it (first in dictionary
    order on ties); else the stripped input.
    ``exact`` (live-layer rule): exact match on the lower text (NULL ->
    'unknown'); else ``initcap`` of it.
    """
    if mode == "exact":
        return let(F.lower(F.trim(nfc(F.coalesce(_c(col), F.lit("unknown"))))),
                   lambda key: F.coalesce(_city_lookup(key, CITY_MAP + CITY_EXACT_ALIASES), F.initcap(key)))
    order = sorted(range(len(CITY_MAP)), key=lambda i: (-len(CITY_MAP[i][0]), i))

    def looked_up(raw: Column, key: Column) -> Column:
        contained = None
        for i in order:
            k, v = CITY_MAP[i]
            cond = key.contains(k)
            contained = F.when(cond, F.lit(v)) if contained is None else contained.when(cond, F.lit(v))
        return F.coalesce(_city_lookup(key, CITY_MAP), contained, raw)

    return let(strip_ws(nfc(F.coalesce(_c(col), F.lit("")))),
               lambda raw: let(F.lower(raw), lambda key: looked_up(raw, key)))


# Vietnamese letters folded to ASCII for slugs (lower-case input).
_VI_FROM = ("àáảãạăằắẳẵặâầấẩẫậ" "èéẻẽẹêềếểễệ" "ìíỉĩị" "òóỏõọôồốổỗộơờớởỡợ"
            "ùúủũụưừứửữự" "ỳýỷỹỵ" "đ")
_VI_TO = ("a" * 17 + "e" * 11 + "i" * 5 + "o" * 17 + "u" * 11 + "y" * 5 + "d")


def fold_accents(col) -> Column:
    return F.translate(F.lower(nfc(col)), _VI_FROM, _VI_TO)


def city_slug(col) -> Column:
    """N6: 'Hà Nội' -> 'ha_noi' (partition-safe)."""
    s = F.regexp_replace(fold_accents(col), r"[^a-z0-9]+", "_")
    return F.regexp_replace(s, r"^_+|_+$", "")


_SALARY_WORDS = r"(lương|thu nhập|triệu|usd|vnd|\$|₫|salary|\btr\b|\bk\b|up to|upto)"


def clean_title(col) -> Column:
    """Drop a parenthesised salary phrase (holding a salary word or
    currency sign and a digit) from a title; the original stays the display
    title."""
    pat = r"(?iU)\s*\((?=[^()]*\d)(?=[^()]*" + _SALARY_WORDS + r")[^()]*\)"
    return strip_ws(F.regexp_replace(_c(col), pat, ""))


def company_case(col) -> Column:
    """Company names in ``initcap``."""
    return F.initcap(_c(col))


def source_case(col) -> Column:
    """Source names lower-case."""
    return F.lower(_c(col))


def normalize_text(col) -> Column:
    """Text normalization used by content hashes (O): lower, whitespace runs
    collapsed, stripped, NULL as ''."""
    return strip_ws(F.regexp_replace(F.lower(nfc(F.coalesce(_c(col), F.lit("")))), r"(?U)\s+", " "))
