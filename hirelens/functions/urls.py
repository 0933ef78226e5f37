"""URL and key column functions: K1, K1b, K2, K2b, K3, domain / source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.constants import TRACKING_PARAMS
from hirelens.functions.text import normalize_text, strip_ws


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def _form_decode(x: Column) -> Column:
    """Form decoding ('+' is a space); malformed escapes are kept as they are."""
    return F.coalesce(F.try_url_decode(x), F.regexp_replace(x, r"\+", " "))


def _form_encode(x: Column) -> Column:
    """Form encoding with the safe set letters, digits and ``_.-~``."""
    e = F.url_encode(x)
    return F.replace(F.replace(e, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def url_parts(col) -> Column:
    """struct(scheme, netloc, path, query) of a stripped URL without fragment."""
    t = strip_ws(_c(col))
    no_frag = F.regexp_replace(t, r"#.*$", "")
    qpos = F.instr(no_frag, "?")
    base = F.when(qpos > 0, F.substring(no_frag, F.lit(1), qpos - 1)).otherwise(no_frag)
    query = F.when(qpos > 0, F.substring(no_frag, qpos + 1, F.lit(1 << 30))).otherwise(F.lit(""))
    scheme = F.regexp_extract(base, _SCHEME, 1)
    rest = F.regexp_replace(base, _SCHEME, "")
    has_netloc = rest.startswith("//")
    netloc = F.regexp_extract(rest, r"^//([^/]*)", 1)
    path = F.regexp_replace(rest, r"^//[^/]*", "")
    return F.struct(scheme.alias("scheme"), netloc.alias("netloc"), path.alias("path"),
                    query.alias("query"), has_netloc.alias("has_netloc"))


def clean_query(query: Column, drop=TRACKING_PARAMS) -> Column:
    """Drop tracking and blank-valued parameters; repeated keys are grouped at
    the place of their first appearance; keys and values are re-encoded."""
    drop_arr = F.array(*[F.lit(p) for p in drop])
    pairs = F.filter(F.split(query, "&"), lambda x: x.rlike(r"^[^=]*=.+$"))
    kv = F.transform(pairs, lambda x: F.struct(
        _form_decode(F.substring_index(x, "=", 1)).alias("k"),
        _form_decode(F.regexp_replace(x, r"^[^=]*=", "")).alias("v")))
    kv = F.filter(kv, lambda s: ~F.array_contains(drop_arr, F.lower(s["k"])))
    keys = F.transform(kv, lambda s: s["k"])
    ordered = F.array_sort(F.transform(kv, lambda s, i: F.struct(
        F.array_position(keys, s["k"]).alias("p"), i.alias("i"),
        F.concat(_form_encode(s["k"]), F.lit("="), _form_encode(s["v"])).alias("kv"))))
    return F.array_join(F.transform(ordered, lambda s: s["kv"]), "&")


def normalize_url(col) -> Column:
    """K1: strip; lower-case scheme and host; drop tracking parameters,
    blank-valued parameters and the fragment; keep the path as it is."""
    def rebuilt(p: Column) -> Column:
        path, netloc = p["path"], p["netloc"]
        with_netloc = F.concat(
            F.lit("//"), F.lower(netloc),
            F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path))
        body = F.when(p["has_netloc"], with_netloc).otherwise(path)
        head = F.when(p["scheme"] != "", F.concat(F.lower(p["scheme"]), F.lit(":"), body)).otherwise(body)
        # A lambda's variable holds each part once, however often it is used.
        return F.get(F.transform(F.array(clean_query(p["query"])),
                                 lambda q: F.when(q != "", F.concat(head, F.lit("?"), q)).otherwise(head)), 0)

    return F.when(_c(col).isNotNull(), F.get(F.transform(F.array(url_parts(col)), rebuilt), 0))


def ensure_scheme(col) -> Column:
    """Add ``https://`` when the URL has no scheme; empty -> NULL (the
    caller turns that into a validation error)."""
    t = strip_ws(_c(col))
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit(None).cast("string")) \
        .when(t.rlike(_SCHEME), t).otherwise(F.concat(F.lit("https://"), t))


def url_domain(col) -> Column:
    """Host part of a URL as written."""
    return url_parts(col)["netloc"]


def source_from_domain(col) -> Column:
    """source = domain without ``www.``."""
    return F.replace(F.coalesce(_c(col), F.lit("")), F.lit("www."), F.lit(""))


def job_id(source, url) -> Column:
    """K2: sha256(lower(strip(source)) || '|' || normalize_url(url))."""
    return F.sha2(F.concat(F.lower(strip_ws(_c(source))), F.lit("|"), normalize_url(url)), 256)


def legacy_job_id(url) -> Column:
    """md5 of the raw URL ('' when there is none)."""
    return F.when(F.coalesce(_c(url), F.lit("")) == "", F.lit("")).otherwise(F.md5(_c(url)))


def content_hash(title, company, location, salary, requirements) -> Column:
    """K3: sha256 of five normalized fields joined by '|'."""
    parts = [normalize_text(x) for x in (title, company, location, salary, requirements)]
    return F.sha2(F.concat_ws("|", *parts), 256)
