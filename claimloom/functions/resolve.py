"""Joining urls and editing their queries as Columns (U6, U9, U10), by RFC 3986 and form encoding; no Python runs.

A url is split once into (scheme, host, path, query, fragment); dot segments are removed by a fold over the path's segments, and only where
there are any. Defined cases: tabs and line breaks inside a url go, as do blanks and control characters before it; nothing is ever
an error. A host with a bracket that is not closed has no joined url, and its query is left as it is. Relative urls
are resolved against web addresses (http, https, ftp) and bare paths; against others they stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions.text import strip, text_or_empty

_SPLIT = "(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:[?]([^#]*))?(?:#(.*))?\\z"
_WEB = ("http", "https", "ftp")
#: Query keys that do not name a provider's item.
TRACKING = ("rd", "rp", "cr", "wp", "v")


def _with(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)``, with the value worked out once however often it is named."""
    return F.transform(F.array(value), of)[0]


def _cleaned(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text_or_empty(url), "^[\\x00-\\x20]+", ""), "[\\t\\r\\n]", "")


def split(url: Column) -> Column:
    """(scheme, host, path, query, fragment) of a cleaned url; empty where there is none, the scheme lower-case."""
    part = [F.regexp_extract(url, _SPLIT, k) for k in range(1, 6)]
    return F.struct(F.lower(part[0]).alias("scheme"), *[p.alias(n) for p, n in zip(part[1:], ("host", "path", "query", "fragment"), strict=True)])


def unsplit(scheme: Column, host: Column, path: Column, query: Column, fragment: Column) -> Column:
    rooted = path.startswith("/")
    full = (
        F.when(host != "", F.concat(F.lit("//"), host, F.when((path != "") & ~rooted, "/").otherwise(""), path))
        .when(path.startswith("//") | (scheme.isin(*_WEB) & (rooted | (path == ""))), F.concat(F.lit("//"), path))
        .otherwise(path)
    )
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), full, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""), F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))


def _broken(host: Column) -> Column:
    return host.contains("[") != host.contains("]")


def _without_dots(path: Column, rooted: Column) -> Column:
    """RFC 3986, 5.2.4. A path that was merged with its base's folder loses empty segments too."""

    def fold(segments: Column) -> Column:
        n = F.size(segments)
        inner = F.filter(segments, lambda s, i: rooted | (s != "") | (i == 0) | (i == n - 1))
        stack = F.aggregate(
            inner,
            F.array().cast("array<string>"),
            lambda kept, s: F.when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).when(s == ".", kept).otherwise(F.concat(kept, F.array(s))),
        )
        folder = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.coalesce(F.nullif(F.array_join(F.concat(stack, folder), "/"), F.lit("")), F.lit("/"))

    plain = ~path.rlike("(?:^|/)[.]{1,2}(?:/|\\z)") & (rooted | ~path.contains("//"))
    return F.when(plain, path).otherwise(_with(F.split(path, "/", -1), fold))


def absolute_url(base: Column, url: Column) -> Column:
    """The url as seen from its page; none for empty values and data urls; ``//host`` gets https."""
    bare = _cleaned(strip(text_or_empty(url)))

    def joined(v: Column) -> Column:
        u, b = v["u"], v["b"]
        # an empty parameter after the last segment is no parameter
        path, base_path = (F.regexp_replace(p, "(?s)^((?:.*/)?[^;/]*);\\z", "$1") for p in (u["path"], b["path"]))
        last = "(?s)^((?:.*/)?[^;/]*)(;[^/]*)?\\z"
        folder = F.when(base_path == "", "/").otherwise(F.regexp_extract(base_path, "(?s)^(.*/)?", 1))
        rooted = path.startswith("/")
        merged = F.concat(F.when(rooted, "").otherwise(folder), F.regexp_extract(path, last, 1))
        resolved = F.concat(_without_dots(merged, rooted), F.regexp_extract(path, last, 2))
        foreign = ((u["scheme"] != "") & (u["scheme"] != b["scheme"])) | ~b["scheme"].isin("", *_WEB)
        return (
            F.when((v["bare"] == "") | F.lower(v["bare"]).startswith("data:"), None)
            .when(v["bare"].startswith("//"), F.concat(F.lit("https:"), v["bare"]))
            .when(v["base"] == "", v["bare"])
            .when(_broken(u["host"]) | _broken(b["host"]), None)
            .when(foreign, v["bare"])
            .when(u["host"] != "", unsplit(u["scheme"], u["host"], path, u["query"], u["fragment"]))
            .when(path == "", unsplit(b["scheme"], b["host"], base_path, F.when(u["query"] != "", u["query"]).otherwise(b["query"]), u["fragment"]))
            .otherwise(unsplit(b["scheme"], b["host"], resolved, u["query"], u["fragment"]))
        )

    values = F.struct(bare.alias("bare"), _cleaned(base).alias("base"), split(bare).alias("u"), split(_cleaned(base)).alias("b"))
    return _with(values, joined)


def _unquoted_plus(col: Column) -> Column:
    return F.try_url_decode(F.regexp_replace(col, "%(?![0-9A-Fa-f]{2})", "%25"))


def _quoted_plus(col: Column) -> Column:
    return F.replace(F.replace(F.url_encode(col), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def parameters(query: Column) -> Column:
    """(k, v) of a query in order, decoded; without those that are blank."""
    pairs = F.filter(F.split(query, "&", -1), lambda p: p.rlike("(?s)^[^=]*=."))
    return F.transform(pairs, lambda p: F.struct(_unquoted_plus(F.substring_index(p, "=", 1)).alias("k"), _unquoted_plus(F.regexp_replace(p, "(?s)^[^=]*=", "")).alias("v")))


def _encoded(pairs: Column) -> Column:
    """Pairs as a query: each key where it first stands, with its last value."""

    def written(own: Column) -> Column:
        keys = F.array_distinct(F.transform(own, lambda p: p["k"]))
        return F.array_join(F.transform(keys, lambda k: F.concat(_quoted_plus(k), F.lit("="), _quoted_plus(F.element_at(F.filter(own, lambda p: p["k"] == k), -1)["v"]))), "&")

    return _with(pairs, written)


def add_query(url: Column, more: dict[str, str], scheme: str = "") -> Column:
    """The url with ``more`` in its query: the last of repeated keys stays, blanks go; ``scheme`` where the url has none."""
    added = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in more.items()])

    def edited(p: Column) -> Column:
        query = _encoded(F.concat(parameters(p["query"]), added))
        return F.when(_broken(p["host"]), text_or_empty(url)).otherwise(unsplit(F.when(p["scheme"] != "", p["scheme"]).otherwise(scheme), p["host"], p["path"], query, p["fragment"]))

    return _with(split(_cleaned(url)), edited)


def sanitize_provider_url(url: Column) -> Column:
    """Without tracking keys and fragment; Instagram posts end in a slash."""

    def edited(p: Column) -> Column:
        query = _encoded(F.filter(parameters(p["query"]), lambda x: ~F.lower(x["k"]).isin(*TRACKING)))
        post = text_or_empty(url).rlike("instagram\\.com/(?:p|reel)/") & ~p["path"].endswith("/")
        path = F.when(post, F.concat(p["path"], F.lit("/"))).otherwise(p["path"])
        return F.when(_broken(p["host"]), text_or_empty(url)).otherwise(unsplit(p["scheme"], p["host"], path, query, F.lit("")))

    return _with(split(_cleaned(url)), edited)
