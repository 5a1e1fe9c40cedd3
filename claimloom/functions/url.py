"""URL functions as Columns: sites, keys, slugs, extensions, widths and asset keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions.text import strip, text_or_empty


def norm_site(col: Column) -> Column:
    """Host (with port) of a site or url, lower-case, without a leading ``www.``."""
    low = F.lower(strip(text_or_empty(col)))
    full = F.when(low.rlike("^https?://") | (low == ""), low).otherwise(F.concat(F.lit("https://"), low))
    return F.regexp_replace(F.regexp_extract(full, "^https?://([^/?#]*)", 1), "^www\\.", "")


def publisher_key(col: Column) -> Column:
    """The name a publisher is registered under."""
    low = F.lower(strip(text_or_empty(col)))
    for part in ("https://", "http://", "www."):
        low = F.replace(low, F.lit(part), F.lit(""))
    return F.translate(F.regexp_replace(F.split_part(low, F.lit("/"), F.lit(1)), "\\.[^.]*$", ""), "-", "_")


def url_hash(col: Column, n: int = 12) -> Column:
    """The first hexadecimal digits of the url's md5."""
    return F.substring(F.md5(text_or_empty(col)), 1, n)


def domain(col: Column) -> Column:
    """U4: network location, lower-case; empty without one."""
    return F.lower(F.regexp_extract(text_or_empty(col), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def is_on(col: Column, host: str) -> Column:
    """Whether a url is on a host."""
    return F.regexp_replace(F.regexp_replace(domain(col), "^.*@", ""), ":[0-9]*$", "").endswith(host)


def with_scheme(col: Column) -> Column:
    """``//host`` gets https."""
    return F.when(col.startswith("//"), F.concat(F.lit("https:"), col)).otherwise(col)


def strip_query(col: Column) -> Column:
    """U8: without query and fragment."""
    return F.regexp_replace(col, "[?#].*$", "")


def path_of(col: Column) -> Column:
    return F.regexp_extract(text_or_empty(col), "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def extension(col: Column) -> Column:
    """The path's extension with its dot, lower-case; none for names that only start with dots."""
    return F.regexp_extract(path_of(F.lower(col)), "(?:^|/)\\.*[^/.][^/]*?(\\.[^./]*)$", 1)


def slug(col: Column, n: int = 64, default: str = "article") -> Column:
    """A safe folder name, the last ``n`` characters."""
    bare = F.regexp_replace(text_or_empty(col), "https?://", "")
    safe = F.regexp_replace(F.regexp_replace(bare, "(?U)[^\\w.-]+", "_"), "^[._]+|[._]+$", "")
    return F.coalesce(F.nullif(F.right(safe, F.lit(n)), F.lit("")), F.lit(default))


def is_image(col: Column, kinds: str = "jpe?g|png|webp|avif") -> Column:
    """Whether the path ends in an image's extension."""
    return path_of(col).rlike(f"(?i)\\.({kinds})$")


def extension_priority(col: Column) -> Column:
    """Jpg, png, webp, avif, anything else."""
    e = extension(col)
    return F.when(e.isin(".jpg", ".jpeg"), 4).when(e == ".png", 3).when(e == ".webp", 2).when(e == ".avif", 1).otherwise(0)


def extension_of_type(content_type: Column) -> Column:
    """Extension for a content type, jpg by default."""
    low = F.lower(text_or_empty(content_type))
    return F.when(low.contains("png"), ".png").when(low.contains("webp"), ".webp").when(low.contains("avif"), ".avif").otherwise(".jpg")


#: Fixed values. U16: steps of each publisher's ladder of width patterns, tried in order: (a part no match is without, pattern).
_FIT_IN, _SIZE, _WIDE = ("/fit-in/", "/fit-in/([0-9]+)x"), ("x", "/([0-9]{2,5})x[0-9]{1,5}(?:/|$)"), ("w", "(?<![0-9a-z])([0-9]{2,5})w(?![a-z0-9])")
WIDTH_LADDERS = {
    "plain": [_FIT_IN, _SIZE, _WIDE],
    "br": [("w=", "[?&]w=([0-9]+)"), _FIT_IN, _SIZE, _WIDE],
    "rtl": [_FIT_IN, _SIZE, _WIDE, (".", "/([0-9]{2,5})/[^/]+\\.[a-z]+")],
    "stern": [("/w", "/w([0-9]+)(?:/|$)"), _FIT_IN, _WIDE],
    "query": [("=", "[?&](?:width|w)=([0-9]+)")],
}


def width(col: Column, ladder: str = "plain") -> Column:
    """The width a url states, 0 without one."""
    low = F.lower(text_or_empty(col))
    found = [F.when(low.contains(part), F.nullif(F.regexp_extract(low, p, 1), F.lit(""))) for part, p in WIDTH_LADDERS[ladder]]
    return F.coalesce(F.coalesce(*found).cast("int"), F.lit(0))


def largest_path_number(col: Column) -> Column:
    """The largest number that stands alone in a path, or before ``x``; 0 without one."""
    found = F.regexp_extract_all(path_of(col), F.lit("(?<=[/x])([0-9]{2,5})(?=[/x])"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(found, lambda x: x.cast("int"))), F.lit(0))


#: Fixed values. U19: what each publisher's image urls are rid of to name the asset, in order: (pattern, replacement).
ASSET_RULES = {
    "plain": [("[?#].*$", ""), ("/fit-in/[0-9]+x[0-9]+", ""), ("/[0-9]+x[0-9]+(?=/)", ""), ("-[0-9]+x[0-9]+(?=\\.[A-Za-z]+$)", ""), ("-scaled(?=\\.[A-Za-z]+$)", "")],
    "br": [("#.*$", ""), ("([?&])w=[^&]*&?", "$1"), ("[?&]+$", ""), ("/fit-in/[0-9]+x[0-9]+", ""), ("/[0-9]+x[0-9]+(?=/)", ""), ("-[0-9]+x[0-9]+(?=\\.[A-Za-z]+(?:[?]|$))", ""), ("-scaled(?=\\.[A-Za-z]+(?:[?]|$))", "")],
    "rtl": [("[?#].*$", ""), ("/fit-in/[0-9]+x[0-9]+", ""), ("/[0-9]+x[0-9]+(?=/)", ""), ("(/img/[^/]+/[^/]+/[^/]+)/[0-9]+/", "$1/"), ("-[0-9]+x[0-9]+(?=\\.[A-Za-z]+$)", ""), ("-scaled(?=\\.[A-Za-z]+$)", "")],
    "afp": [("[?#].*$", ""), ("^.*/styles/[^/]+/public/", "/"), ("-[0-9]+x[0-9]+(?=\\.[A-Za-z]+$)", "")],
    "stern": [("[?#].*$", ""), ("/t/[^/]+", ""), ("/v[0-9]+(?=/|$)", ""), ("/w[0-9]+(?=/|$)", ""), ("/r[0-9.]+(?=/|$)", "")],
    "fit_in": [("[?#].*$", ""), ("/fit-in/.*$", "")],
}
LOWERED = {"afp", "stern"}


def asset_key(col: Column, rule: str = "plain") -> Column:
    """What the renditions of one picture share."""
    if rule == "tagesschau":
        uuid = F.regexp_extract(F.lower(path_of(col)), "([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})", 1)
        return F.concat_ws(":", F.nullif(uuid, F.lit("")), F.substring_index(path_of(col), "/", -1))
    out = text_or_empty(col)
    for pattern, by in ASSET_RULES[rule]:
        out = F.regexp_replace(out, pattern, by)
    return F.lower(out) if rule in LOWERED else out


def file_name(col: Column) -> Column:
    """A safe name from the last segment."""
    return F.regexp_replace(F.substring_index(path_of(col), "/", -1), "(?U)[^\\w.-]+", "_")


def image_name(prefix: Column, col: Column, content_type: Column | None = None) -> Column:
    """File an image is kept in: prefix, 12 digits of the url's md5 and an extension."""
    ext = extension(col)
    known = ext.isin(".jpg", ".jpeg", ".png", ".webp", ".avif")
    return F.concat(prefix, F.lit("_"), url_hash(col), F.when(known, ext).otherwise(extension_of_type(content_type) if content_type is not None else F.lit(".jpg")))


def unquoted(col: Column) -> Column:
    """Percent-decoding that leaves plus signs; null where it is malformed."""
    return F.try_url_decode(F.replace(col, F.lit("+"), F.lit("%2B")))


def b64_text(col: Column) -> Column:
    """The text of doubly quoted, url-safe base64; null where a step fails."""
    once = F.coalesce(unquoted(col), col)
    twice = F.translate(F.coalesce(unquoted(once), once), "-_", "+/")
    padded = F.rpad(twice, F.length(twice) + (4 - F.length(twice) % 4) % 4, F.lit("="))
    return F.decode(F.call_function("try_to_binary", padded, F.lit("base64")), "UTF-8")


def b64_json(col: Column) -> Column:
    """JSON in ``b64_text`` as a variant; null where any step fails."""
    return F.try_parse_json(b64_text(col))


def srcset(col: Column, ladder: str = "plain", density: int = 0) -> Column:
    """(url, w) of a srcset's parts; ``Nw`` is a width, ``Nx`` counts ``density`` each, else the url states it."""
    parts = F.filter(F.transform(F.split(text_or_empty(col), ","), lambda p: F.split(F.trim(F.regexp_replace(p, "\\s+", " ")), " ")), lambda p: F.get(p, F.lit(0)) != "")

    def one(p: Column) -> Column:
        url, size = F.get(p, F.lit(0)), F.coalesce(F.get(p, F.lit(1)), F.lit(""))
        w = F.regexp_extract(size, "^([0-9]+)w$", 1).try_cast("int")
        x = (F.regexp_extract(size, "^([0-9.]+)x$", 1).try_cast("double") * density).cast("int") if density else F.lit(None).cast("int")
        return F.struct(url.alias("url"), F.coalesce(w, x, width(url, ladder)).alias("w"))

    return F.transform(parts, one)


def srcset_best(col: Column, ladder: str = "plain", density: int = 0, last_of_equals: bool = False) -> Column:
    """The url of the widest part; the first of equals, or the last."""
    own = srcset(col, ladder, density)
    keyed = F.transform(own, lambda x, i: F.struct(x.w.alias("w"), (i if last_of_equals else -i).alias("i"), x.url.alias("url")))
    return F.array_max(keyed)["url"]


def srcset_last(col: Column) -> Column:
    """The url of the last part."""
    return F.split(F.trim(F.try_element_at(F.split(text_or_empty(col), ","), F.lit(-1))), "\\s+")[0]
