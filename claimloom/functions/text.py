"""Text functions as Columns: cleaning, cutting, gating and picking, all inside generated code.

Python's notion of white space is kept: blanks are Unicode and include U+001C to U+001F, and lines end at any line break.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = "[\\s\\x1c-\\x1f]"
BREAK = "\\R|[\\x1c-\\x1e]"
#: Breaks but for the plain one.
OTHER_BREAK = "\\r\\n|[\\r\\x0b\\f\\x85\\u2028\\u2029\\x1c-\\x1e]"


def _empty() -> Column:
    return F.array().cast("array<string>")


def bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` a value that is worked out once, however often ``of`` reads it."""
    return F.transform(F.array(value), of)[0]


def text_or_empty(col: Column) -> Column:
    """R2: null becomes the empty string."""
    return F.coalesce(col, F.lit(""))


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"(?U)^{BLANK}++|{BLANK}(?<!{BLANK}{{2}}){BLANK}*+$", "")


def clean(col: Column) -> Column:
    """Blanks collapsed to one space, none at the ends."""
    return strip(F.regexp_replace(text_or_empty(col), f"(?U){BLANK}+", " "))


def caption_key(col: Column) -> Column:
    """T3."""
    return F.lower(clean(col))


def lines(col: Column) -> Column:
    return F.split(text_or_empty(col), BREAK, -1)


def clean_lines(col: Column, only_tabs: bool = False) -> Column:
    """Each line cleaned, empty lines dropped; ``only_tabs`` collapses spaces and tabs alone.

    The plain form goes over the whole text, not line by line: breaks become one kind, then blanks within lines one space, then
    what stands around breaks goes.
    """
    text = F.translate(text_or_empty(col), "\u00a0", " ")
    if only_tabs:
        own = F.transform(lines(text), lambda x: strip(F.regexp_replace(x, "[ \\t]+", " ")))
        return F.array_join(F.filter(own, lambda x: x != ""), "\n")
    broken = F.regexp_replace(text, BREAK, "\n")
    spaced = F.regexp_replace(broken, "(?U)(?:[\\s&&[^\\n]]|\\x1f)+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, " ?\\n[ \\n]*", "\n"), "^\\n|\\n$", ""))


def first_hit(col: Column, phrases: Sequence[str], patterns: Sequence[str] = ()) -> Column:
    """Earliest place (from 1) of a phrase, case ignored, or of a pattern; null without one."""
    low = F.lower(col)
    places = [F.instr(low, p.lower()) for p in phrases if p] + [F.regexp_instr(col, F.lit(f"(?iU){p}")) for p in patterns]
    if not places:
        return F.lit(None).cast("int")
    return F.array_min(F.filter(F.array(*places), lambda x: x > 0))


def cut_at(col: Column, phrases: Sequence[str], patterns: Sequence[str] = (), always_strip: bool = False) -> Column:
    """The text before the earliest marker, stripped; uncut text stays as it is unless ``always_strip``."""
    text = text_or_empty(col)
    hit = first_hit(text, phrases, patterns)
    return F.when(hit.isNotNull(), strip(F.substring(text, F.lit(1), hit - 1))).otherwise(strip(text) if always_strip else text)


def cut_at_line(col: Column, phrases: Sequence[str]) -> Column:
    """The lines before the first that starts with a phrase."""
    own = lines(col)
    bad = F.array_position(F.transform(own, lambda x: _starts(F.lower(strip(x)), phrases)), True)
    return strip(F.array_join(F.when(bad > 0, F.slice(own, F.lit(1), (bad - 1).cast("int"))).otherwise(own), "\n"))


def _starts(low: Column, phrases: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | low.startswith(p.lower())
    return out


@lru_cache(maxsize=1)
def _capitals() -> dict[str, str]:
    """The characters that are written as each character in lower case, itself among them."""
    out: dict[str, str] = {}
    for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))):
        out[c.lower()] = out.get(c.lower(), "") + c
    return out


def _spelled(label: str) -> str:
    """Pattern of the texts that ``label`` (lower-case) is the lower case of."""
    out = ""
    for at, c in enumerate(label):
        own = [x for x in _capitals().get(c, "") + "Σ" if (label[:at] + x + label[at + 1 :]).lower() == label]
        out += f"(?:{'|'.join(map(re.escape, dict.fromkeys(own)))})" if own else re.escape(c)
    return out.replace("(?:I|i)(?:\u0307)", "(?:(?:I|i)\u0307|İ)")


def drop_widgets(col: Column, markers: Sequence[str], buttons: Sequence[str]) -> Column:
    """Drops each marker line with the line after it, and lines that are only a button's label.

    One pass over the text: a match takes what goes, so a line after a marker is gone before it could be one itself.
    """
    text = F.concat(F.regexp_replace(text_or_empty(col), OTHER_BREAK, "\n"), F.lit("\n"))
    beside = f"(?U:[{BLANK[1:-1]}&&[^\\n]])*+"
    label = lambda names: f"(?:{'|'.join(_spelled(n.lower()) for n in names if len(n.splitlines()) < 2)})" if names else "(?!)"
    gone = f"(?m)^{beside}(?:{label(markers)}{beside}\\n(?:[^\\n]*+\\n)?|{label(buttons)}{beside}\\n)"
    return strip(F.regexp_replace(text, gone, ""))


def cut_html(col: Column, pattern: str, phrases: Sequence[str] = ()) -> Column:
    """HTML before the first tag that ``pattern`` matches, else before the earliest phrase."""
    text = text_or_empty(col)
    at = F.regexp_instr(text, F.lit(pattern))
    hit = F.when(at > 0, at).otherwise(first_hit(text, phrases))
    return F.when(hit.isNotNull(), strip(F.substring(text, F.lit(1), hit - 1))).otherwise(text)


#: Opening tags after which a page holds nothing of its article.
COPYRIGHT_TAG = "(?i)<div\\b[^>]*class\\s*=\\s*(['\"])[^'\"]*\\bmentions-copyright\\b[^'\"]*\\1[^>]*>"
FOOTER_TAG = "(?i)<footer\\b[^>]*class=(['\"])[^'\"]*\\bwp-block-group\\b[^'\"]*\\bmargin-block-start-xl\\b[^'\"]*\\1[^>]*>"
FOOTER_PHRASES = ["Science Feedback is a non-partisan, non-profit organization", "Get in touch", "Published on:", "Tags:"]
#: What block pages say.
BLOCK_PAGE = ["access denied", "zugriff verweigert", "accès refusé", "request blocked", "forbidden", "you have been blocked", "bot detection", "verify you are human", "captcha", "cloudflare", "attention required"]


def truncate_at(col: Column, sentinels: Sequence[str] | None) -> Column:
    """Text before the earliest sentinel (case counts); no sentinels: the text itself."""
    if not sentinels:
        return col
    places = F.array_min(F.filter(F.array(*[F.instr(col, s) for s in sentinels]), lambda x: x > 0))
    return F.when(places.isNotNull(), F.substring(col, F.lit(1), places - 1)).otherwise(col)


def is_block_page(html: Column) -> Column:
    """Whether a page only says that access was denied; an empty one counts."""
    low, out = F.lower(text_or_empty(html)), text_or_empty(html) == ""
    for needle in BLOCK_PAGE:
        out = out | low.contains(needle)
    return out


def strip_tags(html: Column) -> Column:
    """T15 for markup without scripts: text between tags, joined by spaces."""
    return clean(F.regexp_replace(text_or_empty(html), "<[^>]*>", " "))


def unescape_basic(col: Column) -> Column:
    """T16 for the five entities of XML; ``html.unescape`` covers the rest (see ``functions.python``)."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        col = F.replace(col, F.lit(entity), F.lit(char))
    return col


def merge_lead(lead: Column, body: Column, window: int) -> Column:
    """Lead before body unless the body's first ``window`` characters hold it, case ignored."""
    a, b = clean_lines(lead), clean_lines(body)
    held = F.lower(F.substring(b, 1, window)).contains(F.lower(a))
    return F.when((a == "") | held, b).when(b == "", a).otherwise(F.concat(a, F.lit("\n"), b))


def with_rights(caption: Column, rights: Column) -> Column:
    """Caption and copyright holder."""
    return F.when(text_or_empty(rights) == "", text_or_empty(caption)).when(text_or_empty(caption) == "", F.concat(F.lit("© "), rights)).otherwise(F.concat(caption, F.lit(" © "), rights))


def split_title(title: Column) -> Column:
    """``caption | rights`` of an image's title."""
    return F.struct(clean(F.split_part(title, F.lit("|"), F.lit(1))).alias("caption"), clean(F.split_part(title, F.lit("|"), F.lit(2))).alias("rights"))


def claim_modality(reply: Column) -> Column:
    """The label after the first line ``claim type:``, else unknown."""
    label = F.lower(strip(F.regexp_extract(text_or_empty(reply), "(?im)^claim type:(.*)$", 1)))
    return F.when(label == "", "unknown").otherwise(label)


def longer(first: Column, second: Column) -> Column:
    """The longer of two texts, the first of equals."""
    return F.when(F.length(second) > F.length(first), second).otherwise(first)


def is_long(col: Column, least: int) -> Column:
    """T26."""
    return F.length(text_or_empty(col)) >= least


def attribute_urls(html: Column, name: str = "src|href") -> Column:
    """Values of the named attributes, both kinds of quotes, in order."""
    own = F.regexp_extract_all(text_or_empty(html), F.lit(f"(?i)\\b(?:{name})\\s*=\\s*(\"[^\"]*\"|'[^']*')"), F.lit(1))
    return F.transform(own, lambda x: F.substring(x, F.lit(2), F.length(x) - 2))


def harvest(html: Column, patterns: Sequence[str]) -> Column:
    """Attribute values that match a provider's pattern, and the patterns' own hits; a sorted set."""
    listed = F.filter(attribute_urls(html), lambda x: x.rlike("|".join(patterns)))
    raw = F.concat(*[F.regexp_extract_all(text_or_empty(html), F.lit(f"({p})"), F.lit(1)) for p in patterns])
    return F.array_sort(F.array_distinct(F.concat(listed, raw)))


def sorted_set(values: Column) -> Column:
    """O2."""
    return F.array_sort(F.array_distinct(values))


def shortest_prefixes(values: Column) -> Column:
    """Distinct values that have no other as a prefix, by length, then by code point."""

    def of(own: Column) -> Column:
        kept = F.filter(own, lambda x: ~F.exists(own, lambda y: (x != y) & x.startswith(y)))
        keyed = F.array_sort(F.transform(kept, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))
        return F.transform(keyed, lambda k: k.x)

    return bound(F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != ""))), of)
