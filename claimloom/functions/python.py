"""The few functions that need Python: entities, folding, ordered JSON walks, and joins of urls inside a page that is parsed anyway.

Each is Arrow-batched and sees whole columns; values repeat within a batch, so each distinct value is worked out once.
"""

from __future__ import annotations

import html
import json
import unicodedata
from collections.abc import Callable, Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _each(series: pd.Series, of: Callable) -> pd.Series:
    known = {value: of(value) for value in series.dropna().unique()}
    return series.map(lambda v: known.get(v) if v is not None and v == v else of(None))


def join_url(base: str | None, url: str | None) -> str | None:
    """U6 for urls found while a page is parsed; ``resolve.absolute_url`` is the Column."""
    url = (url or "").strip()
    if not url or url.lower().startswith("data:"):
        return None
    if url.startswith("//"):
        return f"https:{url}"
    try:
        return urljoin(base or "", url)
    except ValueError:
        return None


@F.pandas_udf(StringType())
def unescape(col: pd.Series) -> pd.Series:
    """All entities of HTML."""
    return _each(col, lambda v: None if v is None else html.unescape(v))


def fold(text: str) -> tuple[str, list[int]]:
    """Text without accents, lower-case, blanks collapsed, and for each of its characters the place it came from."""
    out, at = [], []
    for place, char in enumerate(text):
        for c in unicodedata.normalize("NFKD", char):
            if unicodedata.combining(c):
                continue
            for low in c.lower():
                if low.isspace():
                    if out and out[-1] == " ":
                        continue
                    low = " "
                out.append(low)
                at.append(place)
    return "".join(out), at


def cut_folded(text: str | None, phrases: list[str]) -> str:
    """The text before the earliest phrase, accents and case ignored; offsets are exact."""
    text = text or ""
    folded, at = fold(text)
    hits = [i for p in phrases if (wanted := fold(p)[0].strip()) and (i := folded.find(wanted)) >= 0]
    return (text[: at[min(hits)]] if hits else text).strip()


def accent_cut(phrases: list[str]):
    @F.pandas_udf(StringType())
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([cut_folded(t, phrases) for t in text])

    return run


def walk(value) -> Iterator:
    """Every value inside a JSON document, parents first, in order."""
    yield value
    for inner in value.values() if isinstance(value, dict) else value if isinstance(value, list) else ():
        yield from walk(inner)


def parsed(text: str | None):
    for attempt in (text or "", html.unescape(text or "")):
        try:
            return json.loads(attempt)
        except ValueError:
            continue
    return None


#: JSON-LD types that hold an article.
ARTICLE_TYPES = {"newsarticle", "reportagenewsarticle", "article"}


def jsonld_article(scripts: list[str]) -> tuple[str, str]:
    """(headline, body) of the article with the longest body among JSON-LD blocks, ``@graph`` and lists included."""
    title, body = "", ""
    for node in (n for s in scripts for n in walk(parsed(s)) if isinstance(n, dict)):
        kinds = node.get("@type")
        kinds = {str(k).lower() for k in (kinds if isinstance(kinds, list) else [kinds])}
        text = node.get("articleBody")
        if kinds & ARTICLE_TYPES and isinstance(text, str) and len(text) > len(body):
            title, body = str(node.get("headline") or ""), text
    return title, body


@F.pandas_udf(StringType())
def first_handle(document: pd.Series) -> pd.Series:
    """The first string in a JSON document that starts with ``@``, in document order."""
    return _each(document, lambda d: next((v for v in walk(parsed(d)) if isinstance(v, str) and v.startswith("@")), None))
