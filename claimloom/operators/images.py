"""Images of an article: candidates from its page by a publisher's spec, then the best rendition of each picture.

Candidates come out of one Arrow-batched parse as array<struct<pos,url,w,cap>>. Choosing is relational: rank within the asset,
then within the caption, by (width, kind of file, earliest place). Both rankings are partitioned by article, so a page's
candidates meet in one task and no more.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import url as U
from claimloom.functions.python import join_url
from claimloom.functions.text import caption_key, clean
from claimloom.html.dom import Element, parse
from claimloom.session import page_batches

ALLOWED = re.compile(r"\.(jpe?g|png|webp|avif)$", re.I)
BODY = ("article", "main", ".article", ".article-body", ".entry-content", ".post-content", ".content")
FIGCAPTION = ("figcaption",)


@dataclass(frozen=True)
class ImageSpec:
    """Where a publisher's pictures are and which of them count.

    ``scopes``: the first that holds an image; ``boxes``: elements with one caption each; ``mode``: how renditions are chosen
    (asset+caption, asset+caption with all empty captions as one, asset, url); ``ladder`` and ``asset``: rules of U16 and U19;
    ``pick``: what a box gives, see ``picked``; ``loose``: pictures outside of boxes count too, or only if boxes have none.
    """

    publisher: str
    boxes: str = "figure"
    scopes: tuple[str, ...] = BODY
    captions: tuple[str, ...] = FIGCAPTION
    rights: tuple[str, ...] = ()
    outside: str = ""
    removed: tuple[str, ...] = ()
    before: str = ""
    after: str = ""
    mode: str = "url"
    ladder: str = "plain"
    asset: str = "plain"
    links: bool = False
    kinds: str = r"jpe?g|png|webp|avif"
    any_kind: bool = False
    alt_caption: bool = False
    pick: str = "all"
    loose: bool | str = False
    json_caption: bool = False
    tweets: bool = False
    not_alt: tuple[str, ...] = ()


#: Where each publisher keeps its pictures and captions.
SPECS = {
    s.publisher: s
    for s in [
        ImageSpec("br", "section[class*='ArticleModule'], figure", ("#root",), ("[class*='caption']", "figcaption"), ("[class*='copyright']",), "header, footer, section[class*='ArticleModuleMedia'], [class*='MediaPlayer'], [class*='ardplayer']", mode="asset+caption", ladder="br", asset="br", links=True, json_caption=True),
        ImageSpec("correctiv", "figure", (*BODY, "body"), mode="asset+caption", links=True),
        ImageSpec("factencheckafp", ".wrapper-image", ("#root",), (".legend", "figcaption"), mode="asset+merged", asset="afp"),
        ImageSpec("rtl", "figure", (*BODY, "body"), ("[class*='Picture_caption']", "figcaption"), ("[class*='Picture_copyright']",), before="div[class*='default_root']", mode="asset+caption", ladder="rtl", asset="rtl", links=True),
        ImageSpec("stern", "figure, picture", ("article.article",), ("figcaption", ".legend"), outside=".teaser, [class*='teaser'], [class*='paid'], [class*='widget']", mode="asset+merged", ladder="stern", asset="stern", loose=True),
        ImageSpec("tagesschau", "div.absatzbild", ("article",), (".absatzbild__info__text", ".absatzbild__info p"), outside="[class*='head'], [class*='teaser'], aside", mode="asset+caption", ladder="query", asset="tagesschau"),
        ImageSpec("volksverpetzer", "figure.wp-block-image", ("#article_body_content",), ("figcaption", ".wp-element-caption", ".wp-caption-text"), outside="article.teaser, article.teaser--embed", mode="asset", asset="stern", loose=True, alt_caption=True, not_alt=("logo", "avatar", "banner")),
        ImageSpec("20minutes", "article.o-paper__content figure.c-media", ("#root",), any_kind=True, pick="src"),
        ImageSpec("defactobservatoire", "figure, div.ww-item.image p", ("div.defacto-fact-check-body", "#root"), ("figcaption", "span[class*='legend']"), any_kind=True, pick="img"),
        ImageSpec("factuelafp", "div.wrapper-image", ("#block-factuel-content", "body"), ("span.legend",), kinds=r"jpe?g|png", loose="none", pick="img"),
        ImageSpec("fasocheck", ".wp-caption, figure", ("div.entry-content",), (".wp-caption-text", "figcaption"), removed=(".sfsi_responsive_icons", ".sfsiaftrpstwpr", "#comment-wrap", ".sfsi_icons_container", ".sfsi_wicon"), loose=True, alt_caption=True, pick="img"),
        ImageSpec("francetvinfo", "figure", ("div.c-body",), mode="asset+caption", asset="fit_in", tweets=True),
        ImageSpec("lemonde", "figure", ("article.article__content", "#root"), ("figcaption.article__legend", "figcaption"), any_kind=True, pick="larger"),
        ImageSpec("liberation", "figure", ("article .article-body", "article .article__content", "article .paywall-content", "article", "body"), mode="asset+caption", asset="fit_in", tweets=True),
        ImageSpec("numerama", "figure", ("div.article-content.post-content",), any_kind=True, tweets=True, pick="first"),
        ImageSpec("observalgerie", "figure", ("div.entry-content", "article", "main", "#root"), any_kind=True, loose=True, alt_caption=True, pick="img"),
        ImageSpec("sciencefeedback", "figure", ("main", "article", "#root"), outside="footer", removed=("footer",), after="#verification", before="#references", any_kind=True, pick="first"),
        ImageSpec("tf1info", "figure, .Picture, .ArticleImage", ("article", "#root"), outside="[class*='ReadMore']", any_kind=True, loose=True, pick="widest"),
    ]
}

SOURCES = ("src", "data-src", "data-lazy-src", "data-original")
_WIDTH = [re.compile(p) for p in (r"/fit-in/([0-9]+)x", r"/([0-9]{2,5})x[0-9]{1,5}(?:/|$)", r"(?<![0-9a-z])([0-9]{2,5})w(?![a-z0-9])", r"[?&](?:w|width)=([0-9]+)", r"/w([0-9]{2,5})(?:/|$)")]


def stated_width(url: str) -> int:
    return next((int(m[1]) for p in _WIDTH if (m := p.search(url.lower()))), 0)


def parse_srcset(text: str, density: int = 1000) -> list[tuple[str, int]]:
    out = []
    for part in (p.split() for p in text.split(",")):
        if not part:
            continue
        size = part[1] if len(part) > 1 else ""
        w = int(size[:-1]) if re.fullmatch("[0-9]+w", size) else int(float(size[:-1]) * density) if re.fullmatch(r"[0-9]+(\.[0-9]+)?x", size) else stated_width(part[0])
        out.append((part[0], w))
    return out


def image_sources(img: Element) -> list[tuple[str, int]]:
    """A tag's srcset, then the first of its source attributes."""
    listed = parse_srcset(img.get("srcset") or img.get("data-srcset"))
    single = next((v for a in SOURCES if (v := img.get(a).strip())), "")
    return listed + ([(single, stated_width(single))] if single and img.tag == "img" else [])


def _widest(e: Element, last: bool = False) -> str:
    listed = parse_srcset(e.get("srcset") or e.get("data-srcset"))
    return "" if not listed else listed[-1][0] if last else max(listed, key=lambda x: x[1])[0]


def _source(img: Element, last: bool = False) -> str:
    """The first of a tag's source attributes, else of its srcset."""
    return next((v for a in SOURCES if (v := img.get(a).strip())), "") or _widest(img, last)


#: How an address states its width, and numbers that stand alone in its path.
STATED_WIDTHS, PATH_NUMBER = (r"([0-9]{3,4})w(?:\D|$)", r"/fit-in/([0-9]{3,4})x"), r"/([0-9]{3,4})(?=/|$)"


def _score(url: str) -> int:
    """The width that an address states, else the largest number that stands alone in its path."""
    stated = next((m for p in STATED_WIDTHS if (m := re.search(p, url))), None)
    return int(stated[1]) if stated else max((int(n) for n in re.findall(PATH_NUMBER, re.split("[?#]", url)[0])), default=0)


def picked(holder: Element, how: str) -> list[str]:
    """Addresses that a box gives where renditions do not compete as assets.

    src: the widest of each source, and each image's own address; img: each image's own; first: the first source, image or link that
    has one; larger: the one of all sources and images that states the largest width; widest: the widest of all sources, of image
    types first, else the first image's own.
    """
    sources, imgs = holder.all("source"), holder.all("img")
    if how == "img":
        return [u for i in imgs if (u := _source(i, last=True))]
    if how == "src":
        return [u for e in holder.all("source", "img") if (u := _widest(e) if e.tag == "source" else _source(e))]
    if how == "larger":
        urls = [u for e in holder.all("source", "img") if (u := _widest(e) or (_source(e) if e.tag == "img" else ""))]
        return [max(urls, key=_score)] if urls else []
    if how == "widest":
        known = [e for e in sources if e.get("type").strip().lower().startswith("image/")]
        for group in (known, [e for e in sources if e not in known]):
            listed = [c for e in group for c in parse_srcset(e.get("srcset") or e.get("data-srcset"))]
            if listed:
                return [max(listed, key=lambda c: c[1])[0]]
        sources = []
    links = [a.get("href") for a in holder.all("a") if ALLOWED.search(re.split("[?#]", a.get("href"))[0])]
    return [u for u in (*map(_widest, sources), *map(_source, imgs), *links) if u][:1]


def _caption(box: Element, spec: ImageSpec) -> str:
    text = next((t for s in spec.captions if (e := box.one(s)) and (t := " ".join(e.text().split()))), "")
    rights = next((" ".join(e.text().split()) for s in spec.rights if (e := box.one(s))), "")
    if not text and spec.json_caption:
        for script in box.select("script[type='application/ld+json']"):
            try:
                stated = json.loads("".join(c for c in script.children if isinstance(c, str)))
                text = " ".join(str(stated.get("caption") or "").split())
                rights = rights or " ".join(str((stated.get("copyrightHolder") or {}).get("name") or "").split())
            except (ValueError, AttributeError):
                continue
        if not text and (a := box.one("a[data-sub-html]")):
            text = " ".join(parse(a.get("data-sub-html")).text().split())
    return f"{text} © {rights}" if rights and text else f"© {rights}" if rights else text


def candidates(page: str | Element | None, base: str | None, spec: ImageSpec) -> list[dict]:
    """Every rendition of every picture in scope, in document order; a parsed page is left as it is."""
    root = parse(page) if page is None or isinstance(page, str) else page.copy()
    scope = next((e for s in spec.scopes if (e := root if s == "#root" else root.one(s)) and (e.first("img", "figure", "source") is not None)), None)
    if scope is None:
        return []
    for selector in spec.removed:
        for e in scope.select(selector):
            e.remove()
    first = next((e.order for e in scope.select(spec.after)), None) if spec.after else 0
    if first is None:
        return []
    last = next((e.order for e in scope.select(spec.before) if e.order > first), float("inf")) if spec.before else float("inf")
    outside = {id(e) for e in root.select(spec.outside)} if spec.outside else set()
    out: list[dict] = []
    kinds = re.compile(rf"\.({spec.kinds})$", re.I)
    seen: set[int] = set()

    def add(url: str, w: int, cap: str) -> None:
        full = join_url(base, url)
        if full and not full.startswith("blob:") and (spec.any_kind or kinds.search(re.split("[?#]", full)[0])):
            out.append({"pos": len(out), "url": full, "w": w, "cap": cap})

    def take(holder: Element, cap: str) -> None:
        if spec.pick != "all":
            mine = [i for i in holder.all("img") if id(i) not in seen and not any(id(a) in outside for a in (i, *i.ancestors()))]
            fresh = mine or (holder.first("img") is None and holder.first("source") is not None)
            seen.update(id(i) for i in holder.all("img"))
            alt = next((t for i in mine if (t := " ".join((i.get("title") or i.get("alt")).split()))), "") if spec.alt_caption else ""
            for url in picked(holder, spec.pick) if fresh else []:
                add(url, _score(url), cap or alt)
            return
        for e in holder.all("source", "img", "noscript", *(["a"] if spec.links else [])):
            if id(e) in seen or any(id(a) in outside for a in (e, *e.ancestors())):
                continue
            seen.add(id(e))
            if e.tag == "a":
                if e.get("href") and ALLOWED.search(re.split("[?#]", e.get("href"))[0]):
                    add(e.get("href"), stated_width(e.get("href")), cap)
                continue
            if any(n in f"{e.get('alt')} {e.get('title')}".lower() for n in spec.not_alt):
                continue
            for url, w in image_sources(e):
                add(url, w, cap or (" ".join((e.get("title") or e.get("alt")).split()) if spec.alt_caption else ""))

    for box in scope.select(spec.boxes):
        if not first <= box.order < last or box.first("video") is not None:
            continue
        tweet = next((m[1] for i in box.all("iframe", "blockquote") if (m := re.search(r"(?:[?&]id=|/status/|data-tweet-id=\")([0-9]+)", i.html()))), None) if spec.tweets else None
        if tweet:
            out.append({"pos": len(out), "url": f"tweet:{tweet}", "w": 0, "cap": _caption(box, spec)})
            continue
        take(box, _caption(box, spec))
    if spec.loose is True or (spec.loose and not out):
        for img in scope.all("img"):
            if id(img) not in seen and first <= img.order < last:
                holder = Element("#one", {}, None)
                holder.children = [img]  # its ancestors stay its own
                take(holder, "")
    return out


CANDIDATES = "array<struct<pos:int,url:string,w:int,cap:string>>"


def found(page: str | Element | None, base: str | None, spec: ImageSpec) -> dict:
    """``candidates``, or the reason why a page could not be read."""
    try:
        return {"list": candidates(page, base, spec), "error": None}
    except Exception as error:
        return {"list": [], "error": f"{type(error).__name__}: {error}"}


def candidate_images(html: Column, base: Column, publisher: str) -> Column:
    """Struct (list, error) of a page's candidates."""
    spec = SPECS[publisher]
    page_batches()

    @F.pandas_udf(f"struct<list:{CANDIDATES},error:string>")
    def run(html: pd.Series, base: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([found(h, b, spec) for h, b in zip(html, base, strict=True)], columns=["list", "error"])

    return run(html, base)


def choose(rows: DataFrame, mode: str, asset: Column, group: str = "article_url") -> DataFrame:
    """Of candidate ``rows`` (group, pos, url, w, cap) the ones that stay, by ``mode``.

    The best rendition has the largest width, then the better kind of file, then the earliest place. An asset takes the first
    caption any of its renditions has. With captions, one picture stays for each; empty captions stay apart, or, merged, are one.
    Rows move once, to their article's task; both choices are minima by a sort key there, without a window.
    """
    own = lambda cap: F.struct("pos", "url", "w", cap.alias("cap"), "__asset", "__prio")
    best_first = F.struct(-F.col("w"), -F.col("__prio"), "pos", "url", "cap")
    keyed = rows.withColumns({"__asset": asset, "__prio": U.extension_priority(F.col("url"))}).repartition(group)
    first_cap = F.min_by(F.when(F.col("cap") != "", F.col("cap")), F.when(F.col("cap") != "", F.struct("pos", "url", "cap")))
    first = keyed.groupBy(group, "__asset").agg(F.min_by(own(F.col("cap")), best_first).alias("b"), first_cap.alias("c"))
    first = first.select(group, "b.*", F.coalesce("c", F.lit("")).alias("__cap")).drop("cap").withColumnRenamed("__cap", "cap")
    if mode.startswith("asset+"):
        key = F.when((F.col("cap") == "") & F.lit(mode == "asset+caption"), F.concat(F.lit("\u0000"), F.col("__asset"))).otherwise(caption_key(F.col("cap")))
        first = first.withColumn("__key", key).groupBy(group, "__key").agg(F.min_by(own(F.col("cap")), best_first).alias("b")).select(group, "b.*")
    return first.select(group, "pos", "url", "w", "cap")


def images(pages: DataFrame, publisher: str, html: str = "html", url: str = "url") -> DataFrame:
    """(article_url, images, error): the chosen pictures of each page as array<struct<image_url, caption, path>> in document order."""
    found = pages.select(F.col(url).alias("article_url"), candidate_images(F.col(html), F.col(url), publisher).alias("found"))
    return with_choice(found, "found.list", publisher).select("article_url", "images", F.col("found.error").alias("error"))


def with_choice(pages: DataFrame, found: str, publisher: str) -> DataFrame:
    """``pages`` with ``images``: ``choose`` among each row's own array of candidates, so that no row moves."""
    spec = SPECS[publisher]
    asset = (lambda u: u) if spec.mode == "url" else (lambda u: U.asset_key(u, spec.asset))
    # fields in the order of preference, so that the least struct is the best rendition
    keyed = lambda c: F.struct((-c.w).alias("w"), (-U.extension_priority(c.url)).alias("prio"), c.pos.alias("pos"), c.url.alias("url"), c.cap.alias("cap"), asset(c.url).alias("key"))
    rows = pages.withColumn("__own", F.transform(F.coalesce(F.col(found), F.array().cast(CANDIDATES)), keyed))

    def least(key: Column) -> Column:
        same = F.filter(F.col("__own"), lambda c: c.key == key)
        caps = F.filter(F.transform(same, lambda c: F.struct(c.pos.alias("pos"), c.url.alias("url"), c.cap.alias("cap"))), lambda c: c.cap != "")
        top, cap = F.array_min(same), F.coalesce(F.array_min(caps).cap, F.lit(""))
        empty = F.concat(F.lit("\u0000"), key) if spec.mode != "asset+merged" else F.lit("")
        group = F.when(cap == "", empty).otherwise(caption_key(cap)) if spec.mode.startswith("asset+") else key
        return F.struct(top.w.alias("w"), top.prio.alias("prio"), top.pos.alias("pos"), top.url.alias("url"), cap.alias("cap"), group.alias("key"))

    keys = lambda of: F.array_distinct(F.transform(of, lambda c: c.key))
    rows = rows.withColumn("__best", F.transform(keys(F.col("__own")), least))
    best = F.transform(keys(F.col("__best")), lambda k: F.array_min(F.filter(F.col("__best"), lambda c: c.key == k)))
    listed = F.array_sort(F.transform(best, lambda c: F.struct(c.pos.alias("pos"), c.url.alias("image_url"), clean(c.cap).alias("caption"), U.image_name(F.lit("img"), c.url).alias("path"))))
    rows = rows.withColumn("__listed", listed)
    return rows.withColumn("images", F.transform("__listed", lambda x: F.struct(x.image_url.alias("image_url"), x.caption.alias("caption"), x.path.alias("path")))).drop("__own", "__best", "__listed")


def cdn_images(html: Column) -> Column:
    """Sorted set of one broadcaster's picture urls anywhere in the page."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit("(https?://images\\.tagesschau\\.de/image/[0-9a-f-]{36}/[^\"'\\s<>]+)"), F.lit(1))))


def screenshot_name(article: Column, kind: str, index: Column) -> Column:
    """File of a captured embed."""
    return F.concat(F.lit(f"{kind}_"), F.substring(F.md5(F.concat(article, F.lit(f"#{kind}#"), index.cast("string"))), 1, 12), F.lit(".png"))


def reuse_captured(wanted: DataFrame, captured: DataFrame, every: bool = False, order: str | None = None) -> DataFrame:
    """``wanted`` (image_url) with the body of a captured response: same url, else same url without its query.

    Of responses with equal urls the first by column ``order`` of ``captured`` counts (any without one); with ``every`` each response
    with the wanted url gives a row.
    """
    bare = F.split_part(F.col("image_url"), F.lit("?"), F.lit(1))
    by = F.struct("url", order) if order else F.struct("url")
    exact = captured.select(F.col("url").alias("__u"), F.col("body").alias("__b1")) if every else captured.groupBy(F.col("url").alias("__u")).agg(F.min_by("body", by).alias("__b1"))
    loose = captured.groupBy(F.split_part("url", F.lit("?"), F.lit(1)).alias("__v")).agg(F.min_by("body", by).alias("__b2"))
    joined = wanted.join(exact, F.col("image_url") == F.col("__u"), "left").join(loose, bare == F.col("__v"), "left")
    return joined.withColumn("body", F.coalesce("__b1", "__b2")).drop("__u", "__v", "__b1", "__b2")
