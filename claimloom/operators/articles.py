"""Article extraction: one cascade of strategies, declared per publisher.

A page is parsed once in an Arrow-batched function that returns a struct (title, content, strategy, error); each strategy reads a
copy of its tree, since some take elements out. Strategies are tried in the publisher's order; each rule says from which length on a
result is accepted and whether the longer of two stays.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import python as py
from claimloom.functions import text as T
from claimloom.html import score
from claimloom.html.dom import Element, parse
from claimloom.session import page_batches

#: Phrases that end an article.
COMMON_STOPS = ("Passend dazu", "Du liest Artikel zu Ende", "MÖCHTEST DU MEHR", "Unterstützen")
APA_STOP = (
    r"Wenn\s+Sie\s+zum\s+Faktencheck-Team\s+Kontakt\s+aufnehmen\s+oder\s+Faktenchecks\s+zu\s+relevanten\s+Themen\s+anregen\s+möchten,"
    r"\s*schreiben\s+Sie\s+bitte\s+an\s+faktencheck@apa\.at"
)
CORRECTIV_STOPS = (
    "CORRECTIV im Postfach", "Ihre Unterstützung zählt", "Jetzt unterstützen", "Spendenkonto", "Kontakt", "Zentrale Essen", "Redaktion Berlin",
    "Buchladen Essen", "Jugendredaktion", "Hinweise geben", "Datenschutz", "Online-Shop", "Newsletter",
)
CORRECTIV_MARKERS, CORRECTIV_BUTTONS = ("Mehr von CORRECTIV",), ("weiterlesen", "mehr erfahren", "jetzt spenden", "gerade nicht")
TF1_STOP = (
    "Vous souhaitez nous poser des questions ou nous soumettre une information qui ne vous paraît pas fiable ? N'hésitez pas à nous écrire à "
    "l'adresse lesverificateurs@tf1.fr. Retrouvez-nous également sur X : notre équipe y est présente derrière le compte @verif_TF1LCI."
)
#: Where publishers keep titles, leads and bodies, and what is taken out of them.
PLAIN_CONTAINERS = ("article", ".entry-content", ".post-content", ".et_pb_post_content", ".post-content-inner")
CORRECTIV_CONTAINERS = ("article", "main article", "div.entry-content", "div.post-content", "div.wp-block-post-content", "[itemprop='articleBody']", "main")
AFP_CONTAINERS = (
    "article", "[itemprop='articleBody']", "div.article-body", "div.article__body", "div.c-article__body", "div.story-body", "div.content__body",
    "div.wysiwyg", "main",
)
SCIENCE_CONTAINERS = ("main", "article", "div.wp-block-post-content", "[itemprop='articleBody']", "div.entry-content", "div.post-content")
DPA_LEADS = ("p.teaser", "p.chapo", "p.standfirst", "p.subheading", ".article__teaser", ".article-teaser")
FASOCHECK_REMOVED = (".sfsiaftrpstwpr", ".sfsi_responsive_icons", "#comment-wrap", "#respond", ".comment-respond", "script", "style", "noscript")
OBSERVALGERIE_REMOVED = ("div.code-block", "a.related-article", ".trv-player-container", "nav.related-articles", "script", "style", "noscript", "ins.adsbygoogle", "figcaption")

READ_TAGS, BODY_TAGS = ("h1", "h2", "h3", "p", "blockquote", "li"), ("h2", "h3", "p", "blockquote", "li")


@dataclass(frozen=True)
class Strategy:
    """How a title and a body are read off a page.

    ``kind``: container (first of ``containers``; ``whole`` text without one), content (scored) or jsonld.
    """

    kind: str
    tags: tuple[str, ...] = BODY_TAGS
    containers: tuple[str, ...] = ()
    removed: tuple[str, ...] = ("script", "style", "noscript")
    whole: bool = False
    titles: tuple[str, ...] = ("h1",)
    cut_after: str = ""
    stop_class: str = ""


@dataclass(frozen=True)
class Rule:
    """``accept``: length from which this result ends the cascade; ``only_below``: it is tried if the best is shorter."""

    strategy: Strategy
    only_below: int | None = None
    accept: int | None = None
    at_least_as_long: bool = False


@dataclass(frozen=True)
class Spec:
    publisher: str
    language: str
    rules: tuple[Rule, ...]
    stops: tuple[str, ...] = COMMON_STOPS
    stop_patterns: tuple[str, ...] = ()
    line_stops: tuple[str, ...] = ()
    markers: tuple[str, ...] = ()
    buttons: tuple[str, ...] = ()
    leads: tuple[str, ...] = ()
    lead_window: int = 600
    cut_html: str = ""
    cut_html_phrases: tuple[str, ...] = ()
    fold_accents: bool = False
    rendered_below: int | None = None
    rendered_hosts: tuple[tuple[str, int], ...] = ()
    rendered_first: tuple[str, ...] = ()
    guarded: bool = False
    collapse_tabs_only: bool = False
    sites: tuple[str, ...] = field(default=())


CONTENT = Strategy("content", READ_TAGS)
FALLBACK = Strategy("container", BODY_TAGS, PLAIN_CONTAINERS, whole=True)
CASCADE = (Rule(CONTENT), Rule(FALLBACK, only_below=200))
_FIG = (*BODY_TAGS, "figcaption")
_DEEP = ("h1", "h2", "h3", "h4", "p", "blockquote", "li")
_PRUNED = ("script", "style", "noscript", "aside", "footer", "form")
_AFP = Spec(
    "factencheckafp", "de", (Rule(Strategy("jsonld"), accept=400), Rule(Strategy("container", BODY_TAGS, AFP_CONTAINERS, _PRUNED), at_least_as_long=True), Rule(CONTENT, only_below=300)),
    cut_html=T.COPYRIGHT_TAG, rendered_below=250, rendered_first=("faktencheck.afp.com",), guarded=True, sites=("faktencheck.afp.com",),
)
_DPA = Spec("dpa", "de", CASCADE, leads=DPA_LEADS, sites=("dpa-factchecking.com",))
SPECS = {
    f"{s.language}/{s.publisher}": s
    for s in [
        Spec("apa", "de", CASCADE, stop_patterns=(APA_STOP,), sites=("apa.at",)),
        Spec("br", "de", CASCADE, stop_patterns=(APA_STOP,), sites=("br.de",)),
        Spec(
            "correctiv", "de",
            (
                Rule(Strategy("container", _FIG, ("div.detail__content",), ("div.corre-abbinder-events", "div.related__container", "div.corre-nach-dem-3-absatz-recherche", "div.corre-target", *_PRUNED)), accept=400),
                Rule(replace(CONTENT, tags=(*READ_TAGS, "figcaption"))), Rule(Strategy("container", _FIG, CORRECTIV_CONTAINERS, _PRUNED, whole=True), only_below=250),
            ),
            stops=(), line_stops=CORRECTIV_STOPS, markers=CORRECTIV_MARKERS, buttons=CORRECTIV_BUTTONS, collapse_tabs_only=True, sites=("correctiv.org",),
        ),
        _DPA, replace(_DPA, publisher="presseportal", sites=("presseportal.de",)), replace(_DPA, language="fr"),
        _AFP, replace(_AFP, publisher="factuelafp", language="fr", sites=("factuel.afp.com",)),
        Spec("stern", "de", CASCADE, stop_patterns=(r"\bWeiterer\s+Faktencheck\b",), sites=("stern.de",)),
        *[Spec(name, "de", CASCADE, sites=(site,)) for name, site in (("rtl", "rtl.de"), ("tagesschau", "tagesschau.de"), ("volksverpetzer", "volksverpetzer.de"), ("wdr", "wdr.de"))],
        *[Spec(name, "fr", CASCADE, sites=(site,)) for name, site in (("20minutes", "20minutes.fr"), ("francetvinfo", "francetvinfo.fr"))],
        Spec("defactobservatoire", "fr", CASCADE, leads=("div.defacto-fact-check-chapeau",), lead_window=800, sites=("defacto-observatoire.fr",)),
        Spec("lemonde", "fr", CASCADE, leads=("div.ds-description span.ds-chapo", "div.ds-description"), lead_window=800, sites=("lemonde.fr",)),
        Spec("liberation", "fr", CASCADE, rendered_below=200, rendered_hosts=(("liberation.fr", 800),), sites=("liberation.fr",)),
        Spec("numerama", "fr", (Rule(replace(CONTENT, stop_class="newsletter")), Rule(replace(FALLBACK, tags=READ_TAGS, stop_class="newsletter"), only_below=200)), sites=("numerama.com",)),
        Spec(
            "sciencefeedback", "fr", (Rule(Strategy("container", (*_DEEP, "figcaption"), (*SCIENCE_CONTAINERS, "#root"))), Rule(replace(CONTENT, tags=(*_DEEP, "figcaption")), only_below=400)),
            stops=(), cut_html=T.FOOTER_TAG, cut_html_phrases=tuple(T.FOOTER_PHRASES), sites=("science.feedback.org",),
        ),
        Spec("tf1info", "fr", CASCADE, stops=(*COMMON_STOPS, TF1_STOP), fold_accents=True, sites=("tf1info.fr",)),
        Spec("fasocheck", "fr", (Rule(Strategy("container", _DEEP, ("div.entry-content", "article", "#left-area"), FASOCHECK_REMOVED, titles=("h1.entry-title", "h1"), cut_after="div[class*='sfsi'], div[class*='share'], div[class*='Share']")),), stops=(), sites=("fasocheck.org",)),
        Spec("observalgerie", "fr", (Rule(Strategy("container", _DEEP, ("div.entry-content", "article"), OBSERVALGERIE_REMOVED, titles=("h1.entry-title", "h1"), cut_after="div.component")),), stops=(), sites=("observalgerie.com",)),
    ]
}

_BLANKS, _TABS = re.compile(r"\s+"), re.compile(r"[ \t]+")


def tidy(text: str, only_tabs: bool = False) -> str:
    """T1 for text inside a worker."""
    own = ((_TABS if only_tabs else _BLANKS).sub(" ", line).strip() for line in text.replace(" ", " ").splitlines())
    return "\n".join(line for line in own if line)


def trimmed(text: str, spec: Spec) -> str:
    """The body after a publisher's widgets and stop markers."""
    if spec.markers or spec.buttons:
        kept, skip = [], False
        markers, buttons = {m.lower() for m in spec.markers}, set(spec.buttons)
        for line in text.split("\n"):
            key = line.strip().lower()
            if skip or key in markers:
                skip = not skip and key in markers
            elif key not in buttons:
                kept.append(line)
        text = "\n".join(kept)
    if spec.line_stops:
        lines = text.split("\n")
        starts = tuple(p.lower() for p in spec.line_stops)
        end = next((k for k, line in enumerate(lines) if line.strip().lower().startswith(starts)), len(lines))
        text = "\n".join(lines[:end]).strip()
    if spec.fold_accents:
        return py.cut_folded(text, list(spec.stops))
    low = text.lower()
    hits = [i for p in spec.stops if (i := low.find(p.lower())) >= 0] + [m.start() for p in spec.stop_patterns if (m := re.search(p, text, re.I))]
    return text[: min(hits)].strip() if hits else text


def _parts(scope: list[Element], strategy: Strategy) -> list[str]:
    out = []
    for top in scope:
        for e in ([top] if top.tag in strategy.tags else []) + list(top.descend()):
            if strategy.stop_class and any(strategy.stop_class in c.lower() for a in (e, *e.ancestors()) for c in a.classes):
                return out
            if e.tag in strategy.tags and (text := e.text()):
                out.append(text)
    return out


def run_strategy(page: str | Element, strategy: Strategy, spec: Spec) -> tuple[str, str]:
    """(title, body) by one strategy; a parsed page is left as it is."""
    root = parse(page) if isinstance(page, str) else page.copy()
    if strategy.kind == "jsonld":
        title, body = py.jsonld_article([s.children[0] for s in root.select("script[type='application/ld+json']") if s.children and isinstance(s.children[0], str)])
        return title.strip(), trimmed(tidy(parse(body).text() if "<" in body else body), spec)
    if strategy.kind == "content":
        title = score.short_title(root)
        return title, trimmed(tidy("\n".join(_parts(score.main_content(root), strategy)), spec.collapse_tabs_only), spec)
    heading = next((h for s in strategy.titles if (h := root.one(s))), None)
    title = heading.text() if heading else ""
    container = next((c for s in strategy.containers if (c := root if s == "#root" else root.one(s))), None)
    if container is None:
        return title, trimmed(tidy(root.text("\n")), spec) if strategy.whole else ""
    if strategy.cut_after and (mark := container.one(strategy.cut_after)):
        for sibling in mark.following():
            sibling.remove()
        mark.remove()
    for selector in strategy.removed:
        for e in container.select(selector):
            e.remove()
    return title, trimmed(tidy("\n".join(_parts([container], strategy)), spec.collapse_tabs_only), spec)


def cut_page(html: str, spec: Spec) -> str:
    """T12, T13 inside a worker."""
    if not spec.cut_html:
        return html
    if m := re.search(spec.cut_html, html):
        return html[: m.start()].strip()
    low = html.lower()
    hits = [i for p in spec.cut_html_phrases if (i := low.find(p.lower())) >= 0]
    return html[: min(hits)].strip() if hits else html


def cascade(html: str, spec: Spec, parsed: Element | None = None) -> tuple[str, str, str]:
    """(title, body, strategy) of the best rule on one page; ``parsed`` is its tree, if it is there already."""
    cut = cut_page(html, spec)
    root = parsed if parsed is not None and cut is html else parse(cut)
    title = body = used = ""
    for rule in spec.rules:
        if rule.only_below is not None and len(body) >= rule.only_below:
            continue
        t, b = run_strategy(root, rule.strategy, spec)
        if not used or len(b) > len(body) or (rule.at_least_as_long and len(b) >= len(body)):
            title, body, used = t or title, b, rule.strategy.kind
        if rule.accept is not None and len(b) >= rule.accept:
            break
    if spec.leads:
        lead = next((t for s in spec.leads if (e := root.one(s)) and (t := tidy(e.text()))), "")
        if lead and lead.lower() not in body[: spec.lead_window].lower():
            body = f"{lead}\n{body}" if body else lead
    return title.strip(), body, used


def blocks(html: str | None) -> bool:
    """S6 inside a worker: whether a copy only says that access was denied."""
    low = (html or "").lower()
    return not low or any(n in low for n in T.BLOCK_PAGE)


def copies(static: str | None, rendered: str | None, url: str | None, spec: Spec) -> list[tuple[str, str]]:
    """(kind, html) of the copies that may be read, in order (S5, H7): hosts of ``rendered_first`` show their articles in the rendered copy
    alone; a guarded publisher's block pages are none of it."""
    host = re.sub(r"^[a-z]+://([^/?#]*).*$", r"\1", (url or "").lower(), flags=re.DOTALL)
    both = [("rendered", rendered), ("", static)] if any(host == h or host.endswith("." + h) for h in spec.rendered_first) else [("", static), ("rendered", rendered)]
    return [(kind, html) for kind, html in both if html and not (spec.guarded and blocks(html))]


def extract(static: str | None, rendered: str | None, url: str | None, spec: Spec, parsed: Element | None = None) -> dict:
    """Title and content of a captured page; the rendered copy is read where the static one gives too little or was blocked.

    ``parsed``: the static copy's tree, if it is there already. A page of which only block pages were captured has that as its error.
    """
    try:
        usable = copies(static, rendered, url, spec)
        if not usable:
            if static or rendered:
                raise PermissionError("access denied")
            return {"title": None, "content": None, "strategy": None, "error": "no page captured"}
        (kind, html), later = usable[0], usable[1:]
        title, body, used = cascade(html, spec, parsed if html is static else None)
        used = f"{kind} {used}".strip()
        floor = max([spec.rendered_below or 0, *(n for host, n in spec.rendered_hosts if host in (url or ""))])
        if later and not kind and len(body) < floor:
            t, b, u = cascade(later[0][1], spec)
            if len(b) > len(body):
                title, body, used = t or title, b, f"rendered {u}"
        return {"title": title, "content": body, "strategy": used, "error": None}
    except Exception as error:  # R8: the row survives with its error
        return {"title": None, "content": None, "strategy": None, "error": f"{type(error).__name__}: {error}"}


ARTICLE = "struct<title:string,content:string,strategy:string,error:string>"


def article(html: Column, publisher: Column | str, rendered: Column | None = None, url: Column | None = None) -> Column:
    """Struct (title, content, strategy, error) of a page by its publisher's spec (R15); an unknown one is its row's error."""
    page_batches()
    @F.pandas_udf(ARTICLE)
    def run(html: pd.Series, rendered: pd.Series, url: pd.Series, name: pd.Series) -> pd.DataFrame:
        rows = [extract(h, r, u, SPECS[n]) if n in SPECS else _unknown(n) for h, r, u, n in zip(html, rendered, url, name, strict=True)]
        return pd.DataFrame(rows, columns=["title", "content", "strategy", "error"])

    none = F.lit(None).cast("string")
    return run(html, none if rendered is None else rendered, none if url is None else url, F.lit(publisher) if isinstance(publisher, str) else publisher)


def _unknown(name: str | None) -> dict:
    return {"title": None, "content": None, "strategy": None, "error": f"unknown publisher {name}"}


def spec_table(spark) -> DataFrame:
    """The registry, one row for each publisher and site; small enough to broadcast by its size."""
    return spark.createDataFrame([(key, s.publisher, s.language, site) for key, s in SPECS.items() for site in s.sites], "spec string, publisher_id string, language string, site string")


def plug_in(of: Callable[[str], dict]) -> Callable[[Column], Column]:
    """§2.11: any function of a page's HTML that returns title and content, as a Column function."""

    @F.pandas_udf(ARTICLE)
    def run(html: pd.Series) -> pd.DataFrame:
        rows = []
        for h in html:
            try:
                rows.append({"strategy": "plug-in", "error": None} | of(h))
            except Exception as error:
                rows.append({"title": None, "content": None, "strategy": None, "error": f"{type(error).__name__}: {error}"})
        return pd.DataFrame(rows, columns=["title", "content", "strategy", "error"])

    return run
