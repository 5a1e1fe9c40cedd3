"""Main content by scoring, in the manner of the published readability heuristics.

Paragraphs give points for their commas and length to their parent and half of them to their grandparent; class names and the
share of linked text weigh in; the best container and its siblings of like standing are the content.
"""

from __future__ import annotations

import re

from claimloom.html.dom import Element

GOOD = re.compile("article|body|content|entry|hentry|main|page|post|text|blog|story", re.I)
BAD = re.compile("combx|comment|com-|contact|foot|masthead|media|meta|outbrain|promo|related|scroll|shoutbox|sidebar|sponsor|shopping|tags|tool|widget|nav|advert|(^|[\\s_-])ad([\\s_-]|$)", re.I)
BASE = {"div": 5, "article": 8, "section": 3, "pre": 3, "td": 3, "blockquote": 3, "form": -3, "ul": -3, "ol": -3, "dl": -3, "h1": -5, "h2": -5, "h3": -5, "th": -5}
DROPPED = ("script", "style", "noscript", "nav", "aside", "footer", "header", "form", "iframe", "button")
SHORTEST = 25


def weight(e: Element) -> int:
    names = f"{e.get('class')} {e.get('id')}".strip()
    return (25 if GOOD.search(names) else 0) - (25 if BAD.search(names) else 0) if names else 0


def link_density(e: Element) -> float:
    own = len(e.text())
    return sum(len(a.text()) for a in e.all("a")) / own if own else 0.0


def short_title(root: Element) -> str:
    """The page's title without a site's name after a separator."""
    title = root.first("title")
    full = " ".join((title.text() if title else "").split())
    for separator in (" | ", " - ", " :: ", " / "):
        if separator in full:
            parts = full.split(separator)
            if len(parts[0].split()) >= 4:
                return parts[0].strip()
            if len(parts[-1].split()) >= 4:
                return parts[-1].strip()
    return full


def main_content(root: Element) -> list[Element]:
    """Elements that hold the article, in document order; changes the tree."""
    root.prune(*DROPPED)
    points: dict[int, float] = {}
    seen: dict[int, Element] = {}
    for p in root.all("p", "pre", "td", "blockquote"):
        text = p.text()
        if len(text) < SHORTEST or p.parent is None:
            continue
        score = 1 + text.count(",") + min(len(text) // 100, 3)
        for holder, share in ((p.parent, 1.0), (p.parent.parent, 0.5)):
            if holder is None:
                continue
            if id(holder) not in points:
                points[id(holder)] = BASE.get(holder.tag, 0) + weight(holder)
                seen[id(holder)] = holder
            points[id(holder)] += score * share
    if not points:
        body = root.first("body")
        return [body or root]
    final = {k: v * (1 - link_density(seen[k])) for k, v in points.items()}
    best = max(final, key=lambda k: (final[k], -seen[k].order))
    top, limit = seen[best], max(10.0, final[best] * 0.2)
    kin = [c for c in top.parent.children if isinstance(c, Element)] if top.parent else [top]
    return [c for c in kin if c is top or final.get(id(c), 0.0) >= limit or (c.tag == "p" and len(c.text()) > 80 and link_density(c) < 0.25)]
