"""A small element tree over the standard library's HTML tokenizer, with the CSS selectors that publisher rules need.

The tree lives only inside a worker's batch function; Spark sees strings and structs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Opening one of these ends an open element of the listed kinds.
BLOCKS = {"p", "div", "ul", "ol", "table", "section", "article", "aside", "footer", "header", "nav", "main", "figure", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "form", "pre", "hr"}
ENDS = {"li": {"li", "p"}, "dt": {"dd", "dt"}, "dd": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}} | dict.fromkeys(BLOCKS, {"p"})
#: An element does not end one outside of these.
WALLS = {"ul", "ol", "table", "div", "section", "article", "body", "html", "blockquote", "figure"}
HIDDEN = {"script", "style", "template"}


class Element:
    __slots__ = ("tag", "attrs", "children", "parent", "order", "raw")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []
        self.order = 0

    def get(self, name: str, default: str = "") -> str:
        return self.attrs.get(name, default)

    @property
    def classes(self) -> list[str]:
        return self.get("class").split()

    def descend(self) -> Iterator[Element]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Element)]
        while stack:
            own = stack.pop()
            yield own
            stack.extend(c for c in reversed(own.children) if isinstance(c, Element))

    def ancestors(self) -> Iterator[Element]:
        own = self.parent
        while own is not None:
            yield own
            own = own.parent

    def strings(self) -> Iterator[str]:
        stack: list[Element | str] = list(reversed(self.children))
        while stack:
            own = stack.pop()
            if isinstance(own, str):
                yield own
            elif own.tag not in HIDDEN:
                stack.extend(reversed(own.children))

    def text(self, between: str = " ") -> str:
        """Stripped strings below, joined."""
        return between.join(t for s in self.strings() if (t := s.strip()))

    def all(self, *tags: str) -> list[Element]:
        return [e for e in self.descend() if e.tag in tags]

    def first(self, *tags: str) -> Element | None:
        return next((e for e in self.descend() if e.tag in tags), None)

    def where(self, test: Callable[[Element], bool]) -> list[Element]:
        return [e for e in self.descend() if test(e)]

    def select(self, selector: str) -> list[Element]:
        matches = compiled(selector)
        return [e for e in self.descend() if matches(e)]

    def one(self, selector: str) -> Element | None:
        matches = compiled(selector)
        return next((e for e in self.descend() if matches(e)), None)

    def following(self) -> list[Element]:
        """Sibling elements after this one."""
        kin = self.parent.children if self.parent else []
        at = next((k for k, c in enumerate(kin) if c is self), len(kin))
        return [c for c in kin[at + 1 :] if isinstance(c, Element)]

    def remove(self) -> None:
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None

    def prune(self, *tags: str) -> Element:
        for e in self.all(*tags):
            e.remove()
        return self

    def html(self) -> str:
        """Serialized again, attributes quoted; walks without recursion, so depth has no bound."""
        out: list[str] = []
        stack: list[Element | str] = [self]
        while stack:
            own = stack.pop()
            if isinstance(own, str):
                out.append(own)
                continue
            if own.tag != "#root":
                attrs = "".join(f' {k}="{v.replace(chr(34), "&quot;")}"' for k, v in own.attrs.items())
                out.append(f"<{own.tag}{attrs}>")
                if own.tag in VOID:
                    continue
                stack.append(_End(f"</{own.tag}>"))
            stack.extend(reversed(own.children))
        return "".join(out)

    def copy(self) -> Element:
        """The same tree anew, for readers that take elements out."""
        top = Element(self.tag, self.attrs, None)
        top.order = self.order
        stack = [(self, top)]
        while stack:
            own, made = stack.pop()
            for c in own.children:
                if isinstance(c, str):
                    made.children.append(c)
                    continue
                child = Element(c.tag, c.attrs, made)
                child.order = c.order
                made.children.append(child)
                stack.append((c, child))
        return top


class _End(str):
    """A closing tag among an element's serialized parts."""


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("#root", {}, None)
        self.count = 0

    def handle_starttag(self, tag, attrs):
        ends = ENDS.get(tag, set())
        own = self.at
        while ends and own.parent is not None and own.tag not in (WALLS - ends):
            if own.tag in ends:
                self.at = own.parent
                break
            own = own.parent
        self.count += 1
        made = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        made.order = self.count
        self.at.children.append(made)
        if tag not in VOID:
            self.at = made

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        own = self.at
        while own.parent is not None:
            if own.tag == tag:
                self.at = own.parent
                return
            own = own.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


_SIMPLE = re.compile(r"(?P<tag>^[A-Za-z][\w-]*|^\*)|#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w:-]+)(?:(?P<op>[*^$~]?=)['\"]?(?P<val>[^'\"\]]*)['\"]?)?\]")


def _simple(text: str) -> Callable[[Element], bool]:
    tests: list[Callable[[Element], bool]] = []
    for m in _SIMPLE.finditer(text):
        if m["tag"]:
            if m["tag"] != "*":
                tests.append(lambda e, t=m["tag"].lower(): e.tag == t)
        elif m["id"]:
            tests.append(lambda e, v=m["id"]: e.get("id") == v)
        elif m["cls"]:
            tests.append(lambda e, v=m["cls"]: v in e.classes)
        else:
            compare = {None: lambda a, b: True, "=": lambda a, b: a == b, "*=": lambda a, b: b in a, "^=": lambda a, b: a.startswith(b), "$=": lambda a, b: a.endswith(b), "~=": lambda a, b: b in a.split()}[m["op"]]
            tests.append(lambda e, k=m["attr"], v=m["val"] or "", c=compare: k in e.attrs and c(e.attrs[k], v))
    return lambda e: all(t(e) for t in tests)


@lru_cache(maxsize=512)
def compiled(selector: str) -> Callable[[Element], bool]:
    """Test for a selector: type, .class, #id, attributes, descendants, children and comma groups."""
    groups = [_chain(g.strip()) for g in selector.split(",")]
    return lambda e: any(g(e) for g in groups)


def _chain(text: str) -> Callable[[Element], bool]:
    steps = re.findall(r">|(?:\[[^\]]*\]|[^\s>\[])+", text)
    own = _simple(steps[-1])
    above: list[tuple[bool, Callable[[Element], bool]]] = []
    direct = False
    for step in reversed(steps[:-1]):
        if step == ">":
            direct = True
        else:
            above.append((direct, _simple(step)))
            direct = False

    def holds(e: Element, k: int) -> bool:
        if k == len(above):
            return True
        direct, test = above[k]
        for a in e.ancestors():
            if test(a) and holds(a, k + 1):
                return True
            if direct:
                return False
        return False

    return lambda e: own(e) and holds(e, 0)
