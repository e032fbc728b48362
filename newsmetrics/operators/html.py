"""One streaming pass over a page's HTML that records what selectors match.

No tree is built and nothing recurses: the parser keeps a stack of open
elements, each with how far every selector has been matched by its ancestors.
Tree rules of a non-validating builder: an unclosed ``<p>`` holds what follows,
an end tag closes the nearest open element of its name and is ignored when none
is open, void elements hold nothing, and script, style and comment text is not
page text. An element's text is a slice of the page's list of text pieces, so
nested matches share their memory.

Selectors: ``tag``, ``.class``, ``tag.class`` (several classes allowed),
``[attr]``, ``[attr='v']``, ``[attr^='v']``, the descendant combinator (space)
and comma groups. Matches come in document order without duplicates.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                  "param", "source", "track", "wbr", "basefont", "bgsound", "frame", "keygen",
                  "menuitem", "spacer"])
NON_TEXT = frozenset(["script", "style", "template"])


STEPS = 20_000  # remembered steps per list of selectors
_STEPS: dict[tuple[str, ...], dict] = {}


class Match:
    """An element: its number, the number of the last element in it, its attributes and texts."""

    __slots__ = ("number", "last", "attrs", "begin", "end", "own", "page")

    def __init__(self, page: Scan, number: int, attrs: dict[str, str]):
        self.page, self.number, self.last, self.attrs = page, number, number, attrs
        self.begin = self.end = len(page.pieces)
        self.own: list[str] = []

    def text(self, separator: str) -> str:
        """Stripped pieces of text inside the element, the empty ones left out."""
        return separator.join(self.page.pieces[self.begin:self.end])

    def own_text(self) -> str:
        """Text directly in the element, joined by blanks."""
        return " ".join(self.own).strip()


class Scan(HTMLParser):
    """``found[k]`` holds the matches of ``selectors[k]``."""

    def __init__(self, selectors: list[str]):
        super().__init__(convert_charrefs=True)
        self.chains = [(k, chain) for k, s in enumerate(selectors) for chain in compile_selector(s)]
        self.tested = sorted({a for _, chain in self.chains for *_, tests in chain for a, *_ in tests} - {"class"})
        self.steps = _STEPS.setdefault(tuple(selectors), {})
        self.found: list[list[Match]] = [[] for _ in selectors]
        self.pieces: list[str] = []
        self.number = 0
        # open elements: tag, progress per chain, match or None
        self.stack: list[tuple[str, tuple[int, ...], Match | None]] = [("", (0,) * len(self.chains), None)]
        self.open: Counter[str] = Counter()

    def handle_starttag(self, tag, attrs):
        self.number += 1
        kept: dict[str, str] = {}
        for name, value in attrs:
            kept.setdefault(name, value or "")  # the first of a repeated attribute counts
        before = self.stack[-1][1]
        # equal tags under equal progress match alike; pages repeat few of them
        step = (before, tag, kept.get("class", ""), *[kept.get(a) for a in self.tested])
        known = self.steps.get(step)
        if known is None:
            known = self._step(tag, kept, before)
            if len(self.steps) < STEPS:
                self.steps[step] = known
        after, hits = known
        match = Match(self, self.number, kept) if hits else None
        for k in hits:
            self.found[k].append(match)
        if tag not in VOID:
            self.stack.append((tag, after, match))
            self.open[tag] += 1

    def _step(self, tag: str, kept: dict[str, str], before: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """Progress of every chain inside the element, and the selectors that it matches."""
        classes = kept.get("class", "").split()
        after, hits = [], set()
        for (k, chain), done in zip(self.chains, before):
            if _compound(tag, kept, classes, chain[done]):
                if done == len(chain) - 1:
                    hits.add(k)
                else:
                    done += 1
            after.append(done)
        return tuple(after), tuple(sorted(hits))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _pop(self) -> str:
        tag, _, match = self.stack.pop()
        self.open[tag] -= 1
        if match:
            match.last, match.end = self.number, len(self.pieces)
        return tag

    def handle_endtag(self, tag):
        if self.open[tag]:
            while self._pop() != tag:
                pass

    def handle_data(self, data):
        tag, _, match = self.stack[-1]
        if match:
            match.own.append(data)
        if tag not in NON_TEXT and (piece := data.strip()):
            self.pieces.append(piece)

    def handle_comment(self, data):
        if match := self.stack[-1][2]:
            match.own.append(data)


def scan(html: str | None, selectors: list[str]) -> list[list[Match]]:
    """The matches of every selector; raises what the parser raises."""
    return scan_pieces(html, selectors)[0]


def scan_pieces(html: str | None, selectors: list[str]) -> tuple[list[list[Match]], list[str]]:
    """The matches of every selector and all pieces of the page's text."""
    page = Scan(selectors)
    page.feed(html or "")
    page.close()
    while len(page.stack) > 1:
        page._pop()
    return page.found, page.pieces


# --------------------------------------------------------------------- selectors

_COMPOUND = re.compile(
    r"(?P<tag>[a-zA-Z][a-zA-Z0-9-]*|\*)?(?P<rest>(?:\.[-\w]+|\[[^\]]+\])*)$")
_CLASS = re.compile(r"\.([-\w]+)")
_ATTR = re.compile(r"""\[\s*([-\w]+)\s*(?:(\^=|=|\*=|\$=|~=)\s*(?:'([^']*)'|"([^"]*)"|([^\]\s]+)))?\s*\]""")
_CACHE: dict[str, list] = {}


def compile_selector(selector: str) -> list[list[tuple]]:
    """'a b.c, d[x^=y]' -> groups of compound lists (tag, classes, attrs)."""
    if selector in _CACHE:
        return _CACHE[selector]
    groups = []
    for group in selector.split(","):
        chain = []
        for part in group.split():
            m = _COMPOUND.match(part)
            if not m:
                raise ValueError(f"unsupported selector: {part!r}")
            tag = m.group("tag")
            rest = m.group("rest") or ""
            classes = _CLASS.findall(re.sub(r"\[[^\]]*\]", "", rest))
            attrs = [(a, op, next((v for v in vals if v is not None), None))
                     for a, op, *vals in _ATTR.findall(rest)]
            attrs = [(a, op or None, v) for a, op, v in attrs]
            chain.append((None if tag in (None, "*") else tag.lower(), classes, attrs))
        if chain:
            groups.append(chain)
    _CACHE[selector] = groups
    return groups


def _compound(tag: str, attrs: dict[str, str], classes: list[str], comp: tuple) -> bool:
    name, wanted, tests = comp
    if name is not None and tag != name or any(c not in classes for c in wanted):
        return False
    for key, op, value in tests:
        if key not in attrs:
            return False
        have = " ".join(classes) if key == "class" else attrs[key]
        if not {None: lambda: True, "=": lambda: have == value, "~=": lambda: value in have.split(),
                "^=": lambda: bool(value) and have.startswith(value), "$=": lambda: bool(value) and have.endswith(value),
                "*=": lambda: bool(value) and value in have}[op]():
            return False
    return True
