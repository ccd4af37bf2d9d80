"""One HTML page as a sequence of structural tags and text blocks (plain Python, used inside tasks).

The reader follows what browsers do with broken markup as far as text depends on it: raw elements, bogus comments,
unclosed paragraphs, list items and cells, end tags without a start, pages that break off.
"""

from __future__ import annotations

import re
from html import unescape

import xxhash

TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))
    | <(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?:(?P<attrs>(?>[^>"']+|"[^"]*"|'[^']*')*+)> | (?P<cut>[^>]*)(?:>|\Z))
    | <[!?/][^>]*(?:>|\Z)""", re.S | re.X)
MARKED = re.compile(r"\b(?:class|id|role)\s*=", re.I)
ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
DIGITS = re.compile(r"\d+")
PARTS = re.compile(r"[^a-z0-9]+")

# Element names of HTML.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section
    summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
KEEPS_P = frozenset("body caption dd dt head html legend li optgroup option tbody td tfoot th thead title tr".split())
CLOSED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}}
STOP = {"li": {"ul", "ol", "menu", "dir"}, "dd": {"dl"}, "dt": {"dl"}, "option": {"select"}, "tr": {"table"}, "td": {"table", "tr"},
        "th": {"table", "tr"}, "p": {"table", "td", "th", "caption", "button"}}

# What is no part of an article, by element, by role, and by words of class and id.
OUT_TAGS = frozenset("""nav footer aside form dialog menu search head noscript template svg math object audio video canvas select
    button datalist script style textarea iframe noembed noframes xmp""".split())
OUT_ROLES = frozenset("navigation contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
OUT_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promotion
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
    menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar sidebar sidebars widget widgets
    footer share sharing social related recommended recommendations search form disqus""".split())
COMMENT_WORDS = frozenset("comment comments commentlist respond replies".split())
SPECIAL = frozenset("article main header".split())
HEAD_WORDS = frozenset("header masthead banner topbar".split())


class Page:
    """``items``: (path, text, part, links) in page order; path is 64 bits for the element and all above it,
    text None marks the start of an element. part: 2 inside an article, 1 inside a main element, 0 elsewhere,
    -1 no part of an article. links: characters of the text inside links."""

    def __init__(self, html: str, paths: dict):
        self.items, self.paths = [], paths
        self.stack = [("", 0, 0, False)]  # name, path, part, inside a link
        self.open: dict[str, int] = {}
        self.text: list[str] = []
        self.links = 0
        self.read(html)
        self.flush()

    def read(self, html: str) -> None:
        at, n, search = 0, len(html), TAG.search
        while at < n:
            m = search(html, at)
            if m is None:
                self.add(html[at:])
                return
            begin, end = m.span()
            if begin > at:
                self.add(html[at:begin])
            at = end
            closes, name, attrs, cut = m.groups()
            if name is None:
                continue
            name = name.lower()
            if closes:
                self.close(name)
                continue
            self.start(name, cut or "" if attrs is None else attrs)
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
                at = end.start() if end else n

    def add(self, raw: str) -> None:
        if self.stack[-1][2] >= 0:
            raw = unescape(raw) if "&" in raw else raw
            self.text.append(raw)
            if self.stack[-1][3]:
                self.links += len(raw)

    def flush(self) -> None:
        """The text so far is a block of its own."""
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                for top in reversed(self.stack):
                    if top[0] in BLOCKS or not top[0]:
                        break
                self.items.append((top[1], text, top[2], self.links))
            self.text, self.links = [], 0

    def start(self, name: str, attrs: str) -> None:
        if name in VOID:
            if name == "br":
                self.add("\n")
            elif name == "hr":
                self.flush()
            return
        block = name in BLOCKS
        if block:
            self.flush()
            if name not in KEEPS_P and self.open.get("p"):
                self.pop({"p"}, STOP["p"])
        if name in CLOSED_BY:
            while any(self.open.get(x) for x in CLOSED_BY[name]) and self.pop(CLOSED_BY[name], STOP[name]):
                pass
        _, path, part, link = self.stack[-1]
        label, part = self.judge(name, attrs, part)
        if block or part < 0:
            key = (path, label)
            if key not in self.paths:
                if len(self.paths) > 1 << 17:
                    self.paths.clear()
                self.paths[key] = xxhash.xxh64_intdigest(label, seed=path)
            path = self.paths[key]
            self.items.append((path, None, part, 0))
        if len(self.text) and part < 0 <= self.stack[-1][2]:
            self.text.append(" ")
        self.stack.append((name, path, part, link or name == "a"))
        self.open[name] = self.open.get(name, 0) + 1

    def judge(self, name: str, attrs: str, part: int) -> tuple[str, int]:
        """Label of an element and the part of the page that it is."""
        words, names, role = [], set(), ""
        if attrs and MARKED.search(attrs):
            for key, *value in ATTR.findall(attrs):
                key, value = key.lower(), unescape("".join(value)).lower()
                if key == "class":
                    words = sorted(DIGITS.sub("#", value).split())
                if key in ("class", "id"):
                    names.update(PARTS.split(value))
                elif key == "role":
                    role = value.strip()
        label = f"{name}.{' '.join(words)}" if words else name
        if part < 0:
            return label, part
        if name in OUT_TAGS or role in OUT_ROLES:
            return label, -1
        if not names and not role and name not in SPECIAL:
            return label, part
        if name in ("html", "body"):
            return label, part
        if names & COMMENT_WORDS:
            return label, -1
        if name == "article":
            return label, 2
        if name == "main" or role == "main":
            return label, max(part, 1)
        # an article has a head of its own, which is part of it
        if names & OUT_WORDS or part < 2 and (name == "header" or role == "banner" or names & HEAD_WORDS):
            return label, -1
        return label, part

    def close(self, name: str) -> None:
        if name == "br":
            self.add("\n")
        if name in BLOCKS:
            self.flush()
        if self.open.get(name):
            self.pop({name}, BLOCKS if name not in BLOCKS and name not in OUT_TAGS else frozenset())

    def pop(self, names: set, stop) -> bool:
        """Close the innermost open element of ``names`` and all inside it, unless one of ``stop`` stands between."""
        k = len(self.stack) - 1
        while k > 0 and self.stack[k][0] not in names:
            if self.stack[k][0] in stop:
                return False
            k -= 1
        if k == 0:
            return False
        for gone in self.stack[k:]:
            self.open[gone[0]] -= 1
        if self.stack[k][2] < 0 <= self.stack[k - 1][2]:
            self.text.append(" ")
        del self.stack[k:]
        return True
