"""The text blocks of an HTML page in order, each with its tag path, and made-up pages with labels.

A block is the text between two tags that break lines; inline tags do not end it, a line break is
white space in it.  Reading is one pass over the page with a work per tag that does not depend on
the page's length.  Unclosed tags, quotes, comments and scripts end where browsers end them, or
with the page.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

import numpy as np

_TAG = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</[^A-Za-z][^>]*+(?:>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)""", re.S)
_NAMED = re.compile(r"""(?:^|[\s/"'])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^\W\d_]+")
_UNSEEN = re.compile(r"""(?:^|\s)hidden(?:$|[\s=/])|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Their content is no text of the page.
_RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
_ENDS_P = frozenset("address article aside blockquote center details div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
#: Tags that end an open one of the second group, unless one of the third is open inside it.
_ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)),
         "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}

TAG_SLOTS = 1024
#: Elements of a path that count, the nearest ones.
DEPTH = 32


def slot(token: str) -> int:
    return zlib.crc32(token.encode()) % TAG_SLOTS


@dataclass
class Leaf:
    text: str
    path: int  # node of the innermost open element
    linked: int  # characters within links


class Paths:
    """Distinct tag paths met so far: the slots of each path's own element, and its parent."""

    def __init__(self):
        self.node: dict[tuple[int, str], int] = {}
        self.parent, self.own = [-1], [()]
        self._slots: dict[str, tuple[int, ...]] = {}

    def child(self, parent: int, tag: str, attributes: str) -> int:
        words = ""
        if attributes:
            words = " ".join(m.strip("\"'") for m in _NAMED.findall(attributes))
            if _UNSEEN.search(attributes):
                words += " unseen"
        kind = f"{tag} {words}"
        at = self.node.get((parent, kind))
        if at is None:
            if kind not in self._slots:
                self._slots[kind] = (slot(tag), *sorted({slot("." + p.lower()) for p in _PARTS.findall(words)}))
            at = self.node[parent, kind] = len(self.parent)
            self.parent.append(parent)
            self.own.append(self._slots[kind])
        return at

    def slots(self, node: int) -> list[int]:
        """Distinct slots of the nearest elements of a path."""
        out: set[int] = set()
        for _ in range(DEPTH):
            if node <= 0:
                break
            out.update(self.own[node])
            node = self.parent[node]
        return sorted(out)


def leaves(page: str | None, paths: Paths) -> list[Leaf]:
    """The blocks of a page that hold text."""
    out: list[Leaf] = []
    if not page:
        return out
    tags: list[str] = []  # open elements
    nodes = [0]
    open_at: dict[str, list[int]] = {}
    pieces: list[str] = []
    linked = 0

    def close(upto: int) -> None:
        while len(tags) > upto:
            open_at[tags.pop()].pop()
            nodes.pop()

    def end_leaf() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Leaf(text, nodes[-1], min(linked, len(text))))
            pieces.clear()
        linked = 0

    def last(names: tuple[str, ...]) -> int:
        return max((open_at[n][-1] for n in names if open_at.get(n)), default=-1)

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        begin = m.start() if m else n
        if begin > at:
            piece = page[at:begin]
            if "&" in piece:
                piece = html.unescape(piece)
            pieces.append(piece)
            if open_at.get("a"):
                linked += len(piece)
        if not m:
            break
        at = m.end()
        name = m.group(2)
        if not name:
            continue
        name = name.lower()
        if m.group(1):
            if name == "br" or name == "p" and not open_at.get("p"):
                pieces.append(" ") if name == "br" else end_leaf()
            elif open_at.get(name):
                if name not in _INLINE:
                    end_leaf()
                    close(open_at[name][-1])
                elif open_at[name][-1] == len(tags) - 1:
                    close(len(tags) - 1)
                elif last(tuple(t for t in _ENDS_P if t in open_at)) < open_at[name][-1]:
                    close(open_at[name][-1])
            elif name not in _INLINE:
                end_leaf()
            continue
        if name in _RAW:
            over = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = over.end() if over else n
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name not in _INLINE:
            end_leaf()
            if name in _ENDS_P and open_at.get("p"):
                close(open_at["p"][-1])
            if name in _ENDS:
                ended, within = _ENDS[name]
                found = last(ended)
                if found > last(within):
                    close(found)
        if name in _VOID:
            continue
        open_at.setdefault(name, []).append(len(tags))
        tags.append(name)
        nodes.append(paths.child(nodes[-1], name, m.group(3)))
    end_leaf()
    return out


# Made-up pages.  Names that sites give to their parts, fixed values in no order.
_KINDS = {
    "menu": "nav navbar menu navigation topnav main-menu site-nav primary-menu links tabs breadcrumbs breadcrumb pager pagination toc",
    "header": "header site-header masthead top topbar page-header branding logo banner hero",
    "footer": "footer site-footer bottom colophon copyright legal page-footer footnav",
    "sidebar": "sidebar side aside rail widget widgets widget-area secondary column-right related recommended popular trending tags",
    "notice": "notice cookie cookies cookie-banner consent gdpr alert message popup modal overlay newsletter subscribe paywall promo-bar announcement warning",
    "advert": "ad ads advert advertisement adsense banner-ad sponsored sponsor promo promotion promoted dfp ad-slot commercial",
    "form": "form search search-box login signup contact subscribe-form newsletter-form register survey",
    "comments": "comments comment-list commentlist comment comment-body replies reply discussion responses disqus user-comments feedback thread reader-comments",
    "share": "share sharing social social-links share-bar follow byline meta post-meta",
    "content": "article post entry story content main article-body post-content entry-content text body main-content page-content single blog-post article-content",
    "wrapper": "wrapper container page site layout row col grid inner outer wrap app root block section",
}
KINDS = {k: v.split() for k, v in _KINDS.items()}
_SAYS = {
    "menu": "Home|About|News|Sports|Contact|World|Next|Previous|Archive|Login", "footer": "© 2024 All rights reserved|Privacy policy|Terms of use|Imprint|&copy; Site &middot; all rights",
    "notice": "We use cookies to improve this site|Accept all|Please turn off your ad blocker|Subscribe to our newsletter", "advert": "Advertisement|Sponsored|Buy now|Special offer",
    "form": "Search|Your name|E-mail|Submit|Log in", "comments": "Reply|Report|Leave a comment|12 comments|Great article!", "share": "Share|Tweet|Print|By A. Writer", "sidebar": "Related|Most read|Popular|More stories",
    "header": "The Daily News|Welcome",
}
SAYS = {k: v.split("|") for k, v in _SAYS.items()}


class Maker:
    """Pages of random structure; every text written is one block, with its label."""

    def __init__(self, seed: int):
        self.r = np.random.default_rng(seed)
        syllables = [a + b for a in "b c d f g l m n p r s t v th st qu sch".split() for b in "a e i o u é ü en er on ing".split()]
        self.lexicon = ["".join(self.r.choice(syllables, int(self.r.integers(1, 5)))) for _ in range(1500)]

    def chance(self, p: float) -> bool:
        return self.r.random() < p

    def pick(self, options):
        return options[int(self.r.integers(len(options)))]

    def words(self, n: int) -> str:
        w = [self.pick(self.lexicon) for _ in range(max(1, n))]
        for i in range(0, len(w), int(self.r.integers(5, 15))):
            w[i] = w[i].capitalize()
            if i:
                w[i - 1] += self.pick([".", ".", ",", "!", "?", ".%%%", "&amp;"])
        return " ".join(w) + self.pick([".", ".", ".", "", "!"])

    def length(self, most: float = 4.5) -> int:
        return int(np.exp(self.r.uniform(0, most)))

    def say(self, text: str, label: int) -> str:
        self.labels.append(label)
        return text

    def named(self, kind: str) -> str:
        """An attribute with a name of the kind, sometimes with others beside it, sometimes none."""
        if self.chance(0.12):
            return ""
        name = self.pick(KINDS[kind])
        if self.chance(0.25):
            name += " " + self.pick([*KINDS["wrapper"], "clearfix", "left", "right", "mb-2", "js-" + name])
        if self.chance(0.15):
            name = self.pick(["c", "g", "x", "page", "site"]) + self.pick(["-", "_", "__"]) + name
        quote = self.pick(['"', '"', "'"])
        return f" {self.pick(['class', 'class', 'class', 'id'])}={quote}{name}{quote}"

    def links(self, kind: str) -> str:
        rows = []
        for _ in range(int(self.r.integers(2, 9))):
            words = self.pick(SAYS[kind]) if kind in SAYS and self.chance(0.4) else self.words(int(self.r.integers(1, 4)))
            rows.append(f'<li><a href="/{self.pick(self.lexicon)}">{self.say(words, 0)}</a>' + self.pick(["</li>", "</li>", ""]))
        return "<ul>" + "".join(rows) + "</ul>"

    def prose(self, kind: str, label: int, most: float = 3.5) -> str:
        words = self.pick(SAYS[kind]) if kind in SAYS and self.chance(0.3) else self.words(self.length(most))
        tag = self.pick(["p", "p", "div", "span", ""])
        if tag in ("span", ""):
            return f"<div>{self.say(words, label)}</div>"
        return f"<{tag}>{self.say(words, label)}</{tag}>"

    def part(self, kind: str) -> str:
        """A part of a page that is not its article."""
        tags = {"menu": ["nav", "nav", "div", "header"], "header": ["header", "div"], "footer": ["footer", "footer", "div"], "sidebar": ["aside", "aside", "div", "section"],
                "notice": ["div", "section", "aside", "dialog"], "advert": ["div", "div", "aside"], "form": ["form", "form", "div"], "comments": ["section", "div", "ol"], "share": ["div", "p", "ul"]}
        tag = self.pick(tags[kind])
        name = self.named(kind)
        if not name and tag in ("div", "section", "p", "ul", "ol"):
            name = f' class="{self.pick(KINDS[kind])}"'
        if kind == "menu":
            inner = self.links(kind)
        elif kind == "comments":
            inner = f"<h3>{self.say(self.pick(SAYS[kind]), 0)}</h3>" if self.chance(0.6) else ""
            for _ in range(int(self.r.integers(1, 6))):
                one = self.pick(["li", "div", "article", "p"])
                label = f"<b>{self.pick(self.lexicon)}</b> " if self.chance(0.4) else ""
                text = label + self.words(self.length(4.2))
                inner += f"<{one}{self.named('comments')}>" + (f"<p>{self.say(text, 0)}</p>" if one != "p" and self.chance(0.7) else self.say(text, 0)) + f"</{one}>"
            if self.chance(0.3):
                inner += f"<form>{self.prose('form', 0)}<textarea>x</textarea></form>"
        elif kind == "form":
            inner = self.prose(kind, 0) + '<input name="q">' + (f"<button>{self.say(self.pick(SAYS[kind]), 0)}</button>" if self.chance(0.6) else "")
            if self.chance(0.2):
                inner += "<select>" + "".join(f"<option>{self.say(self.words(1), 0)}" for _ in range(3)) + "</select>"
        elif kind in ("sidebar", "footer", "header", "share"):
            inner = "".join(self.links(kind) if self.chance(0.4) else self.prose(kind, 0, 4.0) for _ in range(int(self.r.integers(1, 4))))
            if kind == "sidebar" and self.chance(0.5):
                inner = f"<h3>{self.say(self.words(2), 0)}</h3>" + inner
            if kind == "header" and self.chance(0.3):
                inner = f"<h1>{self.say(self.words(2), 0)}</h1>" + inner
        else:
            inner = "".join(self.prose(kind, 0) for _ in range(int(self.r.integers(1, 3))))
        if tag == "p" or kind in ("notice", "advert", "footer") and self.chance(0.25):  # text right inside the element
            del self.labels[self.before:]
            inner = self.say(self.words(self.length(3.5)), 0)
        return f"<{tag}{name}>{inner}</{tag}>"

    def aside(self, kind: str) -> str:
        self.before = len(self.labels)
        return self.part(kind)

    def block(self) -> str:
        """A block of an article."""
        r = self.r.random()
        text = self.words(self.length(5))
        if self.chance(0.3):
            text += f" <{self.pick(['b', 'em', 'i', 'strong'])}>{self.words(2)}</b>"
        if self.chance(0.15):
            text += f' <a href="/x">{self.words(2)}</a>'
        if r < 0.68:
            p = self.pick(["<p>", "<p>", "<p>", '<p class="text">'])
            if self.chance(0.2):
                return f"{p}<b>{self.say(text, 1)}<br>"
            return f"{p}{self.say(text, 1)}" + self.pick(["</p>", "</p>", "</p>", ""])
        if r < 0.76:
            return f"<h2>{self.say(self.words(self.length(2)), 1)}</h2>"
        if r < 0.84:
            tag = self.pick(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{self.say(self.words(self.length(3)), 1)}</li>" for _ in range(int(self.r.integers(2, 5)))) + f"</{tag}>"
        if r < 0.89:
            return f"<blockquote><p>{self.say(text, 1)}</p></blockquote>"
        if r < 0.92:
            return f"<table><tr><td>{self.say(self.words(2), 1)}<td>{self.say(self.words(2), 1)}</table>"
        if r < 0.95:
            return f'<figure><img src="a.png"><figcaption>{self.say(self.words(5), 1)}</figcaption></figure>'
        if r < 0.97:
            return f"<pre>{self.say(text, 1)}</pre>"
        return f"<div>{self.say(text, 1)}</div>"

    def article(self) -> str:
        inner = ""
        if self.chance(0.85):
            title = f"<h1>{self.say(self.words(self.length(2.5)), 1)}</h1>"
            inner = f"<header>{title}</header>" if self.chance(0.15) else title
        if self.chance(0.12):
            inner += self.aside("share")
        for _ in range(max(1, self.length(3))):
            inner += self.block()
            if self.chance(0.06):
                inner += self.aside(self.pick(["advert", "advert", "sidebar", "share", "form", "notice"]))
        if self.chance(0.12):
            inner += self.aside("share")
        if self.chance(0.1):
            inner += self.aside("comments")
        r = self.r.random()
        if r < 0.55:
            return f"<article{self.named('content') if self.chance(0.5) else ''}>{inner}</article>"
        if r < 0.9:
            tag = self.pick(["div", "div", "main", "section"])
            return f"<{tag} class=\"{self.pick(KINDS['content'])}\">{inner}</{tag}>"
        return inner

    def page(self) -> tuple[str, list[int]]:
        self.labels: list[int] = []
        self.before = 0
        head = f"<!DOCTYPE html><html><head><title>{self.words(4)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>" if self.chance(0.9) else ""
        body = ""
        for kind in ("notice", "header", "menu", "advert", "form", "sidebar"):
            if self.chance({"menu": 0.8, "header": 0.5, "advert": 0.5}.get(kind, 0.25)):
                body += self.pick(["", "", f"<!-- {kind} -->"]) + self.aside(kind)
        wrap = int(self.r.integers(0, 4))
        for _ in range(wrap):
            body += f"<div{self.named('wrapper')}>"
        if self.chance(0.4):
            body += "<main>"
        body += self.article()
        for kind in ("share", "comments", "sidebar", "advert", "form", "menu"):
            if self.chance({"comments": 0.4, "sidebar": 0.35}.get(kind, 0.2)):
                body += self.aside(kind)
        body += self.pick(["</main>", ""]) + "</div>" * wrap
        for kind in ("sidebar", "comments", "footer", "notice", "advert"):
            if self.chance({"footer": 0.85, "comments": 0.15}.get(kind, 0.25)):
                body += self.aside(kind)
        return head + body + self.pick(["</body></html>", ""]), self.labels
