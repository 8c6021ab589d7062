"""Main text of web pages by wrappers: union-free regular expressions inferred from pages of one host.

A page is a stream of tokens: tags (with their classes) and texts. A host's wrapper starts as the tokens of one page and is generalised
with every further sample page: the two are aligned, and each mismatch is resolved. Texts that differ become a slot. Tags that differ
are either a repetition (the tokens before the mismatch come again: they become a group "one or more") or an option (the next token at
which both agree ends a group "maybe"). So a wrapper is a sequence of tags, texts, slots, repeated and optional groups, with no unions.

A wrapper's nodes come from a few unlike pages of the host and from others that have the tags and classes that these lack. They do no more
than number the places of a page; a token that they have no place for is placed by the last one that has, and its tag. What is at a place is then counted over all pages of the host. Texts that stay
the same in nearly all of them are its template; pages of which little else is left (copies of one article) are no evidence of that. The
content is the article (or main element) or, on hosts without one, the smallest element that nearly all of the text in slots lies in. An
element whose class is an ambiguous word, such as "notice" or "discussion", is content if it holds slots. Within the content, all but
template and boilerplate stays. What a wrapper can't tell, it is told by names: comments and adverts vary from page to page as an article
does, so these, menus, forms and the like go by their elements and plain class words, and so does everything on a host with too few
unlike pages.
"""

from __future__ import annotations

import functools
import html
import json
import re
from collections import Counter, defaultdict

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, small_or_shuffled, table

#: Distinct pages of a host (least hash first) that are looked at, and unlike ones among them that its wrapper's nodes are inferred from;
#: as many pages as are looked at may follow for tags and classes that the host has elsewhere.
CANDIDATES, SAMPLE = 24, 6
#: Pages are unlike if less than this share of the shorter one's text is in the other, and a page is evidence of a template if this share
#: of its text is not what nearly all pages have; copies of one article would make it template.
UNLIKE = 0.5
#: Elements of an article whose text is its own, even if all pages of a host have it.
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6", "th", "dt")
#: Pages of a host, and share of them, that a text must be in at the same place to be template.
SHARED_BY, SHARED = 3, 0.8
#: Share of the text in slots that the content holds.
MOST = 0.9
#: Tokens that the search for the end of an option looks ahead, when a wrapper is inferred and when a page is read.
AHEAD, READ_AHEAD = 60, 400

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)", re.S)
#: The rest of a tag: quotes are closed, or (where they aren't) don't count.
REST = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>")
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Unclosed quotes of a page after which quotes no longer count: each costs a look at the whole rest.
UNCLOSED = 8
#: Elements whose content is no markup.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SKIPPED = {"nav", "footer", "aside", "form", "head", "button", "select", "svg", "math", "object", "canvas", "dialog", "menu", "audio", "video"} | RAW
BLOCKS = {"address", "article", "blockquote", "body", "caption", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: Elements whose id is an anchor.
ANCHORED = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "a", "span", "li", "td", "tr", "dt", "dd", "figure"}
#: Elements that an open paragraph or item ends with.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dd": {"dd", "dt", "p"}, "dt": {"dd", "dt", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"}}
#: Words of classes, ids and roles that make an element boilerplate; those that only do if no wrapper finds an article's text in it; and
#: words that may stand beside either ("site-footer", "comment-list"), while any other ("notice-period") makes a name of its own.
PLAIN = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "sidebar", "aside", "complementary", "footer", "contentinfo", "masthead", "topbar", "toolbar", "cookie", "cookies", "consent", "gdpr", "popup", "modal", "overlay", "comment", "comments", "replies", "respond", "disqus", "share", "sharing", "social", "newsletter", "login"}
AMBIGUOUS = {"promo", "promotion", "notice", "notices", "alert", "dialog", "reply", "discussion", "related", "recommended", "recommendations", "subscribe", "subscription", "signup", "search", "form", "widget", "widgets", "skip", "disclaimer"}
BESIDE = {"site", "page", "main", "top", "bottom", "left", "right", "inner", "outer", "box", "block", "container", "wrapper", "wrap", "area", "section", "list", "item", "items", "bar", "link", "links", "button", "buttons", "btn", "icon", "icons", "text", "content", "body", "header", "title", "post", "posts", "article", "articles", "user", "reader", "primary", "secondary", "global", "mobile", "desktop", "panel", "group", "more", "entry", "media", "thread", "slot", "unit", "field"}
#: Elements that are no boilerplate by a plain class word.
NEVER_PLAIN = ("html", "body", "article", "main", "h1")
SLOT = "#"


def marks_of(tag: str, attributes: str) -> str:
    """Classes, roles and ids of a tag, numbers as one: what tells its element apart."""
    out = []
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        if name.lower() != "id" or tag not in ANCHORED:
            out += [x for x in re.sub(r"\d+", "0", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", a or b or c)).lower().split() if x]
    return " ".join(out)


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, name, value): ("open", tag, marks), ("close", tag, ""), ("text", "", text). Linear in the page's length."""
    out, at, done, unclosed = [], 0, 0, 0
    last = page.rfind(">")

    def text(end: int) -> None:
        if end > done:
            out.append(("text", "", page[done:end]))

    while m := MARKUP.search(page, at, last + 1):
        # a comment that doesn't end takes the rest
        end = m.end() if not m[0].startswith("<!--") or m[0].endswith("-->") else len(page)
        if m[2]:
            rest = REST.match(page, end) if unclosed < UNCLOSED else None
            if rest is None:
                unclosed += 1
                stop = page.find(">", end) + 1
            else:
                stop = rest.end()
        text(m.start())
        if not m[2]:
            at = done = end
            continue
        attributes, at = page[end : stop - 1], stop
        done = at
        tag = m[2].lower()
        if m[1]:
            out.append(("close", tag, ""))
            continue
        out.append(("open", tag, marks_of(tag, attributes) if attributes and not attributes.isspace() else ""))
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = done = close.end() if close else len(page)
            out.append(("close", tag, ""))
        elif tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCKS:
            out.append(("close", tag, ""))
    # no markup but a comment begins after the last ">"
    comment = page.find("<!--", max(done, last + 1))
    text(comment if comment >= 0 else len(page))
    return out


@functools.lru_cache(10_000)
def said(marks: str) -> str:
    """What the marks of an element say: "plain" or "ambiguous" boilerplate, or nothing."""
    out = ""
    for mark in marks.split():
        words = {x for x in re.split(r"[^a-z]+", mark) if x}
        if words <= PLAIN | AMBIGUOUS | BESIDE:
            if words & PLAIN:
                return "plain"
            if words & AMBIGUOUS:
                out = "ambiguous"
    return out


def plain(tag: str, marks: str) -> bool:
    """Whether an element is boilerplate by its tag or a plain class word, wherever it is."""
    return tag in SKIPPED or (tag not in NEVER_PLAIN and said(marks) == "plain")


def noisy(tag: str, marks: str, within: bool, slots: bool = False) -> bool:
    """Whether an element is boilerplate; a header within an article belongs to it. slots: whether its host's wrapper has some in it."""
    if tag in SKIPPED or (tag == "header" and not within):
        return True
    # a site's header made of a div, not an article's
    if not within and any("header" in x.split("-") and not {"article", "post", "entry", "content"} & set(x.split("-")) for x in marks.split()):
        return True
    if tag in NEVER_PLAIN:
        return bool({"comment", "comments", "reply", "related"} & set(marks.split()))
    what = said(marks)
    return what == "plain" or (what == "ambiguous" and not slots)


# ---- wrappers

def keys(toks: list[tuple[str, str, str]]) -> tuple[list[str], list[int]]:
    """Tokens for alignment, "<tag marks>", "</tag>" and "#hash of a text", and the place of each; blank texts are left out."""
    out, at = [], []
    for k, (kind, name, value) in enumerate(toks):
        if kind == "text":
            if not (t := " ".join(html.unescape(value).split())):
                continue
            out.append(SLOT + xxhash.xxh3_64_hexdigest(t.encode("utf-8", "surrogatepass")))
        else:
            out.append(f"<{name} {value}".rstrip() + ">" if kind == "open" else f"</{name}>")
        at.append(k)
    return out, at


def same(a, b) -> bool:
    """Whether a wrapper's node and a token can be one: equal, or both text."""
    return a == b or (isinstance(a, str) and isinstance(b, str) and a[0] == SLOT and b[0] == SLOT)


def alike(a: list, i: int, b: list, j: int, n: int) -> bool:
    """Whether the runs of n at i and j are alike."""
    return i + n <= len(a) and j + n <= len(b) and all(same(a[i + k], b[j + k]) for k in range(n))


def join(a: list, b: list) -> list:
    """Two runs that are alike, as one: texts that differ become slots."""
    return [x if x == y else SLOT for x, y in zip(a, b)]


def square(done: list, rest: list, at: int) -> int:
    """Length of a run that ends `done` and begins again at `at`, ending with the same tag; 0 if there is none."""
    if not done or not isinstance(done[-1], str) or done[-1][0] == SLOT:
        return 0
    for n in range(1, min(len(rest) - at, len(done), AHEAD) + 1):
        if rest[at + n - 1] == done[-1] and alike(done, len(done) - n, rest, at, n):
            return n
    return 0


class Places:
    """Where the tags of a sequence are, for searches ahead."""

    def __init__(self, w: list):
        self.n = len(w)
        self.next: dict[str, list[int]] = defaultdict(list)
        for k in range(len(w) - 1, -1, -1):
            if isinstance(w[k], str) and w[k][0] == "<":
                self.next[w[k]].append(k)

    def meet(self, i: int, t: list, j: int, ahead: int) -> tuple[int, int]:
        """Steps to the nearest places from i and j at which both have the same tag; to the ends, if there are none. i never falls."""
        best = (2 * ahead, self.n - i, len(t) - j)
        for b in range(min(ahead, len(t) - j - 1) + 1):
            if b >= best[0]:
                break
            at = self.next.get(t[j + b])
            while at and at[-1] < i:
                at.pop()
            if at and at[-1] - i <= ahead:
                best = min(best, (at[-1] - i + b, at[-1] - i, b))
        return best[1:]


def generalise(w: list, t: list) -> list:
    """The wrapper w made to match the tokens t as well."""
    out: list = []
    places = Places(w)
    i = j = 0
    while i < len(w) or j < len(t):
        node = w[i] if i < len(w) else None
        if isinstance(node, tuple):
            k = len(node[1])
            while k and alike(node[1], 0, t, j, k):
                node = (node[0], join(node[1], t[j : j + k]))
                j += k
                if node[0] == "?":
                    break
            out.append(node)
            i += 1
        elif node is not None and j < len(t) and same(node, t[j]):
            out.append(node if node == t[j] else SLOT)
            i += 1
            j += 1
        elif (n := square(out, t, j)) or (m := square(out, w, i)):
            if n:
                run, j = join(out[-n:], t[j : j + n]), j + n
            else:
                n, run, i = m, join(out[-m:], w[i : i + m]), i + m
            del out[-n:]
            # further repetitions of the run, on either side
            while True:
                if alike(run, 0, t, j, n):
                    run, j = join(run, t[j : j + n]), j + n
                elif alike(run, 0, w, i, n):
                    run, i = join(run, w[i : i + n]), i + n
                else:
                    break
            out.append(("+", run))
        else:
            a, b = places.meet(i, t, j, AHEAD)
            out += [("?", w[i : i + a])] if a and not any(isinstance(x, tuple) for x in w[i : i + a]) else w[i : i + a]
            out += [("?", t[j : j + b])] if b else []
            i, j = i + a, j + b
    return out


class Wrapper:
    """nodes: the expression; template: texts that are template, by `fixed_text`; slots: places of ambiguous elements that hold slots;
    area: the content, a place or the name of an element, "" if unknown. A place is the number of a node, or see `places`. Numbers count
    nodes in order, those of groups among them."""

    def __init__(self, nodes: list, template=(), slots=(), area: str = ""):
        self.nodes, self.template, self.slots, self.area = nodes, set(template), set(slots), area
        self.flat: list[str] = []
        self.at = self._number(nodes)

    def _number(self, nodes: list) -> list:
        out = []
        for node in nodes:
            if isinstance(node, str):
                out.append(len(self.flat))
                self.flat.append(node)
            else:
                out.append(self._number(node[1]))
        return out

    def dumps(self) -> str:
        return json.dumps([self.nodes, sorted(self.template), sorted(self.slots), [self.area]], separators=(",", ":"))

    @classmethod
    def loads(cls, text: str) -> Wrapper:
        nodes, template, slots, (area,) = json.loads(text)
        return cls(nodes, template, slots, area)

    def _fits(self, nodes: list, at: list, t: list, j: int, out: list) -> int:
        """Where the group's match at j ends, -1 if there is none; out gets (place, number)."""
        for node, n in zip(nodes, at):
            if isinstance(node, str):
                if j >= len(t) or not same(node, t[j]):
                    return -1
                out.append((j, n))
                j += 1
            else:
                first = True
                while (end := self._fits(node[1], n, t, j, more := [])) > j:
                    out += more
                    j, first = end, False
                    if node[0] == "?":
                        break
                if first and node[0] == "+":
                    return -1
        return j

    def read(self, t: list) -> list[int]:
        """The number of each token's node, -1 for those that the wrapper has no place for."""
        out = [-1] * len(t)
        places = Places(self.nodes)
        last = None

        def take(group: int, j: int) -> int:
            end = self._fits(self.nodes[group][1], self.at[group], t, j, got := [])
            for k, n in got if end > j else ():
                out[k] = n
            return end

        i = j = 0
        while i < len(self.nodes) and j < len(t):
            node = self.nodes[i]
            if not isinstance(node, str):
                while (end := take(i, j)) > j:
                    j = end
                    if node[0] == "+":
                        last = i
                    else:
                        break
                i += 1
            elif same(node, t[j]):
                out[j] = self.at[i]
                i += 1
                j += 1
            else:
                a, b = places.meet(i, t, j, READ_AHEAD)
                stop = j + b
                # what the page has more of may be the last repetition
                while j < stop:
                    end = take(last, j) if last is not None else -1
                    j = end if j < end <= stop else j + 1
                i += a
        return out


    def places(self, t: list) -> list[str]:
        """The place of each token: the number of its node or, where the wrapper has none, the last number before it and its tag (a text's
        is the tag before it), so that repetitions of what no node stands for have one place."""
        out, last, tag = [], -1, ""
        for n, x in zip(self.read(t), t):
            if x[0] == "<":
                tag = x
            if n >= 0:
                last = n
            out.append(str(n) if n >= 0 else f"{last} {tag}")
        return out


def fixed_text(place: str, text: str) -> int:
    """A text (as in `keys`) at a place, as a signed number of 64 bits."""
    h = xxhash.xxh3_64_intdigest(f"{place}{text}".encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def unlike(pages: list[str]) -> list[str]:
    """Up to SAMPLE of the pages whose texts are mostly not in one another."""
    out: list[str] = []
    have: list[set[str]] = []
    for p in pages:
        blocks = set(main_text(p).split("\n\n")) - {""}
        size = lambda x: sum(map(len, x))
        if blocks and all(size(blocks & other) < UNLIKE * min(size(blocks), size(other)) for other in have):
            out.append(p)
            have.append(blocks)
            if len(out) == SAMPLE:
                break
    return out


def frame(pages: list[str]) -> Wrapper:
    """The nodes of the wrapper of unlike pages of one host."""
    nodes: list = []
    for k, page in enumerate(pages):
        t, _ = keys(tokens(page))
        nodes = t if k == 0 else generalise(nodes, t)
    return Wrapper(nodes)


def placed(page: str, w: Wrapper) -> tuple[list, dict[int, str], dict[int, int]]:
    """A page's tokens, and by their numbers the places of all and the `fixed_text` of the texts."""
    toks = tokens(page)
    t, at = keys(toks)
    place = dict(zip(at, w.places(t)))
    return toks, place, {k: fixed_text(place[k], x) for k, x in zip(at, t) if x[0] == SLOT}


def texts(page: str, w: Wrapper) -> tuple[dict[int, int], int, int, bool]:
    """Texts of a page that are in no boilerplate by plain names, each (by `fixed_text`) with its length outside links; the length of those
    in articles and in main elements; and whether an element has an ambiguous name."""
    toks, _, fixed = placed(page, w)
    # name, boilerplate, link, article, main (itself or around it)
    stack = [("", False, False, False, False)]
    count: Counter = Counter()
    out: dict[int, int] = {}
    article = main = 0
    ambiguous = False
    for k, (kind, name, value) in enumerate(toks):
        _, bad, link, in_article, in_main = stack[-1]
        if kind == "text":
            if not bad and k in fixed:
                n = 0 if link else len(value.strip())
                out[fixed[k]] = out.get(fixed[k], 0) + n
                article, main = article + n * in_article, main + n * in_main
        elif kind == "open":
            while len(stack) > 1 and stack[-1][0] in CLOSES.get(name, ()):
                count[stack.pop()[0]] -= 1
            _, bad, link, in_article, in_main = stack[-1]
            stack.append((name, bad or plain(name, value), link or name == "a", in_article or name == "article", in_main or name == "main"))
            count[name] += 1
            ambiguous = ambiguous or said(value) == "ambiguous"
        elif count[name]:
            while count[name] and stack[-1][0] != name:
                count[stack.pop()[0]] -= 1
            count[stack.pop()[0]] -= 1
    return out, article, main, ambiguous


def elements(page: str, w: Wrapper) -> dict[str, list]:
    """place -> [whether it is of an ambiguous name, length of the text in slots, of it in h1, depth] of a page's elements that are of such
    a name or hold text in slots; of the page, with place "" and depth -1."""
    toks, place, fixed = placed(page, w)
    out: dict[str, list] = {}
    for k, depth, own, heading in tally(toks, {k for k, x in fixed.items() if x in w.template}):
        odd = k >= 0 and said(toks[k][2]) == "ambiguous"
        if odd or own or k < 0:
            e = out.setdefault(place[k] if k >= 0 else "", [odd, 0, 0, depth])
            e[:] = e[0] or odd, e[1] + own, e[2] + heading, max(e[3], depth)
    return out


def infer(pages: list[str]) -> Wrapper:
    """The wrapper of unlike pages of one host and what they themselves, read along it, say about its places: `wrappers` on few pages."""
    w = frame(pages)
    had: Counter = Counter()
    article = main = 0
    for page in pages:
        out, a, m, _ = texts(page, w)
        had.update(out.keys())
        article, main = article + a, main + m
    w.template = {x for x, c in had.items() if c >= max(SHARED_BY, SHARED * len(pages))}
    of: dict[str, list] = {}
    for page in pages:
        for e, (odd, own, heading, depth) in elements(page, w).items():
            x = of.setdefault(e, [0, 0, 0, 0, depth])
            x[:] = x[0] + odd, x[1] + (odd and own > 0), x[2] + own, x[3] + heading, max(x[4], depth)
    w.slots = {e for e, x in of.items() if x[1] > (1 - SHARED) * x[0]}
    if article or main:
        w.area = "article" if article >= main / 2 else "main"
    elif len(pages) >= SHARED_BY and (total := of[""])[2]:
        w.area = max((e for e, x in of.items() if e and x[2] >= MOST * total[2] and x[3] == total[3]), key=lambda e: (of[e][4], -of[e][2], e), default="")
    return w


def tally(toks: list[tuple[str, str, str]], fixed: set[int]):
    """(number, depth, length of the text outside links and boilerplate by plain names, of it in h1) of every element, leaving out the texts
    at `fixed`; and of the page, with number and depth -1."""
    # name, number, boilerplate or link, h1 (itself or around it), then what is returned of it
    stack: list[list] = [["", -1, False, False, 0, 0]]
    count: Counter = Counter()

    def pop():
        name, k, *_, own, heading = stack.pop()
        count[name] -= 1
        up = stack[-1]
        up[4], up[5] = up[4] + own, up[5] + heading
        return k, len(stack) - 1, own, heading

    for k, (kind, name, value) in enumerate(toks):
        top = stack[-1]
        if kind == "text":
            if k not in fixed and not top[2]:
                n = len(value.strip())
                top[4], top[5] = top[4] + n, top[5] + n * top[3]
        elif kind == "open":
            while len(stack) > 1 and stack[-1][0] in CLOSES.get(name, ()):
                yield pop()
            _, _, out, heading, *_ = stack[-1]
            stack.append([name, k, out or name == "a" or plain(name, value), heading or name == "h1", 0, 0])
            count[name] += 1
        elif count[name]:
            while stack[-1][0] != name:
                yield pop()
            yield pop()
    while len(stack) > 1:
        yield pop()
    yield -1, -1, *stack[0][4:]


def main_text(page: str, wrapper: Wrapper | None = None) -> str:
    """Blocks of a page's content, joined by blank lines, as its host's wrapper reads them or, without one, by names."""
    place: dict[int, str] = {}
    fixed: set[int] = set()
    if wrapper is None:
        toks = tokens(page)
    else:
        toks, place, known = placed(page, wrapper)
        fixed = {k for k, x in known.items() if x in wrapper.template}
    has = {n for k, (kind, n, v) in enumerate(toks) if kind == "open" and n in ("article", "main") and not noisy(n, v, False)}
    area = wrapper.area if wrapper is not None else ""
    if area not in has and (has or area not in place.values()):
        area = "article" if "article" in has else "main" if has else ""
    blocks: list[str] = []
    #: headings that are template, which an article has between its texts: kept if more of it follows
    headings: list[str] = []
    now: list[str] = []
    only_fixed = True
    #: tag, boilerplate (itself or around it), within the content, block elements around it
    stack: list[tuple[str, bool, bool, int]] = []
    at_of: dict[str, list[int]] = defaultdict(list)
    state = (False, area == "")

    def end() -> None:
        nonlocal only_fixed
        if t := " ".join("".join(now).split()):
            if not only_fixed:
                blocks.extend([*headings, t])
                headings.clear()
            elif blocks and area in ("article", "main") and any(at_of[n] for n in HEADINGS):
                headings.append(t)
        now.clear()
        only_fixed = True

    def pop() -> None:
        nonlocal state
        at_of[stack.pop()[0]].pop()
        state = stack[-1][1:3] if stack else (False, area == "")

    for k, (kind, name, value) in enumerate(toks):
        skip, within = state
        if kind == "text":
            if within and not skip:
                now.append(html.unescape(value))
                only_fixed = only_fixed and (k in fixed or not now[-1].strip())
            continue
        if name == "br":
            now.append(" ")
            continue
        if name in BLOCKS and not (skip or (not within and name != area)):
            end()
        if kind == "open":
            if name in BLOCKS:
                while stack and stack[-1][0] in CLOSES.get(name, {"p"}):
                    pop()
                skip, within = state
            bad = noisy(name, value, within, k in place and place[k] in wrapper.slots)
            begins = area != "" and (name == area or place.get(k) == area)
            at_of[name].append(len(stack))
            stack.append((name, skip or bad, within or (begins and not bad), (stack[-1][3] if stack else 0) + (name in BLOCKS)))
            state = stack[-1][1:3]
        elif at_of[name]:
            # an inline element doesn't end a block around it
            at = at_of[name][-1]
            if name not in BLOCKS and name not in SKIPPED and stack[-1][3] > stack[at][3]:
                continue
            while len(stack) > at:
                pop()
    end()
    return "\n\n".join(blocks)


def host():
    """Host of a url, lower case, without port; "" if there is none."""
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def along(rows: DataFrame, w: DataFrame, how: str, columns: list[str], schema: str, types: list, one) -> DataFrame:
    """`columns` of the rows and what one(page, wrapper or None) says of each, with the wrapper of its host in w."""
    size = w.agg(F.coalesce(F.sum(F.length("wrapper") + 100), F.lit(0))).first()[0]

    def run(batches):
        known: dict[str, Wrapper] = {}
        for b in batches:
            out = []
            for h, x in zip(b.column("html").to_pylist(), b.column("wrapper").to_pylist()):
                if x is not None and x not in known:
                    if sum(map(len, known)) > 4 << 20:
                        known.clear()
                    known[x] = Wrapper.loads(x)
                out.append(one(h or "", None if x is None else known[x]))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in columns] + [pa.array([x[k] for x in out], t) for k, t in enumerate(types)], names=[x.split()[0] for x in schema.split(", ")])

    return rows.select("host", "html", *(c for c in columns if c != "host")).join(small_or_shuffled(w.select("host", "wrapper"), size // 16), "host", how).mapInArrow(run, schema)


def frames(rows: DataFrame, keep: Scratch) -> DataFrame:
    """(host, nodes) of each host of two distinct pages or more: what numbers the places of all of its pages. Every tag and class that any
    page of the host has is in one of the pages that the nodes are of, as far as CANDIDATES pages do; the most frequent come first."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h")
        least = pdf.html[pdf.least].tolist()
        some = unlike(least)
        some += [x for x in pdf.html[pdf.cover] if x not in some]
        some += [x for x in least if x not in some][: max(0, SAMPLE - len(some))]
        found = [json.dumps(frame(some).nodes, separators=(",", ":"))] if len(pdf) > 1 else []
        return pd.DataFrame({"host": [pdf.host.iat[0]] * len(found), "nodes": found}, dtype=object)

    first = lambda df, order, *by: df.withColumn("rn", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("rn") <= CANDIDATES).drop("rn")
    # a host of very many pages is dealt to several tasks first
    least = first(first(rows.select("host", "h", F.pmod("h", F.lit(64)).alias("part")).distinct(), ["h"], "host", "part"), ["h"], "host")
    names = F.concat(F.regexp_extract_all("html", F.lit(r"<([a-zA-Z][a-zA-Z0-9:-]*)")), F.regexp_extract_all("html", F.lit(r"(\sclass\s*=\s*(?:\"[^\"<>]*|'[^'<>]*|[^\s\"'<>]+))")))
    names = F.array_distinct(F.transform(F.array_distinct(names), lambda x: F.lower(F.regexp_replace(x, "[0-9]+", "0"))))
    cover = rows.select("host", "h", F.explode(names).alias("name")).groupBy("host", "name").agg(F.count("*").alias("n"), F.min("h").alias("h"))
    cover = first(cover.groupBy("host", "h").agg(F.max("n").alias("n")), [F.desc("n"), "h"], "host")
    chosen = least.select("host", "h", F.lit(True).alias("least"), F.lit(False).alias("cover")).unionByName(cover.select("host", "h", F.lit(False).alias("least"), F.lit(True).alias("cover")))
    chosen = keep.save(chosen.groupBy("host", "h").agg(F.max("least").alias("least"), F.max("cover").alias("cover")), "candidates")
    # copies of a page are one, before they are sent
    some = rows.join(small_or_shuffled(chosen, 3 * chosen.count()), ["host", "h"]).groupBy("host", "h", "least", "cover").agg(F.min("html").alias("html"))
    return some.groupBy("host").applyInPandas(fit, "host string, nodes string")


def wrappers(pages: DataFrame, keep: Scratch) -> DataFrame:
    """(host, wrapper) of each host of which two distinct pages or more are evidence of a template, counted over all of its distinct pages."""
    def whole(template, slots, area):
        empty = F.array().cast("array<string>")
        return F.concat(F.lit("["), "nodes", *(x for c, t in ((template, "array<bigint>"), (slots, "array<string>")) for x in (F.lit(","), F.to_json(F.coalesce(c, empty.cast(t))))), F.lit(","), F.to_json(F.array(area)), F.lit("]")).alias("wrapper")

    none = F.lit(None)
    rows = pages.where("html is not null").select(host().alias("host"), F.xxhash64("html").alias("h"), "html")
    w = keep.save(frames(rows, keep), "frames")

    def see(page, w):
        out, article, main, ambiguous = texts(page, w)
        return list(out), list(out.values()), article, main, ambiguous

    seen = along(rows, w.select("host", whole(none, none, F.lit(""))), "inner", ["host", "h"], "host string, h long, text array<long>, size array<long>, article long, main long, ambiguous boolean", [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.bool_()], see)
    seen = keep.save(seen.dropDuplicates(["host", "h"]), "seen")
    each = lambda df: df.select("host", "h", F.inline(F.arrays_zip("text", "size")))
    hosts = keep.save(seen.groupBy("host").agg(F.count("*").alias("pages"), F.sum("article").alias("article"), F.sum("main").alias("main"), F.max("ambiguous").alias("ambiguous")), "hosts")
    of = small_or_shuffled(hosts.select("host", "pages"), 3 * hosts.count())
    # pages of which most is what nearly all pages have are no evidence of a template
    shared = each(seen).groupBy("host", "text").agg(F.count("*").alias("n")).where("n > 1").join(of, "host").where(F.col("n") >= SHARED * F.col("pages"))
    shared = keep.save(shared.select("host", "text", F.lit(True).alias("shared")), "shared")
    own = each(seen).join(small_or_shuffled(shared, 3 * shared.count()), ["host", "text"], "left").groupBy("host", "h").agg(F.sum("size").alias("size"), F.sum(F.when(F.col("shared").isNull(), F.col("size"))).alias("rest"))
    evidence = keep.save(own.where((F.col("rest") > 0) & (F.col("rest") >= UNLIKE * F.col("size"))).select("host", "h"), "evidence")
    by = keep.save(evidence.groupBy("host").agg(F.count("*").alias("by")).where("by > 1"), "by")
    template = each(seen.join(evidence, ["host", "h"], "left_semi")).groupBy("host", "text").agg(F.count("*").alias("n")).where(F.col("n") >= SHARED_BY).join(small_or_shuffled(by, 3 * by.count()), "host").where(F.col("n") >= SHARED * F.col("by"))
    template = template.groupBy("host").agg(F.sort_array(F.collect_list("text")).alias("template"))
    named = F.when(F.col("article") + F.col("main") == 0, F.lit("")).when(F.col("article") >= F.col("main") / 2, F.lit("article")).otherwise(F.lit("main"))
    w = keep.save(w.join(by, "host").join(hosts.select("host", "ambiguous", named.alias("named")), "host").join(template, "host", "left"), "templates")

    # where names leave something open, what is in slots is summed by element
    def look(page, w):
        out = elements(page, w)
        return [list(out), *map(list, zip(*out.values()))]

    asked = w.where(F.col("ambiguous") | ((F.col("named") == "") & (F.col("by") >= SHARED_BY))).select("host", whole(F.col("template"), none, F.lit("")))
    found = along(rows, asked, "inner", ["host", "h"], "host string, h long, place array<string>, odd array<boolean>, own array<long>, heading array<long>, depth array<long>", [pa.list_(t) for t in (pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())], look)
    found = found.dropDuplicates(["host", "h"]).select("host", F.inline(F.arrays_zip("place", "odd", "own", "heading", "depth")))
    found = found.groupBy("host", "place").agg(F.count_if("odd").alias("odd"), F.count_if(F.col("odd") & (F.col("own") > 0)).alias("filled"), F.sum("own").alias("own"), F.sum("heading").alias("heading"), F.max("depth").alias("depth"))
    found = keep.save(found, "elements")
    slots = found.where(F.col("filled") > (1 - SHARED) * F.col("odd")).groupBy("host").agg(F.sort_array(F.collect_list("place")).alias("slots"))
    total = found.where("place = ''").select("host", F.col("own").alias("all"), F.col("heading").alias("title"))
    area = found.where("place <> ''").join(total, "host").where((F.col("all") > 0) & (F.col("own") >= MOST * F.col("all")) & (F.col("heading") == F.col("title"))).groupBy("host").agg(F.max_by("place", F.struct("depth", -F.col("own"), "place")).alias("area"))
    at = F.when((F.col("named") == "") & (F.col("by") >= SHARED_BY), F.coalesce("area", F.lit(""))).otherwise(F.col("named"))
    return w.join(slots, "host", "left").join(area, "host", "left").select("host", whole(F.col("template"), F.col("slots"), at))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages. A null or empty html has no text; pages without a host in their url are one host.

    Rows may repeat and are each answered, and page_id and url may be null; other columns are ignored, whatever their names; an empty
    table gives no rows. Pages are read whole, in time that grows with their length. Unclosed elements end with the one around them.
    """
    def read(page, w):
        text = main_text(page, w)
        return text, len(text)

    keep = Scratch(pages.sparkSession)
    w = keep.save(wrappers(pages, keep), "wrappers")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host().alias("host"))
    return along(rows, w, "left", ["page_id", "url"], "page_id long, url string, text string, n_chars long", [pa.string(), pa.int64()], read)


def op6_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
