"""Blocks of text of an HTML page, with where they stand and what speaks for or against them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|</([a-zA-Z][^\s/>]*)[^>]*+>?"
    r"|<([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"   # a tag with its quotes closed
    r"|<([a-zA-Z][^\s/>]*)([^>]*+)>?"                             # any other tag
    r"|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACE = re.compile(r"\s+")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements whose text is no text of the page, as far as their end tag.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "object", "select", "button",
       "canvas", "audio", "video", "xmp", "annotation", "annotation-xml"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that do not end a block.
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "output", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img",
          # formulas
          "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mspace", "mfrac", "msqrt", "mroot", "msub", "msup",
          "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mprescripts", "mtable", "mtr", "mtd", "mstyle",
          "mpadded", "mphantom", "mfenced", "menclose", "merror"}
#: A start tag ends an open element of its kind.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, **{f"h{k}": {"p"} for k in range(1, 7)}}
AGAINST_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset", "head", "search"}
#: Weak evidence, like the names below: a wrapper of what the page has to say may be one (see ``_cancel``).
WEAK_TAGS = {"form", "fieldset"}
FOR_TAGS = {"article", "main"}
AGAINST_NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "adsense", "banner", "breadcrumb", "breadcrumbs", "byline",
    "comment", "comments", "consent", "contentinfo", "cookie", "cookies", "copyright", "dialog", "disclaimer", "disqus",
    "footer", "footnote", "form", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notices", "notification", "pager", "pagination", "popup", "promo", "promoted", "related",
    "recommended", "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "sitemap", "skip", "social",
    "sponsor", "sponsored", "subscribe", "tags", "toolbar", "topbar", "widget", "complementary", "alert"}
#: Beginnings of names, in several languages: reader comments, and networks that place adverts.
AGAINST_STEMS = ("comment", "komment", "coment", "discuss", "respons", "feedback", "outbrain", "taboola", "advert", "werb")
NO_STEMS = {"responsive", "commentary"}
FOR_NAMES = {"article", "body", "content", "entry", "main", "post", "story", "text"}
RUNNING_WORDS = 8       # a block of so many words is running text
LEAST_TEXT = 120        # characters of running text that can be a page's text
REST = 0.2
# The page's article: the outermost article with most running text, if it holds this share of it.
SHARE_OF_ONE = 0.25     # where it is the only one
SHARE_OF_MANY = 0.5


@dataclass
class Element:
    tag: str
    number: int
    up: int         # number of the element around it
    evidence: int   # -1, 0, 1: against, nothing, for
    weak: bool      # the evidence against is a name or a form
    otherwise: int  # 0, 1: the evidence without what speaks against
    inside: int     # how many of it and what is around have something that speaks for


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    tag: str = ""
    parent: int = 0
    element: int = 0
    against: int = 0  # how many of the elements around it speak against
    inside: int = 0   # how many speak for
    holder: int = 0   # the innermost element that speaks for it, if none further in speaks against
    in_tag: bool = False  # an article or the like is around it
    outside: bool = False  # the page has an article and this is not in it
    linked: int = 0  # characters in links
    text: str = ""


def _evidence(tag: str, attributes: str, in_article: bool) -> tuple[int, bool, int]:
    """(evidence, whether it is weak, evidence without what speaks against). Wrappers of every page have none."""
    if tag in ("html", "body"):
        return 0, False, 0
    strong = tag in AGAINST_TAGS - WEAK_TAGS or (tag == "header" and not in_article)
    against, found = strong or tag in WEAK_TAGS, 1 if tag in FOR_TAGS else 0
    low = attributes.lower() if attributes else ""
    if low.strip():
        bare = re.sub(r"\"[^\"]*\"|'[^']*'", "", low)
        if re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", bare) or re.search(r"display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", low):
            strong = against = True
        for name, *values in ATTRIBUTE.findall(attributes):
            if name.lower() in ("class", "id", "role"):
                parts = {p.lower() for p in NAME_PARTS.findall("".join(values))}
                stems = any(p.startswith(AGAINST_STEMS) and p not in NO_STEMS for p in parts)
                if stems or parts & AGAINST_NAMES and not (in_article and parts & {"header", "tags"} and not parts & (AGAINST_NAMES - {"header", "tags"})):
                    against = True
                if parts & FOR_NAMES:
                    found = 1
    return -1 if against else found, against and not strong, found


def _cancel(every: list[Element], out: list[Block]) -> None:
    """Cancels weak evidence against what holds the page's text, then counts what speaks for and against each block.

    An element that speaks against weakly is what its name says if the text it would leave is the page's. If it would
    leave next to nothing (``REST`` of what it holds), and holds an article or most of the page's running text,
    it is a wrapper. Outer elements are looked at first.
    """
    n = len(every)
    text, free, articles = [0] * n, [0] * n, [0] * n  # text: all but in strong ones; free: what nothing speaks against
    for b in out:
        if len(b.text.split()) >= RUNNING_WORDS:
            own = max(0, len(b.text) - b.linked)
            text[b.element] += own
            free[b.element] += own
    shown = [0] * n  # articles that nothing speaks against
    for e in reversed(every[1:]):
        if e.tag in FOR_TAGS and (e.evidence > 0 or e.tag == "main"):
            articles[e.number] += 1
            shown[e.number] += e.evidence > 0
        if e.evidence >= 0 or e.weak:
            text[e.up] += text[e.number]
            articles[e.up] += articles[e.number]
        if e.evidence >= 0:
            free[e.up] += free[e.number]
            shown[e.up] += shown[e.number]
    left, left_articles = free[0], shown[0]
    against, inside, holder, in_tag = [0] * n, [0] * n, [0] * n, [False] * n
    for e in every[1:]:
        k = e.number
        if e.evidence < 0 and e.weak and not against[e.up] and left <= REST * text[k]:
            most = text[k] >= max(LEAST_TEXT, text[0] / 2)
            if most or (articles[k] and not left_articles):
                e.evidence = e.otherwise
                left += free[k]
                left_articles += shown[k]
        against[k] = against[e.up] + (e.evidence < 0)
        inside[k] = inside[e.up] + (e.evidence > 0)
        holder[k] = 0 if e.evidence < 0 else k if e.evidence > 0 else holder[e.up]
        in_tag[k] = e.evidence >= 0 and (in_tag[e.up] or (e.evidence > 0 and e.tag in FOR_TAGS))
    for b in out:
        k = b.element
        b.against, b.inside, b.holder, b.in_tag = against[k], inside[k], holder[k], in_tag[k]


def _outside(every: list[Element], out: list[Block]) -> None:
    """Marks the blocks that are not in the page's article, where it has one. Its first-level heading may stand before it."""
    against, top = [0] * len(every), [0] * len(every)
    for e in every[1:]:
        against[e.number] = against[e.up] + (e.evidence < 0)
        top[e.number] = top[e.up] or (e.number if e.tag == "article" and not against[e.number] else 0)
    held: dict[int, int] = {}
    for b in out:
        if not b.against and len(b.text.split()) >= RUNNING_WORDS:
            held[top[b.element]] = held.get(top[b.element], 0) + len(b.text) - b.linked
    articles = {k: v for k, v in held.items() if k and v > 0}
    if not articles:
        return
    most = max(articles, key=articles.get)
    if articles[most] >= (SHARE_OF_ONE if len(articles) == 1 else SHARE_OF_MANY) * sum(held.values()):
        for b in out:
            b.outside = top[b.element] != most and not b.against and b.tag != "h1"


def blocks(page: str) -> list[Block]:
    """The page's blocks in order: the text between two block tags. Broken and unclosed tags are borne."""
    out: list[Block] = []
    stack = [Element("", 0, 0, 0, False, 0, 0)]
    every = list(stack)
    numbers, links, at, size = 0, 0, 0, len(page)
    now = Block()

    def flush() -> None:
        nonlocal now
        text = SPACE.sub(" ", "".join(now.parts)).strip()
        if text:
            now.text = text
            out.append(now)
        top = stack[-1]
        holder = stack[-2] if len(stack) > 1 and top.tag in ("p", "li") else top
        now = Block(tag=top.tag, parent=holder.number, element=top.number)

    flush()
    while at < size:
        m = TOKEN.match(page, at)
        at = m.end()
        token = m.group()
        if token[0] != "<" or token == "<":
            text = html.unescape(token) if "&" in token else token
            now.parts.append(text)
            if links:
                now.linked += len(text)
            continue
        if m[1] is not None:
            tag = m[1].lower()
            if tag == "a":
                links = max(0, links - 1)
            elif tag not in INLINE:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        links = 0
                        break
                flush()
            elif tag == "br":
                now.parts.append(" ")
            continue
        tag, attributes = (m[2], m[3]) if m[2] is not None else (m[4], m[5])
        if tag is None:
            continue  # comment or declaration
        tag = tag.lower()
        if tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else size
            if not end and tag not in ("script", "style", "textarea", "title"):
                at = m.end()
            now.parts.append(" ")
        elif tag == "a":
            links += 1
        elif tag in ("br", "img", "wbr"):
            now.parts.append(" " if tag == "br" else "")
        elif tag not in INLINE:
            for k in range(len(stack) - 1, max(0, len(stack) - 3), -1):
                if stack[k].tag in CLOSES.get(tag, {"p"}):
                    del stack[k:]
                    break
            if tag not in VOID and not attributes.endswith("/"):
                top = stack[-1]
                numbers += 1
                e, weak, otherwise = _evidence(tag, attributes, top.inside > 0)
                stack.append(Element(tag, numbers, top.number, e, weak, otherwise, top.inside + (otherwise > 0)))
                every.append(stack[-1])
            links = 0
            flush()
    flush()
    _cancel(every, out)
    _outside(every, out)
    return out
