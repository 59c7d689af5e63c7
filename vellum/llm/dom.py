"""A small, forgiving reader of web pages: element trees with text leaves, as the tree matching needs them."""

from __future__ import annotations

import html
import re

#: Fixed values of the HTML standard: elements without content, elements whose content is not markup, elements that end an
#: open paragraph, and elements that run within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
UNSEEN = frozenset("script style template noscript".split())
#: An element ends open ones of the first kind, as far as the next of the second.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
PARAGRAPH = ({"p"}, {"table", "td", "th", "button", "body", "html"})

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

#: Names of page parts that are not the article, as words of class, id and role, and the elements that stand for them.
NOISE_TAGS = frozenset(
    "nav footer aside form script style noscript template iframe object svg math head button select textarea dialog menu canvas "
    "audio video map title search".split()
)
NOISE_WORDS = frozenset(
    "nav navigation navbar menu menubar footer sidebar aside ad ads adv advert adverts advertisement advertisements advertising "
    "sponsor sponsored promo promos promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "subscribe subscription newsletter signup login share sharing social related recommended recommendations breadcrumb "
    "breadcrumbs pagination pager widget toolbar masthead copyright contentinfo complementary search dialog".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist respond reply replies discussion disqus".split())
HEADER_WORDS = frozenset({"header", "banner", "masthead"})
WORD = re.compile(r"[a-z0-9]+")


class Node:
    """An element, or a text leaf if ``text`` is not None. ``noise`` marks parts that are not the article."""

    __slots__ = ("tag", "label", "children", "text", "noise", "sig", "size", "first", "last")

    def __init__(self, tag: str, label: str, text: str | None = None, noise: bool = False):
        self.tag, self.label, self.text, self.noise = tag, label, text, noise
        self.children: list[Node] = []


def described(tag: str, attributes: str, inside: bool) -> tuple[str, bool]:
    """Label of an element for matching, and whether it is no part of the article; ``inside``: within an article."""
    classes, words, hidden = "", set(), False
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "class":
                classes = value
            if name in ("class", "id", "role"):
                words.update(WORD.findall(value))
            elif name == "hidden":
                hidden = True
            elif name == "aria-hidden":
                hidden |= value == "true"
            elif name == "style":
                hidden |= "display:none" in value.replace(" ", "")
    noise = hidden or tag in NOISE_TAGS or not words.isdisjoint(COMMENT_WORDS)
    if tag not in ("html", "body", "main", "article"):
        noise = noise or not words.isdisjoint(NOISE_WORDS) or not inside and (tag == "header" or not words.isdisjoint(HEADER_WORDS))
    elif tag in ("html", "body"):
        noise = False
    return f"{tag}.{classes}" if classes else tag, noise


def parse(page: str) -> Node:
    """The tree of a page. Whatever is wrong in the markup, every text ends up in some leaf."""
    root = Node("#root", "#root")
    stack, at, inside = [root], 0, 0
    lowered = None

    def close(count: int) -> None:
        nonlocal inside
        for node in stack[len(stack) - count :]:
            inside -= node.tag in ("article", "main")
        del stack[len(stack) - count :]

    def end_open(rule: tuple[set[str], set[str]]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in rule[0]:
                close(len(stack) - depth)
                return
            if tag in rule[1]:
                return

    def leaf(raw: str) -> None:
        if raw and not raw.isspace():
            stack[-1].children.append(Node("#text", "#text", html.unescape(raw) if "&" in raw else raw))
        elif raw and stack[-1].children and stack[-1].children[-1].tag in INLINE:
            stack[-1].children.append(Node("#space", "#space", " "))

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            leaf(page[at:])
            return root
        leaf(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag = name.lower()
        if m[1] or m[4]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(len(stack) - depth)
                    break
                if tag in INLINE and stack[depth].tag not in INLINE:
                    break
            continue
        if tag in ENDS_PARAGRAPH:
            end_open(PARAGRAPH)
        if tag in ENDS:
            end_open(ENDS[tag])
        attributes = m[3] if m[2] else m[6]
        label, noise = described(tag, attributes, inside > 0)
        node = Node(tag, label, None, noise)
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            lowered = lowered or page.lower() if page.isascii() else lowered or re.sub("[A-Z]", lambda x: x[0].lower(), page)
            end = lowered.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
            continue
        if attributes and attributes.rstrip().endswith("/") and tag not in INLINE | ENDS_PARAGRAPH:
            continue
        stack.append(node)
        inside += tag in ("article", "main")


def articles(root: Node) -> list[Node]:
    """The outermost articles that are no noise, else the main parts, else the whole page."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    todo = [(root, False)]
    while todo:
        node, within = todo.pop()
        if node.noise:
            continue
        if node.tag == "article":
            found["article"].append(node)
            continue
        if node.tag == "main" and not within:
            found["main"].append(node)
            within = True
        todo.extend((c, within) for c in reversed(node.children))
    return found["article"] or found["main"] or [root]


def content(parts: list[Node], template: set[int]) -> str:
    """The text of the parts without noise and without the leaves in ``template`` (by identity)."""
    out: list[str] = []

    def walk(node: Node) -> None:
        todo: list[Node | str] = [node]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.text is not None:
                if id(x) not in template:
                    out.append(x.text)
            elif x.tag not in UNSEEN:
                if x.tag not in INLINE:
                    out.append(" ")
                    todo.append(" ")
                if not x.noise:
                    todo.extend(reversed(x.children))

    for part in parts:
        walk(part)
        out.append(" ")
    return " ".join("".join(out).split())
