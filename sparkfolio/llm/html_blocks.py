"""Leaf blocks of an HTML page: runs of text between block-level tags, with the set of their tag path's features.

One pass of a regular expression over the tags; a stack holds the open elements. Scripts, styles, titles, templates,
embedded graphics and comments hold no text. Malformed pages are read the way browsers do where it matters: a new paragraph
or item ends an open one, an end tag without its start is passed over, what is never closed goes on to the end.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from zlib import crc32

PATH_BUCKETS = 1024
#: Elements without visible text, elements without content, elements that begin and end a block.
SILENT = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "noembed", "noframes", "xmp", "object", "audio", "video", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "label", "legend", "li", "main",
         "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: An element that opens ends open ones of these kinds, up to one of the others.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"})}
_SCOPE = {"td", "th", "caption", "table", "button", "html", "body"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>"']*+(?>"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)(?=>)|[^>]*+)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(class|id|role|data-y)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def bucket(token: str, n: int = PATH_BUCKETS) -> int:
    return crc32(token.encode()) % n


@dataclass
class Block:
    """One leaf: its text with single blanks, the buckets of its path, the share of its characters inside links."""

    text: str
    path: frozenset
    tags: str
    links: float
    label: str = ""


@dataclass
class _Open:
    tag: str
    path: frozenset
    link: bool
    label: str


@dataclass
class _Leaf:
    pieces: list = field(default_factory=list)
    linked: int = 0
    size: int = 0


_CACHE: dict[tuple[str, str], frozenset] = {}


def _features(tag: str, attributes: str) -> frozenset:
    """Buckets of one element: its tag and the words of its class, id and role."""
    found = _CACHE.get((tag, attributes))
    if found is None:
        tokens = {f"tag:{tag}"}
        for name, value in _NAMES.findall(attributes):
            if name.lower() != "data-y":
                tokens |= {f"name:{w.lower()}" for w in _PART.findall(value)}
        if _HIDDEN.search(attributes):
            tokens.add("hidden")
        found = frozenset(map(bucket, tokens))
        if len(attributes) < 200 and len(_CACHE) < 20_000:
            _CACHE[tag, attributes] = found
    return found


def leaves(page: str | None) -> list[Block]:
    """Blocks of the whole page in order; none for null, empty or text-free pages."""
    if not page:
        return []
    out: list[Block] = []
    stack = [_Open("", frozenset(), False, "")]
    opened: Counter = Counter()
    leaf = _Leaf()
    owner = stack[0]

    def text(raw: str) -> None:
        nonlocal owner
        if not leaf.pieces and raw.isspace():
            return
        if "&" in raw:
            raw = html.unescape(raw)
        if not leaf.pieces:
            owner = next((e for e in reversed(stack) if e.tag in BLOCK), stack[0])
        leaf.pieces.append(raw)
        size = len(raw)
        leaf.size += size
        leaf.linked += size * stack[-1].link

    def end_block() -> None:
        nonlocal leaf
        if leaf.pieces:
            words = " ".join("".join(leaf.pieces).split())
            if words:
                out.append(Block(words, owner.path | {bucket(f"leaf:{owner.tag}")}, owner.tag, leaf.linked / max(1, leaf.size), owner.label))
            leaf = _Leaf()

    def pop_to(at: int) -> None:
        for e in stack[at:]:
            opened[e.tag] -= 1
        del stack[at:]

    def close_until(kinds: set, stops: set) -> None:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].tag in kinds:
                return pop_to(at)
            if stack[at].tag in stops:
                return None

    at = 0
    while (m := _TAG.search(page, at)) is not None:
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in SILENT and not closing:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at) if not m[3].endswith("/") else m
            at = len(page) if end is None else max(at, end.end())
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in BLOCK:
            end_block()
        if closing:
            if opened[tag] > 0:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        pop_to(i)
                        break
                    if tag not in BLOCK and stack[i].tag in BLOCK:
                        break
            continue
        if tag in VOID:
            continue
        if tag in BLOCK and opened["p"] > 0:
            close_until({"p"}, _SCOPE)
        if tag in ENDS and any(opened[k] > 0 for k in ENDS[tag][0]):
            close_until(*ENDS[tag])
        if m[3].endswith("/") and tag not in BLOCK:
            continue
        up = stack[-1]
        own = _features(tag, m[3])
        label = next((v.strip("\"'") for n, v in _NAMES.findall(m[3]) if n == "data-y"), up.label) if "data-y" in m[3] else up.label
        stack.append(_Open(tag, up.path if own <= up.path else up.path | own, up.link or tag == "a", label))
        opened[tag] += 1
    if at < len(page):
        text(page[at:])
    end_block()
    return out
