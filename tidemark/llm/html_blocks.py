"""HTML pages as sequences of leaf text blocks.

A small forgiving reader: markup, comments, scripts and styles vanish, character
references are decoded, block-level tags (and ``br``) end a block, and white
space inside a block becomes one space. Each block keeps the path of open tags
above it as tokens (tag, tag.class, #id, @role).
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li "
    "main menu nav noscript ol optgroup option p pre search section select summary table tbody td textarea tfoot "
    "th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the key closes an open tag of the value, up to the nearest container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody"}, "tfoot": {"tbody"}}
CONTAINERS = frozenset("article aside body button div fieldset footer form header html main nav section table td th ul ol dl select".split())
ENDS_P = BLOCK_TAGS - {"br", "button", "label", "option", "textarea", "title", "select", "iframe", "noscript"}

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<[A-Za-z/!?][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?<![^\s\"'])(class|id|role|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in ("script", "style", "template", "textarea", "title")}
_DROPPED = ("script", "style", "template")


class Node:
    """An open tag: its tokens, the tokens of the tags above, and an inherited training mark."""

    __slots__ = ("tag", "tokens", "mark", "in_link")

    def __init__(self, tag: str, attrs: str, above: Node | None):
        own, self.mark = [tag], above.mark if above else None
        if attrs:
            for name, a, b, c in _ATTR.findall(attrs):
                value, name = a or b or c, name.lower()
                if name == "data-y":
                    self.mark = int(value)
                elif name == "class":
                    own += [f"{tag}.{v}" for v in value.lower().split()] + [f".{v}" for v in value.lower().split()]
                else:
                    own.append(("#" if name == "id" else "@") + value.lower())
        self.tag = tag
        self.tokens = above.tokens.union(own) if above else frozenset(own)
        self.in_link = tag == "a" or bool(above and above.in_link)


@dataclass
class Block:
    text: str
    tokens: frozenset
    link_share: float
    mark: int | None


def blocks(page: str | None) -> list[Block]:
    """The non-empty leaf blocks of a page in page order."""
    out: list[Block] = []
    stack: list[Node] = []
    pieces: list[str] = []
    home: Node | None = None
    linked = 0

    def add(raw: str) -> None:
        nonlocal home, linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if text.strip():
                home = home or (stack[-1] if stack else None)
                if stack and stack[-1].in_link:
                    linked += len(text)

    def flush() -> None:
        nonlocal home, linked
        text = " ".join("".join(pieces).split()) if pieces else ""
        if text:
            out.append(Block(text, home.tokens if home else frozenset(), min(1.0, linked / len(text)),
                             home.mark if home else None))
        pieces.clear()
        home, linked = None, 0

    def close(tags: set[str], stop: frozenset) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in stop:
                return

    page = page or ""
    at, size = 0, len(page)
    while at < size:
        m = _MARK.search(page, at)
        add(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if tag in BLOCK_TAGS:
            flush()
        if m["end"]:
            if any(n.tag == tag for n in stack):
                close({tag}, frozenset())
            continue
        if tag in _RAW:
            end = _RAW[tag].search(page, at)
            if tag not in _DROPPED:
                stack.append(Node(tag, m["attrs"], stack[-1] if stack else None))
                add(page[at:end.start()] if end else page[at:])
                flush()
                stack.pop()
            at = end.start() if end else size
            continue
        if tag in ENDS_P:
            close({"p"}, CONTAINERS)
        if tag in CLOSES:
            close(CLOSES[tag], CONTAINERS - CLOSES[tag])
        if tag not in VOID_TAGS and not m["attrs"].endswith("/"):
            stack.append(Node(tag, m["attrs"], stack[-1] if stack else None))
    flush()
    return out
