"""Leaf blocks of a web page with their ancestors, and the features by which they are told apart."""

from __future__ import annotations

import html
import math
import re
from typing import NamedTuple

# Element names of HTML.
_RAW = frozenset("script style template textarea iframe title svg".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img br input object "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover "
    "munderover mmultiscripts mtable mtr mtd maction semantics annotation annotation-xml".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
} | {k: {"p"} for k in (
    "div ul ol dl table form section article aside nav header footer main h1 h2 h3 h4 h5 h6 pre blockquote figure hr fieldset address".split()
)}
_SCOPES = frozenset("ul ol dl table div section article aside nav header footer main body form td th blockquote".split())
# A quote opens a value only behind an equals sign; anywhere else it is an ordinary character, and ``>`` ends the tag.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?--!?>|.*\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]*)|[^>=])*)(>|\Z)", re.S
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_MAIN = re.compile(r"\bdata-main\b")
_PARTS = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    tag: str
    path: tuple[str, ...]
    linked: int
    main: bool


def blocks(page: str | None) -> list[Block]:
    """The texts between block-level tags, in page order, white space reduced to one blank, references decoded.

    Scripts, styles, comments, graphics and what is filled in or shown elsewhere (text areas, frames, templates, the title) have
    no text; formulas and the contents of object and noscript have. Unclosed and stray tags are put up with: a new
    paragraph ends an open one, an end tag ends what is open inside its element, an unfinished tag at the
    end of the page is left out.
    """
    out: list[Block] = []
    page = page or ""
    # Name, name parts of class, id and role, and whether the element is marked as main text.
    stack: list[tuple[str, tuple[str, ...], bool]] = []
    parts: list[str] = []
    linked, links, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            path = tuple(n for name, names, _ in stack for n in (name, *names))
            out.append(Block(text, stack[-1][0] if stack else "", path, linked, any(m for *_, m in stack)))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if links:
            linked += len(text)

    size = len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        end, name, rest = found.group(1), (found.group(2) or "").lower(), found.group(3) or ""
        if not name or not found.group(4):
            continue
        if name in _RAW and not end:
            # A slash closes only what is foreign to HTML.
            if name != "svg" or not rest.endswith("/"):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = close.end() if close else size
            continue
        if name in _INLINE:
            if name == "a":
                links = 0 if end else 1
            elif name == "br":
                parts.append(" ")
            continue
        flush()
        if end:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        closes = _CLOSES.get(name, ())
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in closes:
                del stack[k:]
                break
            if stack[k][0] in _SCOPES:
                break
        if name not in _VOID:
            names = " ".join("".join(m) for m in _NAMES.findall(rest)).lower()
            stack.append((name, tuple(f".{p}" for p in _PARTS.findall(names)), bool(_MAIN.search(rest))))
            links = 0
    flush()
    return out


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features of each block: ancestors, class names, own tag, length, links, marks and place."""
    out = []
    for k, b in enumerate(page):
        words = b.text.split()
        share = b.linked / max(1, len(b.text))
        found = {f"in:{p}" for p in b.path}
        found |= {
            "any", f"tag:{b.tag}", f"words:{min(7, int(math.log2(len(words) + 1)))}", f"links:{min(3, int(share * 4))}",
            f"stop:{b.text[-1] in '.!?…:'}", f"stops:{min(3, sum(w[-1] in '.!?' for w in words))}",
            f"sign:{bool(re.search('[©|»›•]|[0-9]{4}', b.text))}", f"first:{k == 0}", f"last:{k == len(page) - 1}",
        }
        out.append(sorted(found))
    return out
