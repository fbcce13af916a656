"""Blocks of text of a web page, and what its markup says about them."""

from __future__ import annotations

import html
import re

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|math|select|iframe|object)(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes2>[^>]*)>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
#: The start of a tag.
BEGUN = re.compile(r"<[a-zA-Z/!?]")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements whose next sibling or parent's end closes them.
LOOSE = frozenset("p li dt dd tr td th option".split())
#: Never part of an article.
CHROME = frozenset("nav footer aside form button dialog menu head".split())
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HINTS = (
    "ad ads advert advertisement adverts adbox sponsor sponsored promo promotion banner nav navbar navigation menu sidebar footer cookie cookies"
    " consent notice notices alert popup modal overlay newsletter subscribe subscription share sharing social related recommended recommendations"
    " comment comments commentlist reply replies disqus respond breadcrumb breadcrumbs pagination pager widget masthead topbar login signup toolbar copyright legal"
)
HINTS = frozenset(_HINTS.split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
CONTENT = frozenset("articlebody".split())

#: What the markup says of a block: part of the marked article, chrome, hinted to be chrome, or nothing.
ARTICLE, DROPPED, HINTED, OPEN = range(4)
#: Inside an inline element that is chrome, or hinted to be: its text is no part of the block around it.
MUTED, HUSHED = -1, -2
#: While a page is read: inside an article proper (not only ``main``), in an article that a hint is on or around, and
#: hinted inside either of these. The second counts where the page has no text of the first, else it is hinted.
PROPER, WEAK, SIDE = range(4, 7)
#: What these names say of the whole page is no hint.
UNHINTED = frozenset("html body main".split())


def _kind(tag: str, attributes: str, inside: bool) -> int:
    if tag in CHROME or tag == "header" and not inside:
        return DROPPED
    if attributes and not attributes.isspace():
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
        if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
            return DROPPED
        role = found.get("role", "").lower()
        if role in ROLES:
            return DROPPED
        if found.get("itemprop", "").lower() in CONTENT:
            return PROPER
        if role == "main" and tag != "article":
            return ARTICLE
        names = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", found.get("class", "") + " " + found.get("id", "")).lower())
        if tag not in UNHINTED and not HINTS.isdisjoint(names):
            return WEAK if tag == "article" else HINTED
    return PROPER if tag == "article" else ARTICLE if tag == "main" else OPEN


def _inner(kind: int, own: int) -> int:
    """The kind of what stands in an element of kind ``own``, itself inside ``kind``."""
    if kind in (DROPPED, MUTED) or own == DROPPED:
        return MUTED if kind == MUTED else DROPPED  # what is dropped stays so
    if kind == SIDE:
        return SIDE
    if kind in (PROPER, WEAK):  # inside the article only chrome changes anything
        return SIDE if own in (HINTED, WEAK) else kind
    if kind in (HINTED, HUSHED):  # a marked article wins over a hint around it
        return ARTICLE if own == ARTICLE else WEAK if own in (PROPER, WEAK) else HINTED
    return kind if own == OPEN else own


def blocks(page: str) -> list[tuple[str, int]]:
    """The page's blocks in order: text, and what its markup says. Only non-empty blocks."""
    out: list[tuple[str, int]] = []
    text: list[str] = []
    # open elements that carry something: (tag, kind of the content)
    stack: list[tuple[str, int]] = []
    kind = block = OPEN

    def close() -> None:
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if words:
                out.append((words, block))

    # What follows the last ">" holds no whole tag; a tag that begins there is cut off with the page.
    edge, last = page.rfind(">") + 1, None
    for m in TOKEN.finditer(page[:edge]):
        last = m
        if m["text"]:
            if kind not in (MUTED, HUSHED):
                block = kind
                text.append(m["text"])
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue  # comments, raw elements, declarations
        if tag in INLINE:
            if m["end"] or m["end2"]:
                if stack and stack[-1][0] == tag:
                    stack.pop()
                    kind = stack[-1][1] if stack else OPEN
            else:
                own = _kind(tag, m["attributes"] or m["attributes2"] or "", kind in (ARTICLE, PROPER, WEAK))
                if own == DROPPED and kind not in (DROPPED, MUTED) or own == HINTED and kind in (PROPER, WEAK):
                    stack.append((tag, MUTED))
                    kind = MUTED
                elif own == HINTED and kind in (ARTICLE, OPEN):
                    stack.append((tag, HUSHED))
                    kind = HUSHED
                elif stack and stack[-1] in ((tag, MUTED), (tag, HUSHED)):
                    stack.append(stack[-1])
            continue
        close()
        if tag in VOID:
            continue
        if m["end"] or m["end2"]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if at is not None:
                del stack[at:]
        else:
            if tag in LOOSE:
                # an open paragraph or item ends here
                if stack and stack[-1][0] == tag:
                    stack.pop()
            kind = stack[-1][1] if stack else OPEN
            own = _kind(tag, m["attributes"] or m["attributes2"] or "", kind in (ARTICLE, PROPER, WEAK))
            if tag not in LOOSE or own != OPEN:
                stack.append((tag, _inner(kind, own)))
        kind = stack[-1][1] if stack else OPEN
    if last and last["raw"]:
        whole = re.search(rf"</{last['raw']}\s*>\Z", last[0], re.I)
    else:
        whole = not last or not last[0].startswith("<!--") or last[0].endswith("-->")
    if whole and kind not in (MUTED, HUSHED):
        block = kind
        text.append(BEGUN.split(page[edge:], maxsplit=1)[0])
    close()
    weak = HINTED if any(k == PROPER for _, k in out) else ARTICLE
    final = {PROPER: ARTICLE, WEAK: weak, SIDE: HINTED}
    return [(words, final.get(k, k)) for words, k in out]


def article(found: list[tuple[str, int]], boilerplate: frozenset[int] | set[int], hinted: bool = False) -> str:
    """The page's text: the marked article, else the open (and ``hinted``) blocks, that are not boilerplate (by number).

    An article that is nothing but boilerplate stays.
    """
    if marked := [text for text, kind in found if kind == ARTICLE]:
        return "\n".join([text for i, (text, kind) in enumerate(found) if kind == ARTICLE and i not in boilerplate] or marked)
    kinds = (OPEN, HINTED) if hinted else (OPEN,)
    return "\n".join(text for i, (text, kind) in enumerate(found) if kind in kinds and i not in boilerplate)
