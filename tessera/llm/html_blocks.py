"""HTML pages as text blocks with the part of the page they stand in."""

from __future__ import annotations

import re
from html import unescape

#: Parts of a page in which a block can stand.
ARTICLE, MAIN, OPEN, BESIDE = 0, 1, 2, 3

# a < outside quotes ends what would be a tag, so that unclosed tags cost no second look at what follows them
_OTHER = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*>"
_MARKUP = re.compile(_OTHER + r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|(\Z|[\"']))", re.S)
_UNQUOTED = re.compile(_OTHER + r"|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Their content is no text of the page.
_RAW = frozenset("script style template noscript svg math textarea title iframe object canvas video audio".split())
#: Elements that hold no part of the article.
_SIDE = frozenset("head nav footer aside form menu dialog button select fieldset".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
                    "span strike strong sub sup time tt u var wbr".split())
#: An open one of these ends where its parent ends or another block begins.
_LOOSE = frozenset("p li dt dd td th tr option".split())
#: Words in class, id or role that mark an element beside the article.
_BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adbox|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|"
    r"modal|overlay|nav|navbar|navigation|menu|menubar|breadcrumbs?|pagination|pager|header|masthead|footer|sidebar|"
    r"aside|complementary|contentinfo|widget|comments?|disqus|respond|replies|share|sharing|social|related|"
    r"recommend\w*|newsletter|subscribe|signup|login|search|toolbar|skip)(?:$|[\s_-])", re.I)
#: Inside an article only these whole words of a class, id or role set a block element beside it.
_WHOLE = frozenset("ad ads adbox advert adverts advertisement advertisements adsense sponsor sponsored promo banner cookie "
                   "cookies consent notice notices popup modal overlay nav navbar navigation menu menubar breadcrumb "
                   "breadcrumbs pagination pager sidebar complementary contentinfo widget comment comments disqus respond "
                   "reply replies share sharing social related newsletter subscribe signup login search toolbar".split())
_COMMENT = re.compile(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies))(?:$|[\s_-])", re.I)


def _beside(name: str, attributes: str, inside: bool) -> bool:
    if name in _SIDE or (name == "header" and not inside):
        return True
    if name in ("html", "body", "main"):
        return False
    if "=" in attributes:
        named = [next(filter(None, m.groups()), "") for m in _NAMES.finditer(attributes)]
        if inside and name != "article":
            return any(w in _WHOLE for n in named for w in n.lower().split())
        rule = _COMMENT if name == "article" else _BESIDE
        return any(map(rule.search, named))
    return False


def blocks_of(html: str | None, beside: bool = False) -> list[tuple[int, str]]:
    """(part, text) of the page's blocks in order, without empty ones.

    Scripts, styles, comments, menus, page headers, footers, sidebars, forms
    and elements that their class, id or role sets beside the article are left
    out.  Inside an article or main element a class, id or role does so only by
    a whole word of it and only for block elements; an inline one keeps its text
    unless it is of a kind that holds none of the article.  Character references
    are decoded and white space becomes one space.  Broken markup is read as far
    as it goes, in time that grows with the page's length; a ``<`` that opens no
    tag is text, and after a tag whose quotes never close a quote is a character
    like others.

    With ``beside`` the text of menus, page headers, footers, sidebars, forms and
    other elements beside the article comes as blocks of the part BESIDE.
    """
    if not html:
        return []
    out: list[tuple[int, str]] = []
    text: list[str] = []
    side: list[str] = []
    articles = mains = 0
    skipped, depth = "", 0  # inside an element that is left out, and how deep

    def close_block() -> None:
        if text:
            if words := " ".join("".join(text).split()):
                out.append((ARTICLE if articles else MAIN if mains else OPEN, words))
            text.clear()

    def close_side() -> None:
        if side:
            if words := " ".join("".join(side).split()):
                out.append((BESIDE, words))
            side.clear()

    at, size, markup = 0, len(html), _MARKUP
    while at < size:
        m = markup.search(html, at)
        if m and markup is _MARKUP and m[4] is not None:  # ran to the end, or into a quote that does
            if m.end() < size or m[4]:
                markup = _UNQUOTED
                m = markup.search(html, at)
            else:
                m = None
        if not skipped or beside:
            piece = html[at:m.start() if m else size]
            if piece:
                (side if skipped else text).append(unescape(piece) if "&" in piece else piece)
        if not m:
            break
        at = m.end()
        if not (name := m[2]):
            continue
        name, closing = name.lower(), bool(m[1])
        if name in _RAW and not closing:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if skipped:
            if name == "br":
                side.append(" ")
            elif name not in _INLINE:
                close_side()
            if name in _VOID or m[3].endswith("/"):
                continue
            if skipped not in _LOOSE:  # ends at its own end tag
                depth += (name == skipped) * (-1 if closing else 1)
                if depth == 0:
                    skipped = ""
                continue
            if name in _INLINE:
                continue
            if depth > 1:  # inside a block of the loose element
                depth += (name not in _LOOSE) * (-1 if closing else 1)
                continue
            if not closing and skipped != "p" and name != skipped:
                depth += name not in _LOOSE
                continue
            skipped = ""
            if closing and name in _LOOSE:
                continue
        if name in _INLINE and (closing or articles or mains or not _beside(name, m[3], False)):
            continue
        if name == "br":
            text.append(" ")
            continue
        close_block()
        if closing:
            articles -= name == "article" and articles > 0
            mains -= name == "main" and mains > 0
        elif name not in _VOID and not m[3].endswith("/"):
            if _beside(name, m[3], bool(articles or mains)):
                skipped, depth = name, 1
            else:
                articles += name == "article"
                mains += name == "main"
    close_block()
    close_side()
    return out
