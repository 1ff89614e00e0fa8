"""Operator 9: the main text of web pages from flat text blocks.

A page is read once, left to right, into flat blocks: the text between two
block-level tags. A block knows its words, the share of them inside links, the
kind of its tag, and the innermost container around it that says what it is for
(an article, or a menu, footer, advert, form, ...). A decision tree over these
figures of the block and of its two neighbours keeps or drops it. The tree is
grown here (Gini impurity) from the blocks of the labelled page layouts ``LAYOUTS``,
with and without article markup. Elements that HTML lets a page leave open (``p``,
``li``, ``td``, ``dd``, ...) end where the next one starts.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from slotwise.llm.common import arrow_map, quoted

# Element names of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
HIDDEN_TAGS = frozenset("script style noscript template svg iframe object textarea select head title annotation annotation-xml canvas".split())
RAW_TEXT = frozenset("script style textarea title iframe noscript".split())
VOID_TAGS = frozenset("area base basefont bgsound br col embed frame hr img input link meta param source track wbr".split())
HEAD_TAGS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())  # any other ends <head>
MAIN_TAGS = frozenset(("article", "main"))
SIDE_TAGS = frozenset("nav aside footer form menu dialog button fieldset".split())
CONTAINERS = frozenset("div section ul ol table header p span li td th dl dd dt figure details center".split()) | MAIN_TAGS | SIDE_TAGS
# An open element of the first kind ends where one of the others starts, unless a barrier was opened since.
ENDS_P = BLOCK_TAGS - frozenset("button caption legend option tbody td tfoot th thead tr body head html title".split())
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th"), "tbody": ("td", "th"), "tfoot": ("td", "th")}
BARRIERS = {"p": frozenset(("button", "td", "th", "table")), "li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)), "td": frozenset(("table",)), "th": frozenset(("table",))}

# Words in class, id or role that say what a container is for.
SIDE_NAME = re.compile(
    r"(?:^|[\s_-])(?:nav\w*|menu\w*|breadcrumbs?|foot\w*|head|header|masthead|side\w*|cookies?|consent|notices?|alert|banner|popup|modal|overlay|"
    r"ads?|adv\w*|adbox|promo\w*|sponsor\w*|comments?|repl(?:y|ies)|respond|disqus|discussion|reactions?|form|login|signup|search\w*|"
    r"subscri\w*|newsletter|share|sharing|social|related|recommend\w*|widget\w*|tags?|pager|pagination|toolbar|copyright|legal|disclaimer|"
    r"dialog|complementary|contentinfo|navigation)(?=$|[\s_-])",
    re.I,
)
# What holds no part of the article even if it is marked as one: reader comments, and cards that lead elsewhere.
HARD_TAGS = frozenset("nav aside footer".split())
HARD_NAME = re.compile(r"(?:comments?|repl(?:y|ies)|disqus|related|recommend\w*)(?:[_-](?!open|clos|on$|off$|enabled|disabled|count|allowed)\S*)?", re.I)
# Words of notices that stand before or behind the text of many pages.
NOTICE = re.compile(
    r"\b(?:cookies?|consent|privacy policy|newsletter|subscribe|sign (?:up|in)|log ?in|all rights reserved|copyright|advertisements?|sponsored|"
    r"terms of (?:use|service)|share (?:this|on))\b|©",
    re.I,
)
NOTICE_WORDS = 45
MAIN_NAME = re.compile(r"(?:^|[\s_-])(?:article\w*|main|entry|post|story|content|body-?text|text-?body)(?=$|[\s_-])", re.I)

# No branch runs past the next "<" by more than a bounded quoted value, so broken markup costs linear time.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*>?"
    r"|<(/?)([A-Za-z][^\s/<>]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*'|\"[^\"]{0,1000}\"|'[^']{0,1000}'|[\"'])*+)>"
    r"|</?[A-Za-z][^<>]*\Z|<",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# "no-sidebar" or "with-comments" says what is beside the element, or not; the header of an article holds its title
_BESIDE = re.compile(r"(?:^|[_-])(?:no|not|with|without|has|have)[_-].*", re.I)
_OWN_HEADER = re.compile(r"(?<![a-z])(?:head|header|masthead)(?![a-z])", re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_MAY_HIDE = re.compile(r"hidden|none", re.I)
_HIDE = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)

NEUTRAL, MAIN, SIDE, HARD = 0, 1, -1, -2


class Block:
    __slots__ = ("text", "words", "linked", "role", "tag", "notice")

    def __init__(self, text: str, linked: int, role: int, tag: str):
        self.text, self.role, self.tag = text, max(role, SIDE), tag
        self.words = len(text.split(" "))
        self.linked = min(linked, self.words)
        self.notice = self.role == NEUTRAL and self.words <= NOTICE_WORDS and NOTICE.search(text) is not None


def hides(attributes: str) -> bool:
    """Whether the element is hidden by its ``hidden``, ``aria-hidden`` or ``style`` attribute."""
    if not _MAY_HIDE.search(attributes):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if name == "hidden" and value.lower() != "false" or name == "aria-hidden" and value.strip().lower() == "true":
            return True
        if name == "style" and _HIDE.search(value):
            return True
    return False


def role_of(tag: str, attributes: str, inside: int) -> int:
    """What a container is for, given what holds it; ``NEUTRAL`` if it does not say.

    Nothing inside a ``HARD`` side is main text. Elsewhere an article is, in whatever
    form or wrapper it stands, unless its own names say that it is a comment or a card.
    """
    if inside == HARD or tag in HARD_TAGS:
        return HARD
    names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if "=" in attributes else ""
    words = [w for w in (_BESIDE.sub("", n) for n in names.split()) if w]
    if any(HARD_NAME.fullmatch(w) for w in words):
        return HARD
    if tag in MAIN_TAGS:
        return MAIN
    if tag in SIDE_TAGS or (tag == "header" and inside != MAIN):
        return SIDE
    if inside == MAIN:
        words = [_OWN_HEADER.sub("", w) for w in words]
    main, side = [w for w in words if MAIN_NAME.search(w)], [w for w in words if SIDE_NAME.search(w)]
    # a compound such as "tag-news" beside a plain "post" does not make the post a side
    plain = any(all(SIDE_NAME.fullmatch(part) for part in re.split("[_-]+", w)) for w in side)
    if not plain and any(w not in side for w in main):
        return MAIN
    return SIDE if side else MAIN if main else NEUTRAL


def blocks(page: str) -> list[Block]:
    """The page's non-empty text blocks in order; comments, hidden elements and markup leave no text."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # container tag, the role and hiding outside it
    standing: Counter = Counter()  # how often each tag stands in the stack
    role, hidden, links, tag = NEUTRAL, False, 0, "p"

    def close_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, len(html.unescape("".join(linked)).split()), role, tag))
            parts.clear()
            linked.clear()

    def leave(k: int) -> None:
        """End the ``k``-th container and all inside it."""
        nonlocal role, hidden
        close_block()
        _, role, hidden = stack[k]
        for name, _, _ in stack[k:]:
            standing[name] -= 1
        del stack[k:]

    def end_open(ended: tuple[str, ...]) -> None:
        """End the innermost of the named elements, if no barrier was opened inside it."""
        if not any(standing[name] for name in ended):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in ended:
                leave(k)
                return
            if stack[k][0] in BARRIERS[ended[0]] or stack[k][0] in CLOSED:
                return

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else end]
        if stack and stack[-1][0] == "head" and text.strip():
            leave(len(stack) - 1)
        if text and not hidden:
            parts.append(text)
            if links:
                linked.append(text)
        if not m:
            break
        at = m.end()
        closing, name, attributes = m.group(1), m.group(2), m.group(3) or ""
        if name is None:
            if m.group() == "<":
                if not hidden:
                    parts.append("<")
            elif m.group().startswith("<![CDATA[") and not hidden:
                parts.append(html.escape(m.group()[9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if stack and stack[-1][0] == "head" and not closing and name not in HEAD_TAGS:
            leave(len(stack) - 1)
        if name in RAW_TEXT and not closing:  # what it holds is no markup
            stop = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end
            if name in BLOCK_TAGS:
                close_block()
            continue
        if name in ("br", "hr", "wbr", "img", "input"):
            if not hidden and name != "wbr":
                parts.append(" ")
            if name == "hr":
                close_block()
            continue
        if name in VOID_TAGS:
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        if not closing:
            if name in ENDS_P:
                end_open(("p",))
            if name in ENDED_BY:
                end_open(ENDED_BY[name])
        if name in BLOCK_TAGS:
            close_block()
            links = 0
            tag = name if not closing else "p"
        hiding = name in HIDDEN_TAGS or bool(attributes and hides(attributes))
        if hiding or name in CONTAINERS or (hidden and standing[name]):
            if not closing:
                if attributes.endswith("/") or (name == "p" and not attributes):
                    continue
                own = role_of(name, attributes, role)
                gone = hidden or hiding
                if own == MAIN:
                    gone = hiding
                if gone != hidden:
                    close_block()
                stack.append((name, role, hidden))
                standing[name] += 1
                role, hidden = own or role, gone
            elif standing[name]:
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                leave(k)
    close_block()
    return out


# Containers whose content cannot end an element that was open outside them.
CLOSED = frozenset("div section article main aside nav header footer form table ul ol dl details figure dialog fieldset".split())


# --- the tree ----------------------------------------------------------------------------

FEATURES = (
    "role", "unlinked", "words", "link_density", "notice", "heading", "listed", "prev_unlinked", "prev_link_density", "next_unlinked",
    "next_link_density", "has_main",
)
LONG = 20


def figures(found: list[Block]) -> list[tuple]:
    """``FEATURES`` of each block; beyond the page's ends stand empty neighbours.

    A block is a notice only before the first or behind the last long block that is none.
    """
    free = [b.words - b.linked for b in found]
    dense = [b.linked / b.words for b in found]
    has_main = int(any(b.role == MAIN for b in found))
    long = [i for i, b in enumerate(found) if free[i] >= LONG and b.role != SIDE and not b.notice]
    first, last = (long[0], long[-1]) if long else (len(found), -1)
    out = []
    for i, b in enumerate(found):
        before = (free[i - 1], dense[i - 1]) if i else (0, 0.0)
        after = (free[i + 1], dense[i + 1]) if i + 1 < len(found) else (0, 0.0)
        notice = int(b.notice and not first < i < last)
        out.append((b.role, free[i], b.words, dense[i], notice, int(b.tag[0] == "h"), int(b.tag in ("li", "dd", "dt", "td", "th", "option")), *before, *after, has_main))
    return out


# Labelled layouts, written by hand after common kinds of pages. A block reads ``<role><tag><words>[/<linked words>][!]<label>``:
# role m (inside an article), s (inside a side container) or n (no container says), ! for a notice, label + for main text.
LAYOUTS = (
    # article pages
    "sli1/1- sli2/2- sp9- mh8+ mp40+ mp60/6+ mp1+ mp30+ sp12- sp4/4-",
    "sli1/1- sli1/1- mh9+ mp3+ mli2+ mli5/2+ mli90/27+ mp12/12+ mp50+ sh5- sp80- sp40/8- sp3- np6/5-",
    "np14!- sli3/3- mh1+ mp2+ mp200+ np5- sp60- sp9/1- np8-",
    "nh4- nli2/2- nli2/2- mh6+ mp7+ mp6/6+ mp70+ np9- sp25- np7!- np3-",
    "np2/2- mp200+ np12/10- sli9- np4-",
    "mp3+ mp4+ mh2+ mp6/3+ sp30- np8- np10-",
    "np65+ mh7+ mp30+ np28+ sp22- np22+ np9-",
    "ntd24+ mp5+ ntd40/2+ np120+ np5-",
    # plain pages: paragraphs straight in the body or in containers that say nothing
    "np65+ np65+ np65+",
    "np20+ np21+ np20+ np200+",
    "nh5+ np65+ np65+ np1+",
    "nh3+ np30+ np30+ np2+ np30+ np4+ np30+",
    "ndiv65+ ndiv65+ ndiv65+ ndiv65+",
    "ntd65+ ntd22+ ntd30+ ntd65+",
    "nli25+ nli40+ nli20+ nli33/3+",
    "np40/4+ np22/5+ np65/10+ np90/20+",
    "np12+ np65+ np7+ np65+ np12+",
    "np3+", "np1+", "np9+", "np12+ np14+", "np5+ np6+ np7+", "nh4+ np8+ np9+ np6+", "nh2+ np20+", "np200+",
    "nh6+ np10+ np15+ np9+ np16+ np12+",
    "nh8+ np3+ np65+ nh4+ np30+ nh5+ np22+",
    # the same with menus, links and footers around them
    "nli1/1- nli1/1- nli2/2- nh7+ np65+ np40/3+ np65+ np3/3- np2/2-",
    "np2/2- np3/3- np2/2- np65+ np20+ np25+ np30+ nli2/2- nli3/3-",
    "ndiv6/6- ndiv65+ ndiv24+ ndiv8/7- ndiv12/10-",
    "ntd3/3- ntd2/2- ntd4/4- ntd120+ ntd25+ ntd3/3- ntd9/8-",
    "nli2/2- nli2/2- nli2/2- np65+ nli2/2- nli2/2- np24+ nli1/1- nli1/1-",
    "nh3- nli3/3- nli4/4- nli2/2- nh5+ np22+ np65+ nh3- nli8/8- nli9/9-",
    "np4/4- nh6+ np45+ np6+ np45+ np5- np3/3- np6/6-",
    "nli1/1- np3- nli1/1- nli2/2- np2- nli1/1-",
    "np2- np1/1- np3- np2/2- np2- np4/4-",
    "nli4- nli3/3- nli3- nli3/3- nli5- nli2/2-",
    "np8/5- np5/5- np40/32- np15/13- np6/5- np9/8- np30/24- np60/50-",
    "np25/20- np22/22- np35/30- np28+ np24/24- np21/21-",
    "nh5- np2/2- np3/3- nh4- np5/5- np2/2-",
    "sli1/1- sli2/2- np65+ np22+ sp30- sp65- np40+ sp8-",
    "sp60- np30+ sp60- np25+ sh4- np20+ sp20-",
    "sli30- sli25- sp200- sh7- sp60- sp1/1- sp3- sp65-",
    "sp9- np65+ sp12- nh4+ np22+ np4+ np22+ sp65-",
    # notices before and behind the text
    "np18!- nh6+ np65+ np30+ np8!- np12!-",
    "np30!- np4/4- np65+ np40+ np22!- np5!-",
    "np44!- nh5+ np22+ np65+ np35!- np2/2-",
    "np9!- np12!- np25!- np30!-",
    "nli2/2- np24!- np65+ np21!-",
    "nh5!- np20!- np24+ np28+ nli10!- nli6!-",
)
_CODE = re.compile(r"([msn])([a-z]+)(\d+)(?:/(\d+))?(!?)([+-])")


#: Where the figures of the neighbours and of the page begin in ``FEATURES``.
_AROUND = FEATURES.index("prev_unlinked")


def labelled() -> list[tuple]:
    """``FEATURES`` and the label of every block of ``LAYOUTS``, and of some blocks in the surroundings of others.

    What stands in an article or in a side, a long block without links and a block of
    links are what they are wherever they stand: these are learned with the neighbours
    of every other block too. Labels of short blocks that no container explains
    depend on the neighbours, so they are learned as they stand.
    """
    rows = []
    for layout in LAYOUTS:
        found, labels = [], []
        for role, tag, words, linked, notice, label in (_CODE.fullmatch(code).groups() for code in layout.split()):
            block = Block(" ".join(["w"] * int(words)), int(linked or 0), {"m": MAIN, "s": SIDE, "n": NEUTRAL}[role], tag)
            block.notice = bool(notice)
            found.append(block)
            labels.append(int(label == "+"))
        rows += [(*x, y) for x, y in zip(figures(found), labels)]
    around = sorted({r[_AROUND:-1] for r in rows})
    fixed = sorted({(r[:_AROUND], r[-1]) for r in rows if r[0] != NEUTRAL or (r[1] >= LONG or r[3] > 0.6) and not r[4]})
    return rows + [(*own, *them, y) for own, y in fixed for them in around]


def grow(rows: list[tuple], depth: int = 14):
    """A tree ``(feature, threshold, low, high)`` or a leaf 0 / 1 by Gini impurity; ties keep the earliest split."""
    return _grow(np.array(rows, dtype=float), depth)


def _grow(table: np.ndarray, depth: int):
    labels = table[:, -1]
    n, good = len(labels), labels.sum()
    if not depth or good in (0, n):
        return int(2 * good >= n)
    best = None
    for f in range(table.shape[1] - 1):
        order = np.argsort(table[:, f], kind="stable")
        value, below = table[order, f], np.cumsum(labels[order])
        at = np.flatnonzero(value[1:] > value[:-1])  # cuts behind these rows
        if not len(at):
            continue
        low, hit = at + 1.0, below[at]
        cost = hit * (low - hit) / low + (good - hit) * (n - low - good + hit) / (n - low)
        k = int(cost.argmin())
        if best is None or cost[k] < best[0] - 1e-9:
            best = (cost[k], f, float(value[at[k]] + value[at[k] + 1]) / 2)
    if best is None:
        return int(2 * good >= n)
    low_side = table[:, best[1]] <= best[2]
    return (best[1], best[2], _grow(table[low_side], depth - 1), _grow(table[~low_side], depth - 1))


@lru_cache(maxsize=1)
def tree():
    return grow(labelled())


def keep(node, x: tuple) -> int:
    while isinstance(node, tuple):
        node = node[2] if x[node[0]] <= node[1] else node[3]
    return node


def main_text(page: str, node=None) -> str:
    """The kept blocks in page order, joined by newlines; empty if none is kept."""
    found = blocks(page)
    node = tree() if node is None else node
    return "\n".join(b.text for b, x in zip(found, figures(found)) if keep(node, x))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: its id, url, ``text`` and ``n_chars`` (code points).

    Null and empty pages have the empty text. Broken markup never fails: an
    unclosed element lasts to the page's end or to its parent's close. Repeated
    rows give repeated results; other columns are ignored.
    """

    node = tree()  # grown once, here; tasks get the finished tree

    def make():
        def each(cols: dict) -> dict:
            texts = [main_text(p or "", node) for p in cols["html"]]
            return {"id": cols["id"], "url": cols["url"], "text": texts, "n_chars": [len(t) for t in texts]}

        return each

    read = pages.select(quoted(id_col).cast("bigint").alias("id"), quoted(url_col).alias("url"), quoted(html_col).alias("html"))
    out = arrow_map(read, "id bigint, url string, text string, n_chars bigint", make)
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
