"""Main text of web pages by wrappers inferred per host.

A wrapper is a union-free regular expression over tags and text slots, kept as a tree: items that
are mandatory, optional or repeated, and text slots that are constant or variable. A page's token
stream becomes such an expression by folding neighbours (and groups of two or three) of equal form
into repeated items. Two expressions of a host are aligned item by item (longest common
subsequence of their keys at each level): what only one has becomes optional, equal neighbours that
the alignment brings together become repeated, slots of different text become variable.

The alignment is associative enough to be done in steps: each task merges its own pages per host,
then the partial wrappers are merged per (host, salt) and at last per host. A host with a third of
all pages so sends one small wrapper per task, never its pages.

A page is read against its host's wrapper. Boilerplate is what the wrapper or the markup marks as
such: navigation, headers and footers outside the article, asides, forms, adverts, notices,
comments, scripts, styles, and labels (slots outside headings and paragraphs whose text is the same
on most pages that have the element around them; a page with another text there keeps it). Whether
a frame holds the article is seen in the page itself, and else in the wrapper. Names are read as
whole: inside the article an element named after its subject (related-work, social-studies) stays.
Of an article's own header only the headings stay. Of the rest, the text in <article> counts;
without one, in <main>; without one, in an element named as content; without one, in the frame that
the wrapper shows to hold what differs from page to page; else all blocks but those that are mostly
links.

Defined edge cases: null html or markup without text gives the empty text; pages with a null or
odd url form one host of their own; unclosed and misnested tags are closed as browsers do for p,
li, dt, dd, tr, td, th and option; repeated pages and page_ids are extracted one by one; pages of
any length are read whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, written
from .op10_url_filter import host_of

SALTS = 64
#: Items of a wrapper's level that a reader looks through; longer levels are looked up by key. A wrapper
#: keeps every item, however many a level has.
MOST_ITEMS = 64
#: Pages with the element around it that are needed before a text may count as a label, and the
#: share of them that must show it.
LABEL_PAGES, LABEL_SHARE = 8, 0.8
#: Pages that a wrapper needs before it may name the frame of the article, and the share of the
#: varying text that the frame holds.
FRAME_PAGES, FRAME_SHARE = 3, 0.6
#: Texts counted per slot (a text's count falls short by at most the pages of other texts / (TEXTS + 1)).
TEXTS = 8
#: Levels that a wrapper describes; pages nested deeper are read whole, below by markup alone.
DEPTH = 60

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea)\b.*?(?:</\1\s*>|\Z)"
    # others are skipped up to their end; one that is never closed takes the text up to the next tag
    r"|<(noscript|template|title|svg|iframe|object|select|button)\b(?:(?:(?!<\2\b).)*?</\2\s*>|[^>]*(?:>[^<]*)?)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^<>\"'])*+)>"
    r"|<[!?][^>]*>", re.S | re.I)
TITLES = frozenset("h1 h2 h3 h4 h5 h6".split())
NAMES = re.compile(r"(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre "
    "section article main header footer nav aside form fieldset address figure figcaption details summary hr menu "
    "dialog head".split())
#: A start tag of the first kind ends open tags of the second, up to the third.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
ENDS |= {t: ({"p"}, {"td", "th", "li", "div", "article", "section", "main", "body"}) for t in BLOCK if t not in ENDS}

DROP_TAGS = frozenset("nav footer aside form head menu dialog fieldset".split())
DROP_NAMES = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs footer sidebar sidebars aside ad ads adv advert adverts "
    "advertisement advertising sponsor sponsored banner promo promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe signup login social share sharing related recommended comment "
    "comments commentlist disqus respond reply replies pagination pager widget widgets toolbar search form "
    "contentinfo complementary".split())
#: Words that may stand beside one of these in a name of boilerplate (as in site-footer, related-posts).
BESIDE = frozenset(
    "site page main global top bottom left right upper lower inner outer primary secondary box bar block list item items "
    "link links post posts article articles story stories news more wrap wrapper container content section area region "
    "zone slot unit space panel module body row col column title header text icon icons button buttons field fields "
    "group user buttonbar placeholder inline sticky fixed mobile desktop the of and for to by us".split())
HEADER_NAMES = frozenset("header masthead topbar".split())
CONTENT_NAMES = frozenset("content article post entry story articlebody maincontent".split())
FRAMES = frozenset("div section header hgroup".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre li td dd".split())

ARTICLE, MAIN, CONTENT, HEAD, FRAME, PLAIN = 1, 2, 4, 8, 16, 0
#: Stands in the key of an element whose names hold a boilerplate word beside other words.
KEPT = "*"

# an item: [key, repeated, optional, pages, characters, constant text's checksum or None, items,
#           pages by checksum of their text (None for elements)]
KEY, REPEATED, OPTIONAL, PAGES, CHARS, CONSTANT, ITEMS, SHOWN = range(8)

_named: dict[str, str] = {}
_wholly: dict[str, bool] = {}


def key_of(tag: str, attributes: str) -> str:
    """The tag with the words of its class, id, role and itemprop (without digits)."""
    low = attributes.lower()
    if "class" not in low and "id" not in low and "role" not in low and "itemprop" not in low:
        return tag
    known = _named.get(attributes)
    if known is None:
        words = [w for m in NAMES.findall(attributes) for w in PART.findall(CAMEL.sub(" ", "".join(m)).lower())]
        if len(_named) > 50_000:
            _named.clear()
        known = _named[attributes] = " ".join(sorted(set(words)))
    return f"{tag} {known}" if known else tag


def wholly_boilerplate(attributes: str) -> bool:
    """Whether a class, id or role is made of boilerplate words and words that stand beside them only:
    ``site-footer`` and ``related-posts`` are, ``related-work`` and ``social-studies`` are not."""
    known = _wholly.get(attributes)
    if known is None:
        names = [set(PART.findall(CAMEL.sub(" ", name).lower())) for m in NAMES.findall(attributes) for name in "".join(m).split()]
        if len(_wholly) > 50_000:
            _wholly.clear()
        known = _wholly[attributes] = any(words & DROP_NAMES and words <= DROP_NAMES | BESIDE for words in names)
    return known


def events(html: str) -> Iterator[tuple[str, str, str]]:
    """('text', raw, ''), ('open', tag, key) and ('close', tag, '') with implied ends made explicit."""
    stack: list[str] = []
    at = 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            yield "text", html[at:m.start()], ""
        at = m.end()
        tag = m[4]
        if tag is None:
            continue
        tag = tag.lower()
        if m[3]:
            if tag in stack:
                while True:
                    last = stack.pop()
                    yield "close", last, ""
                    if last == tag:
                        break
            continue
        if tag in VOID:
            yield "open", tag, tag
            yield "close", tag, ""
            continue
        if tag in ENDS:
            ended, upto = ENDS[tag]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] in ended:
                    for _ in range(len(stack) - k):
                        yield "close", stack.pop(), ""
                    if tag not in ("tr",):
                        break
                elif stack[k] in upto:
                    break
        stack.append(tag)
        key = key_of(tag, m[5])
        if " " in key and not DROP_NAMES.isdisjoint(key.split(" ")[1:]) and not wholly_boilerplate(m[5]):
            key = f"{key} {KEPT}"
        yield "open", tag, key
    if at < len(html):
        yield "text", html[at:], ""
    while stack:
        yield "close", stack.pop(), ""


def fold(items: list[list]) -> list[list]:
    """Neighbours of equal key become one repeated item, then groups of two and three do."""
    out: list[list] = []
    for item in items:
        if out and out[-1][KEY] == item[KEY]:
            merge(out[-1], item, same_page=True)
            out[-1][REPEATED] = 1
        else:
            out.append(item)
    for g in (2, 3):
        k = 0
        while k + 2 * g <= len(out):
            if all(out[k + x][KEY] == out[k + g + x][KEY] for x in range(g)):
                for x in range(g):
                    merge(out[k + x], out[k + g + x], same_page=True)
                    out[k + x][REPEATED] = 1
                del out[k + g:k + 2 * g]
            else:
                k += 1
    return out


def merge(a: list, b: list, same_page: bool = False) -> None:
    """Align item ``b`` into item ``a`` (of the same key)."""
    a[REPEATED] |= b[REPEATED]
    a[OPTIONAL] |= b[OPTIONAL]
    if a[SHOWN] is not None:
        a[SHOWN] = shown(a, b, same_page)
    a[PAGES] = max(a[PAGES], b[PAGES]) if same_page else a[PAGES] + b[PAGES]
    a[CHARS] += b[CHARS]
    if a[SHOWN] is not None:
        text, n = max(a[SHOWN].items(), key=lambda t: (t[1], t[0]), default=(None, 0))
        a[CONSTANT] = int(text) if n and n >= LABEL_SHARE * a[PAGES] else None
    x, y = a[ITEMS], b[ITEMS]
    if [i[KEY] for i in x] == [i[KEY] for i in y]:
        for p, q in zip(x, y, strict=True):
            merge(p, q, same_page)
    else:
        a[ITEMS] = align(x, y, same_page)


def shown(a: list, b: list, same_page: bool) -> dict[str, int]:
    """On how many pages a slot merged of two shows each text and no other, the most frequent ones."""
    x, y = a[SHOWN], b[SHOWN]
    if same_page:
        # neighbours on one page: a text counts where the other slot does not show a different one
        out = {t: max(x[t], y[t]) if t in x and t in y else x[t] - b[PAGES] if t in x else y[t] - a[PAGES] for t in x | y}
        return {t: n for t, n in out.items() if n > 0}
    out = {t: x.get(t, 0) + y.get(t, 0) for t in x | y}
    if len(out) > TEXTS:
        less = sorted(out.values(), reverse=True)[TEXTS]
        out = {t: n - less for t, n in out.items() if n > less}
    return out


def combined(a: list, b: list) -> list:
    """Two wrappers as one; a wrapper of no pages (null, empty or without any element or text) adds nothing."""
    if not a[PAGES]:
        return b
    if b[PAGES]:
        merge(a, b)
    return a


#: Cells of the alignment table beyond which rare keys are used as anchors.
CELLS = 40_000


def matches(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Pairs of places at which two sequences agree, rising in both: a longest common subsequence of
    short ones; of long ones what lies between anchors, keys that each side has once."""
    found, work = [], [(0, len(x), 0, len(y))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and x[a] == y[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and x[b - 1] == y[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        if (b - a) * (d - c) <= CELLS:
            found += [(a + i, c + j) for i, j in _common(x[a:b], y[c:d])]
            continue
        once = {k for k, n in Counter(x[a:b]).items() if n == 1} & {k for k, n in Counter(y[c:d]).items() if n == 1}
        place = {k: i for i, k in enumerate(y[c:d], c) if k in once}
        anchors = _rising([(i, place[k]) for i, k in enumerate(x[a:b], a) if k in once])
        if not anchors:
            found += _greedy(x, y, a, b, c, d)
            continue
        for i, j in [*anchors, (b, d)]:
            work.append((a, i, c, j))
            if i < b:
                found.append((i, j))
            a, c = i + 1, j + 1
    return sorted(found)


def _common(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    n, m = len(x), len(y)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if x[i] == y[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that rises in the second place too."""
    ends: list[int] = []
    last: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(ends, j)
        back[k] = last[at - 1] if at else -1
        ends[at:at + 1], last[at:at + 1] = [j], [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _greedy(x: list[str], y: list[str], a: int, b: int, c: int, d: int) -> list[tuple[int, int]]:
    """Each place of ``x`` with the next one of ``y`` that agrees, if that does not skip too much."""
    places: dict[str, list[int]] = {}
    for j in range(c, d):
        places.setdefault(y[j], []).append(j)
    out, most = [], max(64, (d - c) // max(1, b - a) * 64)
    for i in range(a, b):
        here = places.get(x[i], [])
        k = bisect_left(here, c)
        if k < len(here) and here[k] - c <= most:
            out.append((i, here[k]))
            c = here[k] + 1
    return out


def align(x: list[list], y: list[list], same_page: bool) -> list[list]:
    """The union-free expression of two sequences: common items mandatory, others optional."""
    out, i, j = [], 0, 0
    for p, q in [*matches([t[KEY] for t in x], [t[KEY] for t in y]), (len(x), len(y))]:
        for t in [*x[i:p], *y[j:q]]:
            t[OPTIONAL] = 1
            out.append(t)
        if p < len(x):
            merge(x[p], y[q], same_page)
            out.append(x[p])
        i, j = p + 1, q + 1
    return fold(out)


def checksum(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"))


def bare(item: list) -> list:
    """An item without the counts that only merging needs."""
    if item[SHOWN] is not None:
        item[SHOWN] = {}
    for child in item[ITEMS]:
        bare(child)
    return item


def holders(page: list[tuple[str, str, str]]) -> set[int]:
    """The events that open an element which is or holds an article or main that is not boilerplate."""
    found, stack = set(), []
    for k, (kind, value, key) in enumerate(page):
        if kind == "open":
            stack.append([k, value in ("article", "main") and DROP_NAMES.isdisjoint(key.split(" ")[1:])])
        elif kind == "close":
            at, held = stack.pop()
            if held:
                found.add(at)
                if stack:
                    stack[-1][1] = True
    return found


def expression(html: str) -> list:
    """A page's own expression: its folded tree."""
    root = ["", 0, 0, 1, 0, None, [], None]
    stack = [root]
    for kind, value, key in events(html):
        if kind == "text":
            if len(stack) <= DEPTH and (text := value.strip()):
                code = checksum(text)
                stack[-1][ITEMS].append(["#", 0, 0, 1, len(text), code, [], {str(code): 1}])
        elif kind == "open":
            stack.append([key, 0, 0, 1, 0, None, [], None])
        else:
            item = stack.pop()
            item[ITEMS] = fold(item[ITEMS])
            item[CHARS] = sum(t[CHARS] for t in item[ITEMS])
            if len(stack) <= DEPTH:
                stack[-1][ITEMS].append(item)
    root[ITEMS] = fold(root[ITEMS])
    if not root[ITEMS]:
        root[PAGES] = 0
    return root


class Reader:
    """A host's wrapper made ready for reading pages."""

    def __init__(self, wrapper: list | None):
        self.root = wrapper or ["", 0, 0, 0, 0, None, [], None]
        self.holds: dict[int, bool] = {}
        self.varies: dict[int, int] = {}
        self.places: dict[int, dict[str, list[int]]] = {}
        self._prepare(self.root)
        self.frame = self._frame()

    def _prepare(self, item: list) -> bool:
        tag, *names = item[KEY].split(" ")
        held = tag in ("article", "main") and DROP_NAMES.isdisjoint(names)
        if len(item[ITEMS]) > MOST_ITEMS:
            places = self.places[id(item)] = {}
            for k, child in enumerate(item[ITEMS]):
                places.setdefault(child[KEY], []).append(k)
        for child in item[ITEMS]:
            held |= self._prepare(child)
        self.holds[id(item)] = held
        # characters that differ from page to page, without links and what is boilerplate by its tag
        if item[SHOWN] is not None:
            self.varies[id(item)] = item[CHARS] if item[CONSTANT] is None else 0
        else:
            self.varies[id(item)] = 0 if tag == "a" or tag in DROP_TAGS or tag == "header" else sum(
                self.varies[id(child)] for child in item[ITEMS])
        return held

    def _frame(self) -> int | None:
        """The innermost element of the wrapper that holds most of what differs from page to page: the
        article of hosts whose markup does not name one."""
        item = self.root
        if item[PAGES] < FRAME_PAGES:
            return None
        while item[ITEMS]:
            best = max(item[ITEMS], key=lambda child: self.varies[id(child)])
            # a paragraph that is often the longest is a part of the article, not its frame
            if best[KEY].split(" ")[0] in HEADINGS or self.varies[id(best)] < FRAME_SHARE * self.varies[id(item)] or best[REPEATED]:
                break
            if best[SHOWN] is not None:
                break
            item = best
        return None if item is self.root else id(item)

    def _dropped(self, tag: str, key: str, inside: int, item: list | None, holds: bool) -> bool:
        if tag in DROP_TAGS:
            return True
        if tag == "header" and not inside & (ARTICLE | MAIN):
            return True
        if inside & HEAD and tag in BLOCK and tag not in TITLES and tag not in FRAMES:
            return True  # of an article's own header the titles stay
        if tag in ("html", "body", "article", "main") and "comment" not in key:
            return False
        names = set(key.split(" ")[1:])
        if not names:
            return False
        if holds or (item is not None and self.holds[id(item)]):
            return False  # it is the frame that holds the article, here or on other pages
        if KEPT in names and inside & (ARTICLE | MAIN):
            return False  # a part of the article that is named after its subject
        return bool(names & DROP_NAMES) or (bool(names & HEADER_NAMES) and not inside)

    @staticmethod
    def _label(block: str, around: list | None, item: list | None, text: str) -> bool:
        """The constant text of a slot that most pages with the element around it have, in a block that
        is no heading or paragraph."""
        return (item is not None and item[CONSTANT] is not None and block not in HEADINGS
                and around[PAGES] >= LABEL_PAGES and item[PAGES] >= LABEL_SHARE * around[PAGES]
                and item[CONSTANT] == checksum(text.strip()))

    def _next(self, item: list | None, cursor: int, key: str) -> tuple[list | None, int]:
        """The wrapper's item for a page's next token under ``item``."""
        if item is None:
            return None, cursor
        items = item[ITEMS]
        if len(items) > MOST_ITEMS:
            if not (found := self.places[id(item)].get(key)):
                return None, cursor
            at = bisect_left(found, cursor)
            k = found[at if at < len(found) else 0]
            return items[k], k
        for k in range(cursor, len(items)):
            if items[k][KEY] == key:
                return items[k], k
        for k in range(min(cursor, len(items))):
            if items[k][KEY] == key:
                return items[k], k
        return None, cursor

    def text(self, html: str) -> str:
        blocks: list[tuple[int, str, int]] = []  # container, text, characters of links
        parts: list[str] = []
        linked, where = 0, PLAIN
        # block, dropped, inside, wrapper's item, cursor, link
        stack: list[list] = [["", False, PLAIN, self.root, 0, False]]

        def flush() -> None:
            nonlocal linked
            if parts:
                if text := " ".join("".join(parts).split()):
                    blocks.append((where, text, linked))
                parts.clear()
            linked = 0

        page = list(events(html))
        holds = holders(page)
        for at, (kind, value, key) in enumerate(page):
            top = stack[-1]
            if kind == "text":
                if top[1] or (top[2] & HEAD and top[0] not in TITLES):
                    continue
                if not value.isspace():
                    item, top[4] = self._next(top[3], top[4], "#")
                    if self._label(top[0], top[3], item, value):
                        continue
                where = top[2]
                raw = unescape(value) if "&" in value else value
                parts.append(raw)
                if top[5]:
                    linked += len(raw)
            elif kind == "open":
                if value in BLOCK:
                    flush()
                elif value == "br":
                    parts.append(" ")
                item, top[4] = self._next(top[3], top[4], key)
                inside = top[2]
                dropped = top[1] or self._dropped(value, key, inside, item, at in holds)
                if value == "article":
                    inside |= ARTICLE
                elif item is not None and id(item) == self.frame:
                    inside |= FRAME
                elif value == "header" and inside & (ARTICLE | MAIN):
                    inside |= HEAD
                elif value == "main" or (" " in key and "main" in key.split(" ")[1:]):
                    inside |= MAIN
                elif value in BLOCK and " " in key and not CONTENT_NAMES.isdisjoint(key.split(" ")[1:]):
                    inside |= CONTENT
                stack.append([value if value in BLOCK else top[0], dropped, inside, item, 0, top[5] or value == "a"])
            else:
                if value in BLOCK:
                    flush()
                stack.pop()
        flush()
        for container in (ARTICLE, MAIN, CONTENT, FRAME):
            if chosen := [t for w, t, _ in blocks if w & container]:
                return "\n".join(chosen)
        return "\n".join(t for _, t, links in blocks if 2 * links <= len(t))


def _merged(wrappers: Iterator[str], last: bool) -> str:
    whole = None
    for w in wrappers:
        w = json.loads(w)
        whole = w if whole is None else combined(whole, w)
    return json.dumps(bare(whole) if last else whole, separators=(",", ":"))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) inferred from all pages."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            own: dict[str, list] = {}
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                found = expression(html or "")
                own[host] = combined(own[host], found) if host in own else found
            yield pa.RecordBatch.from_pydict({
                "host": pa.array(list(own), pa.string()),
                "wrapper": pa.array([json.dumps(w, separators=(",", ":")) for w in own.values()], pa.string())})

    def merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [key[0]], "wrapper": [_merged(iter(sorted(rows["wrapper"])), len(key) == 1)]})

    parts = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(partial, "host string, wrapper string")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    once = salted.groupBy("host", "salt").applyInPandas(merged, "host string, wrapper string")
    return once.groupBy("host").applyInPandas(merged, "host string, wrapper string")


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    known = written(wrappers(pages), "wrappers")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers: dict[str, Reader] = {}
        for batch in slices(batches, "html"):
            texts = []
            for html, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                reader = readers.get(wrapper)
                if reader is None:
                    if len(readers) > 1000:
                        readers.clear()
                    reader = readers[wrapper] = Reader(json.loads(wrapper))
                texts.append(reader.text(html or ""))
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html").join(known, "host")
    return rows.select("page_id", "url", "html", "wrapper").mapInArrow(
        extract, "page_id bigint, url string, text string, n_chars bigint")
