"""Main text of web pages by differencing each page with the one nearest by URL on its host.

Pages are sorted by host and path over the whole cluster, so a page's nearest neighbours stand beside it, whatever the
size of its host; partitions get the neighbours beyond their borders.  Copies pass over each other.  Lines that a page shares with its partner, aligned by longest common subsequence, go.  Two things
are known from the markup and hold whatever a partner says: what stands in navigation, adverts, forms and the like is
not text, and what stands in a marked article is, even where a neighbour repeats it.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import materialise, texts_of

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z|(?=<))|[^<]+|<", re.S)
_MARKS = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_HIDDEN_NAME = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)""", re.I)
_QUOTED = re.compile(r"""\"[^\"]*\"|'[^']*'""")

# Elements of HTML: no text of the page, no end tag, and the inline ones, which don't end a block.
_RAW = frozenset("script style noscript template textarea title svg math iframe object audio video canvas head".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_APART = frozenset("nav footer aside form button select menu dialog fieldset".split())
_ARTICLE = frozenset("article main".split())
# What a form of nothing but fields may hold beside inline elements.
_FIELDS = frozenset("input button select option optgroup datalist fieldset legend".split())
# Whole names in class, id and role of what isn't the article; those in _LOOSE_NAMES may be part of one.
_APART_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice
    notices alert popup modal overlay sidebar aside nav navbar navigation menu breadcrumb breadcrumbs footer masthead toolbar share
    sharing social related recommended comment comments reply replies respond disqus newsletter subscribe subscription signup login
    widget pagination pager skip search form complementary contentinfo""".split()
)
_LOOSE_NAMES = frozenset("notice notices alert reply replies respond form search skip widget".split())
_ARTICLE_NAMES = frozenset("articlebody".split())

NOISE, PLAIN, ARTICLE = 0, 1, 2
# What attributes may say besides.
_LOOSE, _UNSEEN = 3, 4


class _Element:
    """An open element that isn't inline: what its attributes say, and what stands in it."""

    __slots__ = ("name", "marked", "outer", "has_article", "has_blocks", "zone", "unseen")

    def __init__(self, name: str, marked: int | None, outer: _Element | None):
        self.name, self.marked, self.outer = name, marked, outer
        self.has_article = self.has_blocks = False

    def is_article(self) -> bool:
        return self.name == "main" or self.name in _ARTICLE and self.marked != NOISE or self.marked == ARTICLE

    def settle(self) -> None:
        """Its zone, once the whole page is read and its outer element is settled."""
        inside = self.outer.zone if self.outer else PLAIN
        whole = self.name in ("html", "body")
        self.unseen = bool(self.outer and self.outer.unseen) or self.marked == _UNSEEN and not whole
        if self.unseen:
            self.zone = NOISE
        elif self.is_article():
            self.zone = ARTICLE
        elif inside == NOISE or whole:
            self.zone = inside
        elif self.name in ("form", "fieldset"):
            strict = self.marked == NOISE and not self.has_article
            self.zone = NOISE if strict or not (self.has_article or self.has_blocks) else PLAIN
        elif self.name in _APART or self.name == "header" and inside != ARTICLE:
            self.zone = NOISE
        elif not self.has_article and (self.marked == NOISE or self.marked == _LOOSE and inside != ARTICLE):
            self.zone = NOISE
        else:
            self.zone = inside
#: Keys drawn per partition, and in all, to find the borders of partitions of about equal size.
SAMPLED_KEYS, MOST_KEYS = 20, 100_000


def blocks(page: str | None) -> list[tuple[int, str]]:
    """``(zone, text)`` of every block of text, in page order; white space is one space.

    Names in class, id and role make an element noise only as whole names, and neither the page as a whole nor what
    holds an article; an article in noise is one, unless hidden.  A form that holds more than fields is left to the
    differencing.
    """
    out: list[tuple[_Element | None, str]] = []
    held: list[str] = []
    stack: list[_Element] = []
    elements: list[_Element] = []
    here, skip = None, None

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((here, text))

    for match in _TOKEN.finditer(page or ""):
        name = match[2]
        if name is None:
            if skip is None and not match[0].startswith(("<!", "<?")):
                held.append(match[0])
            continue
        name, closing = name.lower(), bool(match[1])
        if skip is not None:
            if closing and name == skip or name == "body":
                skip = None
            if name != "body":
                continue
        if name in _RAW:
            if not closing and not match[3].rstrip().endswith("/"):
                skip = name
            if name not in ("svg", "math", "iframe", "object", "audio", "video", "canvas"):
                flush()
            continue
        if name == "br":
            held.append(" ")
            continue
        marked = _marked(match[3]) if match[3] else None
        if name in _INLINE and not closing and marked in (None, _LOOSE):
            continue
        if closing:
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name), None)
            if name not in _INLINE or at is not None:
                flush()
            if at is not None:
                del stack[at:]
        else:
            flush()
            if name == "p" and stack and stack[-1].name == "p":
                stack.pop()
            if name not in _VOID and not match[3].rstrip().endswith("/"):
                element = _Element(name, marked, stack[-1] if stack else None)
                for flag, holds in (("has_article", element.is_article()), ("has_blocks", name not in _FIELDS and name not in _INLINE)):
                    for x in reversed(stack) if holds else ():
                        if getattr(x, flag):  # so have all around it
                            break
                        setattr(x, flag, True)
                stack.append(element)
                elements.append(element)
        here = stack[-1] if stack else None
    flush()
    for element in elements:
        element.settle()
    return [(element.zone if element else PLAIN, text) for element, text in out]


def _marked(attributes: str) -> int | None:
    """What class, id, role or itemprop say about an element."""
    if _HIDDEN.search(attributes) or _HIDDEN_NAME.search(_QUOTED.sub("''", attributes)):
        return _UNSEEN
    names = {w for found in _MARKS.findall(attributes) for w in "".join(found).lower().split()}
    if names & _APART_NAMES:
        return NOISE if names & _APART_NAMES - _LOOSE_NAMES else _LOOSE
    return ARTICLE if names & _ARTICLE_NAMES else None


def shared(one: list[str], two: list[str]) -> set[int]:
    """Places in ``one`` of the lines of a longest common subsequence with ``two``.

    Lines are compared bit by bit in rows of whole integers, one per line of ``two``; equal beginnings and ends, and
    lines that only one side has, are set aside first.
    """
    low, high = 0, min(len(one), len(two))
    while low < high and one[low] == two[low]:
        low += 1
    end = 0
    while end < high - low and one[-1 - end] == two[-1 - end]:
        end += 1
    found = {*range(low), *range(len(one) - end, len(one))}
    left, right = set(one[low : len(one) - end]), set(two[low : len(two) - end])
    places = [k for k in range(low, len(one) - end) if one[k] in right]
    other = [x for x in two[low : len(two) - end] if x in left]
    masks: dict[str, int] = {}
    for bit, k in enumerate(places):
        masks[one[k]] = masks.get(one[k], 0) | 1 << bit
    full = (1 << len(places)) - 1
    row, rows = full, [full]
    for line in other:
        hit = row & masks[line]
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    i, j = len(places), len(other)
    while i and j:
        if rows[j] >> (i - 1) & 1:
            i -= 1
        elif not rows[j - 1] >> (i - 1) & 1:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found.add(places[i])
    return found


def main_text(own: list[tuple[int, str]], partner: list[str] | None) -> str:
    """The lines that stay beside the lines of ``partner``, joined by line ends."""
    gone = shared([text for _, text in own], partner) if partner else set()
    return "\n".join(text for k, (zone, text) in enumerate(own) if zone == ARTICLE or zone == PLAIN and k not in gone)


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[^/?#]*//([^/?#]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_replace(url, r"^[^/?#]*//[^/?#]*|[?#].*$", "")


def _near(path: str, other: str) -> int:
    """Length of the common beginning of two paths."""
    return next((k for k, (a, b) in enumerate(zip(path, other)) if a != b), min(len(path), len(other)))


def _pack(own: list[tuple[int, str]]) -> str:
    """Blocks as one text; no block holds a line end."""
    return "\n".join(f"{zone}{text}" for zone, text in own)


def _unpack(packed: str) -> list[tuple[int, str]]:
    return [(int(line[0]), line[1:]) for line in packed.split("\n")] if packed else []


def _sign(own: list[tuple[int, str]]) -> int | None:
    """Hash of what a page says outside of noise; none if that is nothing."""
    said = [text for zone, text in own if zone != NOISE]
    return xxhash.xxh3_64_intdigest("\n".join(said).encode("utf-8", "surrogatepass")) - 2**63 if said else None


def _strangers(ends: dict[int, dict], at: int, step: int) -> tuple | None:
    """The page nearest to partition ``at`` on the side of ``step`` that says something else than its outermost page.

    ``ends`` has the pages of each partition as ``(host, path, ident, sign)``: the first and the last one, and beside
    each the nearest one on its host that says something else.
    """
    edge, far = ("first", "last") if step < 0 else ("last", "first")
    host, sign = ends[at][edge][0], ends[at][edge][3]
    for k in sorted((k for k in ends if (k - at) * step > 0), reverse=step < 0):
        near = ends[k][far]
        if near[0] != host:
            return None
        if near[3] != sign:
            return near
        if ends[k][f"{far}_other"]:
            return ends[k][f"{far}_other"]
        if ends[k][edge][0] != host:
            return None
    return None


def _guests(places: DataFrame) -> dict[tuple, list[int]]:
    """Pages that partitions need from beyond their borders, two for each at most, and who needs them."""
    page = F.struct("host", "path", "key", "sign")
    ends = places.groupBy("part").agg(F.min(page).alias("first"), F.max(page).alias("last"))  # a row per partition

    def other(edge: str) -> Column:
        return F.when((F.col("host") == F.col(f"{edge}.host")) & (F.col("sign") != F.col(f"{edge}.sign")), page)

    found = places.join(F.broadcast(ends), "part").groupBy("part").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.min(other("first")).alias("first_other"), F.max(other("last")).alias("last_other")
    )
    ends = {r["part"]: {name: r[name] and tuple(r[name]) for name in ("first", "last", "first_other", "last_other")} for r in found.collect()}
    out: dict[tuple, list[int]] = {}
    for at in ends:
        for step in (-1, 1):
            if guest := _strangers(ends, at, step):
                out.setdefault(guest, []).append(at)
    return out


def extract_text(pages: DataFrame, ident: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(ident, url, text)`` of every page.

    Pages are ordered by host, path and ident.  The partner is the nearest page before or after on the same host that
    says something else, the one whose path has the longer beginning in common, the earlier one in a tie; so copies
    never are each other's partners, and pages without text are nobody's.  A page without a partner loses no line.
    Where partitions begin and end makes no difference: each gets the pages it needs from beyond its borders.  Null
    and empty pages have an empty text; null URLs form a host of their own.  Repeated rows and null idents give a row
    each; other columns are not read.
    """
    rows = pages.select(
        F.col(ident).cast("string").alias("ident"), F.col(url).alias("url"), _host(F.col(url)).alias("host"), _path(F.col(url)).alias("path"), F.col(page).alias("page")
    )
    rows = rows.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit("")), "key": F.coalesce("ident", F.lit(""))})
    conf = pages.sparkSession.conf
    parts = max(int(conf.get("spark.sql.shuffle.partitions")), int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or 1))
    keys = ("host", "path", "key")
    drawn = rows.select(*keys).orderBy(F.xxhash64(*keys), *keys).limit(min(SAMPLED_KEYS * parts, MOST_KEYS))
    drawn = sorted(tuple(r) for r in drawn.collect())
    borders = sorted({drawn[len(drawn) * k // parts] for k in range(1, parts)}) if drawn else []

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(*key, _sign(blocks(page)), bisect_right(borders, key)) for *key, page in batch.itertuples(index=False) for key in [tuple(key)]]
            out = [x for x in out if x[3] is not None]
            if out:
                yield pd.DataFrame(out, columns=["host", "path", "key", "sign", "part"])

    placed = rows.select(*keys, "page").mapInPandas(place, "host string, path string, key string, sign long, part int")
    guests = _guests(materialise(placed, "page-places"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for number, address, host, path, key, page in batch.itertuples(index=False):
                own = blocks(page)
                sign = _sign(own)
                row = (number, address, host, path, sign, _pack(own) if sign is not None else "")
                out.append((*row, bisect_right(borders, (host, path, key)), False))
                out += [(*row, part, True) for part in guests.get((host, path, key, sign), ())]
            frame = {name: texts_of(x[k] for x in out) for k, name in enumerate(("ident", "url", "host", "path"))}
            frame["sign"] = pd.array([x[4] for x in out], dtype="Int64")
            yield pd.DataFrame(frame | {"blocks": texts_of(x[5] for x in out), "part": [x[6] for x in out], "guest": [x[7] for x in out]})

    parsed = rows.select("ident", "url", "host", "path", "key", "page").mapInPandas(
        parse, "ident string, url string, host string, path string, sign long, blocks string, part int, guest boolean"
    )
    order = ["part", "host", "path", F.coalesce("ident", F.lit("")), "sign"]
    ordered = parsed.repartitionById(parts, F.col("part")).sortWithinPartitions(*order)
    texts = ordered.select("part", "host", "path", "sign", "guest", "ident", "url", "blocks").mapInPandas(_paired, "ident string, url string, text string")
    return texts.select(F.col("ident").cast(pages.schema[ident].dataType).alias(ident), F.col("url").alias(url), "text")


def _paired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of the ordered pages of partitions; pages beside each other that say the same wait for the next one."""
    before, run, here = None, [], None  # what says something else before the run; the run, and its (part, host, sign)

    def done(following: tuple | None) -> Iterator[tuple]:
        others = [(path, [text for _, text in _unpack(packed)]) for path, packed in (x for x in (before, following) if x)]
        texts: dict[tuple, str] = {}
        for path, guest, number, address, packed in run:
            if not guest:
                which = max(range(len(others)), key=lambda k: _near(path, others[k][0]), default=None)
                if (packed, which) not in texts:
                    texts[packed, which] = main_text(_unpack(packed), others[which][1] if which is not None else None)
                yield number, address, texts[packed, which]

    for batch in batches:
        out = []
        for part, host, path, sign, guest, number, address, packed in batch.itertuples(index=False):
            if not packed:
                out.append((number, address, ""))
                continue
            if here != (part, host, sign):
                same = here is not None and here[:2] == (part, host)
                for text in done((path, packed) if same else None):
                    out.append(text)
                    if len(out) >= 256:
                        yield _frame(out)
                        out = []
                before, run, here = (run[-1][0], run[-1][4]) if same else None, [], (part, host, sign)
            packed = run[-1][4] if run and run[-1][4] == packed else packed  # copies are held once
            run.append((path, guest, number, address, packed))
        if out:
            yield _frame(out)
    out = list(done(None))
    for at in range(0, len(out), 256):
        yield _frame(out[at : at + 256])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({name: texts_of(x[k] for x in rows) for k, name in enumerate(("ident", "url", "text"))})
