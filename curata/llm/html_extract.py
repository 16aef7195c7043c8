"""Main text of web pages by template deduction over equivalence classes of tokens.

A page is a sequence of tokens: start tags, told apart by their path of elements
and classes, and blocks of text, told apart by path and text. Over the pages of a
host each token has an occurrence vector, its number in each page. Tokens with the
same vector form an equivalence class; classes with enough support are valid.

1. Vectors are compared by three hashes that add up (sums of the number times 31 bits
   of the page's hash), so a host of any size is aggregated in parts, no task holds a
   host, and repeated pages don't cancel.
2. The classes whose tags occur once in a page make the skeleton of the host's
   template. The other valid classes nest in it: each in the slot of the nearest
   skeleton element around it, by the path. A text in the class of its own element
   is template text (what always stands there), unless all pages that have it are
   copies of one page, told by their longest other block.
3. What the template text leaves of a slot is its variable text. The main slot is the
   one with the most of it over all pages of the host, each page's blocks counted by
   their shares of the page, and weighed by names: elements that mark an article
   count more, menus, adverts and the like next to nothing. It
   is widened to the element around it that marks the article, or else to the one
   that holds nearly all variable text.
4. The text of a page is what remains in its main slot: the blocks there, without
   template text and without inner elements for menus, forms, sidebars and the like.

A page that lacks its host's main slot, or whose host has fewer than ``LEAST_PAGES``
pages, is its own template: the slots are its elements that occur once.

A null html counts as empty and gives an empty text, and a null URL belongs to the
empty host. Repeated rows are extracted alike; an empty table gives no rows.
``text`` and ``n_chars`` take the place of columns of these names; other columns
pass through. Pages of any length and depth take time in proportion to their size.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import column_blocks, table, written
from curata.llm.url_filter import host_of

#: A class is valid if its tokens are in so many pages of the host, and in this share of them.
LEAST_PAGES, LEAST_SHARE = 3, 0.5
#: Templates of at most so many bytes together are broadcast; else they are joined by host.
BROADCAST_BYTES = 16_000_000
#: Tokens that a task gathers before it hands on their sums.
TASK_TOKENS = 100_000
#: Weights of variable text by what surrounds it, the share of a page that a mark of the article counts besides (in a template, in a page alone: there it decides), and the share that the main slot shall hold.
MARKED, PLAIN, ASIDE = 4.0, 1.0, 0.05
MARK_SHARE, MARK_ALONE, COVER = 0.05, 0.3, 0.8
#: What the blocks of a page count together.
PAGE_SHARE = 1_000_000

# Elements of HTML by what they do to text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul head title".split()
)
CLOSES_P = BLOCK - set("body button caption dd dt head html legend li optgroup option tbody td tfoot th thead title tr".split())
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr",)}
LISTS = ("ul", "ol", "dl", "table", "select")
RAW = set("script style xmp noembed noframes".split())
NEVER = set("head title noscript template svg math select option textarea button iframe object canvas audio video".split())
DROPPED = NEVER | set("nav footer aside form dialog menu label input".split())
DROPPED_NAMES = set(
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar sidenav aside footer masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert popup modal overlay comment comments disqus respond reply replies share sharing social related recommended newsletter subscribe subscription signup login search widget pagination pager copyright skip".split()
)
#: Parts of a name that say nothing by themselves: a name of these and a dropped one is dropped.
PLAIN_NAMES = set("area bar block body bottom box btn button buttons container content form group header head icons inner item items left link links list main media panel post posts primary right row secondary section site slot text title top unit us wrap wrapper".split())
DROPPED_ROLES = set("navigation banner contentinfo complementary search form menu menubar alert dialog toolbar".split())
MAIN_NAMES = set("article content main post entry story maincontent main-content article-body post-content entry-content article-content post-body story-body".split())

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
QUOTE = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NO_MARK = 9
PAGE, ELEMENT, TEXT = 0, 1, 2


def digest(*parts: str | int) -> int:
    """A signed 64-bit number."""
    x = xxhash.xxh64_intdigest("\x00".join(map(str, parts)))
    return x - (1 << 64) if x >> 63 else x


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): text, start and end tags in order; comments, declarations and raw elements are left out."""
    at, n, quotes = 0, len(page), True
    last = page.rfind(">")
    while at < n:
        open_ = page.find("<", at)
        if open_ < 0:
            yield "text", page[at:], ""
            return
        if open_ > at:
            yield "text", page[at:open_], ""
        if page.startswith("<!--", open_):
            end = page.find("-->", open_ + 4)
            at = n if end < 0 else end + 3
            continue
        m = TAG.match(page, open_)
        if m is None:
            if page[open_ + 1 : open_ + 2] in ("/", "!", "?") and last > open_:
                at = page.find(">", open_) + 1
            else:
                yield "text", "<", ""
                at = open_ + 1
            continue
        if last < m.end():  # no tag ends behind this place
            yield "text", "<", ""
            at = open_ + 1
            continue
        end = -1
        if quotes:
            end = _tag_end(page, m.end())
            quotes = end >= 0  # a quote is open to the end: from here on quotes say nothing
        if end < 0:
            end = page.find(">", m.end())
        name = m[2].lower()
        at = end + 1
        if m[1]:
            yield "end", name, ""
        elif name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = n if close is None else close.end()
        else:
            yield "start", name, page[m.end() : end]


def _tag_end(page: str, at: int) -> int:
    """Where the tag ends, outside quotes; -1 if nowhere."""
    while (m := QUOTE.search(page, at)) is not None:
        if m[0] == ">":
            return m.start()
        at = page.find(m[0], m.end()) + 1
        if at == 0:
            return -1
    return -1


class Page:
    """A parsed page: elements in order with path, parent, mark and kind, and blocks of text with their element."""

    __slots__ = ("path", "up", "rank", "drop", "never", "texts", "owner")

    def __init__(self, html: str):
        self.path, self.up, self.rank, self.drop, self.never = [0], [0], [NO_MARK], [False], [False]
        self.texts: list[str] = []
        self.owner: list[int] = []
        self._read(html)

    def _read(self, html: str) -> None:
        # open elements: tag and number; plain inline elements stand for what they are in
        tags, numbers = [""], [0]
        places: dict[str, list[int]] = defaultdict(list)
        walls = [0]  # places of block elements other than p
        held: list[str] = []

        def flush() -> None:
            if held:
                text = " ".join(html_lib.unescape("".join(held)).split())
                if text and not self.never[numbers[-1]]:
                    self.texts.append(text)
                    self.owner.append(numbers[-1])
                held.clear()

        def cut(at: int) -> None:
            while len(tags) > at:
                place = len(tags) - 1
                places[tags.pop()].pop()
                numbers.pop()
                if walls[-1] == place:
                    walls.pop()

        def close(names: Iterable[str], wall: int) -> None:
            at = max((places[x][-1] for x in names if places.get(x)), default=-1)
            if at > wall:
                cut(at)

        for kind, tag, rest in tokens(html):
            if kind == "text":
                held.append(tag)
                continue
            if tag == "br":
                held.append(" ")
                continue
            block = tag in BLOCK
            if block:
                flush()
            if kind == "end":
                close((tag,), 0 if block else max(walls[-1], *places["p"][-1:], 0))  # an inline end tag doesn't reach over a block
                continue
            if tag in VOID:
                continue
            if tag in CLOSES_P:
                close(("p",), walls[-1])
            if tag in SAME_CLOSES:
                close(SAME_CLOSES[tag], max((places[x][-1] for x in LISTS if places.get(x)), default=0))
            number = numbers[-1]
            if block or tag in DROPPED or "=" in rest:
                if rest.endswith("/") and not block:
                    continue
                number = self._element(tag, rest, number)
            if block and tag != "p":
                walls.append(len(tags))
            places[tag].append(len(tags))
            tags.append(tag)
            numbers.append(number)
        flush()

    def _element(self, tag: str, rest: str, up: int) -> int:
        names: set[str] = set()
        role = ""
        if "=" in rest:
            for a in ATTRIBUTE.finditer(rest):
                value = (a[2] or a[3] or a[4] or "").lower()
                if a[1].lower() == "role":
                    role = value.strip()
                else:
                    names.update(value.split())
        block = tag in BLOCK or tag in DROPPED
        if not block and not names and not role:
            return up
        marked = self.rank[up] < NO_MARK
        drop = tag in DROPPED or role in DROPPED_ROLES or any(map(dropped_name, names)) and not names & MAIN_NAMES
        if tag == "header":
            drop = drop or not marked  # the header of an article belongs to it
        rank = NO_MARK if drop else mark(tag, names, role)
        if not block and not drop:
            return up
        self.path.append(digest(self.path[up], tag, *sorted(n for n in names if not n[-1:].isdigit())))
        self.up.append(up)
        self.rank.append(min(rank, self.rank[up]) if not drop else NO_MARK)
        self.drop.append(drop)
        self.never.append(self.never[up] or tag in NEVER)
        return len(self.path) - 1

    def own_rank(self, i: int) -> int:
        """How well the element itself marks the article (its rank, unless it is that of what surrounds it)."""
        return self.rank[i] if self.rank[i] < self.rank[self.up[i]] else NO_MARK

    def text_tokens(self) -> list[int]:
        return [digest(self.path[o], t) for t, o in zip(self.texts, self.owner, strict=True)]


def dropped_name(name: str) -> bool:
    """A name that says by all of its parts that this isn't the article."""
    parts = [p for p in re.split(r"[^a-z]+", name) if p]
    return any(p in DROPPED_NAMES for p in parts) and all(p in DROPPED_NAMES or p in PLAIN_NAMES for p in parts)


def mark(tag: str, names: set[str], role: str) -> int:
    """How well an element marks the article: 0 best, ``NO_MARK`` not at all."""
    if tag == "article":
        return 0
    if tag == "main" or role in ("main", "article"):
        return 1
    return 2 if names & MAIN_NAMES else NO_MARK


# -- tokens and their vectors --------------------------------------------------------
#: Of each token: its element around, kind, mark, whether aside, sums (three of the vector, pages, occurrences, shares of the pages' text), and least and greatest page.
SUMS = "parent long, kind int, rank int, aside boolean, v1 long, v2 long, v3 long, pages long, total long, share long, low long, high long"


def page_tokens(page: Page) -> dict[int, list]:
    """token: [parent, kind, rank, aside, occurrences, share of the page's text, longest other block]; token 0 is the page itself."""
    size = max(sum(map(len, page.texts)), 1)
    longest = sorted(set(page.texts), key=lambda t: (-len(t), t))[:2]
    other = {t: digest(*longest[1 - i :][:1]) for i, t in enumerate(longest)}
    usual = digest(*longest[:1])
    found: dict[int, list] = {0: [0, PAGE, NO_MARK, False, 1, 0, usual]}
    aside = [False]
    for i in range(1, len(page.path)):
        u = page.up[i]
        aside.append(aside[u] or page.drop[i])
        row = found.setdefault(page.path[i], [page.path[u], ELEMENT, page.own_rank(i), aside[i], 0, 0, usual])
        row[4] += 1
    for token, text, o in zip(page.text_tokens(), page.texts, page.owner, strict=True):
        row = found.setdefault(token, [page.path[o], TEXT, NO_MARK, aside[o], 0, 0, other.get(text, usual)])
        row[4] += 1
        share = len(text) * PAGE_SHARE // size
        row[5] += share
        found[page.path[o]][5] += share
    return found


def occurrences(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Partial sums by ``host`` and ``token`` (see ``SUMS``)."""
    source = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"))
    names = ["host", "token", *(x.split()[0] for x in SUMS.split(", "))]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 8]
    part = (1 << 31) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], list] = {}

        def out() -> pa.RecordBatch:
            rows = [(*k, *s) for k, s in sums.items()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for a, b in column_blocks(batch.column(1)):
                for host, raw in zip(batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_pylist(), strict=True):
                    page = Page(raw)
                    r = xxhash.xxh3_128_intdigest(raw)
                    r1, r2, r3 = r & part | 1, r >> 31 & part, r >> 62 & part
                    for token, (parent, kind, rank, aside, n, chars, same) in page_tokens(page).items():
                        s = sums.get((host, token))
                        if s is None:
                            sums[host, token] = [parent, kind, rank, aside, n * r1, n * r2, n * r3, 1, n, chars, same, same]
                            continue
                        for i, x in enumerate((n * r1, n * r2, n * r3, 1, n, chars), 4):
                            s[i] += x
                        s[10], s[11] = min(s[10], same), max(s[11], same)
                    if len(sums) > TASK_TOKENS:
                        yield out()
        if sums:
            yield out()

    return source.mapInArrow(run, f"host string, token long, {SUMS}")


# -- templates -----------------------------------------------------------------------
def deduce(rows: Iterable[tuple], least: int, share: float = LEAST_SHARE) -> tuple[int | None, list[int]]:
    """The main slot (the path of an element) and the template texts, from tokens with the fields of ``SUMS``.

    Tokens are in at least ``least`` pages and ``share`` of the pages that token 0 counts.
    """
    found = {t: x for t, *x in rows}
    if 0 not in found:
        return None, []
    n = found[0][7]
    valid = {t: x for t, x in found.items() if x[7] >= max(least, share * n)}
    vector = {t: tuple(x[4:9]) for t, x in valid.items()}
    one_page = least <= 1
    # a text in the class of its element is template text
    fixed = [t for t, x in valid.items() if x[1] == TEXT and not one_page and vector.get(x[0]) == vector[t] and x[10] != x[11]]
    # the skeleton: elements that occur once in each page that has them
    skeleton = {t for t, x in valid.items() if x[1] == ELEMENT and x[7] == x[8]} | {0}

    slots: dict[int, int] = {0: 0}

    def slot(token: int) -> int:
        """The nearest skeleton element around, itself included."""
        chain = []
        while token not in slots and token not in skeleton:
            chain.append(token)
            token = found[token][0] if token in found else 0
        s = slots.get(token, token)
        slots.update(dict.fromkeys(chain, s))
        return s

    chars = dict.fromkeys(skeleton, 0)
    for t, x in found.items():
        if x[1] != TEXT:
            chars[slot(t)] += x[9]
    for t in fixed:
        chars[slot(found[t][0])] -= found[t][9]
    above = {t: slot(found[t][0]) for t in skeleton if t}
    rank = {t: found[t][2] for t in skeleton}
    best_rank: dict[int, int] = {0: NO_MARK}  # of the element and those around it

    def climb(t: int) -> list[int]:
        out = [t]
        while out[-1]:
            out.append(above[out[-1]])
        return out

    for t in skeleton:
        chain = []
        while t not in best_rank:
            chain.append(t)
            t = above[t]
        for x in reversed(chain):
            best_rank[x] = min(best_rank[above[x]], rank[x])
    marked = any(r < NO_MARK for r in rank.values())

    def weight(t: int) -> float:
        if found[t][3]:
            return 0.0 if marked else ASIDE
        return MARKED if best_rank[t] < NO_MARK else PLAIN

    bonus = PAGE_SHARE * n * (MARK_ALONE if one_page else MARK_SHARE)
    score = {t: (chars[t] + bonus * (rank[t] < NO_MARK)) * weight(t) for t in skeleton}
    main = max(skeleton, key=lambda t: (score[t], -best_rank[t], t))
    around = climb(main)
    marks = [t for t in around if rank[t] == best_rank[main] < NO_MARK]
    # variable text inside each element around the main slot, without what is aside
    inside = dict.fromkeys(around, 0)
    for t in skeleton:
        if chars[t] and (not found[t][3] or found[main][3]):
            first = t
            while first not in inside:
                first = above[first]
            inside[first] += chars[t]
    total = 0
    for t in around:
        total += inside[t]
        inside[t] = total
    if marks:
        need = COVER * inside[marks[-1]]
        main = next(t for t in marks if inside[t] >= need)
    else:
        main = next(t for t in around if inside[t] >= COVER * total)
    return main, fixed


def templates(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row for each host with at least ``LEAST_PAGES`` pages: ``host``, ``main`` (path of the main slot, 0: the whole page) and ``fixed`` (text tokens of the template)."""
    by = ["host", "token"]
    sums = occurrences(pages, url, html).groupBy(*by).agg(
        *(F.min(c).alias(c) for c in ("parent", "kind", "rank", "aside")), *(F.sum(c).alias(c) for c in ("v1", "v2", "v3", "pages", "total", "share")), F.min("low").alias("low"), F.max("high").alias("high")
    )
    sums = written(sums.where(F.col("pages") >= LEAST_PAGES), "page-tokens")
    counts = sums.where("token = 0").select("host", F.col("pages").alias("n"))
    # what half of a host's pages have is no more than twice a page
    valid = sums.join(counts, "host").where(F.col("pages") >= F.col("n") * LEAST_SHARE)
    names = ["token", *(x.split()[0] for x in SUMS.split(", "))]
    grouped = valid.groupBy("host").agg(F.collect_list(F.struct(*names)).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [deduce([tuple(r.values()) for r in rows], LEAST_PAGES) for rows in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m for m, _ in made], pa.int64()), pa.array([f for _, f in made], pa.list_(pa.int64()))], names=["host", "main", "fixed"])

    return grouped.mapInArrow(run, "host string, main long, fixed array<long>")


# -- extraction ----------------------------------------------------------------------
def main_text(html: str, main: int | None, fixed: frozenset[int]) -> str:
    """What remains in the main slot: the blocks of a page, a line each."""
    page = Page(html)
    if main is None or main and main not in page.path[1:]:
        own = [(t, *x[:4], x[4], x[4], x[4], 1, x[4], x[5], 0, 0) for t, x in page_tokens(page).items()]
        main, _ = deduce(own, 1)
    inside, out = [main == 0], [False]
    for i in range(1, len(page.path)):
        u = page.up[i]
        inside.append(inside[u] or page.path[i] == main)
        out.append(out[u] or page.drop[i] and inside[u])
    kept = [(o, t) for o, t in zip(page.owner, page.texts, strict=True) if inside[o] and not out[o]]
    return "\n".join(t for o, t in kept if not fixed or digest(page.path[o], t) not in fixed)


def _extracting(get):
    """A function for mapInArrow from (.., host, html, main, fixed) to (.., text, n_chars)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in column_blocks(batch.column(batch.num_columns - 3)):
                *kept, host, page, main, fixed = batch.slice(a, b - a).columns
                texts = [main_text(p, *get(h, m, f)) for h, p, m, f in zip(host.to_pylist(), page.to_pylist(), main.to_pylist(), fixed.to_pylist(), strict=True)]
                names = batch.schema.names[: len(kept)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))], names=[*names, "text", "n_chars"])

    return run


def extract(pages: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of the html."""
    keep = [c for c in (pages.columns if keep is None else keep) if c != html and c.lower() not in ("text", "n_chars")]
    found = written(templates(pages, url, html), "templates")
    size = found.agg(F.sum(F.length("host") + 8 * F.size("fixed") + 40)).first()[0] or 0
    source = pages.select(*(F.col(f"`{c}`") for c in keep), host_of(F.col(f"`{url}`")).alias("__host"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("__html"))
    schema = T.StructType([*(pages.schema[c] for c in keep), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    if size <= BROADCAST_BYTES:
        sent = pages.sparkSession.sparkContext.broadcast({r.host: (r.main, frozenset(r.fixed)) for r in found.toLocalIterator()})
        empty = (None, frozenset())
        source = source.withColumns({"__main": F.lit(None).cast("long"), "__fixed": F.lit(None).cast("array<long>")})
        return source.mapInArrow(_extracting(lambda h, m, f: sent.value.get(h, empty)), schema)
    joined = source.join(found.select(F.col("host").alias("__host"), F.col("main").alias("__main"), F.col("fixed").alias("__fixed")), "__host", "left")
    ordered = joined.select(*(F.col(f"`{c}`") for c in keep), "__host", "__html", "__main", "__fixed")
    return ordered.mapInArrow(_extracting(lambda h, m, f: (m, frozenset(f or ()))), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), keep=["page_id", "url"])
