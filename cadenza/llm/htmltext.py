"""HTML extraction (operator 5): nearest-URL page differencing.

A page is parsed into text lines (blocks). Pages are paired by URL path: within a host, every
page is compared with the pages of the nearest ``REACH`` paths before and after its own. The lines
of both are aligned by a longest common subsequence. Lines shared with the nearest path on a side
go: they are the site's, not the page's. Pages of one path are variants of each other and are never
compared, unless the host has no other path; then their queries part them. A page that shares most
of its text may be a copy, and the next path takes its place.

Lines shared with ``SITE_PAGES`` different pages go as well, whatever else those share, if the page
keeps some text: so go the lines of a template that is longer than the page's own text, and the
lines that a site repeats in its articles. Other lines inside an article element stay, and all do
if most of the article is shared: articles that quote each other must stay whole.

An exact check by markup follows, for what is not on the neighbouring pages: of the lines left,
the article's are the main text, or without an article those outside of containers that never are
main text (menus, forms, adverts, reader comments; by tag and by class, id and role). A form or a
named container that is wrapped around the article or most of the text is main text all the same.

Spark moves line hashes, not texts: the lines that go are found on hashes and taken out in a
second pass over the pages.
"""

from __future__ import annotations

import heapq
import html as entities
import re
from collections import Counter

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import Tables, bounded_batches, broadcast_if_small, n_blocks, written

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)"
                  r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements whose content is not markup, and elements without content.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
#: Containers that are never main text; ``header`` counts outside the article only.
APART = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "label", "fieldset",
         "head", "object", "canvas", "audio", "video"} | RAW
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr"}
#: Containers that mostly are not main text, but may be wrapped around it.
SOFT = {"form", "fieldset"}
#: Words of a class, id or role that mark a container as not main text.
_APART_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|popup|modal|overlay|"
    r"newsletter|subscribe|sidebar|widget|menu|nav\w*|breadcrumbs?|masthead|footer|comments?|respond|replies|disqus|"
    r"share|sharing|social|related|login|signup|search|toolbar|pagination|pager|copyright|contentinfo|complementary)"
    r"(?:$|[\s_-])", re.I)
#: First words of names that tell of a layout, not of what the container is.
_LAYOUT = re.compile(r"(?:has|no|not|with|without|sticky|is)[_-]", re.I)
NO_NAME, WEAK, STRONG = 0, 1, 2
#: What a line is: in a container that is not main text, in the page's body, in its article.
APART_LINE, BODY_LINE, ARTICLE_LINE = 0, 1, 2
#: Pages that share more than this of either one's text may be copies; so may articles.
COPY_SHARE = 0.5
#: Paths on either side that a page is compared with, and pages that make a shared line the site's.
REACH, SITE_PAGES = 3, 3
RANGE_ROWS, MAX_RANGES = 4_000, 2_000


def named_apart(value: str) -> int:
    """How surely a class, id or role names a container that is not main text: ``STRONG`` if a
    name is such a word or ends in one (``top-ad``), ``WEAK`` if it only has one (``search-results``)."""
    sure = NO_NAME
    for name in value.split():
        if not _LAYOUT.match(name) and (found := list(_APART_NAME.finditer(name))):
            sure = max(sure, STRONG if found[-1].end() == len(name) else WEAK)
    return sure


class _Soft:
    """A container that may be wrapped around the main text."""

    __slots__ = ("parent", "strong", "children", "own", "held", "article", "has_article")

    def __init__(self, parent, strong):
        self.parent, self.strong, self.children = parent, strong, []
        self.own = self.held = 0                        # characters outside and inside of containers within it
        self.article = self.has_article = False         # it has article lines, itself or within


def _released(soft: list[_Soft], left: int) -> set[int]:
    """Containers that count as main text after all, for a page without an article outside of them.

    ``left``: characters of main text without any of them. The largest are tried first, outer
    ones before those within. A container around an article, or of a weak name, is main text if
    it holds more than is left; any is if nothing is left.
    """
    for i in range(len(soft) - 1, -1, -1):
        c = soft[i]
        c.held += c.own
        c.has_article |= c.article
        if c.parent is not None:
            soft[c.parent].held += c.held
            soft[c.parent].has_article |= c.has_article
            soft[c.parent].children.append(i)
    out: set[int] = set()
    heap = [(-c.held, i) for i, c in enumerate(soft) if c.parent is None]
    heapq.heapify(heap)
    while heap:
        _, i = heapq.heappop(heap)
        c = soft[i]
        if c.held > left and (c.has_article or not c.strong or not left):
            out.add(i)
            left += c.own
            if c.article:
                break
            for j in c.children:
                heapq.heappush(heap, (-soft[j].held, j))
    return out


def text_lines(page: str | None) -> list[tuple[str, int]]:
    """The text lines of a page and what each is; scripts and the like have none."""
    page = page or ""
    found: list[tuple[str, bool, bool, int | None]] = []    # line, apart, article, innermost soft container
    stack: list[tuple[str, bool, bool, int | None]] = []    # open elements: name, and the same
    soft: list[_Soft] = []
    parts: list[str] = []
    pos = 0

    def flush():
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                found.append((text, *(stack[-1][1:] if stack else (False, False, None))))
            parts.clear()

    def text(upto: int):
        if upto > pos:
            parts.append(page[pos:upto])

    while True:
        tag = _TAG.search(page, pos)
        if tag is None:
            text(len(page))
            break
        text(tag.start())
        pos = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if name not in INLINE:
            flush()
        if tag[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
        elif name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, pos)
            pos = end.end() if end else len(page)
        elif name not in VOID and not tag[3].endswith("/"):
            if name not in INLINE:
                while stack and stack[-1][0] == "p":
                    stack.pop()
            article = bool(stack) and stack[-1][2] or name in ("article", "main")
            apart = bool(stack) and stack[-1][1] or name in APART - SOFT or name == "header" and not article
            within = stack[-1][3] if stack else None
            if not apart and name not in ("html", "body", "article", "main"):
                sure = max((named_apart(next(filter(None, a), "")) for a in _ATTR.findall(tag[3])),
                           default=NO_NAME) if tag[3] else NO_NAME
                if sure or name in SOFT:
                    soft.append(_Soft(within, sure == STRONG))
                    within = len(soft) - 1
            stack.append((name, apart, article, within))
    flush()
    main = set()
    if soft:
        left, has_article = 0, False
        for line, apart, article, within in found:
            if not apart and within is None:
                left += len(line)
                has_article |= article
            elif not apart:
                soft[within].own += len(line)
                soft[within].article |= article
        main = set() if has_article else _released(soft, left)
    return [(line, APART_LINE if apart or within is not None and within not in main
             else ARTICLE_LINE if article else BODY_LINE) for line, apart, article, within in found]


def main_lines(lines: list[tuple[str, int]], gone: set[int]) -> list[str]:
    """The article's lines, or else the body's, without those that other pages share."""
    left = [x for i, x in enumerate(lines) if i not in gone]
    kind = ARTICLE_LINE if any(k == ARTICLE_LINE for _, k in lines) else BODY_LINE
    return [text for text, k in left if k == kind]


def url_key(url: str | None) -> tuple[str | None, str | None]:
    """Host and path of a URL; numbers are padded so that near numbers are near paths. Query,
    fragment, a trailing slash and an .html ending do not count. No host: null."""
    m = re.match(r"\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url or "", re.I)
    if not m or not m[1]:
        return None, None
    path = re.sub(r"(?:\.x?html?|/)+$", "", m[2].lower())
    return m[1].lower().rsplit("@", 1)[-1], re.sub(r"\d+", lambda d: d.group().zfill(12), path)


def url_query(url: str | None) -> str:
    """The query of a URL, numbers padded as in its path; empty without one."""
    m = re.match(r"[^?#]*\?([^#]*)", url or "")
    return re.sub(r"\d+", lambda d: d.group().zfill(12), m[1]) if m else ""


def _line_hash(line: str) -> int:
    h = xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def lcs(a: list, b: list) -> list[tuple[int, int]]:
    """A longest common subsequence as index pairs: bit-parallel rows, halved when large."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    ends = [(i, i) for i in range(lo)] + [(len(a) - k, len(b) - k) for k in range(hi, 0, -1)]
    inner = range(lo, len(a) - hi), range(lo, len(b) - hi)
    common = {a[i] for i in inner[0]} & {b[j] for j in inner[1]}
    ia, ib = [i for i in inner[0] if a[i] in common], [j for j in inner[1] if b[j] in common]
    middle = [(ia[i], ib[j]) for i, j in _align([a[i] for i in ia], [b[j] for j in ib])]
    return ends[:lo] + middle + ends[lo:]


def _rows(a: list, b: list):
    """Bit rows of the alignment: bit j of row i is 0 where the length grows at b[j]."""
    at: dict = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    full = row = (1 << len(b)) - 1
    for x in a:
        m = row & at.get(x, 0)
        row = (row + m | row - m) & full
        yield row


def _align(a: list, b: list) -> list[tuple[int, int]]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > 4_000_000:
        half = len(a) // 2

        def lengths(x, y):
            *_, row = _rows(x, y)
            out = [0]
            for j in range(len(y)):
                out.append(out[-1] + (not row >> j & 1))
            return out

        first, second = lengths(a[:half], b), lengths(a[half:][::-1], b[::-1])
        cut = max(range(len(b) + 1), key=lambda j: first[j] + second[len(b) - j])
        return _align(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in _align(a[half:], b[cut:])]
    rows, out, j = list(_rows(a, b)), [], len(b)
    for i in range(len(a) - 1, -1, -1):
        above = rows[i - 1] if i else (1 << len(b)) - 1
        # lengths up to column j: zeros among the first j bits
        while j and (j - (rows[i] & (1 << j) - 1).bit_count()) == (j - 1 - (rows[i] & (1 << j - 1) - 1).bit_count()):
            j -= 1
        if j and j - (above & (1 << j) - 1).bit_count() < j - (rows[i] & (1 << j) - 1).bit_count():
            out.append((i, j - 1))
            j -= 1
    return out[::-1]


def _hashed(batches):
    """Per page: key of the row, host, path, query, line hashes, lengths, and what is protected."""
    import pyarrow as pa

    for batch in batches:
        out = []
        for uid, url, page in zip(*(batch.column(c).to_pylist() for c in ("uid", "url", "html"))):
            host, path = url_key(url)
            if host is None:
                continue
            lines = text_lines(page)
            out.append((uid, host, path, url_query(url), [{"h": _line_hash(t), "n": len(t), "kind": k} for t, k in lines]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string()),
             pa.array([r[2] for r in out], pa.string()), pa.array([r[3] for r in out], pa.string()),
             pa.array([r[4] for r in out], _lines_type())], names=["uid", "host", "path", "query", "lines"])


LINES = "array<struct<h: bigint, n: bigint, kind: int>>"


def _lines_type():
    import pyarrow as pa

    return pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64()), ("kind", pa.int32())]))


def gone_lines(lines: list[dict], before: list[dict], after: list[dict]) -> set[int]:
    """Numbers of the lines that go, by the pages of the paths on either side, nearest first."""
    def chars(rows) -> int:
        return sum(lines[i]["n"] for i in rows if lines[i]["kind"] != APART_LINE)

    own, every = [x["h"] for x in lines], range(len(lines))
    total, near, pages, seen = chars(every), set(), Counter(), {tuple(own)}
    for side in (before, after):
        paired = False
        for other in side:
            shared = {i for i, _ in lcs(own, other["hs"])}
            if not paired and chars(shared) <= COPY_SHARE * min(total, other["chars"]):
                near |= shared
                paired = True
            if tuple(other["hs"]) not in seen:
                seen.add(tuple(other["hs"]))
                pages.update(shared)
    site = {i for i, n in pages.items() if n >= SITE_PAGES}
    article = {i for i in every if lines[i]["kind"] == ARTICLE_LINE}
    repeated = site & article
    if chars(repeated) > COPY_SHARE * chars(article):
        repeated = set()
    if not article and not chars(set(every) - near - site):
        site = set()
    return (near | site) - article | repeated


def _deleted(batches):
    import pyarrow as pa

    for batch in batches:
        uids, gone = [], []
        for uid, lines, before, after in zip(*(batch.column(c).to_pylist() for c in ("uid", "lines", "before", "after"))):
            rows = sorted(gone_lines(lines, before, after))
            if rows:
                uids.append(uid)
                gone.append(rows)
        yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(gone, pa.list_(pa.int64()))],
                                         names=["uid", "gone"])


def _extracted(batches):
    import pyarrow as pa

    for batch in batches:
        texts = []
        for page, gone in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist()):
            texts.append(" ".join(main_lines(text_lines(page), set(gone or ()))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def _guests(ends: list) -> list[tuple[str, str, int]]:
    """``(host, path, range)``: the ``REACH`` paths next to each range, from the ranges beside it.

    ``ends``: the first and last paths of every range, sorted by range and path.
    """
    by_range: dict[int, list] = {}
    for r in ends:
        by_range.setdefault(r["rng"], []).append((r["host"], r["path"]))
    out, ranges = [], sorted(by_range)
    for order, end in ((ranges, slice(-REACH, None)), (ranges[::-1], slice(0, REACH))):
        last: list = []         # the paths passed last, in order
        for rng in order:
            out += [(*path, rng) for path in last]
            own = by_range[rng][end]
            last = (last + own)[end] if order is ranges else (own + last)[end]
    return out


def neighbours(paths: DataFrame, tables: Tables) -> DataFrame:
    """``(host, path, before, after)``: the nearest paths of the host on either side, nearest first.

    ``paths`` holds one row per host and path. Ranges of (host, path) are sorted in parallel;
    each gets the last rows before it and the first ones after it as guests.
    """
    ranges = min(n_blocks(paths.count(), RANGE_ROWS), MAX_RANGES)
    dealt = written(paths.repartitionByRange(ranges, "host", "path").withColumn("rng", F.spark_partition_id()),
                    "html-paths", tables)
    order = Window.partitionBy("rng").orderBy("host", "path")
    back = Window.partitionBy("rng").orderBy(F.desc("host"), F.desc("path"))
    ends = (dealt.select("rng", "host", "path").withColumn("nth", F.row_number().over(order))
            .withColumn("last", F.row_number().over(back)).where(F.least("nth", "last") <= REACH))
    guests = _guests(sorted(ends.collect(), key=lambda r: (r["rng"], r["nth"])))     # a few rows per range
    if guests:
        extra = paths.sparkSession.createDataFrame(guests, "host string, path string, to int")
        extra = dealt.join(F.broadcast(extra), ["host", "path"]).select("host", "path", "hs", "chars", F.col("to").alias("rng"))
        dealt = dealt.withColumn("guest", F.lit(False)).unionByName(extra.withColumn("guest", F.lit(True)))
    else:
        dealt = dealt.withColumn("guest", F.lit(False))
    page = F.struct("host", "hs", "chars")

    def side(at):
        found = F.filter(F.array(*[F.col(f"{at.__name__}{k}") for k in range(1, REACH + 1)]), lambda x: x["host"] == F.col("host"))
        return F.transform(found, lambda x: F.struct(x["hs"].alias("hs"), x["chars"].alias("chars")))

    near = dealt.select("host", "path", "guest", *[at(page, k).over(order).alias(f"{at.__name__}{k}")
                                                   for at in (F.lag, F.lead) for k in range(1, REACH + 1)])
    return near.where("NOT guest").select("host", "path", side(F.lag).alias("before"), side(F.lead).alias("after"))


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``.

    Null or empty html gives an empty text. A page whose url is null or has no host, or which is
    alone on its host, is not differenced. Rows may repeat: equal rows get equal texts. Of the
    pages of one path, the one of the smallest line hashes stands for them all in comparisons. On a
    host of one path the query counts as part of it.
    """
    tables = Tables()
    bounded_batches(pages.sparkSession)
    base = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    base = base.withColumn("uid", F.xxhash64("page_id", "url", "html"))
    hashed = written(base.select("uid", "url", "html").mapInArrow(
        _hashed, f"uid bigint, host string, path string, query string, lines {LINES}"), "html-lines", tables)
    single = (hashed.groupBy("host").agg(F.min("path").alias("lo"), F.max("path").alias("hi"), F.min("query").alias("qlo"),
                                         F.max("query").alias("qhi"))
              .where("lo = hi AND qlo <> qhi").select("host", F.lit(True).alias("single")))
    single = written(single, "html-single", tables)
    hashed = (hashed.join(broadcast_if_small(single, single.count()), "host", "left")
              .withColumn("path", F.when(F.col("single"), F.concat("path", F.lit("?"), "query")).otherwise(F.col("path")))
              .drop("single", "query"))
    counted = F.aggregate("lines", F.lit(0).cast("bigint"),
                          lambda n, x: n + F.when(x["kind"] != APART_LINE, x["n"]).otherwise(0))
    paths = hashed.groupBy("host", "path").agg(F.min(F.struct("uid", "lines"))["lines"].alias("lines"))
    paths = paths.select("host", "path", F.transform("lines", lambda x: x["h"]).alias("hs"), counted.alias("chars"))
    paths = written(paths, "html-first", tables)
    near = neighbours(paths, tables).where("size(before) > 0 OR size(after) > 0")
    gone = hashed.dropDuplicates(["uid"]).join(near, ["host", "path"]).select("uid", "lines", "before", "after").mapInArrow(
        _deleted, "uid bigint, gone array<bigint>")
    gone = written(gone, "html-gone")
    tables.drop(pages.sparkSession)
    got = base.join(broadcast_if_small(gone, gone.count()), "uid", "left")
    return got.select("page_id", "url", "html", "gone").mapInArrow(
        _extracted, "page_id bigint, url string, text string, n_chars bigint")
