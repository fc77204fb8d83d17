"""Main-text extraction by nearest-URL page differencing.

A page is read into text lines (blocks) with the markup they stand in, in time linear in its length.
Pages of a host with equal lines outside their article elements are judged once, at the smallest of
their paths. These are sorted by host and URL path, each is paired with the neighbour whose URL
shares the longer beginning, and the outside lines of both are aligned by their longest common
subsequence; aligned lines are the site's and go. A neighbour that is a near copy (``COPY`` of
the longer one's characters are aligned) tells nothing about the site: the other neighbour
is taken then, and without one the lines stay, so copies never empty each other.
Lines in elements or classes that name
menus, headers, footers, sidebars, notices, adverts, forms or reader comments go as well.
A class or id names one if all parts of a whole token are such names or words of layout
(``cookie-notice``, ``site-footer``; not ``has-sidebar`` or ``share-prices``). ``html``,
``body``, ``main`` and ``article`` are never the site's, nor is an element around ``main`` or
a form around an outermost article; any other element around outermost articles is the
site's only if the page has a ``main`` or an article outside such elements (teasers in a
sidebar).
Lines of an ``article`` or ``main`` element are never differenced: sites repeat whole
passages in their articles, and those must stay.

The outside lines are written once; those of distinct pages move (range exchange by host and
path, so a hot host is dealt over many tasks); they are read as a stream with one page of
memory on either side, and pages at the ends of a task get their second neighbour by a join
of the tasks' ends, whose order is found from their keys alone. What is cut is written, one
row per page that loses lines, and joined back to the pages, which are then read once more
for their texts.

Defined results: null or empty html gives empty text; a null url is the empty url; a comment or
script that never closes runs to the end of the page; a tag whose quotes never close ends at its next
``>``, as do all tags after it, and a tag without any ``>`` after it is text; a page without a neighbour
on its host that is no copy of it keeps its unmarked lines; repeated rows get equal texts.
"""

from __future__ import annotations

import html as entities
import os.path
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.llm.common import digest16, written

#: line states
MAIN, MARKED, PLAIN = 0, 1, 2
#: share of the longer page's characters that two copies have in common
COPY = 0.9
#: cells of one alignment table (bits); larger alignments are halved first
TABLE_BITS = 1 << 26

_BLOCKS = set("""address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre section select
summary table tbody td tfoot th thead title tr ul""".split())
_SITE = set("nav footer aside form menu dialog noscript template button select option label fieldset iframe svg canvas head title".split())
_RAW = {"script", "style", "textarea", "xmp", "noembed", "noframes"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_NAMES = ("ad|ads|advert|adverts|advertisement|advertising|banner|breadcrumb|breadcrumbs|comment|comments|consent|cookie|cookies|"
          "disqus|footer|gdpr|masthead|menu|nav|navbar|navigation|newsletter|notice|popup|promo|related|reply|replies|respond|"
          "share|sharing|sidebar|social|sponsor|sponsored|subscribe|toolbar|widget")
_LAYOUT = ("area|bar|block|bottom|box|button|buttons|container|icons|inner|item|items|left|links|list|main|outer|page|panel|"
           "right|row|section|site|slot|space|top|unit|wrap|wrapper|zone")
#: a whole token of site names and words of layout, one site name at least
_SITE_CLASS = re.compile(rf"(?<!\S)(?:(?:{_LAYOUT})[_-]+)*(?:{_NAMES})(?:[_-]+(?:{_NAMES}|{_LAYOUT}))*(?!\S)", re.IGNORECASE)
_SITE_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "dialog", "alert"}
_OTHER = r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|[^<]+|<"
_TOKEN = re.compile(rf"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|{_OTHER}""", re.DOTALL)
#: for pages with a quote that never closes
_LOOSE = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|{_OTHER}", re.DOTALL)
#: for the rest of a page without another ">": no tag, but groups of the same names
_TEXT = re.compile(rf"(?!)()()()|{_OTHER}", re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_CLOSED_BY = {"p": _BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
              "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"}}


def _site(tag: str, attributes: str, inside: bool) -> bool:
    if tag in _SITE or (tag == "header" and not inside):
        return True
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        if (value.lower() in _SITE_ROLE) if name.lower() == "role" else _SITE_CLASS.search(value):
            return True
    return False


def lines(page: str | None) -> list[tuple[str, int]]:
    """Text blocks of a page in order with their state: article, marked as the site's, or unmarked."""
    page = page or ""
    out: list[tuple[str, bool, int]] = []  # text, inside an article, innermost site element (-1: none)
    stack: list[tuple[str, bool, int]] = []  # tag, inside an article, innermost site element
    held: list[str] = []
    around: list[tuple[str, int]] = []  # site elements: tag, the one around it
    opened: set[int] = set()  # site elements that are not the site's after all
    articles: list[int] = []  # innermost site element around each outermost article
    main, site, free = False, -1, False
    alive: Counter[str] = Counter()  # open elements by tag
    blocks: list[int] = []  # places of the open blocks in the stack

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((text, main, site))

    def close(depth: int) -> None:
        nonlocal main, site
        for name, _, _ in stack[depth:]:
            alive[name] -= 1
        del stack[depth:]
        while blocks and blocks[-1] >= depth:
            blocks.pop()
        main, site = (stack[-1][1], stack[-1][2]) if stack else (False, -1)

    def unmark(mark: int) -> None:
        while mark >= 0 and mark not in opened:
            opened.add(mark)
            mark = around[mark][1]

    at, end, token = 0, len(page), _TOKEN
    last = page.rfind(">")
    while at < end:
        if at > last:  # no tag can follow
            token = _TEXT
        found = token.match(page, at)
        if token is _TOKEN and found.group() == "<" and _LOOSE.match(page, at).group(2):
            token = _LOOSE
            found = token.match(page, at)
        at = found.end()
        tag = found.group(2)
        if tag is None:
            if not found.group().startswith(("<!", "<?")):
                held.append(found.group())
            continue
        tag = tag.lower()
        if found.group(1):
            if tag in _BLOCKS:
                flush()
            if alive[tag]:
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                if blocks and blocks[-1] >= depth:
                    flush()
                close(depth)
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in _RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in _BLOCKS:
            flush()
            if blocks and tag in _CLOSED_BY.get(stack[blocks[-1]][0], ()):
                close(blocks[-1])
        if tag in _VOID or found.group(3).endswith("/"):
            continue
        text = tag == "main" or bool(re.search(r"\brole\s*=\s*[\"']?main\b", found.group(3)))
        inside = main or text or tag == "article"
        mark = site
        if text:
            unmark(site)
            free = True
        elif tag == "article":
            if not main:
                articles.append(site)
        elif tag not in ("html", "body") and _site(tag, found.group(3), inside):
            around.append((tag, site))
            mark = len(around) - 1
        if tag in _BLOCKS:
            blocks.append(len(stack))
        alive[tag] += 1
        stack.append((tag, inside, mark))
        main, site = inside, mark
    flush()
    holds: set[int] = set()  # site elements around outermost articles
    for mark in articles:
        while mark >= 0 and mark not in holds:
            holds.add(mark)
            mark = around[mark][1]

    def still_marked() -> list[bool]:
        marked: list[bool] = []
        for i, (_, outer) in enumerate(around):
            marked.append(i not in opened or (outer >= 0 and marked[outer]))
        return marked

    opened.update(i for i in holds if around[i][0] == "form")
    marked = still_marked()
    if not free and all(mark >= 0 and marked[mark] for mark in articles):
        opened |= holds
        marked = still_marked()
    return [(t, MARKED if mark >= 0 and marked[mark] else MAIN if within else PLAIN) for t, within, mark in out]


def _lengths(a: list, b: list) -> tuple[list[int], int]:
    """Bit vectors of the longest-common-subsequence table: one row per line of ``a``."""
    masks: dict = {}
    for j, line in enumerate(b):
        masks[line] = masks.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for line in a:
        hit = row & masks.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    return rows, full


def common(a: list, b: list) -> set[int]:
    """Positions of ``a`` that take part in a longest common subsequence with ``b``."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    kept = set(range(low)) | set(range(len(a) - high, len(a)))
    a, b = a[low:len(a) - high], b[low:len(b) - high]
    if not a or not b:
        return kept
    if len(a) > 1 and len(a) * len(b) > TABLE_BITS:
        half = len(a) // 2
        ahead = _lengths(a[:half], b)[0][-1]
        back = _lengths(a[half:][::-1], b[::-1])[0][-1]
        best, cut, left, right = -1, 0, 0, len(b) - back.bit_count()
        for j in range(len(b) + 1):
            if left + right > best:
                best, cut = left + right, j
            if j < len(b):
                left += not ahead >> j & 1
                right -= not back >> (len(b) - 1 - j) & 1
        one, two = common(a[:half], b[:cut]), common(a[half:], b[cut:])
        return kept | {low + i for i in one} | {low + half + i for i in two}
    rows, full = _lengths(a, b)
    j = len(b)
    for i in range(len(a) - 1, -1, -1):
        # zeros of a row below j count the subsequence's length; walk back where it grows with line i
        below = rows[i - 1] if i else full
        mask = (1 << j) - 1
        if (~rows[i] & mask).bit_count() > (~below & mask).bit_count():
            kept.add(low + i)
            while a[i] != b[j - 1] or (~rows[i] & ((1 << j - 1) - 1)).bit_count() == (~rows[i] & mask).bit_count():
                j -= 1
                mask = (1 << j) - 1
            j -= 1
    return kept


def shared_lines(own: list[tuple[str, int]], others: list[list[tuple[str, int]]]) -> list[int]:
    """Positions of the unmarked among a page's outside lines that align with the first of the neighbours that is no near copy."""
    if all(state != PLAIN for _, state in own):
        return []
    for other in others:
        aligned = common([t for t, _ in own], [t for t, _ in other])
        longer = max(sum(len(t) for t, _ in own), sum(len(t) for t, _ in other))
        if sum(len(own[i][0]) for i in aligned) < COPY * longer:
            return sorted(i for i in aligned if own[i][1] == PLAIN)
    return []


def main_text(page: list[tuple[str, int]], cut: list[int] | None) -> str:
    """The page's lines without marked ones and without the ``cut`` of its outside lines."""
    gone, kept, at = set(cut or ()), [], 0
    for text, state in page:
        if state == MAIN or (state == PLAIN and at not in gone):
            kept.append(text)
        at += state != MAIN
    return "\n\n".join(kept)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (lower case) and path of a URL; query and fragment are left out."""
    found = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
    return (found.group(1).lower(), found.group(2)) if found else ("", re.split(r"[?#]", url or "", maxsplit=1)[0])


_LINES = pa.list_(pa.struct([("t", pa.string()), ("s", pa.int8())]))
_LINES_SQL = "array<struct<t: string, s: tinyint>>"
_NEAR = pa.struct([("path", pa.string()), ("own", _LINES)])
_NEAR_SQL = f"struct<path: string, own: {_LINES_SQL}>"


def _pairs(value) -> list[tuple[str, int]] | None:
    return None if value is None else [(x["t"], x["s"]) for x in value]


def _digest(own: list[tuple[str, int]]) -> bytes:
    return digest16("\0".join(f"{state}{text}" for text, state in own).encode("utf-8", "surrogatepass"))


def _outside(pages: DataFrame) -> DataFrame:
    """Per page its key and its lines outside articles, with their digest; pages without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [[(t, s) for t, s in lines(h) if s != MAIN] for h in batch.column(3).to_pylist()]
            index = pa.array([i for i, own in enumerate(found) if own], pa.int64())
            arrays = [*(batch.column(i) for i in range(3)), pa.array([h for h, _ in urls], pa.string()),
                      pa.array([p for _, p in urls], pa.string()), pa.array(map(_digest, found), pa.binary()),
                      pa.array([[{"t": t, "s": s} for t, s in own] for own in found], _LINES)]
            yield pa.RecordBatch.from_arrays([x.take(index) for x in arrays],
                                             names=["page_id", "url", "key", "host", "path", "digest", "own"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(run, f"page_id {kind}, url string, key long, host string, path string, digest binary, own {_LINES_SQL}")


#: places of a page in its rows
HOST, PATH, DIGEST, OWN = range(4)


def _nearest(page: tuple, before: tuple | None, after: tuple | None) -> list[list[tuple[str, int]]]:
    """Lines of the neighbours on the same host, first the one whose path shares the longer beginning (else the one before)."""
    near = [x for x in (before, after) if x is not None and x[HOST] == page[HOST]]
    near.sort(key=lambda x: -len(os.path.commonprefix([x[PATH], page[PATH]])))
    return [x[OWN] for x in near]


def _diffed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pages in, the lines to cut out; the first and last page of the task come with their lines and
    inner neighbour instead, and with their place (first, last, only)."""
    names = ["host", "path", "digest", "own", "cut", "task", "place", "near"]
    kinds = [pa.string(), pa.string(), pa.binary(), _LINES, pa.list_(pa.int64()), pa.int32(), pa.string(), _NEAR]
    task = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(OWN)),
                           map(_pairs, batch.column(OWN).to_pylist()), strict=True)

    def structs(found: list[tuple[str, int]]) -> list[dict]:
        return [{"t": t, "s": s} for t, s in found]

    def inner(page: tuple, other: tuple | None) -> dict | None:
        return {"path": other[PATH], "own": structs(other[OWN])} if other is not None and other[HOST] == page[HOST] else None

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    before, page, found = None, None, []
    for after in rows():
        if page is not None:
            if before is None:
                found.append((*page[:OWN], structs(page[OWN]), None, task, "first", inner(page, after)))
            elif cut := shared_lines(page[OWN], _nearest(page, before, after)):
                found.append((*page[:OWN], None, cut, task, None, None))
        before, page = page, after
        if len(found) >= 256:
            yield batch_of(found)
            found = []
    if page is not None:
        found.append((*page[:OWN], structs(page[OWN]), None, task, "only" if before is None else "last", inner(page, before)))
    if found:
        yield batch_of(found)


def _ends_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines to cut from pages at the ends of tasks; ``up`` and ``down`` are the pages before and after."""
    for batch in batches:
        cuts = []
        for host, path, own, near, place, up, down in zip(*(batch.column(n).to_pylist() for n in (
                "host", "path", "own", "near", "place", "up", "down")), strict=True):
            page = (host, path, None, _pairs(own))
            before, after = [None if x is None else (x["host"], x["path"], None, _pairs(x["own"])) for x in (up, down)]
            if place != "only":
                inside = None if near is None else (host, near["path"], None, _pairs(near["own"]))
                before, after = (before, inside) if place == "first" else (inside, after)
            cuts.append(shared_lines(page[OWN], _nearest(page, before, after)))
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("digest"), pa.array(cuts, pa.list_(pa.int64()))],
                                         names=["host", "digest", "cut"])


def _ends_joined(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """The pages at the ends of tasks with the pages before and after them. Their order comes from two
    narrow rows a task; the lines move by an equi-join."""
    place = F.when(F.col("place") == "last", 1).otherwise(0)
    window = Window.orderBy("task", "at")
    keys = ends.select("task", place.alias("at"))
    keys = keys.select("task", "at", *(fn(F.struct("task", "at")).over(window).alias(n)
                                       for n, fn in (("before", F.lag), ("after", F.lead))))
    keys = written(spark, keys, "html-ends")
    pages = ends.select("*", place.alias("at")).join(keys, ["task", "at"])
    for name, key in (("up", "before"), ("down", "after")):
        other = ends.select(F.struct(F.col("task"), place.alias("at")).alias(key), F.struct("host", "path", "own").alias(name))
        pages = pages.join(other, key, "left")
    return pages


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(lines(h), cut) for h, cut in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per page: ``page_id, url, text, n_chars``."""
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.xxhash64("html").alias("key"), "html")
    outside = written(spark, _outside(rows), "html-outside")
    distinct = outside.groupBy("host", "digest").agg(F.min("path").alias("path"), F.first("own").alias("own"))
    order = ["host", "path", "digest"]
    sorted_pages = distinct.select(*order, "own").repartitionByRange(*order).sortWithinPartitions(*order)
    shape = f"host string, path string, digest binary, own {_LINES_SQL}, cut array<bigint>, task int, place string, near {_NEAR_SQL}"
    done = written(spark, sorted_pages.mapInArrow(_diffed, shape), "html-diff")

    ends = _ends_joined(spark, done.where("place is not null"))
    cuts = done.where("place is null").select("host", "digest", "cut").unionByName(
        ends.mapInArrow(_ends_cut, "host string, digest binary, cut array<bigint>").where("size(cut) > 0"))
    cuts = written(spark, cuts, "html-distinct-cuts")
    by_page = (outside.select("page_id", "url", "key", "host", "digest").distinct().join(cuts, ["host", "digest"])
               .select("page_id", "url", "key", "cut").toDF("_id", "_url", "_key", "cut"))
    by_page = written(spark, by_page, "html-cuts")  # its size is known to the plan: small, it is broadcast and no page moves
    joined = rows.join(by_page, F.expr("page_id <=> _id and url <=> _url and key = _key"), "left").select("page_id", "url", "html", "cut")
    texts = joined.mapInArrow(_texts, f"page_id {kind}, url string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
