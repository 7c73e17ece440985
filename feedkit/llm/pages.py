"""Main text of web pages: page structure, then differencing against the pages with the nearest URLs."""

from __future__ import annotations

import html
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import keep
from .words import column, text_slices

BLOCK_PAGES = 64  # pages of a host that are aligned in one task, with the first page of the next block

OUTSIDE, ARTICLE, DOUBT = 0, 1, 2  # where a block stands

DEEPEST = 10_000  # open elements that are told apart
ROW_BITS = 1 << 26  # of the rows that an alignment keeps

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S | re.I,
)
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = set("nav footer aside form button select option menu dialog".split())
_MARKED = set(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies disqus footer hidden "
    "menu modal nav navbar navigation newsletter notice notices popup promo related replies reply share sharing sidebar social "
    "sponsored subscribe widget".split()
)
# What names of page parts are made of besides: "share-buttons" is a part of the page, "widget-count" says what a text is about.
_PLAIN_PARTS = set(
    "area articles bar block body bottom box button buttons center column container content desktop dialog end fixed form global group head header "
    "heading icon icons inner item items left link links list main mobile outer overlay page panel post posts primary right row secondary "
    "section signup site slot small stories sticky tags text thread title tools top unit wrap wrapper zone".split()
)
_HEADINGS = {f"h{i}" for i in range(1, 7)}
# End tags that HTML lets a page leave out: a start tag closes an open element of these, unless one of the second lies between.
_ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "main menu nav ol p pre section summary table ul".split()
)
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
_KEEPS_P = {"table", "td", "th", "caption", "button", "object", "template"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}
_ATTR = re.compile(r"\b(class|id|role|aria-hidden|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)


def _unwanted(tag: str, attrs: str, inside: bool) -> bool:
    if tag in _DROPPED or (tag == "header" and not inside):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in _ROLES):
            return True
        if name == "class" and tag not in _HEADINGS and any(_names_a_part(c) for c in value.split()):
            return True
        if name == "id" and tag not in _HEADINGS and _names_a_part(value):
            return True
    return False


def _names_a_part(name: str) -> bool:
    """Whether a class or id names a part of a page that is no main text, and nothing else."""
    words = [w.rstrip("0123456789") for w in re.split(r"[\s_-]+", name)]
    words = [w for w in words if w]
    return any(w in _MARKED for w in words) and all(w in _MARKED or w in _PLAIN_PARTS for w in words)


def _implied(stack: list[str], tag: str) -> int:
    """How many open elements stay when ``tag`` begins: those it ends without an end tag go, and what is open in them."""
    keep = len(stack)
    if tag in _ENDS_P:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] == "p":
                keep = i
                break
            if stack[i] in _KEEPS_P:
                break
    closed, within = _ENDS.get(tag, (set(), set()))
    for i in range(keep - 1, -1, -1):
        if stack[i] in closed:
            keep = i
        elif stack[i] in within:
            break
    return keep


def _ended(stack: list[str], tag: str) -> int:
    """How many open elements stay after the end tag ``tag``. An inline one ends nothing beyond its own block."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i] == tag:
            return i
        if tag in _INLINE and stack[i] not in _INLINE:
            break
    return len(stack)


def blocks(page: str | None) -> tuple[list[str], bool]:
    """Text blocks of a page in order, and whether they are those of its article."""
    lines, marks, found = parts_of(page)
    return [b for b, m in zip(lines, marks) if m != OUTSIDE or not found], found


def _doubtful(attrs: str) -> bool:
    """Whether a class or id has a word for a part of a page that is no main text, beside words that name something else."""
    for name, *values in _ATTR.findall(attrs):
        if name.lower() in ("class", "id"):
            if any(w.rstrip("0123456789") in _MARKED for v in values if v for w in re.split(r"[\s_-]+", v.lower())):
                return True
    return False


def parts_of(page: str | None) -> tuple[list[str], list[int], bool]:
    """Text blocks of a page in order, what structure says of each, and whether the page has an article.

    A block stands outside of articles, is their text, or is in doubt: in an article, but all of it link text, or in an
    element whose name has a word for a part of a page among others.

    Elements that are never main text are left out, up to their end: their end tag, one that HTML implies, the end of an
    element around them, or the start of an article. With an article (or main) element, only what stands in one counts.
    An unfinished tag at the page's end is no text.
    """
    lines: list[str] = []
    marks: list[int] = []
    parts: list[str] = []
    links, plain, doubt = 0, False, 0  # open links; text beside links in this block; height of the stack below a doubtful name, plus one
    stack: list[str] = []  # open elements
    skip, inside, at = -1, 0, 0  # height of the stack below the element left out, or -1; articles open
    found = False

    def end() -> None:
        nonlocal plain
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                lines.append(text)
                marks.append(OUTSIDE if inside <= 0 else DOUBT if doubt or not plain else ARTICLE)
            parts.clear()
        plain = False

    page = page or ""

    def text(segment: str) -> None:
        nonlocal plain
        if segment and skip < 0:
            parts.append(html.unescape(segment) if "&" in segment else segment)
            plain = plain or not (links or segment.isspace())

    def shrink(to: int) -> None:
        nonlocal skip, inside, links, doubt
        if to < len(stack):
            links -= sum(t == "a" for t in stack[to:])
            if to < doubt:
                doubt = 0
            if skip < 0 or to <= skip:
                inside -= sum(t in ("article", "main") for t in stack[to : skip if skip >= 0 else None])
            del stack[to:]
            if to <= skip:
                skip = -1

    for m in _TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if m["raw"] or not tag:
            continue
        tag, closing = tag.lower(), bool(m["close"])
        if tag not in _INLINE and skip < 0:
            end()
        if closing:
            shrink(_ended(stack, tag))
            continue
        shrink(_implied(stack, tag))
        main = tag in ("article", "main")
        if skip >= 0 and main and not inside:
            skip = -1  # what was left open before the article does not hold it
        if skip < 0 and _unwanted(tag, m["attrs"], inside > 0):
            if tag in _VOID:
                continue
            end()
            skip = len(stack)
        elif skip < 0 and main:
            inside, found = inside + 1, True
        if tag not in _VOID and len(stack) < DEEPEST:
            stack.append(tag)
            links += tag == "a"
            if skip < 0 and inside and not main and not doubt and tag not in _HEADINGS and m["attrs"] and _doubtful(m["attrs"]):
                doubt = len(stack)
    text(page[at:])
    end()
    return lines, marks, found


def common(a: list, b: list) -> tuple[list[int], list[int]]:
    """Positions of a longest common subsequence in both lists, in memory that follows their lengths, not the product.

    Equal beginnings and ends are taken as they are; what is left is halved until its rows fit.
    """
    left, right = [], []

    def solve(lo: int, hi: int, start: int, stop: int) -> None:
        while lo < hi and start < stop and a[lo] == b[start]:
            left.append(lo), right.append(start)
            lo, start = lo + 1, start + 1
        tail = 0
        while lo < hi and start < stop and a[hi - 1] == b[stop - 1]:
            hi, stop, tail = hi - 1, stop - 1, tail + 1
        if lo < hi and start < stop:
            if (hi - lo) * (stop - start) <= ROW_BITS:
                i, j = _rows(a[lo:hi], b[start:stop])
                left.extend(lo + x for x in i), right.extend(start + x for x in j)
            elif hi - lo == 1:
                at = next((j for j in range(start, stop) if b[j] == a[lo]), -1)
                if at >= 0:
                    left.append(lo), right.append(at)
            else:
                half = (lo + hi) // 2
                before = _lengths(a[lo:half], b[start:stop])
                after = _lengths(a[half:hi][::-1], b[start:stop][::-1])[::-1]
                cut = start + int(np.argmax(before + after))
                solve(lo, half, start, cut)
                solve(half, hi, cut, stop)
        left.extend(range(hi, hi + tail)), right.extend(range(stop, stop + tail))

    solve(0, len(a), 0, len(b))
    return left, right


def _places(b: list) -> dict:
    where: dict = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    out = {}
    for x, at in where.items():
        bits = bytearray(at[-1] // 8 + 1)
        for j in at:
            bits[j >> 3] |= 1 << (j & 7)
        out[x] = int.from_bytes(bits, "little")
    return out


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the common subsequence of ``a`` with every beginning of ``b``."""
    where, full = _places(b), (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    steps = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)] == 0
    return np.concatenate(([0], np.cumsum(steps)))


def _rows(a: list, b: list) -> tuple[list[int], list[int]]:
    """The same with all rows at hand: bit j of a row tells a step at b[j]."""
    where, full = _places(b), (1 << len(b)) - 1
    row, rows = full, [full]
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)

    def length(row: int, upto: int) -> int:
        return upto - (row & ((1 << upto) - 1)).bit_count()

    i, j, left, right = len(a), len(b), [], []
    while i and j:
        if length(rows[i - 1], j) == length(rows[i], j):
            i -= 1
        elif length(rows[i], j - 1) == length(rows[i], j):
            j -= 1
        else:
            i, j = i - 1, j - 1
            left.append(i), right.append(j)
    return left[::-1], right[::-1]


def shared_lines(pages: list[tuple[list[int], list[int]]], copy_share: float = 0.8) -> list[set[int]]:
    """Per page, the lines that it shares with the page before or after it. A page is (line hashes, line lengths).

    Pages whose shared lines are most of the text of both are copies of one page, and keep them.
    """
    out: list[set[int]] = [set() for _ in pages]
    for p in range(len(pages) - 1):
        (a, a_size), (b, b_size) = pages[p], pages[p + 1]
        left, right = common(a, b)
        if not left:
            continue
        if sum(a_size[i] for i in left) >= copy_share * sum(a_size) and sum(b_size[j] for j in right) >= copy_share * sum(b_size):
            continue
        out[p] |= set(left)
        out[p + 1] |= set(right)
    return out


def _place(url: str | None) -> tuple[str | None, str]:
    try:
        parts = urlsplit(url or "")
    except ValueError:
        return None, ""
    return (parts.hostname or None), parts.path.rstrip("/")


_PARSED = "row long, page_id long, url string, host string, path string, article boolean, marks array<tinyint>, lines array<string>"


def parse(pages: DataFrame) -> DataFrame:
    """Blocks of every page, with a number of the row that stays once the result is written."""

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, urls, htmls = (column(batch, c) for c in ("page_id", "url", "html"))
            for a, b in text_slices(htmls, 2 << 20):
                got = [parts_of(h) for h in htmls.slice(a, b - a).to_pylist()]
                where = [_place(u) for u in urls.slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + b - a), pa.int64()),
                        ids.slice(a, b - a).cast(pa.int64()),
                        urls.slice(a, b - a).cast(pa.string()),
                        pa.array([h for h, _ in where], pa.string()),
                        pa.array([p for _, p in where], pa.string()),
                        pa.array([f for *_, f in got], pa.bool_()),
                        pa.array([m for _, m, _ in got], pa.list_(pa.int8())),
                        pa.array([x for x, *_ in got], pa.list_(pa.string())),
                    ],
                    ["row", "page_id", "url", "host", "path", "article", "marks", "lines"],
                )
                row += b - a

    return pages.select("page_id", "url", "html").mapInArrow(run, _PARSED)


def numbered(pages: DataFrame) -> DataFrame:
    """``pages`` (host, path, row, ...) with ``at``, the place of each in its host in path order.

    Places are counted per task of a range exchange and moved up by the counts of the tasks before, so a host with any
    number of pages is never in one task.
    """
    order = ["host", "path", "row"]

    def run(batches):
        from pyspark import TaskContext

        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            at = []
            for h in column(batch, "host").to_pylist():
                n = n + 1 if h == last else 0
                last = h
                at.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(at), part), pa.int32()), pa.array(at, pa.int64())], [*batch.schema.names, "part", "nth"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pages.schema.fields)
    local = keep(pages.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"{schema}, part int, nth long"), "url-order")
    counts = local.groupBy("host", "part").agg(F.count("*").alias("n"))  # one row per host and task
    before = Window.partitionBy("host").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("host", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return local.join(base, ["host", "part"]).withColumn("at", F.col("base") + F.col("nth")).drop("base", "nth", "part")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main ``text`` of every page (page_id, url, html).

    In path order within a host every page is aligned with the page before and after it, with all lines outside of menus
    and other parts named by their elements. Lines that both have in the same order are deleted, unless the two are
    copies. Of a page with an article (or main) element, what stands outside goes too, and lines that structure says
    to be the article's own text stay though a neighbour has them: only those in doubt, link lists and elements whose names have a word
    for a part of a page, are left to the alignment. Pages without a host are not compared. Null and empty pages have an
    empty text; repeated rows stay; other columns are not read.
    """
    parsed = keep(parse(pages), "pages")
    hashes = F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes")
    sizes = F.transform("lines", lambda x: F.length(x)).alias("sizes")
    comparable = parsed.filter("host IS NOT NULL AND size(lines) > 0").select("host", "path", "row", hashes, sizes)
    own = F.floor(F.col("at") / BLOCK_PAGES)
    # The first page of a block also ends the block before, so that every page is aligned with both neighbours.
    within = F.when((F.col("at") > 0) & (F.col("at") % BLOCK_PAGES == 0), F.array(own - 1, own)).otherwise(F.array(own))
    blocked = numbered(comparable).withColumn("block", F.explode(within))

    def align(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["at", "row", "hashes", "sizes"]).to_pylist(), key=lambda r: r["at"])
        gone = shared_lines([(r["hashes"], r["sizes"]) for r in rows])
        kept = [(r["row"], sorted(g)) for r, g in zip(rows, gone) if g]
        return pa.table([pa.array([r for r, _ in kept], pa.int64()), pa.array([g for _, g in kept], pa.list_(pa.int32()))], names=["row", "gone"])

    aligned = blocked.groupBy("host", "block").applyInArrow(align, "row long, gone array<int>")
    gone = keep(aligned.groupBy("row").agg(F.flatten(F.collect_list("gone")).alias("gone")), "shared-lines")
    compared = parsed.join(gone, "row", "left")
    deleted = lambda i: F.coalesce(F.array_contains("gone", i), F.lit(False))
    mark = lambda i: F.get("marks", i)
    left = F.filter("lines", lambda x, i: F.when(F.col("article"), (mark(i) == ARTICLE) | ((mark(i) == DOUBT) & ~deleted(i))).otherwise(~deleted(i)))
    return compared.select("page_id", "url", F.array_join(left, " ").alias("text"))
