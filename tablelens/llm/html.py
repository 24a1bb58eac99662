"""Main text of web pages.

All pages of a host are ordered by URL path, in chunks, and each is compared with its nearest neighbour, whatever chunk that is in: their lines
are aligned by a longest common subsequence, and shared lines are the host's template, which is
deleted.  A copy is no help there: the nearest page that differs is taken.  Two things differencing alone gets wrong are settled by the page's own structure: menus
and adverts that differ from page to page go by element, role or class; and lines inside an
``article`` or ``main`` element stay although a copy of the article stands on the neighbouring page.  What a page has outside of such an
element and does not share with its neighbour stays too, as a headline or a lead does.

Pages travel to the comparison as a hash and a length for each line; the answers, which lines are shared, are joined to the texts.
Near copies that follow each other are a run; a run that goes on over a chunk's end gets the pages before and after it from the other chunks.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence
from functools import reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelens.llm.common import prepared
from tablelens.llm.urls import host_of, path_of
from tablelens.plans.runtime import release, staged, written

#: Pages of a chunk, more if there would be more chunks than partitions; rows that a task hands on at a time.
CHUNK, EDGE = 1024, 128
#: Part of the characters from which pages are the same but for a date or a counter.
SAME = 0.9

#: Elements whose content is no markup, and the start of a tag.
RAW = frozenset("script style noscript template svg iframe textarea select title canvas object".split())
START = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
PLAIN_PART = re.compile(r"[^'\">]*")
ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label|hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math meter q rp rt ruby s samp"
    " small source span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold main text, and words of classes, ids and roles that say the same.
REMOVED = frozenset("nav footer aside form button dialog menu head input option fieldset".split())
REMOVED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promotions menu nav navbar"
    " navigation navi sidebar sidebars widget widgets footer masthead topbar breadcrumb breadcrumbs cookie cookies consent gdpr"
    " notice notices notification alert popup modal overlay newsletter subscribe subscription signup share sharing social comment"
    " comments commentlist disqus reply replies respond related recommended recommendations pagination pager toolbar search login"
    " contentinfo complementary banner dialog".split()
)
#: Words that name a container, as in "sidebar-wrapper": it stays when it holds the article or main element.
CONTAINER_WORDS = frozenset("content main wrapper wrap container layout page body site app root".split())
#: Words that only say what part of something a name is for; inside the article any other word makes the name the text's own.
PART_WORDS = CONTAINER_WORDS | frozenset(
    "area bar block bottom box button buttons center column count div element footer form frame group head header heading holder icon icons"
    " info inner input item items label large left line link links list media meta mobile module outer panel post row section"
    " slot small space story text title top unit view wide widget zone right desktop inline native the this a b c js".split()
)
#: A name that ends with these is the whole page's, as in "sidebar-layout".
PAGE_WORDS = frozenset("layout page".split())
#: What follows in a name is only said to be there or not, as in "has-sidebar".
WITH_WORDS = frozenset("has with without no".split())
PAGE_HEADERS = frozenset(("header",))
MAIN = frozenset(("article", "main"))


def tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, closing, name, attributes) of each tag in one pass; comments and raw elements have no name.

    A quote that is never closed swallows nothing: its tag ends at the next ``>``, and from then on quotes are
    not looked at, so that no page is scanned twice.  After the last ``>`` there are no tags.
    """
    at, last, quotes = 0, page.rfind(">"), True
    while True:
        at = page.find("<", at)
        if at < 0:
            return
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            yield at, (len(page) if end < 0 else end + 3), False, "", ""
            at = len(page) if end < 0 else end + 3
            continue
        if at > last:
            return
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1
            yield at, end, False, "", ""
            at = end
            continue
        m = START.match(page, at)
        if not m:
            at += 1
            continue
        end = _tag_end(page, m.end(), last) if quotes else -1
        if end < 0:
            quotes = False
            end = page.find(">", m.end())
        closing, name, attributes = bool(m.group(1)), m.group(2).lower(), page[m.end() : end]
        end += 1
        if name in RAW and not closing:
            close = RAW_END[name].search(page, end, last + 1)
            end = close.end() if close else len(page)
            yield at, end, False, "", ""
        else:
            yield at, end, closing, name, attributes
        at = end


def _tag_end(page: str, at: int, last: int) -> int:
    """The first ``>`` outside of quotes, or -1."""
    while at <= last:
        at = PLAIN_PART.match(page, at).end()
        if at > last or page[at] == ">":
            return at if at <= last else -1
        at = page.find(page[at], at + 1) + 1
        if not at:
            return -1
    return -1


#: What ends an element whose end tag may be left out, besides the end of the element around it.
_BLOCKS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
ENDED_BY = {
    "p": _BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
}


class Removed:
    """An element that holds no main text, up to where it ends."""

    def __init__(self, tag: str):
        self.tag, self.depth, self.inner = tag, 1, []

    def ends(self, tag: str, closing: bool, attributes: str, main: list[str]) -> str:
        """``no``, ``after`` (this tag is its end) or ``before`` (this tag is no part of it)."""
        open_tag = tag not in VOID and not attributes.endswith("/")
        if closing and (tag == "body" or (main and tag == main[-1])):
            return "before"
        if self.tag not in ENDED_BY:
            if tag == self.tag and open_tag:
                self.depth += -1 if closing else 1
            return "no" if self.depth else "after"
        if tag in INLINE:
            return "no"
        if not closing:
            while self.inner and tag in ENDED_BY.get(self.inner[-1], ()):
                self.inner.pop()
            if not self.inner and tag in ENDED_BY[self.tag]:
                return "before"
            if open_tag:
                self.inner.append(tag)
            return "no"
        if tag in self.inner:
            while self.inner.pop() != tag:
                pass
            return "no"
        return "after" if tag == self.tag else "before"


def _names_removed(value: str, in_main: bool, holds_main: Callable[[], bool]) -> bool:
    """Whether a class, id or role says that an element holds no main text."""
    held, named = set(), False
    for name in value.split():
        words = [w.rstrip("0123456789") or w for w in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w]
        held.update(words)
        at = next((i for i, w in enumerate(words) if w in WITH_WORDS), len(words))
        if not in_main and words and words[-1] in PAGE_WORDS:
            continue
        said = set(words[:at])
        removed = said & REMOVED_WORDS
        if in_main and any(w not in REMOVED_WORDS and w not in PART_WORDS and not w.isdigit() for w in said):
            removed = set()  # it speaks of something, as search-engines and share-of-gdp do
        named = named or bool(removed or (not in_main and said & PAGE_HEADERS))
    return named and not (held & CONTAINER_WORDS and holds_main())


def main_holders(page: str) -> set[int]:
    """Where the elements start that hold an article or main element, comments aside."""
    found: set[int] = set()
    if not re.search("<(?:article|main)", page, re.I):
        return found
    opened: list[tuple[str, int]] = []
    counts: Counter = Counter()
    marked = 0  # so many of the opened ones are found already
    for start, _, closing, tag, attributes in tags(page):
        if not tag or tag in VOID or tag in INLINE:
            continue
        if closing:
            if counts[tag]:
                while True:
                    last = opened.pop()[0]
                    counts[last] -= 1
                    if last == tag:
                        break
                marked = min(marked, len(opened))
            continue
        if tag in MAIN and "omment" not in attributes:
            found.update(at for _, at in opened[marked:])
            marked = len(opened)
        if not attributes.endswith("/"):
            opened.append((tag, start))
            counts[tag] += 1
    return found


def _is_removed(tag: str, attributes: str, in_main: bool, holds_main: Callable[[], bool]) -> bool:
    if tag in REMOVED or (tag in PAGE_HEADERS and not in_main):
        return True
    if tag in MAIN and not in_main and "omment" not in attributes:
        return False
    if not attributes.strip() or tag in ("html", "body"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" and not value:
            return True
        if name in ("class", "id", "role") and _names_removed(value, in_main, holds_main):
            return True
    return False


def blocks(page: str) -> list[tuple[str, bool]]:
    """(text, inside the main element) of each block in page order, without what the structure rules out."""
    out: list[tuple[str, bool]] = []
    current: list[str] = []
    at, main = 0, []
    removed: Removed | None = None
    holders: list[set[int]] = []  # looked for when a name asks for it

    def holds_main() -> bool:
        if not holders:
            holders.append(main_holders(page))
        return start in holders[0]

    def close():
        if current:
            text = " ".join("".join(current).split())
            if text:
                out.append((text, bool(main)))
            current.clear()

    for start, end, closing, tag, attributes in tags(page):
        if not removed and start > at:
            current.append(html.unescape(page[at:start]))
        at = end
        if not tag:
            continue
        if removed:
            how = removed.ends(tag, closing, attributes, main)
            if how != "no":
                removed = None
            if how != "before":
                continue
        if tag not in INLINE:
            close()
        if closing:
            if tag in main:
                del main[len(main) - 1 - main[::-1].index(tag) :]
            continue
        if tag in VOID:
            continue
        if _is_removed(tag, attributes, bool(main), holds_main):
            if not attributes.endswith("/"):
                close()
                removed = Removed(tag)
            continue
        if tag in MAIN:
            main.append(tag)
    if not removed and at < len(page):
        rest = page[at:]
        # an unfinished tag at the end of a cut-off page is no text
        cut = re.search(r"<[a-zA-Z/!][^<>]*$", rest)
        current.append(html.unescape(rest[: cut.start()] if cut else rest))
    close()
    return out


def common_lines(a: Sequence, b: Sequence) -> set[int]:
    """Indexes of the lines of ``a`` in a longest common subsequence with ``b``; long equal ends are matched first."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = set(range(head)) | set(range(len(a) - tail, len(a)))
    places: dict[Hashable, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []  # smallest end in b of a common subsequence of each length
    links: list[tuple] = []
    for i in range(head, len(a) - tail):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            elif j < ends[k]:
                ends[k], links[k] = j, link
    link = links[-1] if links else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


#: A line on its way to the comparison: a hash of its text, and its characters.
LINE = np.dtype([("hash", "<u8"), ("chars", "<u4")])


def marks(lines: Sequence[str]) -> bytes:
    import xxhash

    return np.array([(xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")), len(t)) for t in lines], LINE).tobytes()


def shared_part(a: Sequence[tuple[int, int]], b: Sequence[tuple[int, int]]) -> float:
    """Characters of common lines, as a part of the longer page's."""
    size = max(sum(n + 1 for _, n in x) for x in (a, b))
    return sum(a[i][1] + 1 for i in common_lines(a, b)) / max(size, 1)


def main_text(lines: Sequence[str], main: list[bool], shared: Sequence[int] | None) -> str:
    """The page's own lines: those of its main element, and those that its neighbour does not share.

    Without a neighbour the main element's only, if it has one.
    """
    gone = set(shared) if shared is not None else set(range(len(lines))) if any(main) else set()
    return "\n".join(t for i, (t, m) in enumerate(zip(lines, main, strict=True)) if m or i not in gone)


ORDER = ["host", "path", "page_id", "tie"]
#: What a task says of a chunk: pages with an answer have no ``edge``; those of its first and last run, of which more may stand in
#: other chunks, have ``first`` and ``last``.  Single pages: its first and last, the one after the first run, the one before the last run, the first of the last run.
DEALT = "chunk int, edge string, at long, page_id long, tie long, shared array<int>, host string, path string, marks binary"
SINGLE = ("begin", "end", "after", "before", "open")


def in_chunks(pages: DataFrame) -> DataFrame:
    """The pages in the order of ``ORDER``, cut into ranges of about CHUNK, with the number of their ``chunk``.

    Pages are cut by ranges of the order, whatever their number, so a host is spread over many chunks.
    """
    spark = pages.sparkSession
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    chunks = max(1, min(-(-pages.count() // CHUNK), most))
    return pages.repartitionByRange(chunks, *ORDER).sortWithinPartitions(*ORDER).withColumn("chunk", F.spark_partition_id())


def lines_of(marked: bytes) -> tuple:
    return tuple(np.frombuffer(marked, LINE).tolist())


def goes_on(first: dict, page: dict) -> bool:
    """Whether a page is of the run that began with ``first``: of the same host, with nearly the same lines."""
    if first["host"] != page["host"]:
        return False
    return first["marks"] == page["marks"] or shared_part(lines_of(first["marks"]), lines_of(page["marks"])) >= SAME


def likeness(other: dict | None, host: str, path: str) -> int:
    if other is None or other["host"] != host:
        return -1
    n = 0
    while n < min(len(other["path"]), len(path)) and other["path"][n] == path[n]:
        n += 1
    return n


def beside_of(lines: tuple, others: Iterable[bytes | None]) -> list[int] | None:
    """The lines shared with the one of the others that is least alike."""
    other = min((lines_of(m) for m in others if m is not None), key=lambda x: shared_part(lines, x), default=None)
    return sorted(common_lines(lines, other)) if other else None


def answers(before: dict | None, host: str, run: dict[bytes, list[tuple]], after: dict | None, whole: bool = True) -> Iterator[tuple]:
    """(page_id, tie, shared) of a run's pages: compared with the page before or after it, whose path starts more alike.

    A ``whole`` run without both is all of its host; pages with other lines in it take their place, and one that only has copies has no answer.
    """
    held = list(run)
    for i, (marked, rows) in enumerate(run.items()):
        lines, made = lines_of(marked), {}
        for page_id, tie, path in rows:
            a, b = likeness(before, host, path), likeness(after, host, path)
            side = None if max(a, b) < 0 else a >= b
            if side not in made:
                if side is None:
                    made[side] = beside_of(lines, [held[j] for j in (i - 1, i + 1) if 0 <= j < len(held)]) if whole else None
                else:
                    made[side] = sorted(common_lines(lines, lines_of((before if side else after)["marks"])))
            yield page_id, tie, made[side]


def walked(chunk: int, pages: Iterator[dict], first: dict | None) -> Iterator[tuple]:
    """Rows of ``DEALT`` of a chunk's pages in order; ``first`` began the run that goes on from the chunk before."""

    def single(edge, page):
        return chunk, edge, None, None, None, None, page["host"], page["path"], page["marks"]

    def page_of_run(edge, at, page_id, tie, host, path, marked):
        return chunk, edge, at, page_id, tie, None, host, path, marked

    before, last, run, at_start = None, None, {}, True
    at = 0
    for page in pages:
        if last is None:
            yield single("begin", page)
            first = first or page
        elif not (page["host"] == first["host"] and page["marks"] in run) and not goes_on(first, page):
            if at_start:
                yield single("after", page)
            else:
                for row in answers(before, first["host"], {m: [r[1:] for r in rows] for m, rows in run.items()}, page):
                    yield chunk, None, None, *row, None, None, None
            before, first, run, at_start = last, page, {}, False
        if at_start:
            yield page_of_run("first", at, page["page_id"], page["tie"], page["host"], page["path"], page["marks"])
        else:
            run.setdefault(page["marks"], []).append((at, page["page_id"], page["tie"], page["path"]))
        last, at = page, at + 1
    if last is None:
        return
    yield single("end", last)
    yield single("open", first)
    if not at_start:
        yield single("before", before)
        for marked, rows in run.items():
            for at, page_id, tie, path in rows:
                yield page_of_run("last", at, page_id, tie, first["host"], path, marked)


def in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= EDGE:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def arrow_schema(fields: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (f.split() for f in fields.split(", "))])


def walk(ordered: DataFrame, firsts: dict[int, dict]) -> DataFrame:
    """``walked`` for each chunk of pages sorted by chunk and order, as a written table."""
    schema = arrow_schema(DEALT)

    def rows(batches):
        pages = (row for batch in batches for row in batch.to_pylist())
        for chunk, own in groupby(pages, itemgetter("chunk")):
            yield from walked(chunk, own, firsts.get(chunk))

    return written(ordered.select("chunk", "page_id", "tie", "host", "path", "marks").mapInArrow(lambda batches: in_batches(rows(batches), schema), DEALT), "dealt")


def chunk_ends(dealt: DataFrame) -> dict[int, dict[str, dict]]:
    """The single pages of each chunk."""
    found: dict[int, dict[str, dict]] = {}
    for row in dealt.filter(F.col("edge").isin(*SINGLE)).collect():  # five pages a chunk at most
        found.setdefault(row["chunk"], {})[row["edge"]] = {"host": row["host"], "path": row["path"], "marks": bytes(row["marks"])}
    return found


def compared(pages: DataFrame) -> DataFrame:
    """(page_id, tie, shared): what each page shares with the nearest one that differs, the one whose path starts more alike.

    Rows that follow each other with nearly the same lines (copies, mirrors, other query strings) are a
    run; its pages are compared with the last page before and the first one after it, however many pages and chunks the run has.  If a host
    is one run, those with other lines in it take their place.

    A chunk is walked as if a run began with it.  Where the last run of the chunk before goes on, it is walked again from that
    run's first page, until no chunk's start depends on a wrong guess.
    """
    spark = pages.sparkSession
    tables = [walk(in_chunks(pages), {})]
    ends = chunk_ends(tables[0])
    order = sorted(ends)
    table, entered = dict.fromkeys(order, 0), dict.fromkeys(order)
    place = F.struct(*ORDER)
    starts = tables[0].filter("at = 0").select("chunk", F.struct("host", "path", "page_id", "tie").alias("start"))
    while True:
        again, first = {}, None
        for number, chunk in enumerate(order):
            enter = first if first and goes_on(first, ends[chunk]["begin"]) else None
            first = ends[chunk]["open"]
            if (enter and enter["marks"]) != (entered[chunk] and entered[chunk]["marks"]):
                again[chunk] = enter
                # a run that reaches the next chunk's start is taken to fill this one, until the chunk is walked
                if enter and number + 1 < len(order) and goes_on(enter, ends[order[number + 1]]["begin"]):
                    first = enter
        if not again:
            break
        bounds = {r["chunk"]: r["start"] for r in starts.collect()}  # a row a chunk

        def bound(chunk):
            return F.struct(*[F.lit(bounds[chunk][c]).cast(pages.schema[c].dataType).alias(c) for c in ORDER])

        following = dict(zip(order, order[1:], strict=False))
        own = [(c, (place >= bound(c)) & (place < bound(following[c]) if c in following else F.lit(True))) for c in again]
        which = reduce(lambda made, x: made.when(x[1], F.lit(x[0])), own[1:], F.when(own[0][1], F.lit(own[0][0])))
        some = pages.withColumn("chunk", which).filter("chunk is not null").repartition("chunk").sortWithinPartitions("chunk", *ORDER)
        tables.append(walk(some, {c: f for c, f in again.items() if f}))
        ends |= chunk_ends(tables[-1])
        table |= dict.fromkeys(again, len(tables) - 1)
        entered |= again

    dealt = reduce(DataFrame.unionByName, [t.filter(F.col("chunk").isin([c for c in order if table[c] == k])) for k, t in enumerate(tables)])
    runs, parts, run, end = [], {}, None, None
    for chunk in order:
        has = ends[chunk]
        if not entered[chunk]:
            if run:
                run["after"] = has["begin"]
            runs.append(run := {"host": has["begin"]["host"], "before": end, "after": None})
        parts[chunk, "first"] = len(runs) - 1
        if "after" in has:
            run["after"] = has["after"]
            runs.append(run := {"host": has["open"]["host"], "before": has["before"], "after": None})
            parts[chunk, "last"] = len(runs) - 1
        end = has["end"]
    answered = arrow_schema("page_id long, tie long, shared array<int>")

    def settled(batches):
        for batch in batches:
            for row in batch.to_pylist():
                run = runs[parts[row["chunk"], row["edge"]]]
                yield from answers(run["before"], row["host"], {row["marks"]: [(row["page_id"], row["tie"], row["path"])]}, run["after"], whole=False)

    edges = dealt.filter(F.col("edge").isin("first", "last"))
    shape = "page_id long, tie long, shared array<int>"
    found = dealt.filter("edge is null").select("page_id", "tie", "shared")
    found = found.unionByName(edges.mapInArrow(lambda batches: in_batches(settled(batches), answered), shape))
    alone = {k for k, r in enumerate(runs) if all(x is None or x["host"] != r["host"] for x in (r["before"], r["after"]))}
    whole = [(*part, k) for part, k in parts.items() if k in alone]
    if not whole:
        return found
    # runs that are all of their host
    rows = edges.join(F.broadcast(spark.createDataFrame(whole, "chunk int, edge string, run long")), ["chunk", "edge"])
    others = rows.groupBy("run", "marks").agg(F.min(F.struct("chunk", "at")).alias("place"))
    sides = Window.partitionBy("run").orderBy("place")
    others = others.withColumn("left", F.lag("marks").over(sides)).withColumn("right", F.lead("marks").over(sides)).filter("left is not null or right is not null")
    kept = pa.schema([("run", pa.int64()), ("marks", pa.binary()), ("shared", pa.list_(pa.int32()))])

    def beside(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield row["run"], row["marks"], beside_of(lines_of(row["marks"]), [row["left"], row["right"]])

    others = others.select("run", "marks", "left", "right").repartition("run", "marks").mapInArrow(lambda batches: in_batches(beside(batches), kept), "run long, marks binary, shared array<int>")
    return found.unionByName(rows.select("run", "marks", "page_id", "tie").join(others, ["run", "marks"]).select("page_id", "tie", "shared"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text (blocks joined by line feeds).

    Every page with a host is compared with its neighbour. A null or empty page has an empty text; pages without a host have no neighbour; ties of path go
    by id, then row hash; a repeated row or a near copy is passed over for the nearest page that differs; an empty
    table gives no rows.
    """
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{page}`"), F.lit("")).alias("html"))
    rows = rows.select("page_id", "url", F.xxhash64(F.coalesce("url", F.lit("")), "html").alias("tie"), "html")
    marked = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("tie", pa.int64()), ("marks", pa.binary())])
    shape = "page_id long, url string, tie long"

    def mark(batches):
        """The lines of all pages with a host, for the comparison."""
        for batch in batches:
            held = [i for i, u in enumerate(batch.column(1).to_pylist()) if re.search("^[^:]*(?::(?!//)[^:]*)*://[^/?#]", u or "")]
            batch = batch.take(pa.array(held, pa.int64()))
            found = [marks([t for t, _ in blocks(p)]) for p in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())], schema=marked).filter(pa.array([x != b"" for x in found], pa.bool_()))

    held = len(staged())
    lines = written(prepared(rows).mapInArrow(mark, f"{shape}, marks binary"), "lines")  # the order takes two looks at them
    answers = compared(lines.select("page_id", "marks", "tie", host_of("url").alias("host"), path_of("url").alias("path")))
    # rows that are the same in all columns have one answer
    answers = answers.filter("shared is not null").groupBy("page_id", "tie").agg(F.min("shared").alias("shared"))
    on_the_way = staged()[held:]
    answers = written(answers, "shared")
    release(pages.sparkSession, on_the_way)

    parsed = pa.schema([*list(marked)[:3], ("lines", pa.list_(pa.string())), ("main", pa.list_(pa.bool_()))])
    text = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def parse(batches):
        for batch in batches:
            found = [blocks(p) for p in batch.column(3).to_pylist()]
            columns = [pa.array([[x[k] for x in f] for f in found], parsed.field(3 + k).type) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], schema=parsed)

    def cut(batches):
        for batch in batches:
            found = [main_text(*row) for row in zip(*[batch.column(k).to_pylist() for k in (2, 3, 4)], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.string())], schema=text)

    texts = prepared(rows).mapInArrow(parse, f"{shape}, lines array<string>, main array<boolean>").alias("t")
    same = F.col("t.page_id").eqNullSafe(F.col("a.page_id")) & (F.col("t.tie") == F.col("a.tie"))
    joined = texts.join(answers.alias("a"), same, "left").select("t.page_id", "t.url", "t.lines", "t.main", "a.shared")
    return joined.mapInArrow(cut, "page_id long, url string, text string")
