"""Main text of web pages by differencing with the page of the nearest URL.

A page becomes lines, one per block element, with character references decoded and white space
folded. Scripts, styles, forms, navigation and whatever else markup declares not to be content are
left out on the way. Pages of a host are sorted by path, each is paired with the neighbour that
shares the longest beginning of the path, and the lines that a longest common subsequence aligns are
deleted, being the frame that both share. Two things are protected, since copies and stock phrases
are text all the same: lines inside an article or main element, and pages that are mostly equal, which
are compared with the nearest page beyond their copies instead. What
stands outside such elements is left out only if, less the shared lines, it is the smaller part of
the page's text; else the element is a teaser or a caption, and both are the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomframe.llm.common import cut_lineage, slices
from loomframe.operators.joins import lookup
from loomframe.operators.ordering import Running, row_index, running

#: A page of whose text, or of the neighbour's if that is longer, so much aligns may be a copy; other pages tell then.
COPY_SHARE = 0.6
#: Where all pages of a host may be copies of each other, lines that so many different ones hold are the frame.
SEVERAL = 3

# Names of HTML elements and common words of class and id attributes.
RAW = frozenset("script style noscript template textarea iframe object svg math audio video canvas select title".split())
DROPPED = frozenset("nav footer aside form menu dialog button fieldset datalist head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTENT = frozenset("article main".split())
FRAME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer "
    "gdpr masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted related "
    "respond share sharing sidebar skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Of these, words of what readers, advertisers and networks add: it is left out whatever it holds and however long it is.
ADDED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments disqus promo promoted respond share sharing sponsor sponsored".split()
)
#: Words that make a name one of layout: of pages that have, lack or surround such parts.
LAYOUT_WORDS = frozenset("disabled enabled free has hide inner layout no off on open outer page show with without wrap wrapper".split())
#: What may stand before "header" in the name of a page's head.
WHOLE_WORDS = frozenset("global main page site top".split())
FRAME_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass(frozen=True)
class Line:
    """One block's text, and whether it stands inside an article or main element."""

    text: str
    content: bool


def _word_of(name: str, header: bool) -> str | None:
    """The frame word that a class or id name begins or ends with ("cookie-notice", "comment-list", "site-footer"), if any.

    Names with a word of layout ("has-sidebar", "ad-free") have none.
    """
    parts = [p for p in re.split(r"[^a-z0-9]+", name) if p]
    if not parts:
        return None
    if header and parts[-1] == "header" and WHOLE_WORDS.issuperset(parts[:-1]):
        return "header"
    if LAYOUT_WORDS.intersection(parts):
        return None
    return next((p for p in (parts[0], parts[-1]) if p in FRAME_WORDS), None)


#: Elements that are named for what they hold; even one that holds most of the text is left out.
NAMED = frozenset("nav footer aside menu dialog button datalist".split())
HARD, SOFT = "hard", "soft"


def _frame(name: str, attributes: str, in_content: bool) -> str | None:
    """Does this element hold something else than the main text: surely (hard), or unless it is the body (soft)?"""
    if name in NAMED:
        return HARD
    found = SOFT if name in DROPPED or (name == "header" and not in_content) else None
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return found
    for item in _ATTRIBUTE.finditer(attributes):
        key, value = item[1].lower(), (item[2] or item[3] or item[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return HARD
        if key in ("class", "id") and name not in ("html", "body"):
            for word in filter(None, (_word_of(n, name not in CONTENT and not in_content) for n in value.split())):
                if word in ADDED_WORDS:
                    return HARD
                found = SOFT
        if key == "role" and FRAME_ROLES.intersection(re.split(r"[^a-z0-9]+", value)):
            found = SOFT
    return found


@dataclass
class Open:
    """An element that matters: frame of either kind or content; ``depth`` counts elements of its name that are open in it."""

    name: str
    kind: str | None
    soft: int  # number of the innermost soft frame, this one included
    content: bool
    depth: int = 1


class Outline:
    """One pass over a page: its lines, each with the innermost soft frame that it stands in."""

    def __init__(self, page: str):
        self.page = page
        self.lines: list[tuple[Line, int]] = []
        self.above = [-1]  # of each soft frame, the one around it; number 0 is the page
        self.holds = [0]  # content elements right in a soft frame, not in one inside it
        self.stack: list[Open] = []
        self.places: dict[str, list[int]] = {}  # of each name, where it is on the stack
        self.hard = self.content = 0  # how many of them are open
        self.words: list[str] = []
        self._read()

    def _close_line(self) -> None:
        if self.words:
            text = " ".join(html.unescape("".join(self.words)).split())
            if text:
                self.lines.append((Line(text, self.content > 0), self._soft()))
            self.words.clear()

    def _soft(self) -> int:
        return self.stack[-1].soft if self.stack else 0

    def _push(self, name: str, kind: str | None) -> None:
        soft = self._soft()
        content = name in CONTENT and kind != HARD
        if kind == SOFT:
            self.above.append(soft)
            self.holds.append(0)
            soft = len(self.above) - 1
        self.holds[soft] += content
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append(Open(name, kind, soft, content))
        self.hard += kind == HARD
        self.content += content

    def _pop_to(self, size: int) -> None:
        while len(self.stack) > size:
            gone = self.stack.pop()
            self.places[gone.name].pop()
            self.hard -= gone.kind == HARD
            self.content -= gone.content

    def _end(self, name: str) -> None:
        if name in ("body", "html"):
            self._pop_to(0)
        elif self.places.get(name):
            at = self.places[name][-1]
            self.stack[at].depth -= 1
            if not self.stack[at].depth:
                self._pop_to(at)  # elements in it that were never closed end here as well

    def _begin(self, name: str, attributes: str) -> None:
        kind = None if self.hard else _frame(name, attributes, self.content > 0)
        if kind:
            self._close_line()
        if kind or name in CONTENT and not self.hard:
            self._push(name, kind)
        elif self.places.get(name):
            self.stack[self.places[name][-1]].depth += 1

    def _read(self) -> None:
        page, at, end = self.page, 0, len(self.page)
        while at < end:
            found = _TOKEN.search(page, at)
            stop = found.start() if found else end
            if stop > at and not self.hard:
                self.words.append(page[at:stop])
            if not found:
                break
            at = found.end()
            closing, name = (found[1], found[2]) if found[2] else (found[4], found[5])
            if not name:
                if not self.hard and found[0].startswith("<![CDATA["):
                    self.words.append(html.escape(found[0][9:].removesuffix("]]>")))
                continue
            name = name.lower()
            attributes = found[3] or found[6] or ""
            if name in BLOCKS and not self.hard:
                self._close_line()
            if closing:
                if self.places.get(name) or name in ("body", "html"):
                    if not self.hard:
                        self._close_line()
                    self._end(name)
            elif name in RAW:
                at = _after_raw(page, at, name, attributes)
            elif name not in VOID and not attributes.endswith("/"):
                if name == "body" and self.places.get("head"):
                    self._pop_to(self.places["head"][-1])
                self._begin(name, attributes)
        self._close_line()

    def kept(self) -> list[Line]:
        """Lines outside soft frames, and of those frames that hold the body: more than half of the text, and either
        content elements or what the page has none of outside. Such frames lie in each other, the outermost first."""
        sizes = [0] * len(self.above)
        for line, soft in self.lines:
            sizes[soft] += len(line.text)
        total, holds = list(sizes), list(self.holds)
        for soft in range(len(sizes) - 1, 0, -1):
            total[self.above[soft]] += total[soft]
            holds[self.above[soft]] += holds[soft]
        spared, outside = {0}, self.holds[0] > 0
        for soft in range(1, len(total)):
            if self.above[soft] in spared and 2 * total[soft] > total[0] and (holds[soft] or not outside):
                spared.add(soft)
                outside = outside or self.holds[soft] > 0
        return [line for line, soft in self.lines if soft in spared]


def lines_of(page: str | None) -> list[Line]:
    """Lines of a page in order, without what markup declares to be something else.

    Hidden elements, navigation, comments, adverts and share buttons are always left out. Any other
    element named as frame stays if it holds the body of the page, see :meth:`Outline.kept`.
    """
    return Outline(page or "").kept()


def _after_raw(page: str, at: int, name: str, attributes: str) -> int:
    if attributes.endswith("/"):
        return at
    found = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(page, at)
    return found.end() if found else len(page)


def aligned(one: list[int], two: list[int]) -> list[int]:
    """Places in ``one`` on a longest common subsequence with ``two``; memory is one bit per pair of lines.

    Equal beginnings and ends are taken first. Of equally long alignments the one that moves forward
    in ``one`` last is taken, so the result is the same everywhere.
    """
    head = 0
    while head < min(len(one), len(two)) and one[head] == two[head]:
        head += 1
    tail = 0
    while tail < min(len(one), len(two)) - head and one[-1 - tail] == two[-1 - tail]:
        tail += 1
    a, b = np.array(one[head : len(one) - tail], np.int64), np.array(two[head : len(two) - tail], np.int64)
    kept = np.isin(a, b)
    where = np.flatnonzero(kept)
    a, b = a[kept], b[np.isin(b, a)]
    lengths = np.zeros(len(b) + 1, np.int32)
    grew = np.zeros((len(a), len(b) + 1), bool)
    for i, x in enumerate(a):
        longer = lengths.copy()
        longer[1:] = np.maximum(lengths[1:], np.where(b == x, lengths[:-1] + 1, 0))
        longer = np.maximum.accumulate(longer)
        grew[i] = longer > lengths
        lengths = longer
    middle, j = [], len(b)
    for i in range(len(a) - 1, -1, -1):
        if grew[i, j]:
            middle.append(head + int(where[i]))
            j = int(np.flatnonzero(b[:j] == a[i])[-1])
    return [*range(head), *middle[::-1], *range(len(one) - tail, len(one))]


def shared_lines(one: list[int], sizes: list[int], two: list[int], their_sizes: list[int]) -> tuple[list[int], bool]:
    """Lines of a page that its neighbour shares, and whether the two may be copies: mostly equal, or nothing is left."""
    found = aligned(one, two)
    hit, total = sum(sizes[i] for i in found), sum(sizes)
    return found, hit == total or hit > COPY_SHARE * max(total, sum(their_sizes))


def main_text(lines: list[Line], shared: list[int]) -> str:
    """Lines inside content elements, and the unshared others unless they are the smaller part."""
    gone = set(shared)
    kept = [line for i, line in enumerate(lines) if line.content or i not in gone]
    if not _is_open(kept):
        kept = [line for line in kept if line.content]
    return "\n".join(line.text for line in kept)


def _is_open(lines: list[Line]) -> bool:
    """Is there more text outside content elements than inside? Else differencing can't change the text."""
    return sum(-len(line.text) if line.content else len(line.text) for line in lines) > 0


def url_key(url: str | None) -> tuple[str, str] | None:
    """Host and path of a URL; scheme, port, query and fragment do not count."""
    found = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)[^/?#]*([^?#]*)", url or "")
    return (found[1].lower(), found[2] or "/") if found else None


def _outline(pages: DataFrame) -> DataFrame:
    """``id, host, path, open, lines, sizes``: hashed lines of each page; ``open`` pages have most text outside content elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            urls = [url_key(u) for u in batch.column("url").to_pylist()]
            found = [lines_of(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([u[0] if u else None for u in urls], pa.string()),
                    pa.array([u[1] if u else None for u in urls], pa.string()),
                    pa.array([_is_open(f) for f in found]),
                    pa.array([[_line_hash(x.text) for x in f] for f in found], pa.list_(pa.int64())),
                    pa.array([[len(x.text) for x in f] for f in found], pa.list_(pa.int32())),
                ],
                names,
            )

    names = ["id", "host", "path", "open", "lines", "sizes"]
    return pages.mapInArrow(run, "id long, host string, path string, open boolean, lines array<long>, sizes array<int>")


def _line_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _with_common(pairs: DataFrame) -> DataFrame:
    """Add ``common``, the length of the common beginning of ``path`` and ``path0``, by halving."""
    common = F.lit(0)
    for step in (4096, 2048, 1024, 512, 256, 128, 64, 32, 16, 8, 4, 2, 1):
        further = common + step
        fits = (further <= F.length("path")) & (F.substring("path", F.lit(1), further) == F.substring("path0", F.lit(1), further))
        pairs = pairs.withColumn("common", common + F.when(fits, step).otherwise(0))
        common = F.col("common")
    return pairs


def _neighbours(outline: DataFrame) -> DataFrame:
    """``id, other``: for each page the page before or after it in its host's order that shares more of the path.

    The table is range-partitioned, so one host may spread over many tasks; pairs across two
    neighbouring ranges are made from the first and last page of each, two rows per range.
    """
    sorted_pages = (
        outline.where("id is not null and host is not null").select("host", "path", "id").distinct()
        .repartitionByRange("host", "path", "id").sortWithinPartitions("host", "path", "id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            rows = []
            for page in zip(*[batch.column(c).to_pylist() for c in ("host", "path", "id")]):
                rows.append((part, last is None, *page, *(last or (None,) * 3)))
                last = page
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, False, None, None, None, *last), types)], names)

    names = ["part", "first", "host", "path", "id", "host0", "path0", "id0"]
    types = [pa.int32(), pa.bool_(), *[pa.string(), pa.string(), pa.int64()] * 2]
    schema = "part int, first boolean, host string, path string, id long, host0 string, path0 string, id0 long"
    steps = cut_lineage(sorted_pages.mapInArrow(run, schema))
    # the row of a range's first page and the closing row of the range before it meet here
    ends = steps.where("first or id is null").withColumn("at", F.when(F.col("first"), F.col("part") * 2).otherwise(F.col("part") * 2 + 1))
    order = Window.orderBy("at")  # no partition: two rows per range, as many ranges as there are tasks
    across = ends.select("host", "path", "id", "first", *[F.lag(c).over(order).alias(c) for c in ("host0", "path0", "id0")]).where("first")
    pairs = steps.where("not first and id is not null").select("host", "path", "id", "host0", "path0", "id0").unionByName(across.drop("first"))
    pairs = pairs.where("host = host0 and id <> id0")
    pairs = _with_common(pairs)
    both = pairs.select("id", F.col("id0").alias("other"), "common").unionByName(
        pairs.select(F.col("id0").alias("id"), F.col("id").alias("other"), "common")
    )
    return both.groupBy("id").agg(F.max_by("other", F.struct("common", -F.col("other"))).alias("other"))


def _align(met: DataFrame) -> DataFrame:
    """``id, shared, copy`` of rows ``id, lines, sizes, their_lines, their_sizes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("lines", "sizes", "their_lines", "their_sizes")]
            found = [shared_lines(*row) for row in zip(*columns)]
            shared, copy = pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("id"), shared, copy], ["id", "shared", "copy"])

    return met.select("id", "lines", "sizes", "their_lines", "their_sizes").mapInArrow(run, "id long, shared array<int>, copy boolean")


def _shared(outline: DataFrame) -> DataFrame:
    """``id, shared``: places of the lines of an open page that are the frame.

    These are the lines shared with the neighbour. Pages that may be copies of it are compared with
    the nearest page beyond the run of copies they stand in; where there is none or it is a copy too,
    lines that several different pages of the host hold are the frame, unless nothing would be left.
    """
    known = outline.dropDuplicates(["id"])
    theirs = known.select(F.col("id").alias("other"), F.col("lines").alias("their_lines"), F.col("sizes").alias("their_sizes"))
    wanted = outline.where("open and size(lines) > 0").dropDuplicates(["id"]).select("id", "host", "lines", "sizes")
    first = cut_lineage(_align(wanted.join(_neighbours(outline), "id").join(theirs, "other")))
    found, doubt = first.where("not copy"), first.where("copy").select("id")
    if not doubt.isEmpty():
        hosts = known.join(doubt, "id", "left_semi").select(F.col("host").alias("__host")).distinct()
        pages = cut_lineage(lookup(known.where("size(lines) > 0"), hosts, "host", "__host").select("id", "host", "path", "lines", "sizes"))
        beyond = _beyond_copies(pages, doubt).join(wanted, "id")
        second = cut_lineage(_align(lookup(beyond, theirs, "far", "other")))
        found = found.unionByName(second.where("not copy"))
        rest = doubt.join(second.where("not copy"), "id", "left_anti")
        found = found.select("id", "shared").unionByName(_held_by_several(pages, wanted.join(rest, "id")))
    return found.select("id", "shared").where(F.size("shared") > 0)


def _beyond_copies(pages: DataFrame, doubt: DataFrame) -> DataFrame:
    """``id, far``: the nearest page before or after the run of consecutive copies that a page stands in.

    Runs are found by running values over the order of all pages, so a run may be as long as the host.
    """
    places = cut_lineage(row_index(pages.select("host", "path", "id"), ["host", "path", "id"], "at"))
    placed = places.join(pages.select("id", "lines", "sizes"), "id")
    before = placed.select(
        (F.col("at") + 1).alias("at"), F.col("host").alias("host0"), F.col("lines").alias("their_lines"), F.col("sizes").alias("their_sizes"),
    )
    copies = _align(placed.join(before, "at").where("host = host0")).where("copy").select("id", "copy")
    begins = places.join(copies, "id", "left").select("id", "at", F.when(F.col("copy").isNull(), F.col("at")).alias("begin"))
    lows = running(cut_lineage(begins), ["at"], {"low": Running("last", F.col("begin"))})
    back = lows.withColumn("back", -F.col("at"))
    ends = running(cut_lineage(back), ["back"], {"high": Running("last", F.col("begin"), current=False)})
    sides = doubt.join(ends, "id").join(places.select("id", "host", "path"), "id")
    sides = sides.select("id", "host", "path", F.explode(F.array(F.col("low") - 1, F.col("high"))).alias("to"))
    there = places.select(F.col("at").alias("__at"), F.col("id").alias("far"), F.col("host").alias("host0"), F.col("path").alias("path0"))
    near = _with_common(lookup(sides, there, "to", "__at").where("host = host0"))
    return near.groupBy("id").agg(F.max_by("far", F.struct("common", -F.col("far"))).alias("far"))


def _held_by_several(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, shared``: places of the lines that at least ``SEVERAL`` different pages of the host hold."""
    held = (
        pages.select("host", F.xxhash64("lines").alias("page"), F.explode("lines").alias("line"))
        .select(F.xxhash64("host", "line").alias("frame"), "page").distinct()
        .groupBy("frame").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SEVERAL).select("frame")
    )
    own = wanted.select("id", "host", F.size("lines").alias("n"), F.posexplode("lines").alias("place", "line"))
    own = own.select("id", "n", "place", F.xxhash64("host", "line").alias("key"))
    places = lookup(own, held, "key", "frame").groupBy("id", "n").agg(F.sort_array(F.collect_list("place")).alias("shared"))
    return places.where(F.size("shared") < F.col("n")).select("id", "shared")


def extract(df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key, url, text`` of every row: the main text, lines joined by one line end.

    A null or empty page has an empty text. Pages without a usable URL or key, and those alone on
    their host, have no neighbour and keep all lines that markup does not exclude. Rows that repeat a
    key are extracted one by one; the first of them stands for the key as a neighbour. Other columns
    are left behind. Hashes of lines travel to the neighbour, pages themselves only to what was found
    for them; a task holds a slice of pages.
    """
    pages = df.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), F.col(page).alias("html"))
    outline = cut_lineage(_outline(pages))
    shared = cut_lineage(_shared(outline))
    joined = pages.join(shared, "id", "left")
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            rows = zip(batch.column("html").to_pylist(), batch.column("shared").to_pylist())
            texts = [main_text(lines_of(h), s or []) for h, s in rows]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], schema.names)

    return joined.mapInArrow(run, schema).select(F.col("id").cast(kind).alias(key), F.col("url").alias(url), "text")
