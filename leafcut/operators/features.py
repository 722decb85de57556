"""Signals of each page of a document: layout, text, bookmarks, neighbours, and the sequential state between anchors.

Everything row-local is a column expression, everything that looks back a fixed way is one window by document, and what
carries state from page to page is a fold over pages in order, streamed through sorted partitions in constant memory.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType

from leafcut.functions import layout, text



def by_page() -> WindowSpec:
    """A document's pages in order."""
    return Window.partitionBy("doc_id").orderBy("page_num")


DUPLICATE_CHARS, DUPLICATE_RATIO = 15, 0.95
SPIKE_FACTOR, SPIKE_LEAST, LETTERHEAD_SAME = 3, 200, 0.4


#: Characters whose numbers bound a text ratio; all others count as one.
COUNTED = " etaoinshrdlucmfwypvbgkjqxz0123456789ETAOINSHRDLUCMFWYPVBGKJQXZ.,-\n"


def reaches(a: str, b: str, limit: float) -> bool:
    """Whether the matching-block ratio of two texts (frequent characters of the second ignored as starts) is limit or more. Blocks are taken as the ratio takes them, but only until what is matched is enough, or what is left can't be."""
    total = len(a) + len(b)
    if not total:
        return 1.0 >= limit
    most = lambda r: min(r[1] - r[0], r[3] - r[2])
    matcher, matched, left = difflib.SequenceMatcher(None, a, b), 0, [(0, len(a), 0, len(b))]
    open_ = most(left[0])
    while left and 2.0 * (matched + open_) / total >= limit and 2.0 * matched / total < limit:
        # The largest range first: it tells most.
        at = max(range(len(left)), key=lambda i: most(left[i]))
        alo, ahi, blo, bhi = left.pop(at)
        open_ -= min(ahi - alo, bhi - blo)
        i, j, k = matcher.find_longest_match(alo, ahi, blo, bhi)
        if k:
            matched += k
            for r in ((alo, i, blo, j), (i + k, ahi, j + k, bhi)):
                if most(r) > 0:
                    left.append(r)
                    open_ += most(r)
    return 2.0 * matched / total >= limit


# Texts go to Python some rows at a time: a batch of thousands of long texts would fill a worker.
@F.udf(BooleanType(), useArrow=False)
def _reaches(cur: str | None, prev: str | None) -> bool | None:
    return None if cur is None or prev is None else reaches(cur, prev, DUPLICATE_RATIO)


def ratio_bound(a: Column, b: Column) -> Column:
    """At least the text ratio of two texts, by how many of each counted character both have: matching blocks match a character once."""
    n = lambda t, c: F.length(t) - F.length(F.replace(t, c, F.lit("")))
    start = F.struct(F.lit(0).alias("both"), F.length(a).alias("a"), F.length(b).alias("b"))
    step = lambda s, c: F.struct((s["both"] + F.least(n(a, c), n(b, c))).alias("both"), (s["a"] - n(a, c)).alias("a"), (s["b"] - n(b, c)).alias("b"))
    return F.aggregate(F.array(*map(F.lit, COUNTED)), start, step, lambda s: 2.0 * (s["both"] + F.least(s["a"], s["b"])) / (F.length(a) + F.length(b)))


def long_alike(a: Column, b: Column) -> Column:
    """Whether two lengths leave open if texts of these lengths count as duplicates."""
    return (a > DUPLICATE_CHARS) & (b > DUPLICATE_CHARS) & (2 * F.least(a, b) >= DUPLICATE_RATIO * (a + b))


def undecided(cur: Column, prev: Column) -> Column:
    """Whether lengths and counts leave open if two differing page texts count as duplicates."""
    near = long_alike(F.length(cur), F.length(prev)) & (cur != prev)
    return F.coalesce(F.when(near, ratio_bound(cur, prev) >= DUPLICATE_RATIO), F.lit(False))


def similar_enough(cur: Column, prev: Column) -> Column:
    """Whether two page texts count as duplicates. Equal texts need no matching, and lengths and counts of characters bound the ratio from above; only pages they leave open go through Python."""
    open_ = undecided(cur, prev)
    ratio = _reaches(F.when(open_, cur), F.when(open_, prev))
    return F.coalesce(((F.length(cur) > DUPLICATE_CHARS) & (F.length(prev) > DUPLICATE_CHARS) & (cur == prev)) | ratio, F.lit(False))


def bookmark_map(toc: DataFrame) -> DataFrame:
    """One bookmark a page: the lowest level, then the first entry."""
    known = toc.filter("page_1based > 0")
    return known.groupBy("doc_id", F.col("page_1based").alias("page_num")).agg(F.min_by(F.struct("title", "level"), F.struct("level", "ord")).alias("b")).select("doc_id", "page_num", "b.title", "b.level")


def capped(pages: DataFrame, most: int | None) -> DataFrame:
    return pages if most is None else pages.filter(F.col("page_num") <= most)


def own_signals(pages: DataFrame) -> DataFrame:
    """Pages with every signal that a page's text, bands and shape tell by themselves."""
    t, w, h = F.coalesce("text", F.lit("")), F.col("width"), F.col("height")
    d = F.col("drawing_count")
    # Lines are columns of their own, so that each text is cut once however many detectors read it.
    cut = {("", ""): "_lines", **{k: f"_lines_{i}" for i, k in enumerate(text.band_lines(F.col("bands")))}}
    marked = pages.withColumns({cut["", ""]: text.lines(t), **{cut[k]: v for k, v in text.band_lines(F.col("bands")).items()}})
    own, ls = F.col("_lines"), {k: F.col(v) for k, v in cut.items()}
    return marked.withColumns({
        "is_blank": layout.is_blank(t, F.col("image_area"), w, h, d), "format_label": layout.page_format(w, h), "title_anchor": text.title_anchor(t, own), "correspondence_labels": text.correspondence(t, own),
        "text_char_count": F.length(t), "text_density": layout.text_density(t, w, h), "is_drawing": layout.is_drawing(w, h, d, F.col("image_infos")), "block": text.letterhead(ls),
        "labeled": text.labeled_numbering(ls), "bare": text.bare_candidate(ls),
    }).drop(*cut.values())


def marked(pages: DataFrame, toc: DataFrame | None = None) -> DataFrame:
    """Pages with the bookmark of each."""
    if toc is None:
        return pages.withColumns({"title": F.lit(None).cast("string"), "level": F.lit(None).cast("int")})
    return pages.join(bookmark_map(toc), ["doc_id", "page_num"], "left")


def row_local(pages: DataFrame, toc: DataFrame | None = None) -> DataFrame:
    """Pages with the bookmark of each and every signal that a page tells by itself; pages may be a stream."""
    return own_signals(marked(pages, toc))


def digested(pages: DataFrame, *more: str) -> DataFrame:
    """Length and SHA-256 of each page's text, which tell equal texts and texts too unlike in length without carrying them."""
    t = F.coalesce("text", F.lit(""))
    return pages.select("doc_id", "page_num", *more, F.length(t).alias("_chars"), F.unhex(F.sha2(t, 256)).alias("_sha"))


def twins(pages: DataFrame) -> DataFrame:
    """(doc_id, page_num, _twin) of pages whose text differs from the one before, but little enough to count as a duplicate. Only pages that lengths leave open fetch texts, each by its own key, so no document's texts meet in one task."""
    before = {f"_prev_{c}": F.lag(c).over(by_page()) for c in ("page_num", "_chars", "_sha")}
    open_ = digested(pages).withColumns(before).filter(long_alike(F.col("_chars"), F.col("_prev__chars")) & (F.col("_sha") != F.col("_prev__sha"))).select("doc_id", "page_num", "_prev_page_num")
    texts = pages.select("doc_id", "page_num", "text")
    both = open_.join(texts.withColumnRenamed("text", "_cur"), ["doc_id", "page_num"]).join(texts.select("doc_id", F.col("page_num").alias("_prev_page_num"), F.col("text").alias("_prev")), ["doc_id", "_prev_page_num"])
    return both.filter(undecided(F.col("_cur"), F.col("_prev"))).filter(_reaches("_cur", "_prev")).select("doc_id", "page_num", F.lit(True).alias("_twin"))


def detected(pages: DataFrame, toc: DataFrame | None = None) -> DataFrame:
    """Row-local signals and those of the page before; the columns that the fold needs among them. Texts and bands stay behind: what goes through joins and windows is as long as its signals."""
    own = own_signals(pages)
    short = digested(own, *(c for c in own.columns if c not in ("doc_id", "page_num", "text", "bands")))
    local = marked(short, toc).join(twins(pages), ["doc_id", "page_num"], "left")
    d = F.col("drawing_count")
    prev_d = F.lag("drawing_count").over(by_page())
    back = local.withColumns({
        "prev_label": F.lag("format_label").over(by_page()), "_equal": (F.col("_chars") > DUPLICATE_CHARS) & (F.col("_sha") == F.lag("_sha").over(by_page())),
        "drawing_spike": F.coalesce((prev_d > 0) & (d > SPIKE_FACTOR * prev_d) & (d > SPIKE_LEAST), F.lit(False)),
        "drawing_density_drop": F.coalesce((prev_d > SPIKE_LEAST) & (d < prev_d / SPIKE_FACTOR), F.lit(False)),
        "prev_block": F.last("block", ignorenulls=True).over(by_page().rowsBetween(Window.unboundedPreceding, -1)),
    })
    same = F.coalesce(F.col("_equal"), F.lit(False)) | F.coalesce("_twin", F.lit(False))
    changed = F.coalesce(text.jaccard(text.tokens(F.col("block")), text.tokens(F.col("prev_block"))) < LETTERHEAD_SAME, F.lit(False))
    return back.withColumns({"is_duplicate_of_prev": same, "letterhead_changed": changed}).drop("_chars", "_sha", "_equal", "_twin", "prev_block")


FOLD_IN = ("doc_id", "page_num", "is_duplicate_of_prev", "format_label", "prev_label", "drawing_spike", "title", "level", "has_anchor", "cur", "total", "region", "kind", "bare")
STATE_OUT = "page_num_found long, page_total_found long, numbering_reset boolean, numbering_fresh_start boolean, numbering_scheme_changed boolean, bookmark_suppressed boolean, has_l1_bookmark boolean, format_changed boolean, format_returning boolean"
FOLD_OUT = f"doc_id string, page_num int, {STATE_OUT}"


class Fold:
    """The state of one document from page to page."""

    __slots__ = ("cur", "total", "scheme", "title", "title_page", "labels", "seen")

    def __init__(self):
        self.cur = self.total = self.scheme = self.title = self.title_page = None
        self.labels: set[str] = set()
        self.seen = False

    def step(self, page, dup, label, prev_label, spike, title, level, has_anchor, cur, total, region, kind, bare) -> tuple:
        scheme = None
        if cur is not None:
            number, of, scheme = cur, self.total if kind == "split" else total, (region, kind)
        elif bare is not None and self.cur is not None and bare == self.cur + 1:
            number, of = bare, self.total
        else:
            number = of = None
        before = self.cur
        reset = number is not None and (number == 1 or before is not None and not before <= number <= before + 1)
        fresh = reset and number == 1 and not self.seen
        other = fresh and scheme is not None and self.scheme is not None and scheme != self.scheme
        low = level is not None and level <= 2
        repeated = low and self.title is not None and title == self.title and page - self.title_page <= 1 and not reset and not spike
        mark = low and not repeated and not dup
        changed = prev_label is not None and label != prev_label
        returning = changed and label in self.labels
        anchor = not dup and (mark or (changed and not returning) or has_anchor)
        self.labels = {label} if anchor else self.labels | {label}
        if mark:
            self.title, self.title_page = title, page
        if number is not None:
            self.cur, self.total = number, of
        if scheme is not None:
            self.scheme = scheme
        self.seen = number is not None if anchor else self.seen or number is not None
        return number, of, reset, fresh, other, repeated, mark, changed, returning


def with_state(rows: DataFrame) -> DataFrame:
    """Detected pages with the fold's columns behind their own. rows come from detected(), whose windows left each document's pages together; they are sorted
    here and passed through once, so there is no further exchange and no join. A task holds one state, not a document."""
    state_in = [
        "doc_id", "page_num", "is_duplicate_of_prev", "format_label", "prev_label", "drawing_spike", "title", "level",
        (F.col("title_anchor").isNotNull() | F.col("correspondence_labels").isNotNull()).alias("has_anchor"), "labeled.cur", "labeled.total", "labeled.region", "labeled.kind", "bare",
    ]
    kept = [c for c in rows.columns if c not in ("block", "labeled", "bare", "prev_label")]
    both = rows.select(*kept, F.struct(*state_in).alias("_in"))
    names = [*kept, *(x.split()[0] for x in STATE_OUT.split(", "))]
    kinds = (pa.int64(), pa.int64(), *[pa.bool_()] * 7)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, state = None, Fold()
        for b in batches:
            out = []
            for row in zip(*(x.to_pylist() for x in b.column(b.num_columns - 1).flatten()), strict=True):
                if row[0] != doc:
                    doc, state = row[0], Fold()
                out.append(state.step(*row[1:]))
            new = [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * len(kinds), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *new], names)

    schema = StructType([*both.drop("_in").schema.fields, *StructType.fromDDL(STATE_OUT).fields])
    return both.sortWithinPartitions("doc_id", "page_num").mapInArrow(run, schema)


def folded(rows: DataFrame) -> DataFrame:
    """The fold's columns alone."""
    return with_state(rows).select(*(x.split()[0] for x in FOLD_OUT.split(", ")))


def page_features(pages: DataFrame, toc: DataFrame | None = None) -> DataFrame:
    """All features of each page but its text, which later steps join when they need it."""
    full = with_state(detected(pages, toc))
    low = F.col("level") <= 2
    return full.select(
        "doc_id", "page_num", "is_blank", "title_anchor", F.bround("width", 1).alias("w"), F.bround("height", 1).alias("h"), layout.orientation(F.bround("width", 1), F.bround("height", 1)).alias("orientation"),
        layout.size_bucket(F.bround("width", 1), F.bround("height", 1)).alias("size_bucket"), "format_label", "format_changed", "format_returning", "has_l1_bookmark",
        F.when(F.col("has_l1_bookmark"), F.col("title")).alias("bookmark_title"), F.col("level").alias("bookmark_level"), F.coalesce(low & F.col("bookmark_suppressed"), F.lit(False)).alias("bookmark_suppressed"), F.col("title").alias("raw_bookmark_title"),
        "numbering_reset", "numbering_fresh_start", "numbering_scheme_changed", "page_num_found", "page_total_found", "drawing_count", "image_count", "image_infos", F.lit(0).alias("table_count"), "is_drawing",
        "drawing_spike", "drawing_density_drop", "letterhead_changed", "text_char_count", "text_density", "is_duplicate_of_prev", "correspondence_labels",
    )
