"""Column expressions over page text: lines, detectors, numbering, letterheads, redaction patterns.

White space is Unicode white space; patterns use Unicode classes where a language's own text functions would.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line ends and white space.
LINE_END = "\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x{85}\\x{2028}\\x{2029}]"
_WS = "[\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]"
# Detector patterns.
TOTAL = (r"(?i)\bpage\s+(\d+)\s+of\s+(\d+)\b", r"(?i)\bpg\.?\s*(\d+)\s*/\s*(\d+)\b")
BARE = (r"^-\s*(\d+)\s*-$", r"^\s*(\d+)\s*$")
LABEL, LABEL_VALUE = r"(?i)^(PAGE|PG)\.?:?\s*$", r"^(\d+)$"
ANCHOR = r"^(EXHIBIT|SCHEDULE|ATTACHMENT|APPENDIX|ANNEX|ADDENDUM)\b"
MEMO, MEMO_WORD = r"(?i)^(TO|FROM|DATE|RE|SUBJECT|CC|SENT)\s*:", r"(?i)^MEMORANDUM\s*$"
ADDRESS, PHONE, WEB = r",\s*[A-Za-z .]+\s+\d{5}(-\d{4})?\b", r"(?i)\b(?:[TF]|TEL|FAX)[:.]?\s*\d{3}[.\-]\d{3}[.\-]\d{4}\b", r"(?i)\bwww\.\S+\.\w+"
PII = {"ssn": r"(?U)\b\d{3}-\d{2}-\d{4}\b", "ein": r"(?U)\b\d{2}-\d{7}\b", "phone": r"(?U)\(\d{3}\)\s?\d{3}[-.]\d{4}\b|\b\d{3}[-.]\d{3}[-.]\d{4}\b", "email": r"(?U)\b[\w.+-]+@[\w-]+\.[A-Za-z]{2,}\b"}
STOP_WORDS = "the of to and in for a on at street st avenue ave road rd floor suite room blvd boulevard drive dr building".split()
LARGEST_PAGE = 999


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_WS}+|{_WS}+$", "")


def lines(c: Column) -> Column:
    """Stripped lines that are not empty."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), LINE_END), strip), lambda x: x != "")


def first(c: Column) -> Column:
    return F.get(c, F.lit(0))


def is_upper(c: Column) -> Column:
    """At least one cased letter and none in lower case."""
    return c.rlike(r"\p{Lu}") & ~c.rlike(r"\p{Ll}")


def title_anchor(text: Column, ls: Column | None = None) -> Column:
    """ls, here and below: the text's lines, if a column has them already."""
    hit = F.filter(F.slice(lines(text) if ls is None else ls, 1, 3), lambda x: x.rlike(ANCHOR) & is_upper(x))
    return F.substring(first(hit), 1, 80)


def correspondence(text: Column, ls: Column | None = None) -> Column:
    """Sorted distinct header labels among the first 15 lines; null for fewer than two."""
    name = lambda x: F.when(x.rlike(MEMO), F.upper(F.regexp_extract(x, MEMO, 1))).when(x.rlike(MEMO_WORD), F.lit("MEMORANDUM"))
    got = F.array_sort(F.array_distinct(F.filter(F.transform(F.slice(lines(text) if ls is None else ls, 1, 15), name), lambda x: x.isNotNull())))
    return F.when(F.size(got) >= 2, got)


def _small(x: Column) -> Column:
    return x.try_cast("long").between(0, LARGEST_PAGE)


def numbering_total(text: Column, ls: Column | None = None) -> Column:
    """(cur, total) of the first line that says page X of Y or pg X/Y, X at most 999."""
    def one(x: Column) -> Column:
        out = F.lit(None)
        for p in reversed(TOTAL):
            cur = F.regexp_extract(x, p, 1)
            out = F.when(x.rlike(p) & _small(cur), F.struct(cur.try_cast("long").alias("cur"), F.regexp_extract(x, p, 2).try_cast("long").alias("total"))).otherwise(out)
        return out

    return first(F.filter(F.transform(lines(text) if ls is None else ls, one), lambda x: x.isNotNull()))


def numbering_bare(text: Column, ls: Column | None = None) -> Column:
    def one(x: Column) -> Column:
        out = F.lit(None).cast("long")
        for p in reversed(BARE):
            n = F.regexp_extract(x, p, 1)
            out = F.when(x.rlike(p) & _small(n), n.try_cast("long")).otherwise(out)
        return out

    return first(F.filter(F.transform(lines(text) if ls is None else ls, one), lambda x: x.isNotNull()))


def numbering_split(text: Column, ls: Column | None = None) -> Column:
    """The number on the line after a line that is only a page label."""
    ls = lines(text) if ls is None else ls
    pairs = F.arrays_zip(ls.alias("l"), F.slice(ls, F.lit(2), F.greatest(F.size(ls), F.lit(1))).alias("n"))
    hit = F.filter(pairs, lambda x: x["l"].rlike(LABEL) & F.coalesce(x["n"], F.lit("")).rlike(LABEL_VALUE) & F.coalesce(_small(x["n"]), F.lit(False)))
    return first(hit)["n"].try_cast("long")


BANDS = ("0.12", "0.20", "0.30")


def band_lines(bands: Column) -> dict[tuple[str, str], Column]:
    return {(b, r): lines(bands[b][r]) for b in BANDS for r in ("footer", "header")}


def _named(region: str, kind: str):
    def one(n: Column) -> Column:
        cur, total = (n["cur"], n["total"]) if kind == "total" else (n, F.lit(None).cast("long"))
        return F.struct(cur.alias("cur"), total.alias("total"), F.lit(region).alias("region"), F.lit(kind).alias("kind"))

    return one


def labeled_numbering(ls: dict[tuple[str, str], Column]) -> Column:
    """(cur, total, region, kind) of the first band, footer before header, total before split label; a split label leaves total to the page before. ls: lines by band and region, as band_lines() gives them."""
    tries = []
    for b in BANDS:
        for kind in ("total", "split"):
            for region in ("footer", "header"):
                found = numbering_total(F.lit(None), ls[b, region]) if kind == "total" else numbering_split(F.lit(None), ls[b, region])
                got = F.transform(F.array_compact(F.array(found)), _named(region, kind))
                tries.append(first(got))
    return F.coalesce(*tries)


def bare_candidate(ls: dict[tuple[str, str], Column]) -> Column:
    """The bare number of the footer, else of the header, in the narrowest band; zero in the footer is as good as none."""
    foot, head = (numbering_bare(F.lit(None), ls[BANDS[0], r]) for r in ("footer", "header"))
    return F.coalesce(F.nullif(foot, F.lit(0).cast("long")), head)


def letterhead(ls: dict[tuple[str, str], Column]) -> Column:
    tries = []
    for b in BANDS:
        for region in ("header", "footer"):
            block = F.array(F.array_join(F.slice(ls[b, region], 1, 8), " "))
            tries.append(first(F.filter(block, lambda x: x.rlike(ADDRESS) | x.rlike(PHONE) | x.rlike(WEB))))
    return F.coalesce(*tries)


def tokens(block: Column) -> Column:
    words = F.regexp_extract_all(F.lower(block), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_except(F.filter(words, lambda x: F.length(x) > 1), F.array(*map(F.lit, STOP_WORDS)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def slug(c: Column) -> Column:
    """A title as part of a file name."""
    clean = strip(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[^\w\s-]", " "), r"(?U)\s+", " "))
    out = F.substring(F.regexp_replace(clean, " ", "_"), 1, 40)
    return F.when(out == "", "segment").otherwise(out)


def value_shaped(word: Column) -> Column:
    return word.rlike(r"(?U)[\d@]")


def pii_matches(text: Column) -> Column:
    """A map of category to all matches."""
    return F.create_map(*(x for k, p in PII.items() for x in (F.lit(k), F.regexp_extract_all(text, F.lit(p), F.lit(0)))))


def redact(text: Column) -> Column:
    return reduce(lambda t, kp: F.regexp_replace(t, kp[1], f"[{kp[0].upper()}]"), PII.items(), text)
