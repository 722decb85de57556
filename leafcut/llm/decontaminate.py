"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with everything but letters and digits as one blank. An item of L characters may differ in
k = L // CHARS_PER_EDIT places; cut into k + 1 pieces, at least one piece of any such copy is untouched. One automaton finds
exact hits of all pieces in a whole text; each hit is verified with Myers' bit-parallel distance between the item and the
text around the hit. Items are taken in blocks of bounded size, each block against all documents. The driver reads the
benchmark, which is the query set, and holds it; documents never reach it.

Items of fewer than LEAST_CHARS characters after normalising may not differ at all and count as whole words only.

Defined results: start and end count characters of the normalised text, end exclusive, of the first stretch to end with the
smallest distance and the shortest such stretch; long texts are searched whole; items that are empty after normalising are skipped; null texts are empty; rows that repeat an item count
once with their smallest distance; every copy of a document is reported; other columns are ignored; no rows on either side
give no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafcut.llm.common import keep_rows, stage

CHARS_PER_EDIT, LEAST_CHARS = 16, 24
#: Items a block may hold, and their characters; the automaton that executors get is bounded by both.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 2_000_000
_OTHER = re.compile(r"[\W_]+")
#: Letters of scripts that put no blank between words; a word may begin or end at any of them.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def normalised(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def budget(size: int) -> int:
    return size // CHARS_PER_EDIT if size >= LEAST_CHARS else 0


def bounded(text: str, start: int, end: int) -> bool:
    """Whether a stretch of a normalised text begins and ends with a word."""
    edge = lambda i: i in (0, len(text)) or " " in text[i - 1 : i + 1] or _UNSPACED.search(text[i - 1 : i + 1])
    return bool(edge(start) and edge(end))


def pieces(item: str) -> list[tuple[int, str]]:
    """Offsets and contents of k + 1 pieces that make up the item."""
    parts = budget(len(item)) + 1
    cut = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cut, cut[1:], strict=False)]


def myers(item: str, text: str, anchored: bool = False) -> tuple[int, int]:
    """Smallest edit distance of the item to any stretch of the text, or if anchored to any that begins where the text does, and where the first such stretch ends."""
    peq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        peq[c] |= 1 << i
    m = len(item)
    mask, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = mask, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        if score < best:
            best, end = score, j + 1
        ph = (ph << 1 | anchored) & mask
        pv = (mh << 1 | ~(xv | ph)) & mask
        mv = ph & xv
    return best, end


class Matcher:
    """The items of a block; the automaton is built where it is used."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        self._automaton = None

    def __getstate__(self):
        return {"items": self.items, "_automaton": None}

    def _search(self):
        if self._automaton is None:
            import ahocorasick

            where = defaultdict(list)
            for k, (_, item) in enumerate(self.items):
                for at, piece in pieces(item):
                    where[piece].append((k, at))
            self._automaton = ahocorasick.Automaton()
            for piece, places in where.items():
                self._automaton.add_word(piece, (len(piece), places))
            self._automaton.make_automaton()
        return self._automaton

    def matches(self, text: str | None, first: bool = False) -> list[tuple[int, int, int, int]]:
        """(item id, edits, start, end) of each item found, in characters of the normalised text. first: any one will do."""
        text = normalised(text)
        found: dict[int, tuple[int, int, int]] = {}
        looked: set = set()
        if not text or not self.items:
            return []
        for end, (size, places) in self._search().iter(text):
            for k, at in places:
                name, item = self.items[k]
                most, start = budget(len(item)), end + 1 - size - at
                if len(item) < LEAST_CHARS:
                    if (name not in found or found[name][0]) and bounded(text, start, end + 1):
                        found[name] = (0, start, end + 1)
                        if first:
                            return [(name, 0, start, end + 1)]
                    continue
                if name in found and found[name][0] == 0:
                    continue
                # Hits of one copy lie within the budget of each other; a stretch is looked at once.
                spot = (k, start // (most + 1))
                if spot in looked:
                    continue
                looked.update(((k, spot[1]), (k, spot[1] - 1), (k, spot[1] + 1)) if text.startswith(item, max(0, start)) and start >= 0 else (spot,))
                if start >= 0 and text.startswith(item, start):
                    edits, a, b = 0, start, start + len(item)
                else:
                    a = max(0, start - 2 * most - 1)
                    edits, stop = myers(item, text[a : start + len(item) + 2 * most + 1])
                    if edits > most:
                        continue
                    b = a + stop
                    a = b - myers(item[::-1], text[max(0, b - len(item) - edits) : b][::-1], anchored=True)[1]
                if name not in found or edits < found[name][0]:
                    found[name] = (edits, a, b)
                    if first:
                        return [(name, edits, a, b)]
        return [(name, *x) for name, x in sorted(found.items())]


def blocks(benchmark: DataFrame) -> Iterator[Matcher]:
    """The benchmark's items in blocks of bounded size; all texts of an item are in one block."""
    held, size, last = [], 0, None
    for r in benchmark.select("item_id", "text").filter("item_id IS NOT NULL").distinct().orderBy("item_id").toLocalIterator():
        item = normalised(r["text"])
        if not item:
            continue
        if r["item_id"] != last and (len(held) >= BLOCK_ITEMS or size >= BLOCK_CHARS):
            yield Matcher(held)
            held, size = [], 0
        last = r["item_id"]
        held.append((last, item))
        size += len(item)
    yield Matcher(held)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, edits, start, end for each document and item that it holds."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def scan(shared):
        def run(batches):
            for b in batches:
                rows = [(d, *x) for d, text in zip(b.column(0).to_pylist(), b.column(1), strict=True) for x in shared.value.matches(text.as_py())]
                cols = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "item_id", "edits", "start", "end"])

        return docs.mapInArrow(run, "doc_id long, item_id long, edits int, start long, end long")

    out = None
    for matcher in blocks(benchmark):
        # A worker builds a block's automaton once and keeps it with the broadcast.
        shared = docs.sparkSession.sparkContext.broadcast(matcher)
        out = scan(shared) if out is None else out.unionByName(stage(scan(shared), "found"))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that hold a benchmark item; nulls and empty texts stay, all columns as they were."""
    for i, matcher in enumerate(blocks(benchmark)):
        docs = stage(docs, "clean") if i else docs
        shared = docs.sparkSession.sparkContext.broadcast(matcher)
        docs = keep_rows(docs, "text", lambda texts, m=shared: [not m.value.matches(x, first=True) for x in texts])
    return docs
