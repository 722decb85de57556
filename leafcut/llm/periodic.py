"""Stretches of words that repeat with a period, by harmonic grid probing.

For each period p only the words at jp and (j + 1)p are compared, n / p pairs, so all periods together cost n log n. A run that
holds `exponent` periods holds at least `exponent` - 1 such pairs in a row; these survivors are extended to both sides by
comparing the words with those p later, chunk by chunk, until they differ. Periods go up, and grid points that lie within a run
already found for a divisor of p are skipped: there the words have the smaller period.

Defined results: a null or empty text has no words and no runs; without an identifier a text is searched like any other;
repeated rows give a row each; texts are searched whole, however long; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run is at least so many words and so many periods long.
LEAST, EXPONENT = 6, 4
#: Grid pairs that are compared at once, and the first and largest chunk of an extension.
PROBES, CHUNK, MOST_CHUNK = 1 << 20, 64, 1 << 16

_OUT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def _grids(n: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Periods and their grid points, for as many periods at a time as PROBES pairs allow."""
    p, last = 1, n // exponent
    while p <= last:
        to, pairs = p, 0
        while to <= last and (pairs == 0 or pairs + (n - 1) // to <= PROBES):
            pairs += (n - 1) // to
            to += 1
        periods = np.arange(p, to)
        counts = (n - 1) // periods
        per = np.repeat(periods, counts)
        j = np.arange(len(per)) - np.repeat(np.cumsum(counts) - counts, counts)
        yield per, j * per
        p = to


def _candidates(w: np.ndarray, exponent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Periods, and the grid points at which exponent - 1 pairs in a row are equal, in order."""
    for per, at in _grids(len(w), exponent):
        row = w[at] == w[at + per]
        for _ in range(exponent - 2):
            if not row.any():
                break
            row = row[:-1] & row[1:]
        k = len(row)
        row &= per[:k] == per[len(per) - k :]
        hit = np.flatnonzero(row)
        if len(hit):
            periods, first = np.unique(per[hit], return_index=True)
            yield from zip(periods.tolist(), np.split(at[hit], first[1:]), strict=True)


def _right(w: np.ndarray, i: int, p: int) -> int:
    """The first place from i on whose word differs from the one p later, or where that one would be missing."""
    end, size = len(w) - p, CHUNK
    while i < end:
        j = min(end, i + size)
        same = w[i:j] == w[i + p : j + p]
        if not same.all():
            return i + int(np.argmin(same))
        i, size = j, min(2 * size, MOST_CHUNK)
    return end


def _left(w: np.ndarray, i: int, p: int) -> int:
    """The smallest place such that it and all words up to i equal those p later; i + 1 if not even i does."""
    i, size = i + 1, CHUNK
    while i > 0:
        j = max(0, i - size)
        same = w[j:i] == w[j + p : i + p]
        if not same.all():
            return i - int(np.argmin(same[::-1]))
        i, size = j, min(2 * size, MOST_CHUNK)
    return 0


def runs_of(w: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal stretch of numbers with smallest period q that is max(least, exponent * q) long or longer, by start, then period."""
    found: dict[int, list[tuple[int, int]]] = {}
    for p, points in _candidates(w, exponent):
        smaller = [r for q, rs in found.items() if p % q == 0 for r in rs]
        for s, e in smaller:
            points = points[(points < s) | (points + p >= e)]
        past = 0
        for at in points.tolist():
            # Within a stretch that was compared already there is nothing new.
            if at < past:
                continue
            end = _right(w, at, p)
            past, start, end = end, _left(w, at, p), end + p
            if end - start >= max(least, exponent * p) and not any(s <= start and end <= e for s, e in smaller):
                found.setdefault(p, []).append((start, end))
    return sorted((s, e - s, p) for p, rs in found.items() for s, e in rs)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words), bool)
    for s, n, p in runs:
        drop[s + p : s + n] = True
    return [words[i] for i in np.flatnonzero(~drop).tolist()]


def find_runs(docs: DataFrame, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period) by start and period, and collapsed, its words without repetitions joined by one blank, in UTF-8. rewrite changes a document's words before they are searched. A task holds one text at a time."""

    def one(doc: int | None, text: bytes | None) -> tuple:
        words = (text or b"").split()
        if rewrite is not None:
            words = rewrite(doc, words)
        number: dict[bytes, int] = {}
        w = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))
        runs = runs_of(w, least, exponent)
        return doc, len(words), runs, b" ".join(collapsed(words, runs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for b in batches:
            texts = b.column(1).cast(pa.large_binary())
            for i in range(0, b.num_rows, 64):
                rows = [one(d.as_py(), t.as_py()) for d, t in zip(b.column(0).slice(i, 64), texts.slice(i, 64), strict=True)]
                doc, n, found, rest = zip(*rows, strict=True)
                spans = [[{"start": s, "length": k, "period": p} for s, k, p in rs] for rs in found]
                yield pa.record_batch([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(spans, kind), pa.array(rest, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _OUT)


def planted(doc: int | None, words: list[bytes]) -> list[bytes]:
    """Words of a document of which one in ten ends in a repetition, by the check sum of its identifier."""
    if doc is None or not words:
        return words
    h = zlib.crc32(str(doc).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def report(docs: DataFrame) -> DataFrame:
    """Per document, with planted repetitions: the number of runs, the longest one (the first of equals, then that with the smallest period), and check sums of all runs and of the collapsed text."""
    r, x = F.col("runs"), F.col("x")
    order = F.transform(r, lambda x: F.struct((-x["length"]).alias("length"), x["start"].alias("start"), x["period"].alias("period")))
    said = F.array_join(F.transform(r, lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n"))), "")
    rows = find_runs(docs, planted).withColumn("x", F.array_min(order))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), x["start"].alias("start"), (-x["length"]).alias("length"), x["period"].alias("period"), F.floor(1000 * -x["length"] / x["period"]).cast("long").alias("exponent_milli"),
        F.sha2(said, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: The check sum is worked out bit by bit; runs are stretches of equal words at one distance, those of a divisor's runs left out.
SQL = r"""
WITH h0 AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    CASE WHEN doc_id IS NULL THEN 1 ELSE xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda r, b: list_reduce(list_prepend(xor(r, b), list_transform(range(8), lambda i: i::BIGINT)), lambda s, i: xor(s >> 1, (s & 1) * 3988292384))), 4294967295) END AS h FROM documents),
h1 AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g FROM h0), h2 AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM h1), h3 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM h2),
d AS (SELECT row_number() OVER () AS k, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_concat(w[:a], list_transform(range(n - a), lambda i: w[a + i % p + 1])) END AS w FROM h3),
t AS (SELECT k, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
e AS (SELECT x.k, y.i - x.i AS p, x.i FROM t x JOIN t y ON x.k = y.k AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 4 <= x.n),
s AS (SELECT k, p, min(i) AS start, count(*) + p AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY k, p ORDER BY i) AS z FROM e) GROUP BY k, p, z HAVING count(*) + p >= greatest(6, 4 * p)),
r AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s q WHERE q.k = s.k AND q.p < s.p AND s.p % q.p = 0 AND q.start <= s.start AND q.start + q.length >= s.start + s.length)),
f AS (SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || p || chr(10), '' ORDER BY start, p) AS said, min({'l': -length, 's': start, 'p': p}) AS b FROM r GROUP BY k),
gone AS (SELECT DISTINCT k, unnest(range(start + p, start + length)) AS i FROM r),
kept AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS rest FROM t ANTI JOIN gone USING (k, i) GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, -b.l AS length, b.p AS period, (1000 * -b.l) // b.p AS exponent_milli, sha256(coalesce(said, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM d LEFT JOIN f USING (k) LEFT JOIN kept USING (k)
"""
