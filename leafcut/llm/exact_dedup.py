"""Exact duplicates by a log-structured merge index over digests.

Each task keeps a memtable of digests; a full one is flushed as a run sorted by digest, in which the first row of a digest
has its smallest identifier and how many rows the memtable had of it. Compaction deals those first rows by digest range and
merges each range's sorted runs in one pass into the index: a digest, its smallest identifier and its number of rows. A Bloom
filter over the digests that more than one row has is probed by every row; those it rules out are unique and look nothing up.
The texts of hits are grouped byte for byte, and the other rows look up the index. Should different texts share an index
key, their rows are told apart by the texts themselves.

Defined results: a null text is an empty text; rows without an identifier count in their group but never give keep_id
unless the whole group has none; rows that repeat an identifier with equal text are kept or dropped together; other columns
are ignored; long texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafcut.llm.common import FILTER_MOST, any_hot, attach, fresh, id_filter, passing, stage

MEMTABLE_ROWS = 100_000
_SPACES = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def normalised(text: str | None) -> bytes:
    """Each run of ASCII white space as one blank, in UTF-8."""
    out = (text or "").encode("utf-8", "surrogatepass").translate(_SPACES)
    while b"  " in out:
        out = out.replace(b"  ", b" ")
    return out


_INDEX = "key binary, k64 long, keep_id long, n long"


def _k64(keys: list[bytes]) -> np.ndarray:
    """The first eight bytes of each key as a number."""
    return np.frombuffer(b"".join(k.ljust(8, b"\0")[:8] for k in keys), ">u8").view(np.dtype(">i8")).astype(np.int64)


def _runs(key_bytes: int):
    def flush(held: list[tuple[bytes, bool, int | None, bytes]]) -> pa.RecordBatch:
        held.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        key, _, doc, sha = zip(*held, strict=True)
        first = [i for i, k in enumerate(key) if not i or k != key[i - 1]]
        n = np.zeros(len(key), np.int64)
        n[first] = np.diff([*first, len(key)])
        return pa.record_batch([pa.array(key, pa.binary()), pa.array(_k64(key)), pa.array(doc, pa.int64()), pa.array(sha, pa.binary()), pa.array(n)], ["key", "k64", "doc_id", "sha", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memtable: list = []
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                sha = hashlib.sha256(normalised(text.as_py())).digest()
                memtable.append((sha[:key_bytes], doc is None, doc, sha))
                if len(memtable) >= MEMTABLE_ROWS:
                    yield flush(memtable)
                    memtable = []
        if memtable:
            yield flush(memtable)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one digest range in order, one row a digest; the last digest seen waits for the next batch."""
    held = None
    for b in batches:
        now = pa.Table.from_batches([b])
        now = pa.concat_tables([held, now]) if held is not None else now
        now = now.group_by("key", use_threads=False).aggregate([("k64", "min"), ("keep_id", "min"), ("n", "sum")]).select(["key", "k64_min", "keep_id_min", "n_sum"]).rename_columns(["key", "k64", "keep_id", "n"])
        yield from now.slice(0, max(0, now.num_rows - 1)).to_batches()
        held = now.slice(max(0, now.num_rows - 1))
    if held is not None:
        yield from held.to_batches()


def _probe(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = np.zeros(b.num_rows, bool)
            hit[passing(shared, b.column(1).to_numpy(zero_copy_only=False))] = True
            yield pa.record_batch([b.column(0), b.column(2), b.column(3), pa.array(hit)], ["key", "doc_id", "sha", "hit"])

    return run


def _hits(key_bytes: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                texts = [normalised(x.as_py()) for x in part.column(1)]
                keys = [hashlib.sha256(x).digest()[:key_bytes] for x in texts]
                take = passing(shared, _k64(keys))
                if len(take):
                    yield pa.record_batch([pa.array([keys[j] for j in take], pa.binary()), part.column(0).take(pa.array(take)), pa.array([texts[j] for j in take], pa.binary())], ["key", "doc_id", "body"])

    return run


def _plain() -> Column:
    """The normalised text, as normalised() makes it."""
    return F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, key_bytes: int = 32, most: int = FILTER_MOST) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. key_bytes: how much of the digest is the index key; any length gives the same result, shorter ones need the bytes more often. most: beyond so many hits, rows are joined with them instead of probing a filter."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    runs = stage(docs.mapInArrow(_runs(key_bytes), "key binary, k64 long, doc_id long, sha binary, n long"), "runs")
    total = runs.count()
    ranges = runs.filter("n > 0").select("key", "k64", F.col("doc_id").alias("keep_id"), "n").repartitionByRange("key").sortWithinPartitions("key")
    index = stage(ranges.mapInArrow(_merge, _INDEX), "index", {"parquet.bloom.filter.enabled#key": "true"})
    hits = stage(index.filter("n > 1"), "index")
    few = hits.count() <= most
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(hits.select("k64"))) if few else None
    if few:
        seen = docs.mapInArrow(_hits(key_bytes, shared), "key binary, doc_id long, body binary")
    else:
        keyed = docs.select(F.substring(F.unhex(F.sha2(_plain(), 256)), 1, key_bytes).alias("key"), "doc_id", _plain().cast("binary").alias("body"))
        seen = attach(keyed, hits.select("key", "n"), "key", "n", total).filter("n IS NOT NULL").select("key", "doc_id", "body")
    bodies = stage(seen.groupBy("key", "body").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n")).select("key", F.sha2("body", 256).alias("text_sha256"), "keep_id", "n"), "bodies")
    mixed = stage(bodies.groupBy("key").count().filter("count > 1").select("key"), "mixed")
    told = F.lower(F.hex("sha"))
    rows = runs.select("key", "k64", "doc_id", "sha").mapInArrow(_probe(shared), "key binary, doc_id long, sha binary, hit boolean")
    alone = rows.filter("NOT hit").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"), told.alias("text_sha256"))
    rows = rows.filter("hit").drop("hit")
    if mixed.isEmpty():
        found = attach(rows, hits.select("key", "keep_id", "n"), "key", "n", total, any_hot(hits, "n", total)).withColumn("text_sha256", told)
    else:
        # Several texts under one key: the full digest leads each row to its text's group, whose bytes were compared above.
        clear = hits.select("key", "keep_id", "n").join(mixed, "key", "left_anti")
        plain = attach(rows.join(mixed, "key", "left_anti"), clear, "key", "n", total).withColumn("text_sha256", told)
        other = attach(rows.join(mixed, "key", "left_semi").withColumn("text_sha256", told), bodies.drop("key"), "text_sha256", "n", total)
        found = plain.unionByName(other.select(plain.columns))
    # What the filter let through without a hit is unique as well.
    found = found.select("doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("n"), "text_sha256")
    out = alone.unionByName(found)
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return out.select("doc_id", "keep_id", F.col("n").alias("group_size"), kept.alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame) -> DataFrame:
    """docs with one row of each text: of those with the smallest identifier (without any, if none has one) any one, by a hash of their columns. Columns of any names stay as they were."""
    doc, sha, own, row, n = fresh("id", "sha", "own", "row", "n")
    groups = stage(exact_groups(docs).select(F.col("doc_id").alias(doc), F.col("text_sha256").alias(sha), "kept"), "groups")
    again = stage(groups.filter("kept").groupBy(doc, sha).agg(F.count("*").alias(n)).filter(F.col(n) > 1).select(doc, sha), "again")
    cols = docs.columns
    told = docs.withColumn(own, F.sha2(_plain(), 256))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(sha))
    left = told.join(groups.filter("NOT kept").select(doc, sha).distinct(), same, "left_anti")
    if again.isEmpty():
        return left.select(cols)
    one = left.join(again, same, "left_semi").groupBy("doc_id", own).agg(F.min_by(F.struct(*cols), F.xxhash64(*cols)).alias(row)).select(f"{row}.*")
    return left.join(again, same, "left_anti").select(cols).unionByName(one)


SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM t
"""
