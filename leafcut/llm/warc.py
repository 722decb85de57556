"""Web archives: pages as WARC records, and a normaliser of archives that are one gzip stream from end to end.

write_archives() has Spark write records as text in whole-file gzip streams, through its commit protocol. normalise() inflates
such a stream once, piece by piece, and rewrites every record as a gzip member of its own; beside each archive it writes a
sidecar with the identifier, offset and length of every member, and returns the same as rows. read_records() then seeks to
members, wherever they are, and checks lengths and digests. A task that is run again writes under a new name; only names that
a successful task returned are ever read.

Defined results: null html is an empty payload; of rows with equal payloads those with the smallest page_id are responses (all
of them, should a page_id repeat; all rows, if none of the group has a page_id), the others revisits that refer to it; payloads
shorter than `least` bytes are always responses; a null url gives a record without a target; line breaks in a url are percent-
encoded; a row without page_id gets a record without a number; long pages are streamed; other columns are ignored; an empty
table gives no records. A stream that breaks off, a record without a length or a digest that differs raise an error.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafcut.llm.common import FILTER_MOST, attach, delete, id_filter, passing, shared_dir, stage

#: Bytes that are read, inflated or copied at a time; bytes of archive that a reading task is meant to get; the longest header.
PIECE, PER_TASK, MOST_HEADER = 1 << 18, 64 << 20, 1 << 20
#: Pages have no time of their own.
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the format: the end of lines and of records, the profile of revisits, the digits of base 32 in two alphabets.
EOL, END = "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
URN = "urn:leafcut:page:"

INDEX = "file string, offset long, length long, record_id string, record_type string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def base32_sha1(c: Column) -> Column:
    """SHA-1 in base 32, five hexadecimal digits to four of the result."""
    s = F.sha1(c)
    return F.translate(F.concat(*(F.lpad(F.conv(F.substring(s, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8))), DIGITS, BASE32)


def revisits(pages: DataFrame, least: int = 0, most: int = FILTER_MOST) -> tuple[DataFrame, Broadcast | None]:
    """page_id, url, html of all pages, and refers_to: the page that has the same payload first, null for that page itself; and what may be destroyed once that has been read. Only payloads that may occur twice are shuffled; most: beyond so many repeated payloads all are."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")).withColumn("key", F.unhex(F.sha2("html", 256)))
    groups = own.filter(F.octet_length("html") >= least).groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    groups = stage(groups, "payloads")
    count = groups.count()
    if not count:
        return own.select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to")), None
    total, number = pages.count(), F.xxhash64("key")
    alone = shared = None
    if count <= most:
        shared = spark.sparkContext.broadcast(id_filter(groups.select(number)))

        @F.pandas_udf("boolean")
        def repeated(k: pd.Series) -> pd.Series:
            hit = pd.Series(False, index=k.index)
            hit.iloc[passing(shared, k.to_numpy())] = True
            return hit

        told = own.withColumn("again", repeated(number))
        alone, own = told.filter("NOT again").select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to")), told.filter("again").drop("again")
    first = attach(own, groups, "key", "n", total)
    first = first.select("page_id", "url", "html", F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")).alias("refers_to"))
    return first if alone is None else alone.unionByName(first), shared


def records(rows: DataFrame) -> DataFrame:
    """The text of each record (page_id, url, html, refers_to in), but for the end that closes it."""
    c, again = F.col, F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(EOL))
    named = lambda x: F.concat(F.lit(f"<{URN}"), F.coalesce(x.cast("string"), F.lit("none")), F.lit(">"))
    url = F.replace(F.replace(c("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.octet_length("html").cast("string"), F.lit(END))
    block = F.concat(http, F.when(again, "").otherwise(c("html")))
    head = F.concat(
        F.lit(f"WARC/1.0{EOL}"), line("WARC-Type", F.when(again, "revisit").otherwise("response")), line("WARC-Record-ID", named(c("page_id"))), line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(c("html")))),
        F.when(again, F.concat(line("WARC-Refers-To", named(c("refers_to"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""), line("Content-Type", F.lit("application/http; msgtype=response")),
    )
    return rows.select(F.concat(head, line("Content-Length", F.octet_length(block).cast("string")), F.lit(EOL), block).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = 0, rows_per_file: int = 100_000) -> None:
    """A record per page, in files that are one gzip stream each."""
    # Streams that are rewritten soon are packed quickly rather than tightly.
    options = {"compression": "gzip", "lineSep": END, "maxRecordsPerFile": rows_per_file, "zlib.compress.level": "BEST_SPEED"}
    rows, shared = revisits(pages, least)
    records(rows).write.options(**options).text(path)
    if shared is not None:
        shared.destroy()


def archives(spark, path: str) -> DataFrame:
    """Paths of the files of a folder; their contents are not read. Spark deals them out by size."""
    return spark.read.format("binaryFile").load(path).select("path")


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class _Stream:
    """Inflated bytes of a file of one gzip member or of several, of which a few pieces are held at a time."""

    def __init__(self, source):
        self.source, self.inflate, self.held, self.rest, self.used = source, zlib.decompressobj(31), bytearray(), b"", False

    def more(self) -> bool:
        """Inflates one more piece; false at the end."""
        while True:
            raw = self.rest or self.source.read(PIECE)
            if raw and self.inflate.eof:
                self.inflate, self.used = zlib.decompressobj(31), False
            if not raw and (self.inflate.eof or not self.used):
                return False
            self.used = True
            got = self.inflate.decompress(raw, 4 * PIECE)
            self.rest = self.inflate.unconsumed_tail or self.inflate.unused_data
            self.held += got
            if got:
                return True
            if not raw:
                raise ValueError("the stream breaks off")

    def header(self) -> bytes | None:
        """All up to an empty line; null at the end."""
        start = 0
        while True:
            # Blank lines between records are passed over.
            while self.held[:2] == b"\r\n":
                del self.held[:2]
            end = self.held.find(b"\r\n\r\n", start)
            if end >= 0:
                out = bytes(self.held[: end + 4])
                del self.held[: end + 4]
                return out
            start = max(0, len(self.held) - 3)
            if len(self.held) > MOST_HEADER:
                raise ValueError("a record without a header")
            if not self.more():
                if self.held.strip():
                    raise ValueError("the stream breaks off within a header")
                return None

    def pieces(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.held and not self.more():
                raise ValueError("the stream breaks off within a record")
            out = bytes(self.held[:size])
            del self.held[:size]
            size -= len(out)
            yield out


def fields(header: bytes) -> dict[str, str]:
    """Named fields of a header, names in lower case; of a name that repeats the first."""
    out: dict[str, str] = {}
    for x in header.decode("utf-8", "replace").split(EOL)[1:]:
        name, colon, value = x.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _size(named: dict[str, str]) -> int:
    if not re.fullmatch(r"[0-9]+", named.get("content-length", "")):
        raise ValueError("a record without a length")
    return int(named["content-length"])


def _rewrite(source, sink, level: int) -> Iterator[tuple[int, int, str, str]]:
    """Copies the records of a stream as members; offset, length, identifier and type of each."""
    stream, offset = _Stream(source), 0
    while (head := stream.header()) is not None:
        named = fields(head)
        pack, length = zlib.compressobj(level, zlib.DEFLATED, 31), 0
        for piece in chain([head], stream.pieces(_size(named))):
            length += sink.write(pack.compress(piece))
        length += sink.write(pack.compress(END.encode()) + pack.flush())
        yield offset, length, named.get("warc-record-id", ""), named.get("warc-type", "")
        offset += length


def normalise(files: DataFrame, out: str, level: int = 6) -> DataFrame:
    """Rewrites archives (path) into out, every record as a member of its own, with a sidecar index beside each; returns the index (INDEX), which alone tells which files count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in INDEX.split(", ")]
        for b in batches:
            for path in b.column(0).to_pylist():
                stem = re.sub(r"(\.(txt|warc))?\.gz$", "", path.rpartition("/")[2])
                to = f"{out}/{stem}-{uuid.uuid4().hex}.warc.gz"
                source_fs, at = _at(path)
                target_fs, target = _at(to)
                target_fs.create_dir(target.rpartition("/")[0])
                with source_fs.open_input_stream(at, compression=None) as source, target_fs.open_output_stream(target, compression=None) as sink, target_fs.open_output_stream(f"{target}.idx") as side:
                    rows = []
                    for offset, length, record, kind in _rewrite(source, sink, level):
                        side.write(f"{record} {offset} {length}\n".encode())
                        rows.append((to, offset, length, record, kind))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names)

    return files.select("path").mapInArrow(run, INDEX)


def _number(urn: str | None) -> int | None:
    found = re.fullmatch(rf"<{URN}(-?[0-9]+)>", urn or "")
    return int(found[1]) if found else None


def _read(member: bytes, payloads: bool) -> tuple:
    stream = _Stream(pa.BufferReader(member))
    named = fields(stream.header() or b"")
    digest, kind, end = named.get("warc-payload-digest", "").removeprefix("sha1:"), named.get("warc-type"), END.encode()
    head, at, size, own, kept = b"", -1, 0, hashlib.sha1(), []
    for piece in stream.pieces(_size(named)):
        if at < 0:
            head += piece
            if (at := head.find(end)) < 0:
                continue
            head, piece = head[:at], head[at + len(end) :]
        size += len(piece)
        own.update(piece)
        if payloads:
            kept.append(piece)
    length = int(fields(head).get("content-length", size))
    if kind == "response" and (length, digest) != (size, base64.b32encode(own.digest()).decode()):
        raise ValueError(f"{named.get('warc-record-id')} does not hold the payload that it names")
    return _number(named.get("warc-record-id")), named.get("warc-target-uri"), length, digest, kind, _number(named.get("warc-refers-to")), b"".join(kept) if payloads and kind == "response" else None


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of an index, as RECORDS: each task seeks to its members. A revisit has the digest and the length of the full payload, and no payload of its own."""
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, total // PER_TASK + 1)
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, source = None, None
        try:
            for b in batches:
                for i in range(0, b.num_rows, 64):
                    rows = []
                    for path, offset, length in zip(*(x.to_pylist() for x in b.slice(i, 64).columns), strict=True):
                        if path != file:
                            if source is not None:
                                source.close()
                            where, at = _at(path)
                            file, source = path, where.open_input_file(at)
                        rows.append(_read(source.read_at(length, offset), payloads))
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        finally:
            if source is not None:
                source.close()

    dealt = index.select("file", "offset", "length").repartition(int(tasks), "file", F.floor(F.col("offset") / PER_TASK))
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(run, RECORDS)


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """What the archives of pages hold, read back: page_id, payload_bytes, payload_digest, record_type, refers_to. The archives stay in the shared folder until the application ends."""
    spark = pages.sparkSession
    where = f"{shared_dir(spark)}/leafcut-warc-{uuid.uuid4().hex}"
    delete(spark, where, at_exit=True)
    write_archives(pages, f"{where}/streams", least)
    index = stage(normalise(archives(spark, f"{where}/streams"), f"{where}/members"), "members")
    delete(spark, f"{where}/streams")
    return read_records(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), g AS (SELECT page_id, h, sha1(h) AS s, min(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, translate({" || ".join(f"to_base(('0x' || substr(s, {1 + 5 * i}, 5))::BIGINT, 32, 4)" for i in range(8))}, '{DIGITS}', '{BASE32}') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM g
"""
