"""Split files: the pages of each segment as a file of its own, written by executors, with a log of what became of each document.

The splitter, which knows the files' format, is given: it gets a seekable stream of a document and page ranges, and yields the
bytes of one file a range. A document's files appear under their folder all at once. Each task logs its documents when it ends,
however it ends; the log is published when the job is committed and also when it is aborted.
"""

from __future__ import annotations

import csv
import io
import re
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from leafcut.sources import store
from leafcut.sources.files import opened, spread

Splitter = Callable[[object, list[tuple[int, int]]], Iterator[bytes]]

# Columns and states of the log.
LOG = ("pdf_filename", "output_dir", "status", "seconds")
LOG_SCHEMA = "pdf_filename string, output_dir string, status string, seconds double"
OK = "OK"
_SINK = "doc_id string, path string, segments array<struct<output_file: string, start_page: int, end_page: int>>"


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


@dataclass
class Written(WriterCommitMessage):
    """What a task tells the driver: the name of its log, and counts."""

    log: str
    documents: int
    failed: int


class SegmentFiles(DataSource):
    """The sink behind write_segments(); option folder."""

    splitter: Splitter

    @classmethod
    def name(cls) -> str:
        return "segment_files"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _SegmentWriter(self.options["folder"], type(self).splitter)


class _SegmentWriter(DataSourceWriter):
    def __init__(self, folder: str, splitter: Splitter):
        self.folder, self.splitter = folder.rstrip("/"), splitter

    def write(self, iterator) -> WriterCommitMessage:
        name, rows = f"{uuid.uuid4().hex}.csv", []
        try:
            for r in iterator:
                began = time.time()
                to = f"{self.folder}/{r['doc_id']}"
                try:
                    self._document(r, to)
                    status = OK
                except Exception as e:  # noqa: BLE001  a document that fails stops no other
                    status = f"FAILED (exception: {e})"
                rows.append((r["path"].rpartition("/")[2], to, status, round(time.time() - began, 1)))
        finally:
            if rows:
                self._log(f"_attempts/{name}", rows)
        return Written(name if rows else "", len(rows), sum(x[2] != OK for x in rows))

    def _document(self, r, to: str) -> None:
        where, at = _at(to)
        beside = f"{at}.{uuid.uuid4().hex}"
        parts = list(r["segments"])
        try:
            with opened(r["path"]) as stream:
                made = self.splitter(stream, [(s["start_page"], s["end_page"]) for s in parts])
                where.create_dir(beside)
                for s, content in zip(parts, made, strict=True):
                    with where.open_output_stream(f"{beside}/{s['output_file']}", compression=None) as out:
                        out.write(content)
            # An earlier attempt of the task may have got so far; its files are the same.
            if where.get_file_info(at).type == fs.FileType.NotFound:
                where.move(beside, at)
        finally:
            if where.get_file_info(beside).type != fs.FileType.NotFound:
                where.delete_dir(beside)

    def _log(self, name: str, rows: list[tuple]) -> None:
        text = io.StringIO()
        out = csv.writer(text, lineterminator="\n")
        out.writerow(LOG)
        out.writerows(rows)
        where, at = _at(f"{self.folder}/{name}")
        where.create_dir(at.rpartition("/")[0])
        with where.open_output_stream(at, compression=None) as sink:
            sink.write(text.getvalue().encode())

    def _publish(self, names: list[str], state: str) -> None:
        where, at = _at(self.folder)
        where.create_dir(f"{at}/batch_run_log")
        for name in names:
            where.move(f"{at}/_attempts/{name}", f"{at}/batch_run_log/{name}")
        if where.get_file_info(f"{at}/_attempts").type != fs.FileType.NotFound:
            where.delete_dir(f"{at}/_attempts")
        with where.open_output_stream(f"{at}/{state}") as out:
            out.write(b"")

    def commit(self, messages) -> None:
        self._publish([m.log for m in messages if m is not None and m.log], "_SUCCESS")

    def abort(self, messages) -> None:
        """Keeps the log of every attempt: what was done is done."""
        where, at = _at(self.folder)
        found = where.get_file_info(fs.FileSelector(f"{at}/_attempts", allow_not_found=True))
        self._publish([x.base_name for x in found], "_ABORTED")


def write_segments(summary: DataFrame, bundles: DataFrame, splitter: Splitter, root: str, name: str = "run") -> str:
    """Writes each segment of summary (pdf_id, output_file, start_page, end_page) from its bundle (doc_id, path), under a folder root/name_vN that this run alone claims, one folder a document; returns that folder. Only paths and page ranges are shuffled; a document's segments are one row, as they are read from one file."""
    spark = summary.sparkSession

    class Sink(SegmentFiles):
        pass

    Sink.splitter = staticmethod(splitter)
    spark.dataSource.register(Sink)
    per = summary.groupBy(F.col("pdf_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("start_page", "end_page", "output_file"))).alias("s"))
    parts = F.transform("s", lambda x: F.struct(x["output_file"].alias("output_file"), x["start_page"].cast("int").alias("start_page"), x["end_page"].cast("int").alias("end_page")))
    rows = per.join(bundles.select("doc_id", "path"), "doc_id").select("doc_id", "path", parts.alias("segments"))
    folder = store.claim(spark, root, name)
    spread(rows, "doc_id").write.format("segment_files").option("folder", folder).mode("append").save()
    return folder


def batch_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log of a folder that write_segments() made, also of a run that was aborted; a document that several attempts reached has a row for each."""
    return spark.read.schema(LOG_SCHEMA).option("header", True).option("escape", '"').csv(f"{folder}/batch_run_log")
