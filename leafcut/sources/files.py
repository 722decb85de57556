"""Page files: listings without contents, and pages read by executors, by file and page range, through a decoder that is given."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, LessThan, LessThanOrEqual

PAGE_FILES = "*.[pP][dD][fF]"
#: The page contract.
KINDS = {
    "doc_id": "string", "page_num": "int", "width": "double", "height": "double", "text": "string", "bands": "map<string, struct<header: string, footer: string>>",
    "drawing_count": "int", "image_count": "int", "image_area": "double", "image_infos": "array<struct<width: int, height: int, colorspace: int>>",
}
NAMES = tuple(KINDS)
RAW_PAGES = ", ".join(f"{name} {kind}" for name, kind in KINDS.items())
#: Pages that a task decodes at a time, where a file has more; tasks at most.
PAGES_PER_TASK, MOST_TASKS = 64, 20_000


class Document(Protocol):
    """An open file: its number of pages, and each page (from 1) as a value for every wanted column that it can tell."""

    def __len__(self) -> int: ...

    def page(self, number: int, wanted: frozenset[str]) -> dict: ...


#: Opens a seekable stream of a file's bytes.
Decoder = Callable[[object], Document]


def identity(path: Column, roots: Iterable[str] = ()) -> Column:
    """The place of a file below the folder that it was found in, without the ending; of other files the bare name."""
    plain = F.regexp_replace(path, r"\.[^./]+$", "")
    out = F.regexp_extract(plain, r"([^/]+)$", 1)
    for root in roots:
        at = re.sub(r"^file:/+", "/", root).rstrip("/") + "/"
        bare = F.regexp_replace(plain, r"^file:/+", "/")
        out = F.when(F.startswith(bare, F.lit(at)), F.substr(bare, F.lit(len(at) + 1))).otherwise(out)
    return out


def listing(spark: SparkSession, paths: list[str], recursive: bool = False) -> DataFrame:
    """doc_id, path and length of page files below folders and of single files, by path. Spark lists them, in whatever store they are; no contents are read or shuffled; files without a byte are not listed. Files whose doc_id would be the same are refused, since their pages would be taken for those of one document."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", PAGE_FILES).option("recursiveFileLookup", str(recursive).lower()).load(paths)
    files = found.select("path", "length").dropDuplicates(["path"])
    files = files.select(identity(F.col("path"), [qualified(spark, p) for p in paths]).alias("doc_id"), "path", "length")
    twice = files.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("path").alias("a"), F.max("path").alias("b")).filter("n > 1").first()
    if twice is not None:
        raise ValueError(f"{twice.a} and {twice.b} would both be document {twice.doc_id!r}; read them from a common folder, or apart")
    return files.orderBy("path")


def qualified(spark: SparkSession, path: str) -> str:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(at).toString()


def opened(uri: str):
    """A seekable stream of a file in any store."""
    where, at = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return where.open_input_file(at)


def _range(decoder: Decoder, doc_id: str, path: str, first: int, last: int | None, wanted: tuple[str, ...]) -> Iterator[tuple]:
    """Pages first to last of a file, as tuples of the wanted columns."""
    asked = frozenset(wanted) - {"doc_id", "page_num"}
    with opened(path) as stream:
        doc = decoder(stream)
        for n in range(first, (len(doc) if last is None else min(last, len(doc))) + 1):
            row = doc.page(n, asked)
            yield tuple(doc_id if c == "doc_id" else n if c == "page_num" else row.get(c) for c in wanted)


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Few short rows that each stand for long work, dealt over as many tasks: by their bytes Spark would put them all into one."""
    return rows.repartition(max(1, min(rows.count(), MOST_TASKS)), *keys)


def counted(files: DataFrame, decoder: Decoder) -> DataFrame:
    """doc_id, path, pages and error: how many pages each file has, told by executors; a file that can't be opened has none, and says why."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = []
            for doc, path in zip(p["doc_id"], p["path"], strict=True):
                try:
                    with opened(path) as stream:
                        rows.append((doc, path, len(decoder(stream)), None))
                except Exception as e:  # noqa: BLE001  a broken file is a status, not a failed job
                    rows.append((doc, path, 0, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(rows, columns=["doc_id", "path", "pages", "error"])

    return spread(files.select("doc_id", "path"), "path").mapInPandas(run, "doc_id string, path string, pages int, error string")


def pages(counts: DataFrame, decoder: Decoder, max_pages: int | None = None, columns: Iterable[str] | None = None, pages_per_task: int = PAGES_PER_TASK) -> DataFrame:
    """Rows of the page contract (RAW_PAGES) for counted() files, or the given columns of them. A file's pages are dealt out in ranges, so a long one is no single task's, and pages beyond max_pages are never opened. A range that fails gives one row with its error; see whole() and failures()."""
    wanted = NAMES if columns is None else tuple(c for c in NAMES if c in {"doc_id", "page_num", *columns})
    schema = ", ".join(f"{c} {KINDS[c]}" for c in wanted)
    most = F.col("pages") if max_pages is None else F.least("pages", F.lit(max_pages))
    ranges = counts.withColumn("most", most).filter("most > 0").select("doc_id", "path", "most", F.explode(F.sequence(F.lit(1), F.col("most"), F.lit(pages_per_task))).alias("first"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for doc, path, first, most in zip(p["doc_id"], p["path"], p["first"], p["most"], strict=True):
                try:
                    rows, error = list(_range(decoder, doc, path, int(first), int(min(most, first + pages_per_task - 1)), wanted)), None
                except Exception as e:  # noqa: BLE001
                    rows, error = [], f"{type(e).__name__}: {e}"[:500]
                out = pd.DataFrame(rows, columns=list(wanted)).astype(object)
                if error is not None:
                    out = pd.DataFrame([tuple(doc if c == "doc_id" else int(first) if c == "page_num" else None for c in wanted)], columns=list(wanted)).astype(object)
                out["error"] = error
                yield out

    return spread(ranges, "path", "first").mapInPandas(run, f"{schema}, error string")


def whole(decoded: DataFrame) -> DataFrame:
    """Of pages(), the documents of which every range was decoded."""
    broken = decoded.filter("error IS NOT NULL").select("doc_id").distinct()
    return decoded.drop("error").join(broken, "doc_id", "left_anti")


def failures(counts: DataFrame, decoded: DataFrame | None = None) -> DataFrame:
    """doc_id, path, status and error of files that could not be opened, that have no pages, or of which a page could not be decoded."""
    bad = counts.filter("pages = 0").select("doc_id", "path", F.coalesce("error", F.lit("no pages")).alias("error"))
    if decoded is not None:
        torn = decoded.filter("error IS NOT NULL").groupBy("doc_id").agg(F.min_by("error", "page_num").alias("error"))
        bad = bad.unionByName(counts.select("doc_id", "path").join(torn, "doc_id"))
    return bad.select("doc_id", "path", F.lit("FAILED").alias("status"), "error")


class _Range(InputPartition):
    def __init__(self, doc_id: str, path: str, first: int, last: int | None):
        self.doc_id, self.path, self.first, self.last = doc_id, path, first, last


class PageSource(DataSource):
    """spark.read.format("pages"): the page contract of files of a folder, in any store that Arrow's file systems reach; see page_source(). Options path, recursive, pages_per_task. With spark.sql.python.filterPushdown.enabled a bound on page_num is pushed down: only pages up to it are opened, in ranges."""

    decoder: Decoder

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return RAW_PAGES

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options, type(self).decoder)


class _PageReader(DataSourceReader):
    def __init__(self, options, decoder: Decoder):
        self.options, self.decoder, self.most = options, decoder, None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (LessThan, LessThanOrEqual)) and f.attribute == ("page_num",):
                bound = f.value - isinstance(f, LessThan)
                self.most = bound if self.most is None else min(self.most, bound)
            else:
                yield f

    def partitions(self):
        root = self.options["path"]
        where, at = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", root) if ":/" in root else f"file://{root}")
        scheme = root[: root.index(at)] if at in root and ":/" in root else "file://"
        deep = str(self.options.get("recursive", "false")).lower() == "true"
        found = where.get_file_info(fs.FileSelector(at, recursive=deep))
        step = int(self.options.get("pages_per_task", PAGES_PER_TASK))
        starts = [1] if self.most is None else range(1, self.most + 1, step)
        files = sorted(x.path for x in found if x.type == fs.FileType.File and x.path.lower().endswith(".pdf"))
        names = [x[len(at.rstrip("/")) + 1 :].rpartition(".")[0] for x in files]
        return [_Range(doc, f"{scheme}{x}", a, None if self.most is None else min(self.most, a + step - 1)) for doc, x in zip(names, files, strict=True) for a in starts]

    def read(self, part):
        yield from _range(self.decoder, part.doc_id, part.path, part.first, part.last, NAMES)


def page_source(given: Decoder) -> type[PageSource]:
    """The data source "pages" with a decoder, for spark.dataSource.register()."""

    class Pages(PageSource):
        decoder = staticmethod(given)

    return Pages
