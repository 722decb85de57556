"""Readers: bundle listings, page contract tables, taxonomy and prototype JSON, per-bundle summaries; and the decoder seam."""

from __future__ import annotations

import csv
import uuid
import warnings
from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafcut.functions import layout
from leafcut.operators import classify
from leafcut.sources import files, store
from leafcut.sources.embedding import EMPTY_PAGE, EmbeddingProvider, Parts, embed, failed_documents

RAW_PAGES = files.RAW_PAGES
__all__ = ["EMPTY_PAGE", "EmbeddingProvider", "Parts", "embed", "failed_documents", "bundles", "decode", "exists", "failures", "in_order", "prototypes", "save_prototypes", "summaries", "taxonomy", "with_bands", "write_prototypes"]
# Defaults of a taxonomy's settings.
DEFAULTS = {"prototype_min_confidence": 0.82, "keyword_min_hits": 1, "low_confidence_threshold": 0.65, "prototype_min_pages_to_save": 2}


def bundles(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """doc_id, path and length of the PDF files of folders and of single files, extension in any case, ordered by path; doc_id is the place below its folder. An input that does not exist is warned of and left out; one file named twice comes once; files that would be one document are refused (see files.listing)."""
    known = [x for x in ([path] if isinstance(path, str) else path) if exists(spark, x)]
    return files.listing(spark, known, recursive) if known else spark.createDataFrame([], "doc_id string, path string, length long")


def exists(spark: SparkSession, path: str, warn: bool = True) -> bool:
    """Whether a path is there, in whatever store Spark reads it from."""
    found = store.exists(spark, path)
    if warn and not found:
        warnings.warn(f"not found, skipped: {path}", stacklevel=3)
    return found


def taxonomy(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, dict]:
    """types, phrases and settings of a taxonomy file; settings that it lacks have their defaults."""
    schema = "classification map<string, double>, document_types array<struct<id: string, label: string, category: string, ingest_mode: string, anchor_phrases: array<string>, keywords: array<string>>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    t = raw.select(F.posexplode("document_types").alias("type_ord", "t"))
    types = t.select("type_ord", F.col("t.id").alias("type_id"), F.coalesce("t.label", "t.id").alias("label"), "t.category", F.coalesce("t.ingest_mode", F.lit("standard")).alias("ingest_mode"))
    kind = lambda name, field: t.select("type_ord", F.col("t.id").alias("type_id"), F.lit(name).alias("kind"), F.posexplode(f"t.{field}").alias("phrase_ord", "phrase"))
    phrases = kind("anchor", "anchor_phrases").unionByName(kind("keyword", "keywords"))
    row = raw.select("classification").first()
    return types, phrases, {**DEFAULTS, **((row and row[0]) or {})}


def _versions(spark: SparkSession, path: str) -> str:
    """Where the versions of a prototype store are: in its folder, or beside a plain file that came before them."""
    return f"{path}.versions" if store.is_file(spark, path) else path


def _plain(spark: SparkSession, path: str) -> DataFrame:
    """type_id, ord, vec of a JSON file of prototypes. A file that is not valid JSON fails."""
    raw = spark.read.option("wholetext", True).text(path).select(F.from_json("value", "map<string, array<array<double>>>", {"mode": "FAILFAST"}).alias("m"))
    return raw.select(F.explode("m").alias("type_id", "vs")).filter("size(vs) > 0").select("type_id", F.posexplode("vs").alias("ord", "vec"))


def prototypes(spark: SparkSession, path: str, types: DataFrame, version: int | None = None) -> DataFrame:
    """type_id, type_ord, ord, vec of known types with vectors: of a store's newest version, or of the given one; of a JSON file; none where there is nothing yet. Versions that are saved later do not change what is read."""
    rows = store.read(spark, _versions(spark, path), version)
    if rows is None:
        rows = _plain(spark, path) if store.exists(spark, path) else spark.createDataFrame([], "type_id string, ord int, vec array<double>")
    return rows.join(F.broadcast(types.select("type_id", "type_ord")), "type_id").select("type_id", "type_ord", "ord", "vec")


def save_prototypes(spark: SparkSession, path: str, taught: DataFrame) -> tuple[int, int, int]:
    """Adds taught vectors (type_id, ord, vec) behind those of a store, the last classify.KEPT of each type staying, as its next version: its number, how many of its vectors are new, and how many it has.
    A JSON file of that name is what the first version goes by, and stays as it is. If another run saves meanwhile, its vectors count as older."""
    at = _versions(spark, path)
    plain = _plain(spark, path).withColumn("version", F.lit(0)) if at != path else None

    def change(old: DataFrame | None, n: int) -> DataFrame:
        new = taught.select("type_id", "ord", "vec").withColumn("version", F.lit(n))
        old = old if old is not None else plain if plain is not None else new.limit(0).withColumn("ord", F.lit(0))
        return classify.keep_prototypes(old, new)

    n = store.update(spark, at, change)
    row = store.read(spark, at, n).agg(F.count_if(F.col("version") == n).alias("new"), F.count("*").alias("all")).first()
    return n, row["new"], row["all"]


def write_prototypes(kept: DataFrame, path: str) -> int:
    """Writes one JSON object and returns the number of vectors; the cap on prototypes a type bounds its size. What is there is replaced once the new file is whole, so it may be what `kept` was read from. Runs that share a file use save_prototypes()."""
    spark, beside = kept.sparkSession, f"{path}.{uuid.uuid4().hex}"
    rows = kept.groupBy("type_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "vec"))), lambda x: x["vec"]).alias("vs"))
    rows.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("type_id", "vs"))))).coalesce(1).write.text(beside)
    n = _plain(spark, beside).count()
    store.delete(spark, path)
    store.rename(spark, beside, path)
    return n


#: Columns that tell where a row of summaries() stood: sorting by them gives the order of the files, and of the rows in each.
PLACE = ("_file", "_block", "_row")


def summaries(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of per-bundle summary files, one folder level down, with where each stood (PLACE: its file, the block of the file that a task read, the row within that); by position under the header of the first file that has one.
    Files without any line give nothing. A header line that differs is warned of, and its rows are kept by position."""
    text = spark.read.text(f"{path}/*/*.csv", wholetext=True).withColumn("_file", F.input_file_name())
    heads = text.select("_file", F.regexp_extract("value", r"^\x{FEFF}?([^\r\n]*)", 1).alias("head")).filter("head <> ''")
    first = heads.agg(F.min(F.struct("_file", "head")).alias("m")).select("m.head").first()[0]
    if first is None:
        return spark.createDataFrame([], f"{schema + ', ' if schema else ''}_file string, _block long, _row long")
    for (other,) in heads.filter(F.col("head") != first).select(F.min("_file")).collect():
        if other:
            warnings.warn(f"columns may not line up: the header of {other} differs from the first file's", stacklevel=2)
    shape = schema or ", ".join(f"`{c}` string" for c in next(csv.reader([first])))
    read = spark.read.option("header", True).option("enforceSchema", True).option("multiLine", True).option("escape", '"').schema(shape)
    rows = read.csv(f"{path}/*/*.csv")
    # A task reads a block from its start on, so its running number orders the block's rows.
    return rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))


def in_order(rows: DataFrame) -> DataFrame:
    """summaries() in the order of their files, dealt over tasks by ranges of that order, so that part files follow one another and no task has them all."""
    return rows.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)


class PageDecoder(Protocol):
    """Turns a bundle's bytes into rows of the page contract, up to a page cap."""

    def __call__(self, doc_id: str, content: bytes, max_pages: int | None) -> Iterable[tuple]: ...


def decode(bundles: DataFrame, decoder: PageDecoder, max_pages: int | None = None) -> DataFrame:
    """Pages of bundles by a decoder that wants a whole file's bytes, which the task reads itself; a bundle that fails gives no pages and does not stop the others (see failures()). For long files see files.pages()."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for doc, path in zip(p["doc_id"], p["path"], strict=True):
                try:
                    with files.opened(path) as stream:
                        rows = list(decoder(doc, stream.read(), max_pages))
                except Exception:  # noqa: BLE001  a broken file is a status, not a failed job
                    rows = []
                yield pd.DataFrame(rows, columns=list(files.NAMES))

    return files.spread(bundles.select("doc_id", "path"), "path").mapInPandas(run, RAW_PAGES)


def failures(bundles: DataFrame, pages: DataFrame) -> DataFrame:
    """Bundles of which no page was decoded."""
    return bundles.select("doc_id").join(pages.select("doc_id").distinct(), "doc_id", "left_anti").withColumn("status", F.lit("FAILED"))


def with_bands(pages: DataFrame, words: DataFrame) -> DataFrame:
    """Pages (doc_id, page_num, width, height, ...) of a decoder that gives words by position, with the header and footer bands that the detectors read; a page without words has empty ones."""
    ws = words.groupBy("doc_id", "page_num").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1", "text")).alias("_ws"))
    none = F.array().cast("array<struct<x0: double, y0: double, x1: double, y1: double, text: string>>")
    return pages.drop("bands").join(ws, ["doc_id", "page_num"], "left").withColumn("bands", layout.bands(F.coalesce("_ws", none), F.col("height"))).drop("_ws")
