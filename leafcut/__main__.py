"""Command line: run the page plan over decoded pages, merge summaries of runs, count or redact personal data."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafcut.operators import classify, redact, reports
from leafcut.plans import pipeline
from leafcut.sources import readers
from leafcut.streaming import batches


def _given(name: str | None):
    """What module:attribute names: a decoder, a splitter or an embedding function of the caller's."""
    if not name:
        return None
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _learn(spark: SparkSession, a: argparse.Namespace, types: DataFrame, classified: DataFrame) -> None:
    n, new, kept = readers.save_prototypes(spark, a.prototypes, classify.taught(classified, types))
    print(f"prototypes: version {n}, {new} new of {kept}")


def run(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Summaries and reports of all documents that out has none of yet, as its next part; a dry run only tells which they are. A run that broke off is made again as the same part, so nothing comes twice. With --accumulate-prototypes, what the segments may teach is added to the prototypes."""
    pages = spark.read.parquet(a.pages)
    known_docs = readers.exists(spark, f"{a.out}/summary", warn=False)
    done = spark.read.parquet(f"{a.out}/summary") if known_docs else spark.createDataFrame([], "pdf_id string, part int")
    todo = reports.pending(pages.select("doc_id").distinct(), done.select(F.col("pdf_id").alias("doc_id")), "doc_id")
    if a.dry_run:
        return reports.batch_plan(todo.select(F.concat("doc_id", F.lit(".pdf")).alias("pdf_filename")), spark.createDataFrame([], "pdf_filename string"), a.out)
    types, phrases, settings = readers.taxonomy(spark, a.taxonomy)
    known = readers.prototypes(spark, a.prototypes, types) if a.prototypes else None
    table = lambda path: spark.read.parquet(path) if path else None
    # The summary comes last and tells which parts are whole.
    part = 1 + (done.agg(F.max("part")).first()[0] or 0)
    result = pipeline.run(pages.join(todo, "doc_id"), table(a.toc), table(a.vectors), types, phrases, known if a.vectors else None, a.max_pages, settings=settings, teach=a.accumulate_prototypes)
    try:
        result.report().write.mode("overwrite").parquet(f"{a.out}/report/part={part}")
        if a.accumulate_prototypes:
            _learn(spark, a, types, result.classified)
        result.summary.write.mode("overwrite").parquet(f"{a.out}/summary/part={part}")
    finally:
        result.release()
    return spark.read.parquet(f"{a.out}/summary").groupBy("pdf_id").agg(F.count("*").alias("segments")).orderBy("pdf_id")


def batch(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The whole plan over a folder of bundles, from where the last run ended: reads them through the decoder, and with a splitter writes each segment as a file."""
    types, phrases, settings = readers.taxonomy(spark, a.taxonomy)
    known = readers.prototypes(spark, a.prototypes, types) if a.prototypes else None
    teach = (lambda classified: _learn(spark, a, types, classified)) if a.accumulate_prototypes else None
    batches.run_folder(spark, a.folder, a.out, _given(a.decoder), types, phrases, known, settings, a.max_pages, _given(a.embed), _given(a.splitter), teach, a.recursive, a.files_per_batch)
    if not readers.exists(spark, f"{a.out}/summary", warn=False):
        return spark.createDataFrame([], "pdf_id string, segments long")
    return batches.results(spark, a.out, "summary").groupBy("pdf_id").agg(F.count("*").alias("segments")).orderBy("pdf_id")


def merge(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """All rows of the summaries under a folder as CSV, file by file in the order of each file."""
    rows = readers.summaries(spark, a.folder)
    readers.in_order(rows).drop(*readers.PLACE).write.mode("overwrite").option("header", True).csv(a.out)
    return rows.groupBy("_file").agg(F.count("*").alias("rows")).orderBy("_file")


def redacted(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Counts by category, never the values; without a dry run the redacted pages are written too."""
    pages = spark.read.parquet(a.pages)
    if not a.dry_run:
        redact.redacted(pages).write.mode("overwrite").parquet(a.out)
    return redact.pattern_counts(pages).groupBy("category").agg(F.sum("regions").alias("regions")).orderBy("category")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="leafcut", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("run", help=run.__doc__)
    for name in ("pages", "taxonomy", "out"):
        p.add_argument(f"--{name}", required=True)
    for name in ("toc", "vectors", "prototypes"):
        p.add_argument(f"--{name}")
    p.add_argument("--max-pages", type=int)
    p.add_argument("--accumulate-prototypes", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.set_defaults(call=run)
    p = sub.add_parser("batch", help=batch.__doc__)
    p.add_argument("folder")
    for name in ("decoder", "taxonomy", "out"):
        p.add_argument(f"--{name}", required=True)
    for name in ("prototypes", "embed", "splitter"):
        p.add_argument(f"--{name}")
    p.add_argument("--max-pages", type=int)
    p.add_argument("--files-per-batch", type=int, default=batches.FILES_PER_BATCH)
    p.add_argument("--recursive", action="store_true")
    p.add_argument("--accumulate-prototypes", action="store_true")
    p.set_defaults(call=batch)
    p = sub.add_parser("merge", help=merge.__doc__)
    p.add_argument("folder")
    p.add_argument("--out", required=True)
    p.set_defaults(call=merge)
    p = sub.add_parser("redact", help=redacted.__doc__)
    p.add_argument("--pages", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--dry-run", action="store_true")
    p.set_defaults(call=redacted)
    return top


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    if getattr(a, "accumulate_prototypes", False) and not a.prototypes:
        parser().error("--accumulate-prototypes needs --prototypes")
    a.call(SparkSession.builder.appName("leafcut").getOrCreate(), a).show(1000, truncate=False)


if __name__ == "__main__":
    main()
