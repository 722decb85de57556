"""Folders of bundles, taken up where the last run ended: new files, batch by batch, each batch's results under its number.

Spark's file stream remembers in its checkpoint which files a batch has and which batches are over. A batch writes each result
over whatever an earlier attempt of the same batch left, so a run that is killed at any point repeats nothing and loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafcut.plans import pipeline
from leafcut.sources import files, sinks

#: Results of a batch, in the order in which they are written; a document is done by the last of them.
RESULTS = ("failures", "report", "summary")
FILES_PER_BATCH = 1000
_FILE = "path string, modificationTime timestamp, length long, content binary"


def each_batch(spark: SparkSession, folder: str, checkpoint: str, work: Callable[[DataFrame, int], None], recursive: bool = False, files_per_batch: int = FILES_PER_BATCH) -> int:
    """Calls work(files: doc_id, path, length; number) for all files of a folder that no earlier call finished, and ends; returns the number of batches. work may be called again for a batch that broke off, with the same files and number."""
    done = []
    root = files.qualified(spark, folder)

    def one(batch: DataFrame, number: int) -> None:
        found = batch.select(files.identity(F.col("path"), [root]).alias("doc_id"), "path", "length")
        work(found, number)
        done.append(number)

    source = spark.readStream.format("binaryFile").schema(_FILE).option("pathGlobFilter", files.PAGE_FILES).option("recursiveFileLookup", str(recursive).lower()).option("maxFilesPerTrigger", files_per_batch)
    query = source.load(folder).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)


def run_folder(
    spark: SparkSession, folder: str, out: str, decoder: files.Decoder, types: DataFrame, phrases: DataFrame, prototypes: DataFrame | None = None, settings: dict | None = None, max_pages: int | None = None,
    embed: Callable[[DataFrame], DataFrame] | None = None, splitter: sinks.Splitter | None = None, taught: Callable[[DataFrame], None] | None = None, recursive: bool = False, files_per_batch: int = FILES_PER_BATCH,
) -> int:
    """The whole plan over the bundles of a folder that out has no results of yet; see results() for what it leaves. embed gives vectors for pages that the features call not blank; splitter writes each batch's segments as files; taught gets each batch's classified segments once its results are written. Files that can't be decoded are failures and stop nothing."""

    def work(found: DataFrame, number: int) -> None:
        counts = files.counted(found, decoder).persist()
        decoded = files.pages(counts, decoder, max_pages).persist()
        result = None
        try:
            pages = files.whole(decoded)
            blank = pages.select("doc_id", "page_num", "text", F.lit(False).alias("is_blank"))
            result = pipeline.run(pages, None, embed(blank) if embed else None, types, phrases, prototypes if embed else None, None, settings=settings, teach=taught is not None)
            rows = {"failures": files.failures(counts, decoded), "report": result.report(), "summary": result.summary}
            if splitter is not None:
                sinks.write_segments(result.summary, found, splitter, out, f"batch{number}")
            for name in RESULTS:
                rows[name].write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
            if taught is not None:
                taught(result.classified)
        finally:
            if result is not None:
                result.release()
            decoded.unpersist()
            counts.unpersist()

    return each_batch(spark, folder, f"{out}/_checkpoint", work, recursive, files_per_batch)


def results(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The failures, report or summary of all batches."""
    return spark.read.option("basePath", f"{out}/{name}").parquet(f"{out}/{name}")
