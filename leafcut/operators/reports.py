"""Reports over segments, costs and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafcut.functions.text import slug
from leafcut.operators import scoring, similarity


def output_name(df: DataFrame) -> DataFrame:
    """Adds output_file: segment number, type label as slug, tags and page range."""
    tags = F.when(F.size("special_tags") > 0, F.concat(F.lit("_"), F.array_join("special_tags", "+"))).otherwise("")
    return df.withColumn("output_file", F.concat(F.format_string("segment_%03d_", "segment_index"), slug(F.col("document_type_label")), tags, F.format_string("_pp%d-%d.pdf", "start_page", "end_page")))


def segments_summary(classified: DataFrame, described: DataFrame, totals: DataFrame) -> DataFrame:
    """The sixteen columns of a document's summary."""
    at = described.select("doc_id", F.col("page_num").alias("start_page"), "boundary_signals")
    rows = output_name(classified).join(at, ["doc_id", "start_page"], "left").join(totals, "doc_id", "left")
    return rows.select(
        F.col("doc_id").alias("pdf_id"), F.concat("doc_id", F.lit(".pdf")).alias("pdf_filename"), "total_pages", F.col("segment_index").alias("seg"), "start_page", "end_page", (F.col("end_page") - F.col("start_page") + 1).alias("page_count"),
        "document_type_id", "document_type_label", "document_category", "confidence", "classification_method", F.coalesce("boundary_signals", F.lit("unscored_boundary")).alias("boundary_signals_fired"), F.array_join("special_tags", "|").alias("special_tags"), "ingest_mode", "output_file",
    )


#: Fixed value: the status of a run that was only planned.
DRY_RUN = "dry-run"


def batch_plan(inputs: DataFrame, done: DataFrame, root: str) -> DataFrame:
    """Log rows of a dry run: what would run and where its output would go, in order of file names; inputs (pdf_filename), done (pdf_filename)."""
    stem = F.regexp_replace("pdf_filename", r"\.[^./]+$", "")
    return pending(inputs, done, "pdf_filename").select("pdf_filename", F.concat(F.lit(root.rstrip("/") + "/"), stem).alias("output_dir"), F.lit(DRY_RUN).alias("status"), F.lit(0.0).alias("seconds")).orderBy("pdf_filename")


def batch_log(runs: DataFrame) -> DataFrame:
    """Log rows of finished runs: (pdf_filename, output_dir, exit_code, seconds) in; a status that is not 0 is told with its number."""
    status = F.when(F.col("exit_code") == 0, "OK").otherwise(F.concat(F.lit("FAILED("), "exit_code", F.lit(")")))
    return runs.select("pdf_filename", "output_dir", status.alias("status"), F.round("seconds", 1).alias("seconds")).orderBy("pdf_filename")


def cost_summary(costs: DataFrame, *keys: str) -> DataFrame:
    return costs.groupBy(*keys).agg(F.count("*").alias("calls"), F.sum("text_tokens").alias("text_tokens"), F.sum("image_tokens").alias("image_tokens"), F.bround(F.sum("cost_usd"), 6).alias("cost_usd"), F.bool_or("estimated").alias("any_estimated"))


def _config() -> Column:
    """The limits and weights that decided, as a struct."""
    named = lambda **v: F.struct(*(F.lit(x).alias(k) for k, x in v.items()))
    weights = named(structural=scoring.STRUCTURAL, returning_format=scoring.RETURNING, numbering_fresh=scoring.FRESH, numbering_reset=scoring.RESET, scheme_change=scoring.SCHEME, embedding_high=scoring.HIGH, embedding_moderate=scoring.EACH, drawing=scoring.DRAWING, letterhead=scoring.LETTERHEAD, penalty=scoring.PENALTY)
    return F.struct(weights.alias("weights"), *(F.lit(v).alias(k) for k, v in (("boundary_threshold", scoring.BOUNDARY), ("z_threshold", similarity.MODERATE_Z), ("z_high_threshold", similarity.HIGH_Z), ("min_absolute_drop", similarity.LEAST_DROP))))


def run_report(summary: DataFrame, scores: DataFrame, meta: DataFrame | None = None, timing: DataFrame | None = None, costs: DataFrame | None = None) -> DataFrame:
    """One JSON document a bundle: metadata, timing, cost, every segment and page in order with all that is known of them, and the configuration.
    meta and timing have a row a bundle (doc_id and any columns), costs some (doc_id and the columns of cost_summary); what is not given is left out."""
    parts = summary.withColumn("special_tags", F.filter(F.split("special_tags", r"\|"), lambda t: t != ""))
    segs = parts.groupBy(F.col("pdf_id").alias("doc_id")).agg(F.first("pdf_filename").alias("input_pdf"), F.max("total_pages").alias("total_pages"), F.array_sort(F.collect_list(F.struct(F.col("seg").alias("segment_index"), *(c for c in parts.columns if c != "seg")))).alias("segments"))
    pages = scores.groupBy("doc_id").agg(F.count("*").alias("pages_processed"), F.count_if("is_blank").alias("blank_pages_skipped"), F.array_sort(F.collect_list(F.struct("page_num", *(c for c in scores.columns if c not in ("doc_id", "page_num"))))).alias("per_page_detail"))
    rows = pages.join(segs, "doc_id", "left")
    one = lambda df, name: df.select("doc_id", F.struct(*(c for c in df.columns if c != "doc_id")).alias(name))
    told = ["input_pdf", "total_pages", "pages_processed", "blank_pages_skipped", F.size(F.coalesce("segments", F.array())).alias("segments_found")]
    if meta is not None:
        rows, told = rows.join(one(meta, "_meta"), "doc_id", "left"), [*told, *(F.col(f"_meta.{c}") for c in meta.columns if c != "doc_id")]
    if timing is not None:
        rows = rows.join(one(timing, "timing_seconds"), "doc_id", "left")
    if costs is not None:
        rows = rows.join(one(costs, "c").groupBy("doc_id").agg(F.array_sort(F.collect_list("c")).alias("cost_and_tokens")), "doc_id", "left")
    more = [c for c, x in (("timing_seconds", timing), ("cost_and_tokens", costs)) if x is not None]
    return rows.select("doc_id", F.to_json(F.struct(F.struct(*told).alias("run_metadata"), *more, "segments", "per_page_detail", _config().alias("config"))).alias("report"))


def merged(parts: list[DataFrame]) -> DataFrame:
    """All rows of summaries with the same number of columns, by position under the first one's names."""
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def next_version(taken: DataFrame, *keys: str) -> DataFrame:
    """The smallest positive number that is free for each key; (keys, version) in, (keys, version) out."""
    free = taken.select(*keys, (F.col("version") + 1).alias("version")).union(taken.select(*keys).distinct().withColumn("version", F.lit(1))).distinct()
    return free.join(taken, [*keys, "version"], "left_anti").groupBy(*keys).agg(F.min("version").alias("version"))


def pending(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs without a completed run."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def batch_counts(log: DataFrame) -> DataFrame:
    return log.agg(F.count("*").alias("runs"), F.count_if(F.col("status").startswith("FAILED")).alias("failed"), F.count_if(F.col("status") != DRY_RUN).alias("executed"), F.sum("seconds").alias("seconds"))
