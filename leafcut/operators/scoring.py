"""Boundary scores of pages, and the segments between boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafcut.operators.features import by_page

# Weights of the signals and the score that makes a boundary.
STRUCTURAL, RETURNING, FRESH, RESET, SCHEME, HIGH, EACH, DRAWING, LETTERHEAD, PENALTY, BOUNDARY = 1.0, 0.4, 0.9, 0.8, 0.2, 1.0, 0.5, 0.3, 0.5, -0.5, 1.0


def with_flags(features: DataFrame, image: DataFrame, text: DataFrame) -> DataFrame:
    """Features with both series' flags; pages without one have null similarity and no flag."""
    for name, df in (("image", image), ("text", text)):
        df = df.select("doc_id", "page_num", F.col("sim").alias(f"{name}_similarity"), F.col("is_moderate").alias(f"{name}_mod"), F.col("z_reason").alias(f"{name}_z_reason"), F.col("is_high").alias(f"{name}_high"))
        features = features.join(df, ["doc_id", "page_num"], "left")
    return features.fillna(False, ["image_mod", "image_high", "text_mod", "text_high"])


def page_scores(rows: DataFrame) -> DataFrame:
    """Scores of with_flags() rows. A duplicate page scores nothing and clears the look-back of the penalty."""
    c = F.col
    any_high = c("image_high") | c("text_high")
    i, t = c("image_mod").cast("double"), c("text_mod").cast("double")
    one = F.coalesce(F.abs(c("image_similarity") - c("text_similarity")) < 1e-9, F.lit(False))
    emb = F.when(any_high, HIGH).when(one, EACH * F.greatest(i, t)).otherwise(EACH * i + EACH * t)
    num = F.bround(F.when(c("numbering_fresh_start"), FRESH).when(c("numbering_reset"), RESET).otherwise(0.0) + F.when(c("numbering_fresh_start") & c("numbering_scheme_changed"), SCHEME).otherwise(0.0), 2)
    draw = F.when(c("drawing_spike") | c("drawing_density_drop"), DRAWING).otherwise(0.0)
    letter = F.when(c("letterhead_changed"), LETTERHEAD).otherwise(0.0)
    new_format = c("format_changed") & ~c("format_returning")
    scored = rows.withColumns({"emb": emb, "num": num, "draw": draw, "letter": letter})
    backed = (c("num") != 0) | (c("draw") != 0) | new_format | (c("emb") != 0) | (c("letter") != 0)
    rescued = c("bookmark_suppressed") & any_high
    trusted = F.coalesce(c("has_l1_bookmark") & ((c("bookmark_level") == 1) | backed), F.lit(False)) | rescued
    structural = c("trusted") | new_format | (F.coalesce(F.length("title_anchor"), F.lit(0)) > 0) | c("correspondence_labels").isNotNull()
    scored = scored.withColumns({"trusted": trusted, "shown": F.when(rescued, c("raw_bookmark_title")).otherwise(c("bookmark_title"))}).withColumn("strong", structural)
    alone = ~c("is_duplicate_of_prev") & (c("emb") > 0) & ~c("strong") & ~c("numbering_reset") & ~c("letterhead_changed")
    scored = scored.withColumn("alone", alone).withColumn("penalty", F.when(c("alone") & F.coalesce(F.lag("alone").over(by_page()), F.lit(False)), PENALTY).otherwise(0.0))
    scored = scored.withColumn("structure", F.when(c("strong"), STRUCTURAL).when(c("format_changed"), RETURNING).otherwise(0.0))
    total = F.greatest(F.lit(0.0), c("structure") + c("num") + c("emb") + c("draw") + c("letter") + c("penalty"))
    dup = c("is_duplicate_of_prev")
    zero = lambda x: F.when(dup, 0.0).otherwise(x)
    null = lambda x: F.when(~dup, x)
    return scored.select(
        "doc_id", "page_num", "is_blank", zero(c("structure")).alias("structural_score"), zero(c("num")).alias("numbering_score"), zero(F.bround("emb", 2)).alias("embedding_score"),
        zero(c("draw")).alias("drawing_score"), zero(c("letter")).alias("letterhead_score"), zero(c("penalty")).alias("consecutive_penalty"), zero(F.bround(total, 2)).alias("total_score"),
        (~dup & (total >= BOUNDARY)).alias("is_boundary"), null(c("image_similarity")).alias("image_similarity"), null(c("image_z_reason")).alias("image_z_reason"), null(c("text_similarity")).alias("text_similarity"), null(c("text_z_reason")).alias("text_z_reason"),
        null(c("shown")).alias("bookmark_title"), null(c("bookmark_level")).alias("bookmark_level"), (~dup & c("trusted")).alias("bookmark_trusted"), null(c("title_anchor")).alias("title_anchor"),
        null(c("correspondence_labels")).alias("correspondence_labels"), dup.alias("duplicate_of_prev"),
    )


def segment_index(scores: DataFrame) -> DataFrame:
    """(doc_id, page_num, segment_index) of each page; a document's first page always starts a segment."""
    starts = (F.col("is_boundary") | (F.row_number().over(by_page()) == 1)).cast("int")
    return scores.select("doc_id", "page_num", F.sum(starts).over(by_page().rowsBetween(Window.unboundedPreceding, 0)).cast("int").alias("segment_index"))


def segments(scores: DataFrame) -> DataFrame:
    return segment_index(scores).groupBy("doc_id", "segment_index").agg(F.min("page_num").alias("start_page"), F.max("page_num").alias("end_page"))


def describe(scores: DataFrame, features: DataFrame) -> DataFrame:
    """(doc_id, page_num, boundary_signals): which signals made a page's score, strongest kind first."""
    c = F.col
    f = features.select("doc_id", "page_num", "format_changed", "format_label", "numbering_fresh_start", "numbering_scheme_changed", "drawing_density_drop")
    said = lambda x: F.coalesce(F.length(x), F.lit(0)) > 0
    structure = F.when(c("structural_score") > 0, F.when(c("bookmark_trusted") & said(c("bookmark_title")), F.concat(F.lit("bookmark(L"), c("bookmark_level"), F.lit("):"), c("bookmark_title")))
        .when(said(c("title_anchor")), F.concat(F.lit("title_anchor:"), c("title_anchor"))).when(F.size("correspondence_labels") > 0, F.concat(F.lit("correspondence_header:"), F.array_join("correspondence_labels", "+")))
        .when(c("format_changed"), F.concat(F.lit("format_change:"), c("format_label"))))
    number = F.when(c("numbering_score") > 0, F.concat(F.when(c("numbering_fresh_start"), "page_numbering_fresh_start").otherwise("page_numbering_reset"), F.when(c("numbering_scheme_changed"), "+scheme_change").otherwise("")))
    z = F.coalesce("image_z_reason", "text_z_reason")
    drop = F.when(c("embedding_score") > 0, F.when(z.isNotNull(), F.concat(F.lit("embedding_drop("), z, F.lit(")"))).otherwise("embedding_drop"))
    draw = F.when(c("drawing_score") > 0, F.when(c("drawing_density_drop"), "drawing_density_drop").otherwise("drawing_density_spike"))
    letter = F.when(c("letterhead_score") > 0, "letterhead_change")
    every = F.array_join(F.array_compact(F.array(structure, number, drop, draw, letter)), ";")
    return scores.join(f, ["doc_id", "page_num"], "left").select("doc_id", "page_num", F.when(c("page_num") == 1, "document_start").when(every == "", "unscored_boundary").otherwise(every).alias("boundary_signals"))
