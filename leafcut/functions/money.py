"""Cost of embedding calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prices per token or image, and tokens assumed for an image.
TEXT_PRIMARY, IMAGE_PRIMARY, TEXT_FALLBACK, IMAGE_FALLBACK, IMAGE_TOKENS = 0.20 / 1e6, 0.45 / 1e6, 0.15 / 1e6, 0.0001, 1290


def primary(length: Column, reported: Column) -> Column:
    """(text_tokens, image_tokens, cost_usd): with a reported total, text is at most the total less 100; else both are estimated."""
    guess = F.floor(length / 4).cast("long")
    text = F.when(reported.isNotNull(), F.least(guess, reported - 100)).otherwise(guess)
    image = F.when(reported.isNotNull(), reported - text).otherwise(F.lit(IMAGE_TOKENS).cast("long"))
    return F.struct(text.alias("text_tokens"), image.alias("image_tokens"), (text * F.lit(TEXT_PRIMARY) + image * F.lit(IMAGE_PRIMARY)).alias("cost_usd"))


def fallback(length: Column, reported: Column) -> Column:
    """One image, and text tokens as reported or estimated; no text costs none."""
    text = F.when(length == 0, F.lit(0).cast("long")).otherwise(F.coalesce(reported, F.greatest(F.floor(length / 4).cast("long"), F.lit(1).cast("long"))))
    return F.struct(text.alias("text_tokens"), F.lit(1).cast("long").alias("image_tokens"), (F.lit(IMAGE_FALLBACK) + text * F.lit(TEXT_FALLBACK)).alias("cost_usd"))


def calls(embedded: DataFrame) -> DataFrame:
    """A cost row for each page that a provider answered (doc_id, page_num, method, rank, chars, text_tokens and image_tokens as told): the first provider's prices where rank is 0, else the fallback's."""
    c = F.col
    told = F.when(c("text_tokens").isNotNull() | c("image_tokens").isNotNull(), F.coalesce("text_tokens", F.lit(0)) + F.coalesce("image_tokens", F.lit(0)))
    cost = F.when(c("rank") == 0, primary(c("chars"), told)).otherwise(fallback(c("chars"), c("text_tokens")))
    rows = embedded.filter("rank IS NOT NULL").select("doc_id", "page_num", "method", cost.alias("c"), ((c("rank") == 0) & told.isNull()).alias("estimated"))
    return rows.select("doc_id", "page_num", "method", "c.*", "estimated")
