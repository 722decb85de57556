"""The whole plan over page streams: features, flags, scores, segments, classes, summary, in one lazy DataFrame each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafcut.functions import money
from leafcut.operators import classify, features, reports, scoring, similarity


@dataclass
class Result:
    features: DataFrame
    scores: DataFrame
    index: DataFrame
    segments: DataFrame
    classified: DataFrame
    summary: DataFrame
    costs: DataFrame | None = None

    def report(self, meta: DataFrame | None = None, timing: DataFrame | None = None) -> DataFrame:
        """One JSON document a bundle, with the costs of its embedding calls where the vectors told them."""
        return reports.run_report(self.summary, self.scores, meta, timing, self.costs)

    def release(self) -> None:
        self.features.unpersist()
        self.scores.unpersist()


def run(pages: DataFrame, toc: DataFrame | None, vectors: DataFrame | None, types: DataFrame, phrases: DataFrame, prototypes: DataFrame | None = None, max_pages: int | None = None, settings: dict | None = None, teach: bool = False) -> Result:
    """pages follow the page contract; vectors are (doc_id, page_num, image_embedding, text_embedding), or what embedding.embed() gives, from which costs follow; settings are the taxonomy's; teach: tell what segments may teach also where there are no prototypes yet. Nothing runs until a result is used; release() frees what was kept."""
    pages = features.capped(pages, max_pages)
    # Features and scores are read several times over; they are kept on disk where memory is short, and made again if an executor is lost.
    f = features.page_features(pages, toc).persist(StorageLevel.MEMORY_AND_DISK)
    told = vectors is not None
    if vectors is None:
        vectors = f.select("doc_id", "page_num").limit(0).withColumns({"image_embedding": F.lit(None).cast("array<double>"), "text_embedding": F.lit(None).cast("array<double>")})
    v = f.filter("NOT is_blank").select("doc_id", "page_num").join(vectors, ["doc_id", "page_num"], "left")
    image, text = (similarity.flags(similarity.chain(v, c)) for c in ("image_embedding", "text_embedding"))
    scores = scoring.page_scores(scoring.with_flags(f, image, text)).persist(StorageLevel.MEMORY_AND_DISK)
    index = scoring.segment_index(scores)
    inputs = classify.segment_inputs(f, index, pages.select("doc_id", "page_num", "text"))
    cents = None
    if told and (teach or prototypes is not None):
        cents = classify.centroids(vectors.join(index, ["doc_id", "page_num"]).select("doc_id", "segment_index", F.col("image_embedding").alias("vec")), "doc_id", "segment_index")
    classified = classify.classify(inputs, types, phrases, prototypes, cents, settings)
    described = scoring.describe(scores, f)
    totals = pages.groupBy("doc_id").agg(F.max("page_num").alias("total_pages"))
    costs = None
    if told and "method" in vectors.columns:
        calls = money.calls(vectors.join(pages.select("doc_id", "page_num", F.length(F.coalesce("text", F.lit(""))).alias("chars")), ["doc_id", "page_num"]))
        costs = reports.cost_summary(calls, "doc_id", "method")
    return Result(f, scores, index, scoring.segments(scores), classified, reports.segments_summary(classified, described, totals), costs)
