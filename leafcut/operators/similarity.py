"""Similarity of each page to the one before, and drops that stand out against the pages before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from leafcut.functions.vectors import cosine
from leafcut.operators import places
from leafcut.operators.features import by_page

#: Rows of the frame before a page, least values in it, and limits of a drop.
FRAME, CONTEXT, LOW, LEAST_STD, MODERATE_Z, HIGH_Z, LEAST_DROP = 11, 3, 0.55, 0.02, -2.0, -4.0, 0.07
#: Pages of a long stream that are judged together.
PART = 4096


def chain(pages: DataFrame, vector: str) -> DataFrame:
    """(doc_id, page_num, sim): each page against the last page that had a vector; null without a vector, for the first, and where lengths differ."""
    prev = F.last(vector, ignorenulls=True).over(by_page().rowsBetween(Window.unboundedPreceding, -1))
    return pages.select("doc_id", "page_num", cosine(F.col(vector), prev).alias("sim"))


def long_chain(pages: DataFrame, vector: str) -> DataFrame:
    """chain() of streams of any length: pages meet the one before in parts of PART numbers, a part's first ones the last vector of the parts before. Only a row a part is ordered by document."""
    rows = pages.select("doc_id", "page_num", F.col(vector).alias("_v"), F.floor(F.col("page_num") / PART).alias("_part"))
    edges = rows.groupBy("doc_id", "_part").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("page_num"))).alias("_edge"))
    before = Window.partitionBy("doc_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    of = edges.select("doc_id", "_part", F.last(F.when(F.col("_edge").isNotNull(), F.col("_part")), ignorenulls=True).over(before).alias("_of"))
    edge = of.join(edges.select("doc_id", F.col("_part").alias("_of"), "_edge"), ["doc_id", "_of"]).select("doc_id", "_part", "_edge")
    own = Window.partitionBy("doc_id", "_part").orderBy("page_num").rowsBetween(Window.unboundedPreceding, -1)
    met = rows.withColumn("_prev", F.last("_v", ignorenulls=True).over(own)).join(edge, ["doc_id", "_part"], "left")
    return met.withColumn("_prev", F.coalesce("_prev", "_edge")).select("doc_id", "page_num", cosine(F.col("_v"), F.col("_prev")).alias("sim"))


def long_flags(sims: DataFrame) -> DataFrame:
    """flags() of streams of any length: pages are dealt by place into parts of PART, and a part's last FRAME pages go into the next one's frames too."""
    at = places.numbered(sims, "doc_id", "page_num", "_place").withColumn("_home", F.floor((F.col("_place") - 1) / PART))
    late = F.col("_place") > (F.col("_home") + 1) * PART - FRAME
    dealt = at.withColumn("_part", F.explode(F.when(late, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(F.array("_home"))))
    frame = Window.partitionBy("doc_id", "_part").orderBy("page_num").rowsBetween(-FRAME, -1)
    return _judged(dealt, frame, F.col("_part") == F.col("_home"))


def flags(sims: DataFrame) -> DataFrame:
    """(doc_id, page_num, sim, is_moderate, z_reason, is_high) from sims of pages that are not blank; a null sim takes a place in the frame but has no say."""
    return _judged(sims, by_page().rowsBetween(-FRAME, -1), F.lit(True))


def _judged(sims: DataFrame, frame: WindowSpec, own: Column) -> DataFrame:
    """own: which rows are judged; the others are there for the frames."""
    sim = F.col("sim")
    seen = sims.select("doc_id", "page_num", "sim", F.count(sim).over(frame).alias("n"), F.avg(sim).over(frame).alias("mean"), F.greatest(F.stddev_pop(sim).over(frame), F.lit(LEAST_STD)).alias("std"), own.alias("_own")).filter("_own")
    z, drop = (sim - F.col("mean")) / F.col("std"), F.col("mean") - sim
    few = F.col("n") < CONTEXT
    moderate = F.coalesce(F.when(few, sim < LOW).otherwise((z < MODERATE_Z) & (drop > LEAST_DROP)), F.lit(False))
    high = F.coalesce(~few & (z < HIGH_Z) & (drop > LEAST_DROP), F.lit(False))
    reason = F.when(moderate, F.when(few, "insufficient_context").otherwise(F.concat(F.lit("z="), F.bround(z, 2).cast("string"), F.lit(",drop="), F.bround(drop, 3).cast("string"))))
    return seen.select("doc_id", "page_num", F.when(few, sim).otherwise(F.bround(sim, 4)).alias("sim"), moderate.alias("is_moderate"), reason.alias("z_reason"), high.alias("is_high"))
