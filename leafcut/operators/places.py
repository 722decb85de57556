"""Places of rows in ordered streams, counted in blocks so that a long stream is no task's whole work."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Numbers in a block of rows that are counted together.
BLOCK = 4096


def numbered(rows: DataFrame, stream: str, order: str, name: str) -> DataFrame:
    """rows with their place from 1 in their stream by a whole number. Only a row a block is ordered by stream; a block starts where those before it end."""
    at = rows.withColumn("_at", F.struct(F.col(stream).alias("s"), F.floor(F.col(order) / BLOCK).alias("b")))
    own = F.row_number().over(Window.partitionBy("_at").orderBy(order))
    before = F.sum("_n").over(Window.partitionBy("_at.s").orderBy("_at.b").rowsBetween(Window.unboundedPreceding, -1))
    starts = at.groupBy("_at").agg(F.count("*").alias("_n")).select("_at", F.coalesce(before, F.lit(0)).alias("_before"))
    return at.withColumn("_own", own).join(starts, "_at").withColumn(name, F.col("_own") + F.col("_before")).drop("_at", "_own", "_before")
