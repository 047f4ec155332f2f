"""Runs in ordered sequences, unions of sheets and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def counting_runs(df: DataFrame, least: int = 5) -> DataFrame:
    """Stretches of at least ``least`` neighbours that count up by one (gaps and islands): (sheet, start, length)."""
    order = Window.partitionBy("sheet").orderBy("pos")
    island = F.col("val") - F.row_number().over(order)
    step = F.coalesce((F.col("val") - F.lag("val").over(order) != 1).cast("int"), F.lit(1))
    marked = df.withColumn("__new", step).withColumn("__run", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__island", island)
    runs = marked.groupBy("sheet", "__run", "__island").agg(F.min("pos").alias("first_pos"), F.min("val").alias("first_val"), F.count("*").alias("length"))
    return runs.where(F.col("length") >= least).select("sheet", "first_pos", "first_val", "length")


def repetition_runs(df: DataFrame, least: int = 5) -> DataFrame:
    """Of at least ``least`` equal neighbours only the first stays: the rows kept, with the length of their run."""
    order = Window.partitionBy("sheet").orderBy("pos")
    new = F.coalesce((F.col("text") != F.lag("text").over(order)).cast("int"), F.lit(1))
    marked = df.withColumn("__new", new).withColumn("__run", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("sheet", "__run")
    sized = marked.withColumn("length", F.count("*").over(run)).withColumn("__rn", F.row_number().over(run.orderBy("pos")))
    return sized.where((F.col("length") < least) | (F.col("__rn") == 1)).select("sheet", "pos", "text", "length")


def reading_order(tokens: DataFrame) -> DataFrame:
    """Kept reads first, then top to bottom and left to right, per sheet."""
    order = Window.partitionBy("sheet").orderBy("dropped", "y1", "x1", "tok_id")
    return tokens.withColumn("place", F.row_number().over(order))


def merged(parts: list[DataFrame], sheet: str = "sheet") -> DataFrame:
    """Union of per-sheet features; columns that a part lacks are null and a missing sheet takes the part's stem."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.withColumn(sheet, F.coalesce(sheet, "stem"))
