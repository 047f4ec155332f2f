"""Writers of control points, world files, GeoJSON and token tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def control_points(labels: DataFrame) -> DataFrame:
    """(line): mapX,mapY,sourceX,sourceY (negative) and residual, as a geo-referencer reads them."""
    line = F.format_string("%.3f,%.3f,%.3f,%.3f,1,0,0,%.3f", "map_x", "map_y", "px", -F.col("py"), "residual")
    return labels.select(line.alias("line"))


def world_file(poses: DataFrame) -> DataFrame:
    """(sheet, body): the six lines of a world file, about the centre of the first pixel."""
    x0 = F.col("a11") * 0.5 + F.col("a12") * 0.5 + F.col("tx")
    y0 = F.col("a21") * 0.5 + F.col("a22") * 0.5 + F.col("ty")
    values = [F.col("a11"), F.col("a21"), F.col("a12"), F.col("a22"), x0, y0]
    return poses.select("sheet", F.format_string("\n".join(["%.10f"] * 6), *values).alias("body"))


def feature(kind: str, coordinates: Column, properties: Column) -> Column:
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"), properties.alias("properties")))


def collection_lines(features: DataFrame, crs: str) -> DataFrame:
    """A FeatureCollection as lines of text: head, a feature a line, tail; in order, for a single-file text write per sheet."""
    head = F.lit(f'{{"type":"FeatureCollection","crs":{{"type":"name","properties":{{"name":"{crs}"}}}},"features":[')
    rows = features.select(F.col("ordinal").alias("at"), F.concat(F.when(F.col("ordinal") > 0, ",").otherwise(""), F.col("feature")).alias("line"))
    ends = features.sparkSession.range(1).select(F.lit(-1).cast("long").alias("at"), head.alias("line")).unionByName(features.sparkSession.range(1).select(F.lit(2**62).alias("at"), F.lit("]}").alias("line")))
    return rows.withColumn("at", F.col("at").cast("long")).unionByName(ends).orderBy("at").select("line")


def write_tokens(tokens: DataFrame, path: str) -> None:
    """Flags as 1 or nothing, null as nothing."""
    flags = {c: F.when(F.col(c), "1").otherwise("") for c, t in tokens.dtypes if t == "boolean"}
    tokens.withColumns(flags).write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="")
