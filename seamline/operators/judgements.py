"""Verdicts, roll-ups and spatial attributes of blocks, tiles and fits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamline.functions import dictionaries as D
from seamline.functions import geo as G


# ------------------------------------------------------------------------------------------------- verdicts
def block_verdict(compactness: Column, outliers: Column, through: Column, numbered: Column, lots: Column, has_number: Column) -> Column:
    """Why a traced block is rejected (the first reason that holds), or null."""
    return (
        F.when(compactness < 0.15, "thin")
        .when(outliers > 0, "outlier_labels")
        .when(through >= 2, "streets_through")
        .when(numbered & (lots < 2) & ~has_number, "no_numerals")
    )


def area_drop(area: Column, least: Column, at_border: Column, numerals: Column, compactness: Column) -> Column:
    return F.when(area < least, "small").when(at_border & (numerals == 0), "border_no_numerals").when((compactness < 0.25) & (numerals == 0), "thin_no_numerals")


def component_keep(share: Column, vertices: Column, aspect: Column, fill: Column, at_edge: Column) -> Column:
    return share.between(0.0015, 0.2) & (vertices >= 3) & ~(at_edge & ((aspect > 4) | (fill < 0.35)))


def outline_keep(share: Column, of_block: Column, recovered: Column) -> Column:
    return (share >= 0.00008) & (of_block <= 0.6) & (recovered <= 0.5)


def affine_plausible(sx: Column, sy: Column, shear: Column) -> Column:
    return F.when((F.abs(F.try_divide(sx, sy) - 1) <= 0.04) & (F.abs(shear) <= 2), "affine").otherwise("similarity")


def tile_status(ink: Column, selected: Column, least: float = 0.004) -> Column:
    return F.when(ink < least, "skipped_blank").when(~selected, "not_selected").otherwise("pending")


def text_verdict(size: Column, cap: Column) -> Column:
    return F.when(size < 3000, "collapsed").when(size >= cap, "runaway").otherwise("ok")


def placed(tiles: DataFrame, pages: DataFrame) -> DataFrame:
    """(sheet, placed): whether a page exists that is no older than the tiles, less a second."""
    return tiles.join(pages.withColumnRenamed("at", "page_at"), "sheet", "left").select("sheet", F.coalesce(F.col("page_at") >= F.col("at") - F.expr("INTERVAL 1 SECOND"), F.lit(False)).alias("placed"))


def resume(work: DataFrame, done: DataFrame, redo_capped: bool = False) -> DataFrame:
    """Work units without a finished result of the same geometry; those cut by the cap again if asked."""
    good = done.where(~F.col("hit_cap")) if redo_capped else done
    return work.join(good.select("tile", "angle", "geometry").distinct(), ["tile", "angle", "geometry"], "left_anti")


# ------------------------------------------------------------------------------------------------- names and ids
def title(text: Column) -> Column:
    """Each run of letters capitalised."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0)), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2))))), "")


def place_query(name: Column, typ: Column) -> Column:
    """The string to ask a gazetteer for a street."""
    long = {}
    for spelled, kind in D.TYPE_WORDS.items():
        if len(spelled) > len(long.get(kind, "")):
            long[kind] = spelled
    fused = ["STRASSE", "GASSE", "PLATZ", "MARKT", "STEIG", "ZEILE", "ALLEE", "BRUECKE", "PROMENADE", "STRAAT", "GRACHT", "PLEIN", "SINGEL"]
    spelled = F.create_map(*(F.lit(x) for pair in long.items() for x in pair))[typ]
    words = F.transform(F.split(name, " "), title)
    joined = F.when(F.size(words) == 1, F.concat(words[0], F.lower(typ))).otherwise(F.concat(F.array_join(words, "-"), F.lit("-"), title(typ)))
    return F.when(typ.isNull(), title(name)).when(typ.isin(fused), joined).otherwise(F.concat_ws(" ", title(name), title(spelled)))


def tail_start(text: str, least: int = 8000, times: int = 10, shortest: int = 2) -> int:
    """Where a text's last repeat begins that is kept: the shortest piece it ends in ``times`` times or more stays once.

    How far a text agrees with itself shifted by a period, read from its end, is
    the prefix table of the text turned round: one pass over the characters.
    """
    n = len(text)
    if n < least:
        return n
    turned = text[::-1]
    agree = [0] * n
    low = high = 0
    for i in range(1, n):
        size = min(high - i, agree[i - low]) if i < high else 0
        while i + size < n and turned[size] == turned[i + size]:
            size += 1
        agree[i] = size
        if i + size > high:
            low, high = i, i + size
    for period in range(shortest, n // times + 1):
        if agree[period] >= (times - 1) * period:
            return n - agree[period] // period * period
    return n


def repeated_tail(text: Column, least: int = 8000, times: int = 10, shortest: int = 2) -> Column:
    """A text that ends in a piece repeated at least ``times`` times keeps one of them; shorter texts stay as they are and in the JVM."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else t[: tail_start(t, least, times, shortest)])

    return F.when(F.length(text) >= least, cut(text)).otherwise(text)


def preset_of(prompts: DataFrame, presets: DataFrame) -> DataFrame:
    known = presets.select(F.trim("body").alias("__body"), F.col("name").alias("preset"))
    return prompts.join(known, F.trim(prompts["prompt"]) == F.col("__body"), "left").drop("__body").withColumn("preset", F.coalesce("preset", F.lit("custom")))


# ------------------------------------------------------------------------------------------------- spatial attributes
def block_number(tokens: DataFrame, tall: float = 1.6, reach: float = 80.0) -> DataFrame:
    """(block, number, inferred, lots): of the numerals inside the tallest, if it stands out among three or more; else the nearest bold one outside.

    ``tokens`` (block, number, height, dist, bold); dist is positive inside.
    """
    own = tokens.where("dist >= 0").groupBy("block").agg(
        F.max_by("number", F.struct("height", F.col("number"))).alias("tallest"),
        F.max("height").alias("top"),
        F.median("height").alias("middle"),
        F.count("*").alias("n"),
    )
    chosen = own.withColumn("own", F.when((F.col("n") >= 3) & (F.col("top") >= tall * F.col("middle")), F.col("tallest")))
    near = tokens.where(f"bold AND dist < 0 AND dist >= -{reach}").groupBy("block").agg(F.min_by("number", F.struct(-F.col("dist"), F.col("number"))).alias("near"))
    joined = tokens.select("block").distinct().join(chosen, "block", "left").join(near, "block", "left")
    return joined.select("block", F.coalesce("own", "near").alias("number"), (F.col("own").isNull() & F.col("near").isNotNull()).alias("inferred"), F.coalesce(F.col("n") - F.col("own").isNotNull().cast("int"), F.lit(0)).alias("lots"))


def block_names(tokens: DataFrame, reach: float = 170.0) -> DataFrame:
    """Names outside a block within reach, nearest first, one a name: (block, name, dist, place)."""
    near = tokens.where((F.col("dist") >= 0) & (F.col("dist") <= reach)).withColumn("name", F.lower("name"))
    first = near.groupBy("block", "name").agg(F.min("dist").alias("dist"))
    return first.withColumn("place", F.row_number().over(Window.partitionBy("block").orderBy("dist", "name")))


def streets_through(rings: DataFrame, segments: DataFrame, step: float = 5.0, deep: float = 8.0, least: float = 40.0) -> DataFrame:
    """(ring_id, street, inside_m): streets that run at least so far inside a ring, sampled along their segments."""
    length = F.sqrt((F.col("bx") - F.col("ax")) * (F.col("bx") - F.col("ax")) + (F.col("by_") - F.col("ay")) * (F.col("by_") - F.col("ay")))
    n = F.greatest(F.ceil(length / step), F.lit(1)).cast("int")
    samples = segments.withColumns({"len": length, "n": n}).select("street", "ax", "ay", "bx", "by_", "len", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    u = (F.col("i") + 0.5) / F.col("n")
    points = samples.select("street", (F.col("ax") + u * (F.col("bx") - F.col("ax"))).alias("px"), (F.col("ay") + u * (F.col("by_") - F.col("ay"))).alias("py"), (F.col("len") / F.col("n")).alias("part"))
    box = [F.array_min(F.transform("ring", lambda p: p["x"])), F.array_min(F.transform("ring", lambda p: p["y"])), F.array_max(F.transform("ring", lambda p: p["x"])), F.array_max(F.transform("ring", lambda p: p["y"]))]
    placed_ = rings.select("ring_id", "ring", F.explode(G.cells(*box, 64.0)).alias("cell"))
    home = F.struct(F.floor(F.col("px") / 64).alias("cx"), F.floor(F.col("py") / 64).alias("cy"))
    held = points.withColumn("cell", home).join(placed_, "cell").where(G.ring_depth(F.col("px"), F.col("py"), F.col("ring")) >= deep)
    return held.groupBy("ring_id", "street").agg(F.sum("part").alias("inside_m")).where(F.col("inside_m") >= least)


def neighbour_window(corners: DataFrame, width: Column, height: Column) -> DataFrame:
    """(book, box, scale): corners of placed sheets, grown by a sheet on every side."""
    return corners.groupBy("book").agg(
        (F.min("x") - F.max(width)).alias("x1"), (F.min("y") - F.max(height)).alias("y1"), (F.max("x") + F.max(width)).alias("x2"), (F.max("y") + F.max(height)).alias("y2"), F.median("scale").alias("scale")
    )


def fit_rollup(labels: DataFrame) -> DataFrame:
    """Residuals and kinds per sheet; counts of plain, alias and fuzzy labels are null where flags are missing."""
    inlier = ~F.col("outlier")
    r = F.when(inlier, F.col("residual"))
    flagged = F.bool_and(F.col("alias").isNotNull() & F.col("fuzzy").isNotNull())
    return labels.groupBy("sheet").agg(
        F.count("*").alias("labels"),
        F.count_if(inlier).alias("inliers"),
        F.round(F.sqrt(F.avg(r * r)), 4).alias("rms"),
        F.median(r).alias("median"),
        F.max(r).alias("worst"),
        F.when(flagged, F.count_if(~F.coalesce("alias", F.lit(False)) & ~F.coalesce("fuzzy", F.lit(False)))).alias("plain"),
        F.when(flagged, F.count_if(F.coalesce("alias", F.lit(False)))).alias("aliased"),
    )


def tint_names(df: DataFrame) -> DataFrame:
    """Names of tints by the angle of their colour; several of one name are numbered in the order of the tints."""
    angle = F.col("angle")
    base = F.when((angle <= 35) | (angle >= 325), "pink").when(angle <= 130, "yellow").when(angle <= 200, "green").when(angle <= 300, "blue").otherwise("purple")
    same = Window.partitionBy("sheet", "base")
    named = df.withColumn("base", base).withColumns({"n": F.count("*").over(same), "i": F.row_number().over(same.orderBy("tint"))})
    return named.withColumn("name", F.when(F.col("n") > 1, F.concat("base", F.col("i").cast("string"))).otherwise(F.col("base"))).drop("n", "i", "base")
