"""Placed sheets: footprints, transforms in both directions, gates on labels and blocks, collections in two systems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamline.functions import dictionaries as D
from seamline.functions import geo as G
from seamline.functions import text as X
from seamline.operators import streets as S

POSE = ["a11", "a12", "tx", "a21", "a22", "ty"]


def _pose() -> list[list[Column]]:
    return [[F.col(c) for c in POSE[:3]], [F.col(c) for c in POSE[3:]]]


def on_map(points: Column) -> Column:
    """An array of struct(x, y) in source pixels through the row's pose."""
    a = _pose()
    return F.transform(points, lambda p: F.struct(*(v.alias(n) for n, v in zip("xy", G.affine(p["x"], p["y"], a), strict=True))))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A closed ring round a box."""
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))


def crop_box(crop: Column) -> list[Column]:
    """The content box x0,y0,x1,y1 of a sheet, all of it (w, h) without one."""
    part = F.split(crop, ",")
    whole = [F.lit(0), F.lit(0), F.col("w"), F.col("h")]
    return [F.coalesce(F.get(part, F.lit(i)).try_cast("int"), v) for i, v in enumerate(whole)]


def content_px(crop: Column, work_scale: Column) -> tuple[Column, Column]:
    """Pixels of the content in the source and in the work image."""
    x0, y0, x1, y1 = crop_box(crop)
    source = ((x1 - x0) * (y1 - y0)).cast("long")
    return source, F.bround(source * work_scale * work_scale, 0).cast("long")


def footprints(poses: DataFrame) -> DataFrame:
    """(sheet, what, px, map) of (sheet, w, h, crop, pose): the outline of the scan and of its content."""
    scan, content = box_ring(F.lit(0), F.lit(0), F.col("w"), F.col("h")), box_ring(*crop_box(F.col("crop")))
    both = F.explode(F.array(F.struct(F.lit("scan").alias("what"), scan.alias("px")), F.struct(F.lit("content").alias("what"), content.alias("px"))))
    return poses.select("sheet", *POSE, both.alias("f")).select("sheet", "f.what", "f.px", on_map(F.col("f.px")).alias("map"))


def georeferences(poses: DataFrame) -> DataFrame:
    """(sheet, document): a JSON document with a pose, its inverse, scales, angles and the scan resolutions they imply."""
    back = G.inverse(_pose())
    parts = G.decomposed(*(F.col(c) for c in ("a11", "a12", "a21", "a22")))
    named = lambda values: F.struct(*(v.alias(n) for n, v in zip(POSE, values, strict=True)))
    document = F.struct(
        F.col("sheet"), F.concat(F.lit("EPSG:"), F.col("epsg").cast("string"), F.lit(" ("), crs_name(F.col("epsg")), F.lit(")")).alias("crs"), F.col("epsg"),
        named([F.col(c) for c in POSE]).alias("affine_source_px_to_map"), named([v for row in back for v in row]).alias("affine_map_to_source_px"),
        F.struct(parts["sx"].alias("x"), parts["sy"].alias("y")).alias("scale_m_per_px"), parts["rotation"].alias("rotation_deg"), parts["shear"].alias("shear_deg"),
        implied_dpi(F.lit(50.0), parts["sx"]).alias("implied_dpi_if_50ft_per_inch"), implied_dpi(F.lit(100.0), parts["sx"]).alias("implied_dpi_if_100ft_per_inch"),
        implied_dpi(F.col("stated_ft"), parts["sx"]).alias("implied_dpi_from_stated_scale"),
    )
    return poses.select("sheet", F.to_json(document).alias("document"))


def implied_dpi(feet: Column, metres_per_px: Column) -> Column:
    """Scan resolution at which so many feet to the inch give so many metres a pixel."""
    return F.try_divide(feet * 0.3048, metres_per_px)


# ------------------------------------------------------------------------------------------------- coordinate systems
def crs_name(epsg: Column) -> Column:
    zone, north = G.utm_zone(epsg)
    datum = F.when(epsg.between(26901, 26923), "NAD83").when(epsg.between(25828, 25838), "ETRS89").otherwise("WGS 84")
    utm = F.concat(datum, F.lit(" / UTM zone "), zone.cast("string"), F.when(north, "N").otherwise("S"))
    return F.coalesce(utm, F.concat(F.lit("EPSG:"), epsg.cast("string")))


def parsed_epsg(name: Column) -> Column:
    """The code in the name of a GeoJSON coordinate system, plain or as a URN; null without one."""
    code = F.regexp_extract(name, r"EPSG:{1,2}(\d+)", 1)
    return F.when(name.rlike("CRS84|4326$"), 4326).when(code != "", code.try_cast("int"))


def central_meridian(epsg: Column) -> Column:
    return 6 * G.utm_zone(epsg)[0] - 183.0


def crs_status(epsg: Column) -> Column:
    """Whether coordinates of a system can be changed: those of UTM zones and degrees; others are refused, by status."""
    return F.when((epsg == 4326) | G.utm_zone(epsg)[0].isNotNull(), "ok").otherwise("refused_crs")


def to_degrees(x: Column, y: Column, epsg: Column) -> tuple[Column, Column]:
    """Longitude and latitude in any system that is not refused; degrees stay."""
    zone, north = G.utm_zone(epsg)
    grs = epsg.between(26901, 26923) | epsg.between(25828, 25838)
    one, two = G.utm_inverse(x, y, zone, north), G.utm_inverse(x, y, zone, north, "GRS 1980")
    return tuple(F.when(epsg == 4326, same).when(grs, b).otherwise(a) for same, a, b in zip((x, y), one, two, strict=True))


def from_degrees(lon: Column, lat: Column, epsg: Column) -> tuple[Column, Column]:
    zone, north = G.utm_zone(epsg)
    grs = epsg.between(26901, 26923) | epsg.between(25828, 25838)
    one, two = G.utm_forward(lon, lat, zone, north), G.utm_forward(lon, lat, zone, north, "GRS 1980")
    return tuple(F.when(epsg == 4326, same).when(grs, b).otherwise(a) for same, a, b in zip((lon, lat), one, two, strict=True))


def collections(features: DataFrame) -> DataFrame:
    """(sheet, name, accepted, document): feature collections of (sheet, epsg, accepted, ordinal, ring, properties) in the sheet's
    system and in degrees, rejected ones only where there are any. Rings of one sheet make one document."""
    lonlat = lambda p: to_degrees(p["x"], p["y"], F.col("epsg"))
    pair = lambda values, digits: F.array(*(F.round(v, digits) for v in values))
    own = F.transform("ring", lambda p: pair((p["x"], p["y"]), 3))
    degrees = F.transform("ring", lambda p: pair(lonlat(p), 7))
    told = F.explode(F.array(F.struct(F.concat(F.lit("epsg"), F.col("epsg").cast("string")).alias("name"), own.alias("at")), F.struct(F.lit("wgs84").alias("name"), degrees.alias("at"))))
    rows = features.select("sheet", "epsg", "accepted", "ordinal", "properties", told.alias("t"))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array("t.at").alias("coordinates"))
    rows = rows.select("sheet", "epsg", "accepted", "t.name", F.struct("ordinal", F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), "properties").alias("f")).alias("x"))
    listed = F.transform(F.array_sort(F.collect_list("x"), lambda a, b: F.when(a["ordinal"] < b["ordinal"], -1).when(a["ordinal"] > b["ordinal"], 1).otherwise(0)), lambda x: x["f"])
    crs = F.when(F.col("name") != "wgs84", F.struct(F.lit("name").alias("type"), F.struct(F.concat(F.lit("urn:ogc:def:crs:EPSG::"), F.col("epsg").cast("string")).alias("name")).alias("properties")))
    grouped = rows.groupBy("sheet", "epsg", "accepted", "name").agg(listed.alias("features"))
    return grouped.select("sheet", "name", "accepted", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), crs.alias("crs"), "features")).alias("document"))


# ------------------------------------------------------------------------------------------------- gates
def in_reach(labels: DataFrame, segments: DataFrame, centres: DataFrame, radius: float) -> tuple[DataFrame, DataFrame]:
    """(sheet, label_id, seg_id) of segments of a label's street whose middle is within ``radius`` of the sheet's centre, and the
    (sheet, label_id) left without any. ``centres`` (sheet, cx, cy)."""
    middle = [((F.col("ax") + F.col("bx")) / 2), ((F.col("ay") + F.col("by_")) / 2)]
    off = [m - F.col(c) for m, c in zip(middle, ("cx", "cy"), strict=True)]
    met = labels.join(centres, "sheet").join(segments, "street").where(off[0] * off[0] + off[1] * off[1] <= radius * radius).select("sheet", "label_id", "seg_id")
    return met, labels.select("sheet", "label_id").distinct().join(met, ["sheet", "label_id"], "left_anti")


def reach_counts(labels: DataFrame, segments: DataFrame, centres: DataFrame, radius: float) -> DataFrame:
    """(sheet, label_id, segments): how many segments ``in_reach`` keeps for each label, 0 too. A sheet's labels of one street are counted together."""
    streets = labels.select("sheet", "street").distinct().withColumn("label_id", F.lit(0))
    counts = in_reach(streets, segments.withColumn("seg_id", F.col("street")), centres, radius)[0].groupBy("sheet", F.col("seg_id").alias("street")).agg(F.count("*").alias("segments"))
    told = labels.join(counts.hint("merge"), ["sheet", "street"], "left")
    return told.groupBy("sheet", "label_id").agg(F.sum(F.coalesce("segments", F.lit(0))).alias("segments"))


def labels_inside(labels: DataFrame, rings: DataFrame, cell: float = 64.0) -> DataFrame:
    """(ring_id, inliers, outliers): labels of (label_id, px, py, outlier) inside each ring, rings without any too."""
    held = labels.withColumnRenamed("label_id", "point_id").join(_in_rings(labels, rings, cell), "point_id")
    counts = held.groupBy("ring_id").agg(F.count_if(~F.col("outlier")).alias("inliers"), F.count_if("outlier").alias("outliers"))
    return rings.select("ring_id").join(counts, "ring_id", "left").select("ring_id", F.coalesce("inliers", F.lit(0)).alias("inliers"), F.coalesce("outliers", F.lit(0)).alias("outliers"))


def _in_rings(labels: DataFrame, rings: DataFrame, cell: float) -> DataFrame:
    edge = lambda f, c: f(F.transform("ring", lambda p: p[c]))
    placed = rings.select("ring_id", "ring", F.explode(G.cells(edge(F.array_min, "x"), edge(F.array_min, "y"), edge(F.array_max, "x"), edge(F.array_max, "y"), cell)).alias("cell"))
    home = F.struct(F.floor(F.col("px") / cell).alias("cx"), F.floor(F.col("py") / cell).alias("cy"))
    return labels.withColumn("cell", home).join(placed, "cell").where(G.inside(F.col("px"), F.col("py"), F.col("ring"))).select(F.col("label_id").alias("point_id"), "ring_id")


def split_parts(parts: DataFrame, least: float = 0.2) -> DataFrame:
    """Parts (block, part, area) of blocks cut along their streets, with the share of the whole and whether they are slivers.

    A block that falls into one part only was not cut; its part is the block.
    """
    of_block = Window.partitionBy("block")
    share = F.try_divide(F.col("area"), F.sum("area").over(of_block))
    return parts.withColumns({"share": share, "of": F.count("*").over(of_block)}).withColumn("sliver", (F.col("of") > 1) & (F.col("share") < least))


def alias_suggestions(words: DataFrame, segments: DataFrame, limit: float, most: int = 12) -> DataFrame:
    """(sheet, text, street, distance, place): unmatched words in capitals next to a street of another name, the nearest of each text.

    ``words`` (sheet, point_id, text, in_block, px, py) in map coordinates.
    Words in blocks, with digits, of fewer than four letters, types and
    directions are no names; the nearest segment of any street must be within
    ``limit``. Places count from the nearest; the log keeps ``most``.
    """
    label = X.norm_label(F.col("text"))["name"]
    named = words.where(~F.col("in_block") & F.col("text").rlike("^[A-Z][A-Z .'&-]*$")).withColumn("name", label)
    named = named.where((F.length("name") >= 4) & X.type_of(F.col("name")).isNull() & ~F.col("name").isin(D.DIRECTIONS))
    near = S.nearest_segment(named, segments, limit).where(F.col("dist") <= limit).join(segments.select("seg_id", "street"), "seg_id")
    other = near.where(X.base_name(F.col("street")) != F.col("name"))
    best = other.groupBy("sheet", "text").agg(F.min(F.struct("dist", "street")).alias("b")).select("sheet", "text", F.col("b.street").alias("street"), F.round("b.dist", 1).alias("distance"))
    order = Window.partitionBy("sheet").orderBy("distance", "text")
    return best.withColumn("place", F.row_number().over(order)).withColumn("logged", F.col("place") <= most)


def numerals_inside(tokens: DataFrame, tall: float = 1.6) -> DataFrame:
    """(part, lots, number) of (part, text, height): the tallest numeral if it stands out among three or more is the number, the
    others are lots, each once, shorter ones first."""
    told = tokens.groupBy("part").agg(F.median("height").alias("middle"), F.max(F.struct("height", "text")).alias("top"), F.count("*").alias("n"), F.collect_set("text").alias("texts"))
    number = F.when((F.col("top.height") >= tall * F.col("middle")) & (F.col("n") >= 3), F.col("top.text"))
    return told.select("part", natural(F.filter("texts", lambda t: ~F.coalesce(t == number, F.lit(False)))).alias("lots"), number.alias("number"))


def natural(texts: Column) -> Column:
    """Distinct texts, shorter ones first, then by value."""
    keyed = F.array_sort(F.transform(F.array_distinct(texts), lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))
    return F.transform(keyed, lambda x: x["t"])
