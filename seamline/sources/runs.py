"""Run folders: readers of what a run left, the event log's writer, documents and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seamline.functions import text as X

# Fields that may hold the two streets of a crossing, by preference.
CROSSING_FIELDS = (["StreetName1", "STREET1", "name1"], ["StreetName2", "STREET2", "name2"])
#: Columns that a table of the log begins with, if it has them.
COMMON = ["run", "sheet", "stage", "status", "started", "finished", "elapsed_s"]


def run_folders(spark: SparkSession, root: str, suffix: str = "_tiles.json") -> DataFrame:
    """(folder, stem) of every folder at any depth that holds a file of that ending, each once, in order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(root).select("path")
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), f"{suffix.replace('.', '[.]')}$", "")
    return files.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), stem.alias("stem")).groupBy("folder").agg(F.min("stem").alias("stem")).orderBy("folder")


def crossings(features: DataFrame) -> DataFrame:
    """(x, y, names) of point features that name two streets; of a multipoint the first point counts. ``features`` as layers.geojson_features gives them."""
    first = lambda fields: F.coalesce(*(F.when(F.col("properties")[f] != "", F.col("properties")[f]) for f in fields))
    one, two = (first(fields) for fields in CROSSING_FIELDS)
    at = F.when(F.col("kind") == "MultiPoint", F.get(F.from_json("coordinates", "array<array<double>>"), F.lit(0))).otherwise(F.from_json("coordinates", "array<double>"))
    rows = features.where(one.isNotNull() & two.isNotNull()).select(at.alias("at"), F.array(X.canon(one), X.canon(two)).alias("names"))
    return rows.select(F.get("at", F.lit(0)).alias("x"), F.get("at", F.lit(1)).alias("y"), "names")


def block_rings(features: DataFrame) -> DataFrame:
    """(feature, part, ring): the outer ring of every polygon, an array of struct(x, y). ``features`` with an ordinal ``feature``."""
    many = F.when(F.col("kind") == "Polygon", F.array(F.from_json("coordinates", "array<array<array<double>>>"))).when(F.col("kind") == "MultiPolygon", F.from_json("coordinates", "array<array<array<array<double>>>>"))
    outer = features.select("feature", F.posexplode(many).alias("part", "polygon"))
    ring = F.transform(F.get("polygon", F.lit(0)), lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return outer.select("feature", "part", ring.alias("ring"))


def detected_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_id, x1, y1, x2, y2, confidence) of a second detector's JSON."""
    rows = spark.read.schema("lines array<struct<id long, bbox_xyxy array<double>, confidence double>>").json(path, multiLine=True).select(F.explode("lines").alias("l"))
    return rows.select(F.col("l.id").alias("line_id"), *(F.get("l.bbox_xyxy", F.lit(i)).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))), F.col("l.confidence").alias("confidence"))


def legend(spark: SparkSession, path: str) -> DataFrame:
    """(place, name, colour, low, high) of a key's materials in order, by colour word or by a band of hues."""
    kind = "materials array<struct<name string, colour string, hue_deg array<double>>>"
    rows = spark.read.schema(kind).json(path, multiLine=True).select(F.posexplode("materials").alias("place", "m"))
    return rows.select("place", "m.name", F.lower("m.colour").alias("colour"), F.get("m.hue_deg", F.lit(0)).alias("low"), F.get("m.hue_deg", F.lit(1)).alias("high"))


def presets(spark: SparkSession, folder: str) -> DataFrame:
    """(name, body) of the text files of a folder."""
    files = spark.read.text(f"{folder}/*.txt", wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.col("value").alias("body"))
    return files.select(F.regexp_replace("file", r"\.txt$", "").alias("name"), "body")


def append_events(events: DataFrame, path: str) -> None:
    """Add events to the log, a folder of JSON lines by run: writers only ever add files, so none waits for another."""
    events.write.mode("append").partitionBy("run").json(path)


def read_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The log; lines that are no JSON are set aside in ``_corrupt`` and not lost."""
    return spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def log_table(pairs: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each event of (event_id, key, value): common columns first, the others by name, "" where an event has none."""
    ordered = [*(c for c in COMMON if c in columns), *sorted(c for c in columns if c not in COMMON)]
    wide = pairs.groupBy("event_id").pivot("key", ordered).agg(F.first("value"))
    return wide.select("event_id", *(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in ordered))


def utc(text: Column) -> Column:
    """A time from ISO 8601 text, null if it is none."""
    return F.try_to_timestamp(text)


def relative(path: Column, root: str) -> Column:
    """A path below ``root`` without it; others as they are."""
    start = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(start)), F.substr(path, F.lit(len(start) + 1))).otherwise(path)


def history(events: DataFrame) -> DataFrame:
    """(run, body): a Markdown report of each run: a heading, a line of totals and a table of its stages by time."""
    order = F.struct(F.coalesce("finished", F.lit("")), "event_id")
    cell = lambda c, none="": F.coalesce(F.col(c).cast("string"), F.lit(none))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", cell("stage"), cell("status", "?"), cell("finished", "-"), F.coalesce(F.format_string("%.1f", F.col("elapsed_s")), F.lit("-"))), F.lit(" |"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), line.alias("l")))), lambda x: x["l"])
    totals = F.format_string("%d events, %d stages, %.1f s", F.count("*"), F.count_distinct("stage"), F.coalesce(F.sum("elapsed_s"), F.lit(0.0)))
    head = F.concat(F.lit("# Run "), F.col("run").cast("string"))
    return events.groupBy("run").agg(listed.alias("lines"), totals.alias("totals")).select("run", F.concat_ws("\n", head, F.lit(""), F.col("totals"), F.lit(""), F.lit("| stage | status | finished | s |"), F.lit("|---|---|---|---|"), F.array_join("lines", "\n")).alias("body"))


def retries(sheets: DataFrame) -> DataFrame:
    """(sheet, action): what a second pass does with sheets of (sheet, book, placed, tried_near, rotated): an unplaced sheet is fitted
    again with the placed neighbours of its book, then read again with turned views, and given up after both."""
    placed = sheets.withColumn("placed_in_book", F.count_if("placed").over(Window.partitionBy("book")))
    near = (F.col("placed_in_book") > 0) & ~F.col("tried_near")
    action = F.when(F.col("placed"), "done").when(near, "fit_with_neighbours").when(~F.col("rotated"), "read_turned").otherwise("unplaced")
    return placed.select("sheet", action.alias("action"))
