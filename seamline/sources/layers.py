"""Readers of street layers, dictionaries and sheet documents."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from seamline.functions import text as X

# Fields that may hold a street's name, by preference.
NAME_FIELDS = ["name", "NAME", "STNAME", "StreetName", "FULLNAME", "FULL_NAME", "ST_NAME", "STREET", "street", "STREETNAME", "ROADNAME", "RD_NAME", "LINEARNAME_FULL", "STRUCTURED_NAME_1", "FULL_STREET_NAME"]
TYPE_FIELDS = ["STTYPE", "ST_TYPE", "StreetType", "SUFFIX", "TYPE"]


def pick_field(fields: list[str], candidates: list[str], explicit: str | None = None) -> str | None:
    """The field to read: the explicit one, which must exist, else the first candidate there is."""
    if explicit:
        if explicit not in fields:
            raise ValueError(f"no field {explicit!r}; there are {', '.join(sorted(fields))}")
        return explicit
    return next((c for c in candidates if c in fields), None)


def geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """(kind, coordinates as JSON, properties) of every feature of FeatureCollection files."""
    schema = "features array<struct<type string, properties map<string,string>, geometry struct<type string, coordinates string>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    return rows.select(F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"), F.col("f.properties").alias("properties"))


def street_segments(features: DataFrame, name_field: str | None = None, type_field: str | None = None) -> DataFrame:
    """(street, line, part, ax, ay, bx, by_): named lines cut into segments; nameless and empty ones are left out."""
    first = features.where("properties IS NOT NULL").select(F.map_keys("properties").alias("k")).first()
    fields = list(first["k"]) if first else []
    name, typ = pick_field(fields, NAME_FIELDS, name_field), pick_field(fields, TYPE_FIELDS, type_field)
    if name is None:
        raise ValueError(f"no name field; there are {', '.join(sorted(fields))}")
    single = F.from_json("coordinates", "array<array<double>>")
    many = F.from_json("coordinates", "array<array<array<double>>>")
    lines = F.when(F.col("kind") == "LineString", F.array(single)).when(F.col("kind") == "MultiLineString", many)
    label = F.concat_ws(" ", F.col("properties")[name], *([F.col("properties")[typ]] if typ else []))
    named = features.where((F.trim(label) != "") & lines.isNotNull()).select(X.canon(label).alias("street"), F.posexplode(lines).alias("line", "c"))
    pairs = F.transform(F.slice("c", F.lit(2), F.greatest(F.size("c") - 1, F.lit(0))), lambda q, i: F.struct(F.get("c", i).alias("p"), q.alias("q")))
    rows = named.select("street", "line", F.posexplode(pairs).alias("part", "s"))
    return rows.select("street", "line", "part", F.col("s.p")[0].alias("ax"), F.col("s.p")[1].alias("ay"), F.col("s.q")[0].alias("bx"), F.col("s.q")[1].alias("by_"))


def alias_table(spark: SparkSession, text: str) -> DataFrame:
    """(label, streets) of a JSON dictionary; keys that begin with an underscore are comments, an empty list silences a label."""
    rows = [(k.upper().strip(), list(v)) for k, v in json.loads(text).items() if not k.startswith("_")]
    made = spark.createDataFrame(rows, "label string, streets array<string>")
    return made.select("label", F.transform("streets", lambda s: X.canon(s)).alias("streets"))


def epsg_of(crs: str | None) -> int | None:
    """EPSG code of a GeoJSON crs name."""
    if not crs:
        return None
    if crs.endswith("CRS84") or crs.endswith("4326"):
        return 4326
    digits = crs.rpartition(":")[2]
    return int(digits) if "EPSG:" in crs and digits.isdigit() else None


def sheet_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Tokens of sheet documents, with the sheet's stem; only kept ones are usable."""
    schema = "source_image string, tokens array<struct<id long, text string, tile string, rotation int, bbox_xyxy array<int>, bbox_xyxy_source array<int>, edge_margin_px int, dup_of long, fragment boolean, conflict boolean, in_block boolean>>"
    docs = spark.read.schema(schema).json(path, multiLine=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_tiles\.json$", 1).alias("sheet"), F.explode("tokens").alias("t"))
    return docs.select("sheet", "t.*").withColumn("kept", F.col("dup_of").isNull() & ~F.coalesce("fragment", F.lit(False)) & ~F.coalesce("conflict", F.lit(False)))


class PagedReader(DataSourceReader):
    """Pages of a service by offset: one partition a page, so that pages are fetched in parallel and again if lost."""

    def __init__(self, options: dict):
        self.fetch, self.total, self.page = options["fetch"], int(options["total"]), int(options.get("page", 1000))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(offset) for offset in range(0, self.total, self.page)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import importlib

        module, _, name = self.fetch.rpartition(":")
        for row in getattr(importlib.import_module(module), name)(partition.value, self.page):
            yield (int(row[0]), str(row[1]))


class PagedFeatures(DataSource):
    """``spark.read.format("paged").option("fetch", "module:function").option("total", n)``; the function is called with offset and size."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "feature_id long, feature string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


def unanswered(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests not in the cache, to be asked once each; both have a params column of sorted JSON."""
    return requests.dropDuplicates(["params"]).join(cache.select("params"), "params", "left_anti")
