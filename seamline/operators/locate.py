"""From the names of a sheet to places: queries, lookups, candidate boxes, their order and the box to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamline.functions import geo as G
from seamline.functions import text as X
from seamline.operators import judgements as J
from seamline.operators import names as N

#: Tiers of bare names that each mode asks for, besides those with a type word.
BARE = {"none": ["A"], "repeated": ["A", "B"], "all": ["A", "B", "C"]}


def selection(tokens: DataFrame, bare: str = "repeated", force: tuple[str, ...] = (), drop: tuple[str, ...] = (), most: int = 25, least: int = 4) -> DataFrame:
    """(sheet, name, typ, type_assumed, tier, occurrences, upper_frac, rank, query, reason) of every name on a sheet.

    ``reason`` is null for names to ask for; else it says why a group is left
    out: dropped, its tier, or over the most names. Forced names are asked for
    whatever they look like, once on each sheet if not read there. A bare name
    is asked for with the type word its sheet uses most.
    """
    label = X.norm_label(F.col("text"))
    letters = F.regexp_replace(X.fold(F.col("text")), "[^A-Za-z]", "")
    read = tokens.where(N.skip_reason(F.col("text"), F.col("in_block"), least).isNull())
    read = read.select("sheet", "tok_id", label.alias("label"), ((letters != "") & (letters == F.upper(letters))).cast("int").alias("up"))
    groups = read.groupBy("sheet", F.col("label.name").alias("name")).agg(
        F.count("*").alias("occurrences"), F.sum("up").alias("uppers"), F.min_by("label.typ", F.when(F.col("label.typ").isNotNull(), F.col("tok_id"))).alias("typ")
    )
    wanted = F.array(*(X.norm_label(F.lit(f)) for f in force)) if force else F.array().cast("array<struct<name:string,typ:string>>")
    asked = tokens.select("sheet").distinct().select("sheet", F.explode(wanted).alias("f")).where("f.name <> ''").select("sheet", F.col("f.name").alias("name"), F.col("f.typ").alias("forced_typ"), F.lit(True).alias("forced"))
    joined = groups.join(asked, ["sheet", "name"], "full").withColumns(
        {"forced": F.coalesce("forced", F.lit(False)), "occurrences": F.coalesce("occurrences", F.lit(1)), "typ": F.coalesce("typ", "forced_typ"), "uppers": F.coalesce("uppers", F.lit(0))}
    )
    share = F.col("uppers") / F.col("occurrences")
    tier = F.when(F.col("forced") | F.col("typ").isNotNull(), "A").when((F.col("occurrences") >= 2) | ((share == 1) & (F.length("name") >= 6)), "B").otherwise("C")
    rank = 3 * F.col("typ").isNotNull().cast("int") + 2 * share + F.least(F.col("occurrences") - 1, F.lit(3)) + F.length("name") / 4
    unwanted = F.array(*(X.norm_label(F.lit(x))["name"] for x in drop)) if drop else F.array().cast("array<string>")
    judged = joined.withColumns({"tier": tier, "exact": rank, "upper_frac": F.round(share, 2)})
    judged = judged.withColumn("out", F.when(F.array_contains(unwanted, F.col("name")), "dropped").when(~F.col("tier").isin(BARE[bare]), F.concat(F.lit("bare_tier_"), F.col("tier"))))
    judged = judged.withColumn("rank", F.round("exact", 2))
    place = F.row_number().over(Window.partitionBy("sheet", F.col("out").isNull()).orderBy(F.desc("rank"), "name"))
    judged = judged.join(N.dominant_type(tokens).select("sheet", F.col("typ").alias("main")), "sheet", "left")
    assumed = F.when(F.col("typ").isNull(), F.col("main"))
    told = judged.withColumns({"reason": F.coalesce("out", F.when(place > most, "over_max")), "type_assumed": assumed})
    return told.select("sheet", "name", "typ", "type_assumed", "tier", "occurrences", "upper_frac", "rank", J.place_query(F.col("name"), F.coalesce("typ", "type_assumed")).alias("query"), "reason")


# ------------------------------------------------------------------------------------------------- answers of a gazetteer
def hits(answers: DataFrame) -> DataFrame:
    """Answers as they come, all text, as hits: the category falls back on the class, the box (S, N, W, E) becomes four numbers."""
    number = lambda c: F.col(c).try_cast("double")
    box = [F.get("boundingbox", F.lit(i)).try_cast("double") for i in (0, 2, 1, 3)]
    given = {"category": F.coalesce("category", "class"), "lat": number("lat"), "lon": number("lon"), "display_name": F.coalesce("display_name", F.lit(""))}
    return answers.withColumns(given | dict(zip("swne", box, strict=True))).drop("class", "boundingbox")


def of_class(classes: list[str] | None) -> Column:
    """Whether a hit is of the classes that are asked for; none given means any."""
    return F.lit(True) if classes is None else F.coalesce(F.col("category").isin(classes), F.lit(False))


def looked_up(names: DataFrame, found: DataFrame, classes: list[str] | None, limit: int) -> DataFrame:
    """(sheet, name, query_used, n_raw, n_kept, saturated) of (sheet, name, query) from hits by (query, category).

    A typed query without a hit of the classes gives way to the bare name if
    that has one. A query with as many answers as the service gives at most is
    saturated. Names that were never answered have no counts.
    """
    counts = found.groupBy(F.col("query").alias("asked")).agg(F.count("*").alias("raw"), F.count_if(of_class(classes)).alias("kept"))
    bare = J.title(F.lower("name"))
    typed = names.withColumn("bare", bare).join(counts, F.col("query") == F.col("asked"), "left").drop("asked")
    both = typed.join(counts.select(F.col("asked").alias("bare"), F.col("raw").alias("bare_raw"), F.col("kept").alias("bare_kept")), "bare", "left")
    falls = (F.col("kept") == 0) & (F.col("query") != F.col("bare")) & (F.coalesce("bare_kept", F.lit(0)) > 0)
    pick = lambda b, t: F.when(falls, F.col(b)).otherwise(F.col(t))
    return both.select("sheet", "name", pick("bare", "query").alias("query_used"), pick("bare_raw", "raw").alias("n_raw"), pick("bare_kept", "kept").alias("n_kept"), (pick("bare_raw", "raw") >= limit).alias("saturated"))


# ------------------------------------------------------------------------------------------------- candidates
def candidate_boxes(members: DataFrame, pad_km: float, longest_km: float = 5.0) -> DataFrame:
    """(candidate, s, w, n, e, area_km2) of hits with boxes: their union, padded; a way longer than ``longest_km`` counts as its point."""
    tall, wide = (F.col("n") - F.col("s")) * G.KM_PER_DEG, (F.col("e") - F.col("w")) * G.KM_PER_DEG * F.cos(F.radians((F.col("s") + F.col("n")) / 2))
    whole = F.sqrt(tall * tall + wide * wide) < longest_km
    edge = {c: F.when(whole, F.col(c)).otherwise(F.col(p)) for c, p in (("s", "lat"), ("w", "lon"), ("n", "lat"), ("e", "lon"))}
    union = members.groupBy("candidate").agg(F.min(edge["s"]).alias("s"), F.min(edge["w"]).alias("w"), F.max(edge["n"]).alias("n"), F.max(edge["e"]).alias("e"))
    area = F.abs((F.col("n") - F.col("s")) * G.KM_PER_DEG * (F.col("e") - F.col("w")) * G.KM_PER_DEG * F.cos(F.radians((F.col("s") + F.col("n")) / 2)))
    padded = G.pad_box(*(F.col(c) for c in "swne"), pad_km)
    return union.select("candidate", *(v.alias(c) for c, v in zip("swne", padded, strict=True)), area.alias("area_km2"))


def ranked(candidates: DataFrame) -> DataFrame:
    """Candidates of a sheet with their place: by score and names, fewer hits and smaller area first."""
    order = Window.partitionBy("sheet").orderBy(F.desc("score"), F.desc("n_names"), "n_hits", "area_km2", "candidate")
    return candidates.withColumn("rank", F.row_number().over(order))


def picked(candidates: DataFrame, n: int) -> DataFrame:
    """The n-th candidate of each sheet, counted from 1; sheets without one are told as such."""
    chosen = candidates.where(F.col("rank") == n).withColumn("found", F.lit(True))
    return candidates.select("sheet").distinct().join(chosen, "sheet", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def merged_names(parts: DataFrame) -> DataFrame:
    """(into, names) of (into, part, names): the names of all parts once, in the order of the parts and in them."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("part", "names"))), lambda x: x["names"])
    return parts.groupBy("into").agg(F.array_distinct(F.flatten(listed)).alias("names"))


def parsed_box(text: Column) -> Column:
    """A box S,W,N,E from text as a struct, null if it is none or is turned."""
    part = F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("double"))
    fits = (F.size(part) == 4) & F.forall(part, lambda x: x.isNotNull()) & (F.get(part, F.lit(0)) < F.get(part, F.lit(2))) & (F.get(part, F.lit(1)) < F.get(part, F.lit(3)))
    return F.when(fits, F.struct(*(F.get(part, F.lit(i)).alias(c) for i, c in enumerate("swne"))))


def resolved_boxes(requests: DataFrame, places: DataFrame, candidates: DataFrame, pad_km: float) -> DataFrame:
    """(request, s, w, n, e, origin): a box given as text, else the union of the places named, else a candidate's box; then padded.

    ``requests`` (request, bbox, sheet, candidate), ``places`` (request, s, w, n, e), ``candidates`` (sheet, rank, s, w, n, e).
    """
    named = places.groupBy("request").agg(F.struct(F.min("s").alias("s"), F.min("w").alias("w"), F.max("n").alias("n"), F.max("e").alias("e")).alias("named"))
    chosen = candidates.select("sheet", F.col("rank").alias("candidate"), F.struct("s", "w", "n", "e").alias("chosen"))
    joined = requests.withColumn("given", parsed_box(F.col("bbox"))).join(named, "request", "left").join(chosen, ["sheet", "candidate"], "left")
    asked = F.when(F.col("bbox").isNotNull(), F.col("given")).otherwise(F.coalesce("named", "chosen"))
    origin = F.when(F.col("bbox").isNotNull(), "bbox").when(F.col("named").isNotNull(), "place").otherwise("locate")
    told = joined.select("request", asked.alias("b"), origin.alias("origin")).where("b IS NOT NULL")
    padded = G.pad_box(*(F.col(f"b.{c}") for c in "swne"), pad_km)
    return told.select("request", *(v.alias(c) for c, v in zip("swne", padded, strict=True)), "origin")


def fetch_command(slug: Column) -> Column:
    """The command that fetches the streets of the box (s, w, n, e) into a file named by ``slug``."""
    box = F.format_string("%.4f,%.4f,%.4f,%.4f", *(F.col(c).cast("double") for c in "swne"))
    return F.concat(F.lit("fetch-streets --bbox="), box, F.lit(" --out "), slug, F.lit("_streets.geojson"))


# ------------------------------------------------------------------------------------------------- catalogue ids
def catalogue_id(text: Column) -> Column:
    """struct(cls, item) of a map library's resource id such as g3934tm.g3934tm_g013521884 anywhere in a text, null without one."""
    pattern = r"(g\d{4}[a-z]*)\.(\1_g\d+[a-z]*)"
    return F.when(text.rlike(pattern), F.struct(F.regexp_extract(text, pattern, 1).alias("cls"), F.regexp_extract(text, pattern, 2).alias("item")))


def storage_path(cls: Column, item: Column) -> Column:
    """Where a library keeps an item: by the first three and all four digits of its class."""
    digits = F.regexp_extract(cls, r"^g(\d{4})", 1)
    return F.concat(F.lit("gmd/gmd"), F.left(digits, F.lit(3)), F.lit("m/g"), digits, F.lit("m/"), cls, F.lit("/"), item)


def image_id(cls: Column, item: Column, stem: Column) -> Column:
    """The id under which an image service serves a sheet."""
    return F.concat_ws(":", F.lit("service"), F.replace(storage_path(cls, item), F.lit("/"), F.lit(":")), stem)


def plan_stem(item: Column) -> Column:
    """Number and year of an insurance plan whose item ends in five and four digits, null for others."""
    pattern = r"_g(\d{5})(\d{4})$"
    return F.when(item.rlike(pattern), F.concat_ws("_", F.regexp_extract(item, pattern, 1), F.regexp_extract(item, pattern, 2)))


def sheet_number(stem: Column) -> Column:
    """The number at the end of a sheet's name, without leading p and zeros."""
    return F.regexp_replace(F.element_at(F.split(stem, "[-_]"), -1), "^p?0*(?=.)", "")
