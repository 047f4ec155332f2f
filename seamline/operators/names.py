"""Street names on sheets: selection, grouping and matching to a street layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamline.functions import dictionaries as D
from seamline.functions import text as X


def skip_reason(text: Column, in_block: Column, least: int = 4) -> Column:
    """Why a token names no street (the first reason that holds), or null."""

    def reason(label: Column) -> Column:
        name, bare = label["name"], label["typ"].isNull()
        words = F.split(name, " ")
        return (
            F.when(in_block, "in_block")
            .when(~X.fold(text).rlike("[A-Za-z]{3,}") | (name == ""), "no_letters")
            .when(bare & F.forall(words, lambda w: X.type_of(w).isNotNull() | X.is_direction(w)), "type_only")
            .when(bare & F.exists(words, lambda w: w.isin(D.FURNITURE)), "furniture")
            .when(F.upper(X.fold(text)).rlike(r"&|\b(CO|LTD|INC|BROS|SONS|MFG)\b\.?") | (F.size(words) > 3), "business")
            .when(F.length(F.replace(name, F.lit(" "), F.lit(""))) < least, "short")
            .when(bare & text.rlike("[0-9]"), "digits")
        )

    return X.let(X.norm_label(text), reason)


def name_groups(tokens: DataFrame, most: int = 25) -> DataFrame:
    """(sheet, name) groups of usable tokens with their tier and rank, best first; those over ``most`` are marked."""
    upper = F.regexp_replace(X.fold(F.col("text")), "[^A-Za-z]", "")
    named = tokens.withColumn("label", X.norm_label(F.col("text"))).where(skip_reason(F.col("text"), F.col("in_block")).isNull())
    named = named.withColumn("up", ((upper != "") & (upper == F.upper(upper))).cast("int"))
    groups = named.groupBy("sheet", F.col("label.name").alias("name")).agg(
        F.count("*").alias("occurrences"),
        F.avg("up").alias("upper_frac"),
        F.min_by("label.typ", F.when(F.col("label.typ").isNotNull(), F.col("tok_id"))).alias("typ"),
        F.min("tok_id").alias("first_id"),
    )
    tier = F.when(F.col("typ").isNotNull(), "A").when((F.col("occurrences") >= 2) | ((F.col("upper_frac") == 1) & (F.length("name") >= 6)), "B").otherwise("C")
    rank = 3 * F.col("typ").isNotNull().cast("int") + 2 * F.col("upper_frac") + F.least(F.col("occurrences") - 1, F.lit(3)) + F.length("name") / 4
    ranked = groups.withColumn("tier", tier).withColumn("rank", F.round(rank, 2)).where("tier <> 'C'")
    place = F.row_number().over(Window.partitionBy("sheet").orderBy(F.desc("rank"), "name"))
    return ranked.withColumn("over_max", place > most)


def dominant_type(tokens: DataFrame) -> DataFrame:
    """(sheet, typ): the type word a sheet carries most, the first seen on ties."""
    label = X.norm_label(F.col("text"))
    typed = tokens.select("sheet", "tok_id", F.coalesce(label["typ"], X.type_of(label["name"])).alias("typ")).where("typ IS NOT NULL")
    counts = typed.groupBy("sheet", "typ").agg(F.count("*").alias("n"), F.min("tok_id").alias("first"))
    best = Window.partitionBy("sheet").orderBy(F.desc("n"), "first")
    return counts.withColumn("rn", F.row_number().over(best)).where("rn = 1").select("sheet", "typ", "n")


def stated_scale(tokens: DataFrame) -> DataFrame:
    """(sheet, feet): of the statements of the best rank the most frequent, the smallest on ties."""
    said = tokens.select("sheet", X.scale_statement(F.col("text")).alias("s")).where("s IS NOT NULL").select("sheet", "s.*")
    counts = said.groupBy("sheet", "rank", "feet").count()
    best = Window.partitionBy("sheet").orderBy("rank", F.desc("count"), "feet")
    return counts.withColumn("rn", F.row_number().over(best)).where("rn = 1").select("sheet", "rank", "feet")


def match_streets(labels: DataFrame, streets: DataFrame, aliases: DataFrame | None = None, exact: bool = False) -> DataFrame:
    """(text, street) matches of distinct label texts with distinct layer names, by a ladder of keys.

    Equal keys, layer names without their leading direction, then names without
    leading words if nothing else fits; then only those of the label's
    direction and of its type, if there are any. Every step is an equality
    join on a key, so the layer is never crossed with the labels. Historic
    spellings are folded unless names must be ``exact``.
    """
    label = X.norm_label(F.col("text"))
    texts = labels.select("text").distinct().withColumn("label", label)
    usable = (F.length("label.name") >= 3) & ~(F.col("label.typ").isNull() & (X.type_of(F.col("label.name")).isNotNull() | X.is_direction(F.col("label.name"))))
    texts = texts.where(usable).select("text", F.col("label.name").alias("name"), F.col("label.typ").alias("typ"))
    layer = streets.select("street").distinct().withColumn("base", X.base_name(F.col("street")))
    rung = lambda key, step: F.struct(X.spell_key(key, exact).alias("key"), F.lit(step).alias("step"))
    keys = layer.select("street", F.explode(F.array(rung(F.col("base"), 0), rung(X.strip_direction(F.col("base")), 0), rung(X.strip_leading(F.col("base")), 1))).alias("k"))
    asked = texts.select("*", F.explode(F.array(rung(F.col("name"), 0), rung(X.strip_leading(F.col("name")), 1))).alias("k"))
    keys, asked = keys.select("street", "k.*").where("key IS NOT NULL"), asked.select("text", "typ", "k.*").where("length(key) >= 3")
    hits = asked.join(keys, ["key", "step"]).select("text", "typ", "street", "step").distinct()
    if aliases is not None:
        own = texts.join(aliases.withColumnRenamed("label", "__l"), F.upper(F.trim("text")) == F.col("__l")).drop("__l")
        named = own.select("text", "typ", F.explode("streets").alias("street")).join(layer.select("street"), "street", "left_semi")
        hits = hits.join(own.select("text"), "text", "left_anti").unionByName(named.withColumn("step", F.lit(0)))
    words = F.filter(F.split(F.upper(F.regexp_replace("text", "[^A-Za-z' ]+", " ")), " "), lambda w: w != "")
    turn = F.when((F.size(words) > 2) & X.is_direction(F.element_at(words, -1)), F.element_at(words, -1))
    first = F.split("street", " ")[0]
    judged = hits.withColumn("turned", F.coalesce((first == turn) | (first == F.left(turn, F.lit(1))), F.lit(False)))
    judged = judged.withColumn("typed", F.coalesce(F.endswith("street", F.concat(F.lit(" "), F.col("typ"))), F.lit(False)))
    of_text = Window.partitionBy("text")
    judged = judged.withColumn("best", F.min("step").over(of_text)).where("step = best")
    judged = judged.withColumn("any_turned", F.max("turned").over(of_text)).where("turned OR NOT any_turned")
    return judged.withColumn("any_typed", F.max("typed").over(of_text)).where("typed OR NOT any_typed").select("text", "street")


def fuzzy_streets(labels: DataFrame, streets: DataFrame) -> DataFrame:
    """(text, taken_for): labels one slip or a fragment away from exactly one name of the layer.

    Slips and fragments change the length by two at most, so names meet labels
    on their length, not all with all.
    """
    named = labels.select("text").distinct().select("text", X.norm_label(F.col("text"))["name"].alias("name"))
    named = named.where((F.length("name") >= 5) & X.type_of(F.col("name")).isNull()).withColumn("key", X.spell_key(F.col("name")))
    pool = streets.select(X.base_name(F.col("street")).alias("base")).distinct().where(F.length("base") >= 5).withColumn("pool", X.spell_key(F.col("base")))
    pool = pool.groupBy("pool").agg(F.min("base").alias("base"))
    asked = named.withColumn("n", F.explode(F.sequence(F.length("key") - 2, F.length("key") + 2)))
    met = asked.join(pool.withColumn("n", F.length("pool")), "n").where(X.fuzzy_match(F.col("key"), F.col("pool")))
    return met.groupBy("text").agg(F.count("*").alias("fits"), F.min("base").alias("taken_for")).where("fits = 1").select("text", "taken_for")
