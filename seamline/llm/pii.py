"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

E-mail addresses, IP addresses, card and phone numbers are found by pattern and
check sums. Each value found is a protected entity. The corpus then tells which
words reveal it: for a term t in the words around an entity e the disclosure is
PMI(t; e) / IC(e), with document frequencies over the whole corpus, 1 where t
is said only around e. Words around are the ``AROUND`` whole words next to it
on either side, within ``REACH`` characters. A term seen around e in at least
``SUPPORT`` documents whose disclosure reaches ``GENERALISE`` is generalised to
its kind of word, from ``REMOVE`` on removed, in the documents that hold e.
Copies count: whoever holds a copy that was not sanitised finds the others by
the rare words around the entity. One document alone is no evidence, as most
words are rare in it.

The patterns are possessive and start at the beginning of a run, which finds
the same spans as their plain forms but in linear time and constant stack.

Defined cases: null text is empty and has no spans; equal rows get equal
results; empty tables and further columns are allowed.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seamline.llm.common import Stash, bounded, few, table
from seamline.llm.decontaminate import row_key

KINDS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
#: A number of at most 255, leading zeros allowed.
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?+)?+"
TERM = r"\p{L}{3,}+"
#: Characters and words looked at on either side of an entity.
REACH, AROUND = 200, 5
SUPPORT, GENERALISE, REMOVE = 2, 0.75, 0.9
ROWS_CAP = 1_000_000
SPAN = "array<struct<s:int,e:int,m:string>>"


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substr(number, -i, F.lit(1))) - 48
        twice = F.when(i % 2 == 0, 2 * d).otherwise(d)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits(m)).between(13, 19), luhn(digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(digits(m)).between(9, 15)
    return F.lit(True)


def valid_span(kind: str, x: Column) -> Column:
    return valid(kind, x["m"])


def tagged(kind: str, x: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"))


def written(kind: str, x: Column) -> Column:
    return F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string"))


def replaced(kind: str, x: Column) -> Column:
    return F.struct(x["s"].alias("start"), x["e"].alias("end"), F.lit(f"[{kind.upper()}]").alias("to"))


def located(text: Column, pattern: str, matches: Column) -> Column:
    """Matches with their code-point offsets: the texts between them are split off and lengths added up."""
    pieces = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))

    def place(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(F.struct(start.alias("s"), end.alias("e"), x["m"].alias("m")))).alias("spans"))

    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans")), place, lambda state: state["spans"])


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with a column of valid spans per kind."""
    none = F.array().cast("array<string>")
    text = F.coalesce(F.col("text"), F.lit(""))
    found = {}
    for kind, (pattern, sign) in KINDS.items():
        all_of = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        found[f"__{kind}"] = F.when(F.contains(text, F.lit(sign)), all_of).otherwise(none) if sign else all_of
    out = docs.withColumns(found)
    for kind, (pattern, _) in KINDS.items():
        m = F.col(f"__{kind}")
        some = F.size(F.filter(m, partial(valid, kind))) > 0
        spans = F.filter(located(text, pattern, m), partial(valid_span, kind))
        out = out.withColumn(f"__s_{kind}", F.when(some, spans).otherwise(F.array().cast(SPAN)))
    return out.drop(*found)


def disclosure(total: Column) -> Column:
    """PMI of term and entity over the entity's information, from document counts."""
    ic = F.log(total / F.col("n_e"))
    return F.when(ic > 0, F.log(total * F.col("n_te") / (F.col("n_t") * F.col("n_e"))) / ic)


def revealing(docs: DataFrame, spanned: DataFrame, stash: Stash) -> DataFrame:
    """(k1, k2, start, end, word, level) of terms that disclose an entity of their document."""
    every = F.flatten(F.array(*(F.transform(f"__s_{kind}", partial(tagged, kind)) for kind in KINDS)))
    mentions = spanned.select("k1", "k2", "text", F.explode(every).alias("x"))
    value = F.concat(F.col("x.kind"), F.lit(":"), F.when(F.col("x.kind") == "email", F.lower("x.m")).when(F.col("x.kind") == "ip", F.col("x.m")).otherwise(digits(F.col("x.m"))))
    begin = F.greatest(F.col("x.s") - REACH, F.lit(0))
    # A word that the reach cuts is left out, on either side.
    ahead = F.regexp_replace(F.substr("text", begin + 1, F.col("x.s") - begin), F.when(begin > 0, r"^\p{L}++").otherwise("^$"), F.lit(" "))
    after = F.substr("text", F.col("x.e") + 1, F.lit(REACH))
    after = F.regexp_replace(after, F.when(F.length("text") > F.col("x.e") + REACH, r"(?<!\p{L})\p{L}++$").otherwise("^$"), F.lit(" "))
    ahead, after = (F.regexp_extract_all(x, F.lit(TERM), F.lit(0)) for x in (ahead, after))
    near = F.concat(F.slice(ahead, F.greatest(F.size(ahead) - AROUND + 1, F.lit(1)), F.lit(AROUND)), F.slice(after, 1, AROUND))
    near = F.array_distinct(F.transform(near, F.lower))
    seen = stash.put("mentions", mentions.select("k1", "k2", value.alias("entity"), near.alias("near")), small=True)
    entity = seen.groupBy("entity").agg(F.count_distinct("k1", "k2").alias("n_e"))
    around = seen.select("k1", "k2", "entity", F.explode("near").alias("term")).distinct()
    pairs = around.groupBy("entity", "term").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= SUPPORT)
    total = F.lit(docs.count()).cast("double")
    # A term is in at least as many documents as have it around some entity: enough to tell that it discloses nothing.
    least = around.select("k1", "k2", "term").distinct().groupBy("term").agg(F.count("*").alias("n_t"))
    likely = pairs.join(entity, "entity").join(least, "term")
    likely = stash.put("likely", likely.where(disclosure(total) >= GENERALISE).drop("n_t"), small=True)
    said = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    # Counting all terms costs less than it seems, as they are summed before the shuffle; joined first, a frequent
    # term that is said around a much copied entity would meet all its documents.
    frequency = said.groupBy("term").agg(F.count("*").alias("n_t"))
    flagged = likely.join(frequency, "term").withColumn("disclosure", disclosure(total)).where(F.col("disclosure") >= GENERALISE).select("entity", "term", "disclosure")
    flagged = stash.put("flagged", flagged, small=True)
    told = seen.select("k1", "k2", "entity").distinct().join(flagged, "entity").groupBy("k1", "k2", "term").agg(F.max("disclosure").alias("disclosure"))
    told = stash.put("told", told, small=True)
    texts = spanned.select("k1", "k2", "text", every.alias("every")).join(bounded(told.select("k1", "k2").distinct(), ROWS_CAP), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    word = F.regexp_extract_all("text", F.lit(TERM), F.lit(0))
    gaps = F.slice(F.split("text", TERM, -1), F.lit(1), F.size(word))
    spread = texts.select("k1", "k2", "every", F.posexplode(F.arrays_zip(gaps.alias("gap"), word.alias("word"))).alias("i", "x"))
    run = Window.partitionBy("k1", "k2").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = spread.withColumn("end", F.sum(F.length("x.gap") + F.length("x.word")).over(run).cast("int")).withColumn("start", F.col("end") - F.length("x.word"))
    clear = ~F.exists("every", lambda s: (s["s"] < F.col("end")) & (s["e"] > F.col("start")))
    named = placed.where(clear).withColumn("term", F.lower("x.word"))
    level = F.when(F.col("disclosure") >= REMOVE, "removed").otherwise("generalised")
    kind = F.when(F.substring("x.word", 1, 1) != F.substring("term", 1, 1), "[NAME]").otherwise("[WORD]")
    return named.join(told, ["k1", "k2", "term"]).select("k1", "k2", "start", "end", level.alias("level"), F.when(level == "removed", "").otherwise(kind).alias("to"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    stash = Stash(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spanned = with_spans(docs.select("doc_id", "text", *row_key()))
    held = sum((F.size(f"__s_{k}") for k in KINDS), F.lit(0)) > 0
    terms = revealing(docs, spanned.where(held), stash)
    extra = terms.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("level", "start", "end"))).alias("terms"))
    listed = [F.transform(f"__s_{k}", partial(written, k)) for k in KINDS]
    own = F.concat(*listed)
    more = F.transform(F.coalesce("terms", F.array().cast("array<struct<level:string,start:int,end:int>>")), lambda x: F.concat_ws(":", x["level"], x["start"].cast("string"), x["end"].cast("string")))
    found = spanned.drop("text").join(bounded(stash.put("extra", extra, small=True), ROWS_CAP), ["k1", "k2"], "left").select(
        "doc_id",
        *(F.size(f"__s_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(own, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(own, more), ",").alias("spans"),
    )
    return few(found)


def sanitise(docs: DataFrame, stash: Stash) -> DataFrame:
    """``docs`` with entities replaced by their kind, revealing terms generalised to [NAME] or [WORD] or removed."""
    names = docs.columns
    spanned = with_spans(docs.select(F.struct(*names).alias("row"), "text", *row_key()))
    held = sum((F.size(f"__s_{k}") for k in KINDS), F.lit(0)) > 0
    terms = revealing(docs, spanned.where(held), stash)
    extra = terms.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end", "to")).alias("terms"))
    joined = spanned.join(bounded(stash.put("terms", extra), ROWS_CAP), ["k1", "k2"], "left")
    entities = [F.transform(f"__s_{k}", partial(replaced, k)) for k in KINDS]
    spans = F.array_sort(F.concat(*entities, F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,to:string>>"))))

    def write(state: Column, x: Column) -> Column:
        """Spans that overlap are one: the later ones extend what is cut out."""
        gap = F.substr("text", state["at"] + 1, F.greatest(x["start"] - state["at"], F.lit(0)))
        out = F.when(x["start"] >= state["at"], F.concat(state["out"], gap, x["to"])).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.aggregate(spans, begin, write, lambda s: F.concat(s["out"], F.substr("text", s["at"] + 1, F.length("text"))))
    told = F.when(F.size(spans) > 0, text).otherwise(F.col("text"))
    return joined.select(*(told.alias(n) if n == "text" else F.col("row").getField(n).alias(n) for n in names))
