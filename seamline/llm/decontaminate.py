"""Benchmark decontamination by a prefix-filtered join, in DataFrame functions only.

An item's windows are 13 consecutive words (all its words if it has fewer); a
window is a set of shingles of ``K`` words and their places in it. Shingles are
ordered by rarity in the corpus. For containment of a whole window the
necessary prefix of that order is one shingle, the rarest: documents are joined
on these alone. An occurrence fixes where the window would lie; it must lie
inside the document (length and position) and is then verified exactly, by the
shingles that cover the window's words at their places.

The corpus is read once: the occurrences of the benchmark's shingles in it give
the counts of rarity, the prefix join and the verification. Shingles are
compared as texts, so nothing rests on hashes. Items of fewer than ``K`` words
are one shingle of their own length.

Defined cases: null text has no words; an item without words has no window;
equal rows get equal results; null item ids count as hits but not as items;
empty tables and further columns are allowed.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seamline.llm.common import Stash, bounded, few, table

#: What parts words, once A-Z are lower-cased. Splitting at it is several times faster than matching the words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, K = 13, 5
#: Rows of the benchmark's shingles, and of contaminated documents, up to which they are broadcast.
SHINGLES_CAP, IDS_CAP = 500_000, 1_000_000


def lowered(text: Column) -> Column:
    """A-Z as a-z; other letters stay. Plain ASCII texts take the fast function."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def parts(text: Column) -> Column:
    """Words in order; the first and the last part may be empty, which no word equals."""
    return F.split(F.coalesce(lowered(text), F.lit("")), GAP)


def words(text: Column) -> Column:
    return F.filter(parts(text), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    split = F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    return F.transform(F.array(split), lambda w: F.size(w) - (w[0] == "").cast("int") - ((F.size(w) > 1) & (F.element_at(w, -1) == "")).cast("int"))[0].cast("long")


def row_key() -> list[Column]:
    """Names a row by id and text, so that null and repeated ids stay apart."""
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k1"), F.xxhash64("text").alias("k2")]


def shingled(words_: str, size: int) -> Column:
    """The runs of ``size`` words of an array column, joined by blanks, in order."""
    last = F.size(words_) - size
    run = lambda i: F.concat_ws(" ", *(F.get(words_, i + j) for j in range(size)))
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), run)).otherwise(F.array().cast("array<string>"))


def windows(bench: DataFrame, stash: Stash) -> tuple[DataFrame, DataFrame]:
    """(window, size, k, place, shingle) of every shingle, of k words, of every distinct window, and (window, item_id) of their items.

    A window is named by its text.
    """
    items = bench.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("item")).where(F.size("item") > 0).distinct()
    size = F.least(F.lit(WINDOW), F.size("item"))
    run = F.transform(F.sequence(F.lit(0), F.size("item") - size), lambda i: F.array_join(F.slice("item", i + 1, size), " "))
    held = stash.put("item-windows", items.select("item_id", size.alias("size"), F.explode(run).alias("window")).distinct(), small=True)
    split = held.select("window", "size").distinct().withColumn("w", F.split("window", " "))
    k = F.least(F.lit(K), F.col("size"))
    runs = F.transform(F.sequence(F.lit(0), F.col("size") - k), lambda i: F.array_join(F.slice("w", i + 1, k), " "))
    shingles = split.select("window", "size", k.alias("k"), F.posexplode(runs).alias("place", "shingle"))
    return stash.put("window-shingles", shingles, small=True), held.select("window", "item_id")


def prefixes(shingles: DataFrame, seen: DataFrame) -> DataFrame:
    """(window, size, place, shingle): each window's rarest shingle; windows with a shingle that never occurs are left out."""
    ranked = shingles.join(seen.groupBy("shingle").agg(F.count("*").alias("n")), "shingle", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    first = ranked.groupBy("window", "size").agg(F.min(F.struct("n", "shingle", "place")).alias("first")).where("first.n > 0")
    return first.select("window", "size", F.col("first.place").alias("place"), F.col("first.shingle").alias("shingle"))


def occurrences(docs: DataFrame, shingles: DataFrame, stash: Stash) -> DataFrame:
    """(k1, k2, at, length, shingle) wherever a shingle of the benchmark occurs in a document of ``length`` words."""
    wanted = shingles.select("k", "shingle").distinct()
    sizes = sorted(r["k"] for r in shingles.select("k").distinct().collect())  # at most K of them
    split = docs.select(*row_key(), parts(F.col("text")).alias("w"))
    rows = None
    for k in sizes:
        of_k = bounded(wanted.where(F.col("k") == k).select("shingle"), SHINGLES_CAP)
        found = split.select("k1", "k2", F.size("w").alias("length"), F.posexplode(shingled("w", k)).alias("at", "shingle")).join(of_k, "shingle")
        rows = found if rows is None else rows.unionByName(found)
    if rows is None:
        rows = split.select("k1", "k2", F.size("w").alias("length"), F.lit(0).alias("at"), F.lit("").alias("shingle")).where("false")
    return stash.put("seen", rows.select("k1", "k2", "at", "length", "shingle").distinct(), small=True)


def candidates(seen: DataFrame, first: DataFrame) -> DataFrame:
    """(k1, k2, start, window, size): where a window's rarest shingle occurs and the window lies inside the document."""
    met = seen.join(first, "shingle").withColumn("start", F.col("at") - F.col("place"))
    inside = (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("length"))
    return met.where(inside).select("k1", "k2", "start", "window", "size")


def verified(found: DataFrame, shingles: DataFrame, seen: DataFrame) -> DataFrame:
    """The candidates whose words are those of the window: shingles side by side, and the last one, all occur in place."""
    last = F.col("size") - F.least(F.lit(K), F.col("size"))
    cover = shingles.where((F.col("place") % K == 0) | (F.col("place") == last))
    cover = cover.groupBy("window").agg(F.collect_list(F.struct("place", "shingle")).alias("cover"))
    asked = found.join(cover, "window").withColumn("need", F.size("cover"))
    asked = asked.withColumn("c", F.explode("cover")).select("k1", "k2", "start", "window", "size", "need", (F.col("start") + F.col("c.place")).alias("at"), F.col("c.shingle").alias("shingle"))
    met = asked.join(seen.drop("length"), ["k1", "k2", "at", "shingle"])
    return met.groupBy("k1", "k2", "start", "window", "size").agg(F.count("*").alias("n"), F.first("need").alias("need")).where("n = need").drop("n", "need")


def contamination(docs: DataFrame, bench: DataFrame, stash: Stash) -> DataFrame:
    """(k1, k2, n_hit, ids) of rows with an occurring window."""
    shingles, items = windows(bench, stash)
    seen = occurrences(docs, shingles, stash)
    exact = stash.put("exact", verified(candidates(seen, prefixes(shingles, seen)), shingles, seen), small=True)
    # The words in any occurrence: each adds what lies behind the end of those before it.
    order = Window.partitionBy("k1", "k2").orderBy("start", "end")
    spans = exact.select("k1", "k2", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    spans = spans.withColumn("before", F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    hit = spans.groupBy("k1", "k2").agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "before"), F.lit(0))).cast("long").alias("n_hit"))
    of_item = exact.select("k1", "k2", "window").distinct().join(items, "window").select("k1", "k2", "item_id").distinct()
    ids = of_item.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    return stash.put("hits", hit.join(ids, ["k1", "k2"]), small=True)


def scored(docs: DataFrame, bench: DataFrame, stash: Stash) -> DataFrame:
    hits = contamination(docs, bench, stash)
    sized = docs.select("doc_id", *row_key(), word_count(F.col("text")).alias("n_words"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    found = few(sized.join(bounded(hits, IDS_CAP), ["k1", "k2"], "left")).withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, bench: DataFrame, stash: Stash) -> DataFrame:
    """``docs`` without contaminated rows."""
    hits = contamination(docs, bench, stash)
    keyed = docs.select(F.struct(*docs.columns).alias("row"), word_count(F.col("text")).alias("n_words"), *row_key())
    joined = keyed.join(bounded(hits, IDS_CAP), ["k1", "k2"], "left")
    return joined.where(F.col("n_hit").isNull() | (20 * F.col("n_hit") < F.col("n_words"))).select("row.*")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Stash(spark))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(13, len(w)) AS size FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS run
       FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM bi)),
sizes AS (SELECT DISTINCT size FROM bi),
dw AS (SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS run
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
h AS (SELECT doc_id, item_id, i, dw.size FROM dw JOIN bw USING (size, run)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""
