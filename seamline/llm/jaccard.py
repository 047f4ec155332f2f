"""Exact n-gram Jaccard join that skips work through relations between sets.

Documents with equal shingle sets form one class, and only one document of a
class is indexed. All sets are read in one fixed order of shingles: light ones
by hash, then the most frequent ones. Two sets of the wanted similarity share a
shingle in the prefixes of that order, so a list per prefix shingle finds every
pair. Lists are never expanded into pairs:

* each list is compared with a hub first; documents close to the hub join its
  component at once, and the overlap with the hub is kept as a computed answer;
* documents that stay outside are compared with the rest of the list, block by
  block of set sizes (other blocks are skipped), by positions in the prefixes
  and the number of shared prefix shingles, and only if the answers of their hubs leave room: with overlaps x and y with
  the same hub, two sets share at most min(x, y) + min(|A| - x, |B| - y);
* what is left of long lists, the families of near copies, meets in blocks of
  bounded size, where each answer is derived from the two sets' differences
  from the hub. A block returns a spanning forest, never pairs.

The set of frequent shingles only orders the index. It holds at most
``FREQUENT`` shingles; any choice gives the same links.

A class is known by two independent sums of 64 bits; classes that agree in the
first only, if there ever are any, are numbered anew.

Defined cases: null, empty and blank texts have no shingles and link with
nothing; a text of fewer words than a shingle is one shingle; equal rows are
linked; rows of one id with different texts are compared each by its own text;
rows without an id link with nothing; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seamline.llm.common import Stash, bounded, python_batches, table
from seamline.llm.components import components, link_labels
from seamline.llm.shingles import mix64, shingle_set

#: Size of the dictionary of frequent shingles, and the count from which one is frequent.
FREQUENT, OFTEN = 200_000, 48
#: Rounds of comparing each list with a hub before the rest is compared.
HUBS = 2
#: Longest list whose documents may meet in a join; those of longer ones meet in blocks of so many sets and items.
LIGHT, BLOCK_SETS, BLOCK_ITEMS = 64, 1024, 1 << 19
#: Ids that are broadcast to pick texts; more go through a shuffle.
IDS = 2_000_000


def _need(n: np.ndarray | int, percent: int):
    """Shingles that a set of size n shares at least with a similar one."""
    return -(-n * percent // 100)


def prints(found: np.ndarray) -> tuple[int, int]:
    """Two sums that name a set."""
    n = np.uint64(len(found))
    with np.errstate(over="ignore"):
        return tuple(int(mix64(x).sum(dtype=np.uint64).astype(np.int64)) for x in (found + n, found * np.uint64(0xD6E8FEB86659FD93) + n))


def _heads(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), k) for text in batch.column("text")]
            named = [prints(x) for x in sets]
            columns = [pa.array(x, pa.int64()) for x in ([len(x) for x in sets], [x for x, _ in named], [x for _, x in named])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), *columns], names=["doc_id", "th", "n", "cid", "check"])

    return run


def _region(k: int, percent: int):
    """The shingles that may fall in a prefix: twice its length by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), k)
                parts.append(found[: 2 * (len(found) - _need(len(found), percent) + 1)])
            tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], names=["tok"])

    return run


def _postings(k: int, percent: int, frequent, moved: dict[tuple[int, int], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for batch in batches:
            tokens, cids, sizes, places = [], [], [], []
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), k)
                n = len(found)
                if not n:
                    continue
                named = prints(found)
                cid = moved.get(named, named[0])
                if len(often):
                    common = often[np.minimum(np.searchsorted(often, found), len(often) - 1)] == found
                    found = np.concatenate([found[~common], found[common]])
                prefix = found[: n - _need(n, percent) + 1]
                tokens.append(prefix)
                cids.append(np.full(len(prefix), cid, np.int64))
                sizes.append(np.full(len(prefix), n, np.int32))
                places.append(np.arange(len(prefix), dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(cids)), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places))],
                    names=["tok", "cid", "n", "place"],
                )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(text.as_py(), k) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in found], pa.binary())], names=["cid", "items"])

    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = [
            len(np.intersect1d(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), assume_unique=True))
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "na", "nb")), pa.array(shared, pa.int64())], names=["a", "b", "na", "nb", "shared"])


def _compare_families(members: DataFrame, texts: DataFrame, classes: DataFrame, stash: Stash, k: int, percent: int) -> DataFrame:
    """(a, b) linking what belongs together among ``members`` of the same hub; blocks of members meet in pairs."""
    sets = stash.put("family-sets", _sets_of(members.select("cid").distinct(), texts, classes, stash, "family", k))
    blocks = F.greatest(F.ceil(F.sum("n") / BLOCK_ITEMS), F.ceil(F.count("*") / BLOCK_SETS)).cast("int")
    sizes = stash.put("families", members.groupBy("hub").agg(blocks.alias("nb")))
    own = F.pmod(F.xxhash64(F.lit(11), "cid"), F.col("nb")).cast("int")
    rows = members.join(sizes, "hub").withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.select("hub", F.least("own", "with").alias("bi"), F.greatest("own", "with").alias("bj"), "own", "cid", "comp")
    every = F.sequence(F.lit(0), F.col("nb") - 1)
    hubs = sizes.withColumn("bi", F.explode(every)).withColumn("bj", F.explode(every)).where("bi <= bj")
    hubs = hubs.select("hub", "bi", "bj", F.lit(-1).alias("own"), F.col("hub").alias("cid"), F.lit(0).cast("long").alias("comp"))
    return rows.unionByName(hubs).join(sets, "cid").groupBy("hub", "bi", "bj").applyInPandas(_family(percent), "a long, b long")


def _sets_of(ids: DataFrame, texts: DataFrame, classes: DataFrame, stash: Stash, name: str, k: int) -> DataFrame:
    """(cid, items) of the classes ``ids``, read from the text of one document each."""
    wanted = stash.put(f"{name}-ids", ids.join(classes, "cid").select("cid", F.col("rep").alias("doc_id"), "th"))
    return texts.join(bounded(wanted, IDS), ["doc_id", "th"]).select("cid", "text").mapInArrow(_sets(k), "cid long, items binary").dropDuplicates(["cid"])


def _family(percent: int):
    """Compare the members of a family through their differences from the hub.

    With r items of the hub missing and some others added, two members share
    |hub| - r1 - r2 + (items in which both differ from the hub), so only the
    differences are multiplied. Members of one component are not compared.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        hub = np.frombuffer(pdf.loc[pdf["own"] < 0, "items"].iloc[0], np.uint64)
        part = pdf[pdf["own"] >= 0]
        left = part[part["own"] == part["bi"]]
        right = part[part["own"] == part["bj"]]
        none = pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        if not len(left) or not len(right):
            return none
        comp1, comp2 = left["comp"].to_numpy(), right["comp"].to_numpy()
        todo = comp1[:, None] != comp2[None, :]
        read = lambda x: [np.frombuffer(v, np.uint64) for v in x["items"]]
        one, two = read(left), read(right)
        n1, n2 = np.array([len(x) for x in one]), np.array([len(x) for x in two])
        least = -(-percent * (n1[:, None] + n2[None, :]) // (100 + percent))
        todo &= np.minimum(n1[:, None], n2[None, :]) >= least
        if not todo.any():
            return none
        gone = lambda sets: np.array([len(hub) - len(np.intersect1d(x, hub, assume_unique=True)) for x in sets])
        r1, r2 = gone(one), gone(two)
        d1, d2 = ([np.setxor1d(x, hub, assume_unique=True) for x in sets] for sets in (one, two))
        shared = (len(hub) - r1[:, None] - r2[None, :]).astype(np.float32)
        items = np.intersect1d(np.concatenate(d1), np.concatenate(d2))
        for start in range(0, len(items), 4096):
            some = items[start : start + 4096]
            x, y = (_incidence(d, some) for d in (d1, d2))
            shared += x @ y.T
        links = todo & (np.rint(shared) >= least)
        if not links.any():
            return none
        low, high = link_labels(links)
        names = np.concatenate([left["cid"].to_numpy(), right["cid"].to_numpy()])
        out = pd.DataFrame({"a": names, "b": names[np.concatenate([low, high])]})
        return out[out["a"] != out["b"]]

    return run


def _incidence(sets: list[np.ndarray], items: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(items)), np.float32)
    for i, x in enumerate(sets):
        at = np.searchsorted(items, x)
        at[at == len(items)] = 0
        out[i, at[items[at] == x]] = 1
    return out


def groups(docs: DataFrame, stash: Stash, k: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; ``percent`` is the similarity from which two sets link."""
    return grouped(docs, stash, k, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _classes(heads: DataFrame, stash: Stash) -> tuple[DataFrame, DataFrame, dict[tuple[int, int], int]]:
    """``heads`` and their classes (cid, rep, th, size), with a number of its own for each, and the numbers that changed."""
    first = F.min(F.struct("doc_id", "th"))
    found = heads.where("n > 0 AND doc_id IS NOT NULL").groupBy("cid", "check").agg(first.alias("first"), F.count("*").alias("size"))
    classes = stash.put("classes", found.select("cid", "check", F.col("first.doc_id").alias("rep"), F.col("first.th").alias("th"), "size"))
    shared = classes.groupBy("cid").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high").select("cid", "low")
    again = classes.join(shared, "cid").where("check <> low").select("cid", "check", F.xxhash64("cid", "check").alias("own")).collect()  # hardly ever any
    if again:
        table_ = F.broadcast(heads.sparkSession.createDataFrame([tuple(r) for r in again], "cid long, check long, own long"))
        anew = lambda df: df.join(table_, ["cid", "check"], "left").withColumn("cid", F.coalesce("own", "cid")).drop("own")
        heads, classes = anew(heads), anew(classes)
    return heads, classes.drop("check"), {(r["cid"], r["check"]): r["own"] for r in again}


def grouped(docs: DataFrame, stash: Stash, k: int, percent: int) -> DataFrame:
    """(doc_id, th, n, group, component_id) for every row: the hash of its text, the size of its set, and its component
    by number (null without one) and by smallest id."""
    spark = docs.sparkSession
    python_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    heads = stash.put("heads", texts.mapInArrow(_heads(k), "doc_id long, th long, n long, cid long, check long"))
    heads, classes, moved = _classes(heads, stash)

    region = texts.mapInArrow(_region(k, percent), "tok long").groupBy("tok").count().where(F.col("count") >= OFTEN)
    top = region.orderBy(F.desc("count"), "tok").limit(FREQUENT).select("tok").toPandas()["tok"]
    frequent = spark.sparkContext.broadcast(np.sort(top.to_numpy(np.int64).view(np.uint64)))

    copies = heads.where("n > 0").join(classes.where("size > 1").withColumnRenamed("th", "rep_th"), "cid").where("doc_id <> rep OR th <> rep_th").select("doc_id", "th")
    single = texts.where("doc_id IS NOT NULL").join(bounded(copies, IDS), ["doc_id", "th"], "left_anti")
    listed = Window.partitionBy("tok")
    postings = single.mapInArrow(_postings(k, percent, frequent, moved), "tok long, cid long, n int, place int")
    index = stash.put(
        "index",
        postings.withColumn("hub", F.min("cid").over(listed))
        .withColumn("many", F.count("*").over(listed) > LIGHT)
        .withColumn("most", F.max("cid").over(listed))
        .where("hub <> most")
        .select("tok", "cid", "n", "place", "hub", "many")
        .distinct(),
    )

    def verified(name: str, pairs: DataFrame) -> DataFrame:
        """``pairs`` with their overlaps; only the texts of documents in a pair are read into sets."""
        pairs = stash.put(f"{name}-pairs", pairs)
        ids = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        sets = stash.put(f"{name}-sets", _sets_of(ids, texts, classes, stash, name, k))
        x = sets.select(F.col("cid").alias("a"), F.col("items").alias("x"))
        y = sets.select(F.col("cid").alias("b"), F.col("items").alias("y"))
        joined = pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "x", "y")
        out = stash.put(name, joined.mapInArrow(_overlaps, "a long, b long, na long, nb long, shared long"))
        stash.drop(f"{name}-sets")
        return out

    def enough(pairs: DataFrame) -> DataFrame:
        """Pairs that share so many prefix shingles that they may be similar.

        Common shingles outside of both prefixes lie behind the prefix that ends
        first, so a pair shares at most those counted and one of the two rests.
        A hub sees only its own lists; a pair dropped there is counted again with
        the rest, over all lists that are not long.
        """
        rest = F.greatest(*(F.ceil(F.col(n) * percent / 100 - 1e-9) - 1 for n in ("na", "nb")))
        least = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent) - 1e-9)
        return pairs.groupBy("a", "b", "na", "nb").count().where(F.col("count") + rest >= least).drop("count")

    def ordered(a: str, b: str, na: str, nb: str) -> list:
        """A pair with its smaller id first: lists give it in either order, and its shingles are counted over all of them."""
        swap = F.col(a) > F.col(b)
        sides = [(a, b), (b, a), (na, nb), (nb, na)]
        return [F.when(swap, F.col(y)).otherwise(F.col(x)).cast("long").alias(n) for (x, y), n in zip(sides, ("a", "b", "na", "nb"), strict=True)]

    alike = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    linked = 100 * F.col("shared") >= percent * (F.col("na") + F.col("nb") - F.col("shared"))
    answers = found = labels = None
    for turn in range(HUBS):
        now = index if labels is None else index.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        if labels is None:
            now = now.withColumn("comp", F.col("cid"))
            rest = now
        else:  # what the hubs so far did not bring into the main component of a list
            main = Window.partitionBy("tok")
            rest = now.withColumn("main", F.min(F.struct("cid", "comp")).over(main)["comp"]).where("comp <> main")
        hub = F.min(F.struct("cid", "n", "comp")).over(Window.partitionBy("tok"))
        pairs = (
            rest.withColumn("hub", hub)
            .where("comp <> hub.comp")
            .select(F.col("cid").alias("a"), F.col("hub.cid").alias("b"), F.col("n").cast("long").alias("na"), F.col("hub.n").cast("long").alias("nb"))
            .where(alike)
        )
        pairs = enough(pairs)
        if answers is not None:
            pairs = pairs.join(answers, ["a", "b"], "left_anti")
        done = verified(f"turn{turn}", pairs)
        answers = done if answers is None else answers.unionByName(done)
        found = answers.where(linked).select("a", "b")
        labels = stash.put(f"labels{turn}", components(found, stash, f"cc{turn}").select(F.col("node").alias("cid"), F.col("component").alias("comp")))

    # Each document's best answer: its largest overlap with a hub.
    best = answers.groupBy(F.col("a").alias("cid")).agg(F.max(F.struct("shared", "b")).alias("best")).select("cid", F.col("best.b").alias("near"), F.col("best.shared").alias("held"))
    hubs = answers.select(F.col("b").alias("cid"), F.col("b").alias("near"), F.col("nb").alias("held")).distinct()
    known = best.unionByName(hubs.join(best, "cid", "left_anti"))
    placed = index.join(labels, "cid", "left").join(known, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    mixed = (
        placed.withColumn("main", F.min(F.struct("cid", "comp")).over(listed)["comp"])
        .withColumn("other", F.max(F.col("comp") != F.col("main")).over(listed))
        .where("other")
    )
    mixed = stash.put("mixed", mixed)
    members = stash.put("members", mixed.where("many").select("cid", "hub", "n", "comp").distinct())
    families = members.groupBy("cid").agg(F.collect_set("hub").alias("hubs"))
    dense = stash.put("dense", _compare_families(members, texts, classes, stash, k, percent))
    mixed = mixed.where("NOT many").join(families, "cid", "left").withColumn("hubs", F.coalesce("hubs", F.array().cast("array<bigint>")))
    mixed = (
        mixed.withColumn("block", F.floor(F.log("n") / float(-np.log(percent / 100))).cast("int"))
    )
    side = lambda s: [F.col(c).alias(f"{c}{s}") for c in ("cid", "n", "place", "comp", "near", "held", "hubs")]
    left = mixed.where("comp <> main").select("tok", F.explode(F.array(*(F.col("block") + d for d in (-1, 0, 1)))).alias("block"), *side(1))
    right = mixed.select("tok", "block", (F.col("comp") == F.col("main")).alias("inner"), *side(2))
    least = F.ceil(percent * (F.col("n1") + F.col("n2")) / (100 + percent) - 1e-9)
    reach = F.least("place1", "place2") + 1 + F.least(F.col("n1") - F.col("place1") - 1, F.col("n2") - F.col("place2") - 1)
    room = F.least("held1", "held2") + F.least(F.col("n1") - F.col("held1"), F.col("n2") - F.col("held2"))
    rest = (
        left.join(right, ["tok", "block"])
        .where((F.col("comp1") != F.col("comp2")) & (F.col("inner") | (F.col("cid1") < F.col("cid2"))))
        .where(~F.arrays_overlap("hubs1", "hubs2"))
        .where((100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")) & (reach >= least))
        .where(F.col("near1").isNull() | F.col("near2").isNull() | (F.col("near1") != F.col("near2")) | (room >= least))
        .select(*ordered("cid1", "cid2", "n1", "n2"))
    )
    told = answers.select(*ordered("a", "b", "na", "nb")).select("a", "b")
    last = verified("rest", enough(rest).join(told, ["a", "b"], "left_anti"))
    joined = components(found.unionByName(last.where(linked).select("a", "b")).unionByName(dense), stash, "ccz")
    named = joined.join(classes, joined["node"] == classes["cid"]).select("cid", "component", "rep")
    least_of = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    final = classes.join(named.join(least_of, "component").select("cid", "component", "component_id"), "cid", "left").select("cid", F.coalesce("component", "cid").alias("group"), F.coalesce("component_id", "rep").alias("component_id"))
    own = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return heads.join(final, "cid", "left").select(
        "doc_id", "th", "n", F.when(own, F.col("group")).alias("group"), F.when(own, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, stash: Stash, k: int = 4, percent: int = 85) -> DataFrame:
    """One row of each component: that of the smallest id and, where its texts differ, of the smallest hash. Rows without
    an id or without a word stay."""
    kept = grouped(docs, stash, k, percent).where("group IS NOT NULL").groupBy("group").agg(F.min(F.struct("doc_id", "th")).alias("first")).select("first.*")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("said"))
    joins = F.col("said") & F.col("doc_id").isNotNull()
    chosen = keyed.where(joins).join(kept, ["doc_id", "th"], "left_semi").dropDuplicates(["doc_id", "th"])
    return chosen.select("row.*").unionByName(keyed.where(~joins).select("row.*"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"), Stash(spark), 4, 85)
