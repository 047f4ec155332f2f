"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow of its documents, shuffled by a hash. A document is
served in packets of at most ``PACKET`` words, a source up to ``PASSES`` times
over. A packet's virtual finish time is the flow's words up to and including
it, divided by the source's weight. All packets are range-sorted by finish time
and the order is cut where their words add up to the budget: there every flow
has got its share, and flows that ran dry before have left theirs to the rest.
The packet at the cut is cut to the word; a source's takings differ from its
target by less than three packets, one a weight.

No source is gathered: running sums are taken inside the partitions of a range
sort, and the partitions' totals, one row each, give them their offsets. Finish
times are counted in sixths, so that they are whole numbers for weights 1 to 3.

Defined cases: null or blank text has size 0 and is never taken; null sources
form one source, ordered last; equal rows are separate documents; an empty
table gives an empty result; other columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seamline.llm.common import Stash, python_batches, table

WORD = r"[^\x20\x09-\x0D]+"
PACKET, PASSES = 16, 3
#: Finish times are in this fraction of a word's time; all weights divide it.
TICK = 6


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(key, source_size) -> the same with rank, weight, start (words of the sources before), target and level.

    The level is the virtual time at which capped sources and level * weight of
    the rest add up to the total; sources are met in the order in which they
    reach their caps. There is one row per source, so the windows need no keys.
    """
    everything, order = Window.partitionBy(), Window.orderBy("key")
    ranked = sizes.withColumn("rank", F.row_number().over(order).cast("long")).withColumn("weight", (F.col("rank") - 1) % 3 + 1)
    ranked = ranked.withColumns(
        {
            "start": F.sum("source_size").over(order) - F.col("source_size"),
            "total": F.sum("source_size").over(everything),
            "weights": F.sum("weight").over(everything),
            "cap": PASSES * F.col("source_size"),
        }
    ).withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    before = Window.orderBy("ratio", "key").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / (
        F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    # The level rises while sources below it are capped, and falls if one above it were.
    ranked = ranked.withColumn("level", F.max(level).over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level"))
    return ranked.select("key", "source_size", "rank", "weight", "start", "level", target.alias("target"))


def _running(value: str):
    """Adds the partition's number and the running sum of ``value`` over its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            sums = total + np.cumsum(batch.column(value).to_numpy())
            total = int(sums[-1]) if len(sums) else total
            columns = [*batch.columns, pa.array(np.full(len(sums), part, np.int64)), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "within"])

    return run


def running(df: DataFrame, order: list[str], value: str, stash: Stash, name: str) -> DataFrame:
    """``df`` with ``upto``, the sum of ``value`` up to and including a row in the global order of ``order``."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stash.put(name, ordered.mapInArrow(_running(value), f"{kinds}, part long, within long"))
    ends = placed.groupBy("part").agg(F.max("within").alias("words"))
    offset = F.sum("words").over(Window.orderBy("part")) - F.col("words")
    offsets = ends.select("part", offset.alias("offset"))  # a row for each partition
    return placed.join(F.broadcast(offsets), "part").withColumn("upto", F.col("offset") + F.col("within")).drop("part", "within", "offset")


def mix(docs: DataFrame, stash: Stash, keep: list[str]) -> DataFrame:
    """Every document as ``row``, a struct of the few columns of ``keep``, with size, source_size, target, taken,
    served (an array of the words taken in each pass) and finish (the finish times of each pass)."""
    python_batches(docs.sparkSession)
    identity = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))
    keyed = docs.select(
        F.struct(*keep).alias("row"),
        F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source"))).alias("key"),
        F.md5(identity.cast("binary")).alias("h"),
        F.xxhash64("text").alias("tie"),
        size_of(F.col("text")).alias("size"),
    )
    keyed = stash.put("mix-sizes", keyed, small=True)
    flows = stash.put("mix-flows", targets(keyed.groupBy("key").agg(F.sum("size").alias("source_size"))), small=True)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    placed = running(keyed, ["key", "h", "tie", "size"], "size", stash, "mix-order").join(flows, "key")
    placed = stash.put("mix-placed", placed.withColumn("prefix", F.col("upto") - F.col("size") - F.col("start")).select("row", "size", "source_size", "rank", "weight", "level", "target", "prefix"))

    # The words of a flow that end at a packet's end: whole passes, whole documents and the packets of this one.
    flow = lambda turn, end: turn * F.col("source_size") + F.col("prefix") + end
    time = lambda words: words * (F.lit(TICK) / F.col("weight")).cast("long")
    sources, budget = flows.agg(F.count("*"), F.sum("source_size")).first()
    # By this time the packets that have finished hold the budget: a flow lacks less than a packet of its share.
    last = F.ceil(TICK * (F.col("level") + PACKET * (sources + 1)))
    packets = (
        placed.where("size > 0")
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))))
        .where(time(flow(F.col("turn"), F.lit(0))) <= last)
        .withColumn("begin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(PACKET).cast("long"))))
        .withColumn("words", F.least(F.lit(PACKET).cast("long"), F.col("size") - F.col("begin")))
        .select(time(flow(F.col("turn"), F.col("begin") + F.col("words"))).alias("finish"), "rank", "words")
        .where(F.col("finish") <= last)
    )
    queue = running(stash.put("mix-packets", packets.select("finish", "rank", "words")), ["finish", "rank"], "words", stash, "mix-queue")
    at = queue.where(F.col("upto") >= F.lit(budget or 0)).agg(F.min(F.struct("finish", "rank", "words", "upto")).alias("at")).first()["at"]
    stash.drop("mix-packets", "mix-queue")
    if at is None:
        at = (-1, 0, 0, 0)
    cut, cut_rank, cut_words, cut_upto = at[0], at[1], at[2], at[3]

    # Words of a flow whose packets are in the order before the cut, and the words left to the packet at the cut.
    ticks = F.lit(TICK) / F.col("weight")
    reached = F.floor((F.lit(cut) - F.when(F.col("rank") >= cut_rank, 1).otherwise(0)) / ticks)
    partial = F.lit(cut_words - (cut_upto - (budget or 0)))

    def served(turn: int) -> Column:
        left = reached - flow(F.lit(turn), F.lit(0))
        whole = F.when(left >= F.col("size"), F.col("size")).otherwise(F.greatest(F.floor(left / PACKET) * PACKET, F.lit(0)))
        begun = flow(F.lit(turn), whole)
        end = begun + F.least(F.lit(PACKET), F.col("size") - whole)
        at_cut = (F.col("rank") == cut_rank) & (whole < F.col("size")) & (time(end) == cut)
        return (whole + F.when(at_cut, partial).otherwise(0)).cast("long")

    words = F.array(*(served(e) for e in range(PASSES)))
    finish = F.array(*(time(flow(F.lit(e), F.col("size"))) for e in range(PASSES)))
    total = F.aggregate("served", F.lit(0).cast("long"), lambda a, b: a + b)
    return placed.withColumns({"served": words, "finish": finish}).select("row", "size", "source_size", "target", total.alias("taken"), "served", "finish", "rank")


def mixture(docs: DataFrame, stash: Stash) -> DataFrame:
    """The mix itself: ``docs`` rows in the order of virtual finish times, one for each time a document is served.

    The text of a document that the budget cuts keeps its first words, joined by single spaces.
    """
    names = docs.columns
    held = stash.put("mix-rows", docs.select(F.struct(*names).alias("row"), F.monotonically_increasing_id().alias("id")))
    turns = F.filter(F.transform(F.arrays_zip("served", "finish"), lambda x: x), lambda x: x["served"] > 0)
    served = mix(held.select("id", "row.doc_id", "row.text", "row.source"), stash, ["id"]).select("row.id", "size", "rank", F.explode(turns).alias("x")).select("id", "size", "rank", "x.served", "x.finish")
    joined = held.select("id", "row").join(served, "id")
    cut = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0)), 1, F.col("served").cast("int")), " ")
    told = joined.withColumn("cut", F.when(F.col("served") < F.col("size"), cut).otherwise(F.col("row.text")))
    ordered = told.repartitionByRange("finish", "rank", "id").sortWithinPartitions("finish", "rank", "id")
    return ordered.select(*(F.col("cut").alias(n) if n == "text" else F.col("row").getField(n).alias(n) for n in names))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"), Stash(spark), ["doc_id"])
    return found.select("row.doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), concat('#', md5(coalesce(text, ''))))) AS h,
         CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
      FROM d GROUP BY source),
r AS (SELECT *, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / weight AS ratio FROM s),
l AS (SELECT *, CAST((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER b, 0) AS DOUBLE)
              / ((SELECT sum(weight) FROM s) - coalesce(sum(weight) OVER b, 0)) AS level
      FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, rank, weight, least(CAST(cap AS DOUBLE), weight * (SELECT max(level) FROM l)) AS target FROM l),
p AS (SELECT d.id, d.doc_id, d.size, t.source_size, t.rank, t.weight, t.target,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, size ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS prefix
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT id, rank, least(16, size - start) AS words, (turn * source_size + prefix + least(start + 16, size)) * (6 // weight) AS finish
      FROM (SELECT *, unnest(range(0, size, 16)) AS start FROM (SELECT *, unnest(range(3)) AS turn FROM p))),
q AS (SELECT id, words, sum(words) OVER (ORDER BY finish, rank ROWS UNBOUNDED PRECEDING) - words AS before FROM k),
g AS (SELECT id, sum(least(words, greatest((SELECT sum(size) FROM d) - before, 0))) AS taken FROM q GROUP BY id)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM p LEFT JOIN g USING (id)
"""
