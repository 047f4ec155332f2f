"""Analytics over the append-only log of stage executions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_per_key(df: DataFrame, keys: list[str], finished: str, ordinal: str) -> DataFrame:
    """The last row of each key by time, the later in file order on ties. One shuffle; WindowGroupLimit prunes before it."""
    last = Window.partitionBy(*keys).orderBy(F.col(finished).desc_nulls_last(), F.col(ordinal).desc())
    return df.withColumn("__rn", F.row_number().over(last)).where("__rn = 1").drop("__rn")


def flat_pairs(df: DataFrame, id_column: str) -> DataFrame:
    """(id, key, value) of every field: dotted keys for nested fields, scalar lists joined by blanks, other lists as JSON."""

    def leaves(column: Column, kind: T.DataType, key: str) -> list[tuple[str, Column]]:
        if isinstance(kind, T.StructType):
            return [leaf for f in kind.fields for leaf in leaves(column.getField(f.name), f.dataType, f"{key}.{f.name}" if key else f.name)]
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType)):
                return [(key, F.when(F.size(column) == 0, "").otherwise(F.to_json(column)))]
            return [(key, F.array_join(F.transform(column, lambda x: x.cast("string")), " "))]
        return [(key, column.cast("string"))]

    pairs = [leaf for f in df.schema.fields if f.name != id_column for leaf in leaves(F.col(f.name), f.dataType, f.name)]
    rows = F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs))
    return df.select(id_column, F.inline(rows))


def status_of(elapsed: Column) -> Column:
    return F.when(elapsed.isNull(), "missing").when(elapsed < 20, "ok").when(elapsed < 80, "slow").otherwise("refused")


def status_rollup(log: DataFrame) -> DataFrame:
    """Totals per stage with null-safe ratios."""
    status = status_of(F.col("elapsed_s"))
    return log.groupBy("stage").agg(
        F.count("*").alias("n"),
        F.count_if(status == "ok").alias("n_ok"),
        F.count_if(status == "slow").alias("n_slow"),
        F.count_if(status == "refused").alias("n_refused"),
        F.round(F.try_divide(F.count_if(status == "ok").cast("double"), F.count("*")), 6).alias("ok_share"),
        F.min("finished").alias("first_utc"),
        F.max("finished").alias("last_utc"),
        F.count_distinct("run").alias("runs"),
    )


def rebuild(master: DataFrame, per_run: DataFrame) -> DataFrame:
    """Per-run events and those of the master log that no run holds."""
    return per_run.unionByName(master.join(per_run.select("event_id"), "event_id", "left_anti"))


def backfill(log: DataFrame, stages: list[str]) -> DataFrame:
    """(run, stage) pairs of the known stages without an event, for runs that have any."""
    have = log.groupBy("run").agg(F.collect_set("stage").alias("have"))
    lacking = F.array_except(F.array(*(F.lit(s) for s in stages)), "have")
    return have.select("run", F.explode(lacking).alias("stage")).withColumn("backfilled", F.lit(True))


def lap_seconds(log: DataFrame) -> DataFrame:
    """Seconds since the previous event of the run, summed per (run, stage)."""
    before = F.lag("finished").over(Window.partitionBy("run").orderBy("finished", "event_id"))
    lap = F.unix_micros(F.col("finished").cast("timestamp")) - F.unix_micros(before.cast("timestamp"))
    laps = log.withColumn("lap", F.coalesce(lap, F.lit(0)))
    return laps.groupBy("run", "stage").agg((F.sum("lap") / 1e6).alias("seconds"), F.count("*").alias("laps"))
