"""The run log as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamline.operators.runlog import latest_per_key

#: Parts of the table by a hash of the key; a batch rewrites those it touches.
BUCKETS = 16


def log_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(path)


def _files(spark: SparkSession, path: str) -> tuple:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _versions(spark: SparkSession, target: str) -> dict[int, list[int]]:
    """The versions of each bucket, in order: a few numbers for each of a fixed number of folders."""
    files, pattern = _files(spark, f"{target}/bucket=*/v=*")
    out: dict[int, list[int]] = {}
    for status in files.globStatus(pattern) or []:
        path = status.getPath()
        out.setdefault(int(path.getParent().getName().split("=")[1]), []).append(int(path.getName().split("=")[1]))
    return {k: sorted(v) for k, v in out.items()}


def _read(spark: SparkSession, target: str, parts: dict[int, int]) -> DataFrame:
    return spark.read.option("basePath", target).parquet(*(f"{target}/bucket={b}/v={v}" for b, v in parts.items()))


def latest(spark: SparkSession, target: str) -> DataFrame:
    """The table that ``keep_latest`` maintains: the last version of each bucket."""
    return _read(spark, target, {b: v[-1] for b, v in _versions(spark, target).items()}).drop("bucket", "v")


def keep_latest(stream: DataFrame, target: str, checkpoint: str, keys: list[str], finished: str, ordinal: str):
    """Maintain the latest event per key in ``target``.

    A batch is first reduced to one event per key, then merged with the buckets
    of the table that its keys fall in; these get a new version under the
    batch's number. The version before stays, so that a batch done again after
    a failure starts from what it started from; older ones are removed.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
        new = latest_per_key(batch, keys, finished, ordinal).withColumn("bucket", bucket)
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most BUCKETS
        versions = {b: [v for v in _versions(spark, target).get(b, []) if v < number] for b in touched}
        before = {b: v[-1] for b, v in versions.items() if v}
        if before:
            new = latest_per_key(_read(spark, target, before).select(*batch.columns, "bucket").unionByName(new), keys, finished, ordinal)
        for b in touched:
            files, path = _files(spark, f"{target}/bucket={b}/v={number}")
            files.delete(path, True)
        new.withColumn("v", F.lit(number)).write.mode("append").partitionBy("bucket", "v").parquet(target)
        for b, old in versions.items():
            for v in old[:-1]:
                files, path = _files(spark, f"{target}/bucket={b}/v={v}")
                files.delete(path, True)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge).trigger(availableNow=True).start()


def unfinished(stream: DataFrame, unit: list[str], watermark: str, delay: str = "1 day") -> DataFrame:
    """Each work unit once; repeats within the delay are dropped, so the state stays bounded."""
    return stream.withWatermark(watermark, delay).dropDuplicatesWithinWatermark(unit)


def windowed_counts(stream: DataFrame, at: str, key: str, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    return stream.withWatermark(at, delay).groupBy(F.window(at, width), key).count()
