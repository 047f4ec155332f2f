"""Shared pieces of the corpus operators: tables, checkpoints and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamline.session import ship

#: Bytes of a batch that is handed to Python. Batches are counted in rows and
#: texts can be long, so the row count is small; Spark also cuts by bytes.
ARROW_ROWS = 256
ARROW_BYTES = 8 << 20
#: Bytes a core below which a table is small.
SMALL = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus. A small one, which may be a single row group, is dealt out evenly."""
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    small = found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < cores * SMALL
    return found.repartition(cores) if small else found


def python_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers hold at once, and see that they find this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``. Only a local master may leave it unset, as tests do."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="seamline-"))
        found = spark.sparkContext.getCheckpointDir()
    return str(found).rstrip("/")


def few(df: DataFrame) -> DataFrame:
    """``df``, far smaller than what it was made from, dealt to a sixteenth of the usual partitions: the work
    before keeps all of its tasks, and there are few files and few tasks that write."""
    return df.repartition(max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16))


class Stash:
    """Tables written to the shared folder: they cut lineage and outlive lost executors.

    What ``drop`` has not removed is removed when the application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def put(self, name: str, df: DataFrame, small: bool = False) -> DataFrame:
        """Write ``df`` and read it back. A ``small`` table, one far smaller than the input, gets a sixteenth of the files."""
        if small:
            df = few(df)
        path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.paths[name] = path
        self._files(path)[0].deleteOnExit(self._files(path)[1])
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        for name in names:
            files, path = self._files(self.paths.pop(name))
            files.delete(path, True)
            files.cancelDeleteOnExit(path)

    def _files(self, path: str) -> tuple:
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows; else as it is, for a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def id_mod(column: str, m: int) -> Column:
    """crc32 of an id's decimal text, modulo ``m``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % m
