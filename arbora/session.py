"""Sessions and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A session on this machine, for tests and benchmarks; clusters bring their own."""
    conf = {
        "spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": memory, "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.showConsoleProgress": "false",
    }
    spark = SparkSession.builder.master(f"local[{cores}]").appName("arbora").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the cluster names it.

    Only a local session may leave it unset: it then gets a folder of its own, since one machine holds everything.  The
    setting itself is left alone, as a running session may not change it.
    """
    at = spark.conf.get("spark.checkpoint.dir", "")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = f"{tempfile.gettempdir()}/checkpoints/{spark.sparkContext.applicationId}"
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: its lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark then deletes a query's shuffle files when the query ends, not when the driver next collects garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """The shuffles of what is run within are gone when it has run.  For large shuffles before other large ones."""
    before = spark.conf.get(TIDY)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(TIDY, before)


def tidied(df: DataFrame, name: str) -> DataFrame:
    """written(), and the shuffles that made it are gone when it returns."""
    with tidy(df.sparkSession):
        return written(df, name)


def staged(spark: SparkSession, path: str, extract: Callable[[], DataFrame]) -> DataFrame:
    """The table at path; if it isn't there whole, extract() is written there first."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        extract().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Deletes tables that written() made and that nothing reads any more."""
    for df in frames:
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            hadoop = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)


class Grown:
    """Rows that are only added to, in rounds, bucketed by keys in the shared folder: what is to be compared with all that is known is
    shuffled, what is known is not.  Each round's rows are a partition, written once, so a lost executor costs nothing."""

    def __init__(self, schema: DataFrame, keys: list[str], name: str = "grown"):
        self.spark, self.keys, self.columns, self.rounds = schema.sparkSession, keys, schema.columns, 0
        self.table = f"{name}_{uuid.uuid4().hex}"
        self.path = f"{scratch_dir(self.spark)}/{self.table}"
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def add(self, rows: DataFrame) -> DataFrame:
        """Writes a round of rows that are new, and reads it back."""
        now = rows.select(*self.columns, F.lit(self.rounds).alias("_round"))
        now.write.mode("append").partitionBy("_round").bucketBy(self.buckets, *self.keys).option("path", self.path).saveAsTable(self.table)
        self.rounds += 1
        return self.spark.table(self.table).where(F.col("_round") == self.rounds - 1).select(*self.columns)

    def without(self, rows: DataFrame) -> DataFrame:
        """Distinct rows whose keys are not known; the hash table is of the new rows, what is known streams by."""
        known = self.all().select(*self.keys).withColumn("_known", F.lit(True))
        return known.join(rows.distinct().hint("shuffle_hash"), self.keys, "right").where("_known is null").select(*self.columns)

    def all(self) -> DataFrame:
        return self.spark.table(self.table).select(*self.columns)
