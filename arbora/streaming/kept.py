"""The vote over a log that goes on, with each pair's witnesses kept as state.

A log has rows (source, sub, sup, stated, ord): from ord on, a source states a pair or takes it back.  The state of a voice (an
unordered pair, a source and a direction) is the last such row, whatever order rows arrive in, so a batch touches only
the voices that it names and reads nothing that was told before.  A voice is a key of its own, so that a pair may have any number
of sources.  The state lies in RocksDB, which the session must name as its state store (`STORE`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arbora.operators import votes

STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
VOICE = ["low", "high", "source", "down"]
VOICES = "low string, high string, source string, down boolean, stated boolean, epoch long"


def sides(log: DataFrame) -> DataFrame:
    """Rows of a log by unordered pair; rows without a source, an end or an ord say nothing, a null `stated` takes back."""
    log = log.where("source is not null and sub is not null and sup is not null and ord is not null")
    return log.select(F.least("sub", "sup").alias("low"), F.greatest("sub", "sup").alias("high"), "source", (F.col("sub") > F.col("sup")).alias("down"), F.coalesce("stated", F.lit(False)).alias("stated"), F.col("ord").cast("long").alias("ord"))


def votes_of(log: DataFrame) -> DataFrame:
    """The vote on a whole log: (sub, sup, for, against)."""
    last = log.where("ord is not null").groupBy("source", "sub", "sup").agg(F.max_by(F.coalesce("stated", F.lit(False)), F.struct("ord")).alias("stated"))
    return votes.witnesses(last.where("stated"))


def keep(log: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Takes the vote on a streamed log: each batch writes the voices it has heard below path, by epoch; a batch that is repeated
    after a failure replaces what it wrote before."""

    def write(changed: DataFrame, epoch: int) -> None:
        changed.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(f"{path}/{epoch:09d}")

    changed = sides(log).groupBy(*VOICE).agg(F.max_by("stated", "ord").alias("stated"))
    return changed.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str) -> DataFrame:
    """The vote as it is now: (sub, sup, for, against)."""
    told = spark.read.schema(VOICES).parquet(f"{path}/*")
    held = told.groupBy(*VOICE).agg(F.max_by("stated", "epoch").alias("stated")).where("stated")
    side = lambda down, name: F.array_sort(F.collect_set(F.when(F.col("down") == down, F.col("source")))).alias(name)
    return votes.both_ways(held.groupBy("low", "high").agg(side(False, "up"), side(True, "down")))
