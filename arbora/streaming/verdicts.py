"""Verdicts and rulings as streams: an append-only log that goes on while the vote is taken.

An extension of the batch operators, not a change of them: what a stream ends with is what the batch gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arbora.operators import votes


def log(spark: SparkSession, path: str, schema: str, most_files: int = 100) -> DataFrame:
    """A folder that rows are appended to."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(path)


def latest(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The last value of each key so far: a running aggregation, whatever order rows arrive in."""
    return rows.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def windowed_counts(rows: DataFrame, time: str, keys: list[str], length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    return rows.withWatermark(time, late).groupBy(F.window(time, length).alias("window"), *keys).agg(F.count("*").alias("n"))


def once_each(rows: DataFrame, time: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Rows whose keys weren't seen within the watermark."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def revote(stream: DataFrame, stated: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """With each batch of reviews (sub, sup, ...), the pairs that it touches are voted on anew, from all that is stated."""

    def batch(rows: DataFrame, epoch: int) -> None:
        touched = rows.select("sub", "sup").union(rows.select("sup", "sub")).distinct()
        write(votes.witnesses(stated().join(touched, ["sub", "sup"], "left_semi")), epoch)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
