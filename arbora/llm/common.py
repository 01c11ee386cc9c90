"""What the training-data operators share: scratch tables, text columns, and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.session import dropped, written

__all__ = ["components", "dropped", "forest", "grouped", "met", "remainder_of_five", "salt", "slices", "table", "text_of", "written"]
SALT = "_salt"


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A task's batches in small parts, so that few rows are Python objects at a time; then freed memory goes back."""
    for b in batches:
        for i in range(0, len(b), rows):
            yield b.slice(i, rows)
    trim()


def trim() -> None:
    """A reused worker keeps what it has freed, unless told otherwise (where the C library can)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column = "text") -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def remainder_of_five(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, mod 5: the rule by which rows are held out."""
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")) % 5


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of n nodes reaches by edges (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (root[a], root[b], a, b):
            np.minimum.at(new, end, low)
        while True:
            shorter = new[new]
            if (shorter == new).all():
                break
            new = shorter
        if (new == root).all():
            break
        root = new
    return root


def salt(spark: SparkSession, by: str | Column) -> Column:
    """A number for a row by a hash of what tells rows of one key apart: as many as there are shuffle partitions, so that a
    key that holds a third of all rows is dealt to all tasks."""
    return F.pmod(F.xxhash64(by), F.lit(max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))).cast("int").alias(SALT)


def grouped(rows: DataFrame, keys: list[str], parts: list[Column], whole: list[Column], having: str = "true") -> DataFrame:
    """Aggregates of rows (with _salt) by keys, with a row for each salt that a key has: (keys, _salt, whole).

    `parts` are aggregates by key and salt, `whole` aggregates of these by key, of which those stay that `having` holds for.  What is joined with it by keys and _salt
    meets the key's aggregate without all of the key's rows in one task.
    """
    some = rows.groupBy(*keys, SALT).agg(*parts)
    every = some.groupBy(*keys).agg(*whole, F.collect_list(SALT).alias("_salts")).where(having)
    return every.withColumn(SALT, F.explode("_salts")).drop("_salts")


def met(left: DataFrame, right: DataFrame, on: list[str] | str, how: str = "inner") -> DataFrame:
    """Joined by sorting both: what happens to be small isn't sent to the driver and on to all tasks, as each such table costs
    the driver a thread and memory besides its rows, and loops make many."""
    return left.join(right.hint("merge"), on, how)


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b: long): rows (id, component), component the smallest id reachable.

    Each round, every edge (u, v) is hung on the smallest neighbour of its larger end and of its smaller end (the
    large-star and small-star steps), which shortens paths by a constant factor, so rounds grow as the log of the
    longest path.  Every step is a shuffle of edges with partial minima, salted, since the middle of a star may have a third
    of all edges; no group is gathered.  Ids that are in no link have no row.  Links of an id with itself give it a row of
    its own.  Links with a null end are none, repeated ones are one, and no links give no rows.
    """
    spark = links.sparkSession
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    given = written(links.where("a is not null and b is not null").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    edges = given.where("u != v")

    def with_least(rows: DataFrame) -> DataFrame:
        """Adds m, the smallest v of each u."""
        rows = rows.withColumn(SALT, salt(spark, "v"))
        return met(rows, grouped(rows, ["u"], [F.min("v").alias("m")], [F.min("m").alias("m")]), ["u", SALT]).drop(SALT)

    def stars() -> bool:
        """Each u hangs on one v, which hangs on none."""
        ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
        return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()

    while not stars():
        # Large star: every larger neighbour of u hangs on the smallest of u and its neighbours.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least(both).withColumn("m", F.least("u", "m")).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large, "large")
        # Small star: u and its smaller neighbours hang on the smallest of them.
        joined = with_least(large)
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.where("v = m").select("u", "v")).distinct()
        before, edges = edges, written(small, "small")
        dropped(large, *([] if before.inputFiles() == given.inputFiles() else [before]))
    own = given.select(F.col("u").alias("id"), F.col("u").alias("component")).union(given.select("v", "v")).union(edges.select("u", "v"))
    out = written(own.groupBy("id").agg(F.min("component").alias("component")), "components")
    dropped(*([given] if edges.inputFiles() == given.inputFiles() else [given, edges]))
    return out
