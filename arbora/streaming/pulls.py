"""Pulls from a remote source that go on where they stopped.

The ids are dealt to chunk files once; a stream reads some of these in each batch, asks for them, and appends the answers.
The stream's checkpoint holds which files are answered, so that after a failure, of a task or of the whole application, only
the batch that was under way is asked again, and no answer is stored twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arbora.sources import readers

CHUNKS = "chunk long, values array<string>"


def deal(ids: DataFrame, column: str, size: int, path: str, files: int) -> None:
    """Writes chunks of at most `size` ids into about so many files; ids are distinct and not null."""
    chunks = readers.chunked(ids.select(F.col(column).cast("string").alias("id")).where("id is not null").distinct(), "id", size)
    chunks.select("chunk", "values").repartition(files, "chunk").write.parquet(path)


def pull(spark: SparkSession, chunks: str, ask: Callable[[list], list[tuple]], schema: str, answers: str, checkpoint: str, files_at_once: int = 8, tries: int = 4, pause: float = 1.0) -> StreamingQuery:
    """Asks for all chunks that aren't answered yet, and ends.  ask(values) -> rows of the schema; it runs on the workers, and is
    tried again as readers.pulled() says.  Started again, with the same folders, it goes on."""
    stream = spark.readStream.schema(CHUNKS).option("maxFilesPerTrigger", files_at_once).parquet(chunks)
    told = readers.pulled(stream, ask, schema, tries, pause)
    return told.writeStream.format("parquet").option("path", answers).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
