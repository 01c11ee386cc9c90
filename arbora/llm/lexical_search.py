"""Ranked lexical search as a blocked product of sparse matrices.

Items are the rows of one matrix (item x term, how often the item has the term), documents the columns of another (term x
document, int64 impacts).  Documents are read once: a task hashes all of a text's terms and keeps, of those that some item
has, (term, occurrences) with the text's length.  Counts over all documents give each term's weight and each document's
impacts.  The product is made by blocks of DOCS documents: for each item the rows of its terms are merged into a dense int64
accumulator (Gustavson's way), the block's ten highest stay, and blocks' best are merged, in a task and then across tasks.

Items are taken in blocks as well, of at most TERMS terms with repeats, so that what a task holds of them is bounded (one item
is never cut); each block of items is a pass over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arbora.llm.common import slices, text_of, trim, written
from arbora.llm.hashing import Words, lowered

#: Fixed values of the score.
SCALE, LENGTH_SHARE, HUNDRED, SMOOTH, TOP = 1_000_000_000, 75, 100, 8, 10
TERMS = 1 << 22
DOCS = 8192
#: What parts terms: all of ASCII but digits and letters.
PARTS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
COUNTED = "doc_id {kind}, n long, terms binary, counts binary"


class Items:
    """A block of items: the vocabulary as sorted hashes, and each item's distinct terms with their multiplicities."""

    def __init__(self, texts: list[str]):
        words = Words(PARTS)
        found = [np.unique(words(lowered(np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)))[0], return_counts=True) for t in texts]
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for h, _ in found)]))
        self.rows = [(np.searchsorted(self.vocabulary, h).astype(np.int32), n.astype(np.int64)) for h, n in found]

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vocabulary's terms among hashes, and how often each is there."""
        if not len(self.vocabulary):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        terms, counts = np.unique(at[self.vocabulary[at] == hashes], return_counts=True)
        return terms.astype(np.int32), counts.astype(np.int64)


def _counted(items: Items):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(PARTS)
        for b in slices(batches):
            n, terms, counts = [], [], []
            for text in b.column("text"):
                hashes, _ = words(lowered(np.frombuffer(text.as_buffer() or b"", np.uint8)))
                t, c = items.of(hashes)
                n.append(len(hashes))
                terms.append(t.tobytes())
                counts.append(c.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "n", "terms", "counts"])

    return count


def _frequencies(size: int):
    """How many of a task's documents hold each term: rows of (first term, counts of 4,096 terms)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in slices(batches):
            flat = [np.frombuffer(t.as_buffer(), np.int32) for t in b.column("terms")]
            df += np.bincount(np.concatenate([np.zeros(0, np.int32), *flat]), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some], pa.int64())], names=["term", "df"])

    return add


def weights(df: np.ndarray, n: int) -> np.ndarray:
    """A term's weight from the documents that hold it, of n."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def _best(scores: np.ndarray, order: np.ndarray, top: int) -> np.ndarray:
    """Places of the highest scores above 0, the highest first, ties by order."""
    some = np.flatnonzero(scores)
    if len(some) > top:
        least = np.partition(scores[some], len(some) - top)[len(some) - top]
        some = some[scores[some] >= least]
    return some[np.lexsort((order[some], -scores[some]))[:top]]


class Product:
    """Item rows against blocks of documents; what is best so far stays."""

    def __init__(self, items: Items, weight: np.ndarray, documents: int, length: int, top: int):
        self.items, self.weight, self.documents, self.length, self.top = items, weight, documents, length, top
        self.kept: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items.rows]
        #: Ids that are null, as which they rank: behind all others.
        self.last = np.iinfo(np.int64).max

    def add(self, ids: np.ndarray, n: np.ndarray, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> None:
        """A block: documents' ids, lengths, ends of their entries, and the entries by document."""
        m = HUNDRED - LENGTH_SHARE + LENGTH_SHARE * n * self.documents // max(self.length, 1)
        doc = np.repeat(np.arange(len(ids)), np.diff(np.concatenate([[0], ends])))
        impact = self.weight[terms] * (SCALE * counts // (1000 * counts + SMOOTH * m[doc]))
        by_term = np.argsort(terms, kind="stable")
        doc, impact = doc[by_term], impact[by_term]
        starts = np.searchsorted(terms[by_term], np.arange(len(self.weight) + 1))
        scores = np.zeros(len(ids), np.int64)
        for i, (row, times) in enumerate(self.items.rows):
            scores[:] = 0
            for term, k in zip(row, times, strict=True):
                part = slice(starts[term], starts[term + 1])
                scores[doc[part]] += k * impact[part]
            best = _best(scores, ids, self.top)
            if len(best):
                s, d = np.concatenate([self.kept[i][0], scores[best]]), np.concatenate([self.kept[i][1], ids[best]])
                stay = np.lexsort((d, -s))[: self.top]
                self.kept[i] = s[stay], d[stay]


def _multiplied(items: Items, weight: np.ndarray, documents: int, length: int, top: int):
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = Product(items, weight, documents, length, top)
        for b in slices(batches, DOCS):
            if len(b) == 0:
                continue
            ids = b.column("doc_id").cast(pa.int64()).fill_null(product.last).to_numpy(zero_copy_only=False)
            terms = [np.frombuffer(x.as_buffer(), np.int32) for x in b.column("terms")]
            counts = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column("counts")]
            product.add(ids, b.column("n").to_numpy(zero_copy_only=False), np.cumsum([len(t) for t in terms]), np.concatenate(terms), np.concatenate(counts))
        item = np.concatenate([np.zeros(0, np.int64), *(np.full(len(s), i) for i, (s, _) in enumerate(product.kept))])
        scores = np.concatenate([np.zeros(0, np.int64), *(s for s, _ in product.kept)])
        ids = np.concatenate([np.zeros(0, np.int64), *(d for _, d in product.kept)])
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(ids, pa.int64(), mask=ids == product.last), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])
        trim()

    return multiply


def blocks(items: DataFrame, terms: int = TERMS) -> Iterator[list[tuple[object, str]]]:
    """Items in blocks of at most so many bytes of text over four (a term and what parts it takes two bytes at least)."""
    rows = items.select("item_id", text_of().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    if total <= 2 * terms:
        yield [tuple(r) for r in rows.collect()]
        return
    parts = -(-2 * total // terms)
    dealt = written(rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("int")), "items")
    for block in range(parts):
        now, size = [], 0
        for r in dealt.where(F.col("block") == block).select("item_id", "text").toLocalIterator():
            more = len(r["text"].encode("utf-8", "surrogatepass"))
            if now and size + more > 2 * terms:
                yield now
                now, size = [], 0
            now.append((r["item_id"], r["text"]))
            size += more
        if now:
            yield now


def search(docs: DataFrame, items: DataFrame, top: int = TOP, terms: int = TERMS) -> DataFrame:
    """Each item's `top` documents of the highest score above 0: (item_id, rank, doc_id, score).

    docs (doc_id, text), items (item_id, text).  Null and empty texts have no terms: such documents count in nothing and are
    never found, such items find nothing.  Long texts are read whole.  Equal scores rank by doc_id, null ids last; repeated
    rows of docs are documents of their own, repeated rows of items are ranked each by itself.  Ids are read as long, null
    ids of items stay null.  Empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    out = None
    for block in blocks(items, terms):
        now = _searched(docs, block, top)
        out = now if out is None else out.union(now)
    kind = dict(items.dtypes)["item_id"]
    return out.select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score") if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


def _searched(docs: DataFrame, block: list[tuple[object, str]], top: int) -> DataFrame:
    spark = docs.sparkSession
    items = Items([t for _, t in block])
    counted = written(docs.mapInArrow(_counted(items), COUNTED.format(kind="long")), "terms")
    whole = counted.where("n > 0").agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    df = np.zeros(len(items.vocabulary), np.int64)
    # As many rows as the block's vocabulary has terms, at most.
    for r in counted.select("terms").mapInArrow(_frequencies(len(df)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r["term"]] = r["df"]
    best = counted.where("n > 0").mapInArrow(_multiplied(items, weights(df, whole["n"]), whole["n"], whole["length"], top), "item long, doc_id long, score long")
    # The tasks' best meet in two steps, so that no task reads all tasks' rows of an item.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    best = best.withColumn("part", F.spark_partition_id() % 64)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    named = spark.createDataFrame([(i, None if k is None else str(k)) for i, (k, _) in enumerate(block)], "item long, item_id string")
    return best.join(F.broadcast(named), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
