"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph is a line.  Each is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs'
vectors modulo powers of two, so it doesn't depend on their order, and a paragraph is inserted or deleted by adding or
subtracting its vector.  A vector has two parts:

* EXACT lanes modulo 2^64, from a cryptographic hash of the whole line.  They tell multisets of paragraphs apart.
* NEAR lanes modulo 2^16, to which each pair of words that follow each other in the line (its first word has none before
  it) adds +1 or -1 in one lane of its own.  The cosine of two documents' NEAR lanes, read as signed numbers, estimates the
  cosine of their multisets of word pairs with a standard error of about 1 / sqrt(NEAR) = 0.06.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.llm.common import slices
from arbora.llm.hashing import ODD, Words, mixed_bits

EXACT, NEAR = 8, 256


class Fingerprint:
    """The sum for one document.  add() and remove() take a paragraph."""

    words = Words()

    def __init__(self, exact: np.ndarray | None = None, near: np.ndarray | None = None):
        self.exact = np.zeros(EXACT, np.uint64) if exact is None else exact
        self.near = np.zeros(NEAR, np.int64) if near is None else near

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        """All paragraphs of a text; an empty text has none."""
        out = cls()
        if text:
            data = text.encode("utf-8", "surrogatepass")
            for line in data.split(b"\n"):
                out.exact += cls._exact(line)
            out.near = cls._near(data)
        return out

    @staticmethod
    def _exact(line: bytes) -> np.ndarray:
        return np.frombuffer(hashlib.blake2b(line, digest_size=EXACT * 8).digest(), "<u8")

    @classmethod
    def _near(cls, data: bytes) -> np.ndarray:
        raw = np.frombuffer(data, np.uint8)
        h, start = cls.words(raw)
        if not len(h):
            return np.zeros(NEAR, np.int64)
        line = np.searchsorted(np.flatnonzero(raw == 10), start)
        before = np.concatenate([np.zeros(1, np.uint64), h[:-1]])
        before[np.concatenate([[True], line[1:] != line[:-1]])] = 0
        with np.errstate(over="ignore"):
            x = mixed_bits(before * ODD + h)
        return np.bincount((x >> np.uint64(1)).astype(np.int64) % NEAR, np.where(x & np.uint64(1), 1.0, -1.0), NEAR).astype(np.int64)

    def add(self, paragraph: str, times: int = 1) -> Fingerprint:
        data = paragraph.encode("utf-8", "surrogatepass")
        with np.errstate(over="ignore"):
            return Fingerprint(self.exact + self._exact(data) * np.uint64(times % (1 << 64)), self.near + times * self._near(data))

    def remove(self, paragraph: str) -> Fingerprint:
        return self.add(paragraph, -1)

    def hex(self) -> str:
        return (self.exact.astype("<u8").tobytes() + self.near.astype("<u2").tobytes()).hex()

    @classmethod
    def read(cls, told: str) -> Fingerprint:
        raw = bytes.fromhex(told)
        return cls(np.frombuffer(raw[: EXACT * 8], "<u8").copy(), np.frombuffer(raw[EXACT * 8 :], "<i2").astype(np.int64))

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints; else the NEAR lanes' cosine, from 0 on (0 if one of them is all zero)."""
        a, b = (x.near.astype("<u2").view("<i2").astype(float) for x in (self, other))
        if (self.exact == other.exact).all() and (a == b).all():
            return 1.0
        size = float(np.sqrt((a @ a) * (b @ b)))
        return min(1.0, max(0.0, float(a @ b) / size)) if size else 0.0


def range_of(value: Column, cuts: list[Column]) -> Column:
    """The number of cuts (sorted) at or below value, in two steps: which run of cuts, and where in it."""
    step = max(1, math.isqrt(len(cuts)))
    runs = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    if not runs:
        return F.lit(0)
    upto = lambda array: F.size(F.filter(array, lambda c: c <= value))
    run = upto(F.array(*[r[0] for r in runs]))
    inner = upto(F.element_at(F.array(*[F.array(*r) for r in runs]), run))
    return F.when(run == 0, 0).otherwise((run - 1) * step + inner)


def with_next(docs: DataFrame, rows_per_task: int = 20_000, most_parts: int = 1 << 16) -> DataFrame:
    """docs (doc_id, text) dealt by ranges of (id, hash of text), so that each range also has the row that follows it: rows (part,
    ahead, doc_id, text).

    Ends of ranges come from quantiles of the ids and, of an id (or null) that has more rows than a task, of its hashes.  The
    text is shuffled once; besides, the first row of each range goes to the range before it too (ahead: true), the first
    row of all to the last range.
    """
    place = lambda i, h: F.struct(i.isNotNull().alias("given"), F.coalesce(i, F.lit(0)).cast("long").alias("doc_id"), h.cast("long").alias("h"))
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_hash(docs).alias("h"))
    n = ids.count()
    parts = min(most_parts, max(1, -(-n // rows_per_task)))
    cuts: set[tuple] = set()
    if parts > 1:
        cuts = {(True, i, -(1 << 63)) for i in ids.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or []}
        # No more ids than parts have that many rows.
        often = [(r["doc_id"], r["count"]) for r in ids.groupBy("doc_id").count().where(F.col("count") > 2 * n // parts).collect()]
        for i, count in often:
            k = -(-count * parts // n)
            found = ids.where(F.col("doc_id").eqNullSafe(F.lit(i).cast("long"))).select(F.percentile_approx("h", [j / k for j in range(1, k)], 10 * k)).first()[0]
            cuts |= {(i is not None, i or 0, h) for h in found}
    at = range_of(place(F.col("doc_id"), F.col("h")), [place(F.lit(i if given else None).cast("long"), F.lit(h)) for given, i, h in sorted(cuts)])
    firsts = sorted((r["part"], r["k"]) for r in ids.groupBy(at.alias("part")).agg(F.min(place(F.col("doc_id"), F.col("h"))).alias("k")).collect())
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), text_hash(docs).alias("h")).withColumn("part", at)
    # A row for each range: most_parts at most.
    told = docs.sparkSession.createDataFrame([(part, k["given"], k["doc_id"], k["h"], firsts[i - 1][0]) for i, (part, k) in enumerate(firsts)], "p int, g boolean, d long, f long, back int")
    leads = (F.col("part") == F.col("p")) & (F.col("doc_id").isNotNull() == F.col("g")) & (F.coalesce("doc_id", F.lit(0)) == F.col("d")) & (F.col("h") == F.col("f"))
    rows = rows.join(F.broadcast(told), leads, "left").drop("p", "g", "d", "f")
    twice = F.when(F.col("back").isNull(), F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("ahead")))).otherwise(F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("ahead")), F.struct(F.col("back").alias("part"), F.lit(True).alias("ahead"))))
    rows = rows.select(F.explode(twice).alias("x"), "doc_id", "text", "h").select("x.part", "x.ahead", "doc_id", "text", "h")
    return rows.repartitionById(len(firsts) and max(p for p, _ in firsts) + 1 or 1, "part").sortWithinPartitions("part", "ahead", F.col("doc_id").asc_nulls_first(), "h").select("part", "ahead", "doc_id", "text")


def text_hash(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint: doc_id, n_chars, fingerprint; one pass, no shuffle.

    Null texts are empty, and an empty text's fingerprint is all zeros.  Rows repeat if the input's do.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([Fingerprint.of(t).hex() for t in texts], pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(task, "doc_id long, n_chars long, fingerprint string")


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints beside those of an edited text and of the next document, by ascending id, and their likeness.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document; after the last comes the first, and a single row follows itself.  Null ids come first; rows of one id
    stand in the order of a hash of their texts.  Null texts are empty.  No rows give no rows.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def judge(row: tuple, after: tuple) -> tuple:
            _, doc_id, text, mark = row
            half = len(text) // 2
            new = text[: len(text) - half] + after[2][:half]
            other = Fingerprint.of(new)
            return doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), mark.hex(), other.hex(), mark.likeness(other), mark.likeness(after[3])

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 7
            out.clear()
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in OUT.split(", ")])

        held = None
        for b in slices(batches):
            for part, ahead, doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                row = (part, doc_id, text or "", Fingerprint.of(text or ""))
                if held is not None and held[0] == part:
                    out.append(judge(held, row))
                held = None if ahead else row
                if len(out) >= 2000:
                    yield batch()
        yield batch()

    return with_next(docs).mapInArrow(task, OUT)
