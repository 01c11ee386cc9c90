"""Removal of all bytes that a string of LENGTH bytes covers which also starts earlier, across all documents.

Documents are ordered by id; a byte's place is its number in that order.  A window is a string of LENGTH bytes within a
document.

1. Each window has an anchor: of its GRAM-byte strings the one of the least hash, the leftmost of equal ones.  Windows that
   follow each other with one anchor make a stretch.  Equal windows have equal anchors at the same offset, so that only
   stretches that share an anchor's bytes need to be compared.
2. Of stretches that are equal as a whole, all but the earliest are repeats.  Stretches are told apart by a hash, the shuffle
   carries no text.
3. Anchors of which there are different stretches are contested.  Their earliest stretches are cut in two, by whether a window
   begins at least half of what it has besides the anchor before it; each half then shares a core of LENGTH - REACH bytes,
   and is dealt by the core.
4. A task sorts the suffixes that begin REACH places before a core or less by external induced sorting (induced_sorting.py),
   with common prefixes.  Windows are equal where REACH bytes around their core are; all but the earliest are repeats.
5. What is found goes back to the blocks of documents, a few bytes for each stretch.

Blocks of texts are written once, bucketed, so that the three joins that bring something back to them shuffle no text.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.common import text_of, trim, written
from arbora.llm.hashing import ODD, Words, mixed_bits
from arbora.llm.induced_sorting import Scratch, Spool, Strings
from arbora.session import scratch_dir

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1
#: Bytes that a window has besides its core.
REACH = SPAN // 2
BLOCK, PIECE = 4 << 20, 1 << 20
MESSAGES = 1 << 18
PARTS = 1 << 17
PLACE = np.uint64((1 << 31) - 1)


# Blocks


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's documents as rows of at most BLOCK bytes of text, or one document."""
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), 0
    ids: list = []
    hashes: list = []
    texts: list[bytes] = []
    size = 0

    def made() -> pa.RecordBatch:
        nonlocal number, size
        block = part << 32 | number
        number += 1
        out = {"block": block, "ids": list(ids), "hashes": list(hashes), "sizes": [len(t) for t in texts], "data": b"".join(texts)}
        ids.clear(), hashes.clear(), texts.clear()
        size = 0
        return pa.RecordBatch.from_pylist([out], schema=pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("data", pa.binary())]))

    for b in batches:
        for i, h, text in zip(b.column("doc_id"), b.column("h"), b.column("text"), strict=True):
            t = bytes(text.as_buffer() or b"")
            if texts and size + len(t) > BLOCK:
                yield made()
            ids.append(i.as_py())
            hashes.append(h.as_py())
            texts.append(t)
            size += len(t)
    if texts:
        yield made()
    trim()


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """Writes blocks to the shared folder so that joins by block needn't shuffle them."""
    spark, name = rows.sparkSession, f"blocks_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, "block").option("path", f"{scratch_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def _places(blocks: DataFrame, parts: int) -> DataFrame:
    """(block, bases): the place of the first byte of each of its documents, in the order of ids.

    Null ids come last, rows of one id by their text's hash; only equal rows are ordered by where they stand.
    """
    rows = blocks.select("block", F.arrays_zip("ids", "hashes", "sizes").alias("d")).select("block", F.posexplode("d").alias("i", "d"))
    rows = rows.select("block", "i", F.col("d.ids").isNull().alias("last"), F.col("d.ids").alias("doc_id"), F.col("d.hashes").alias("h"), F.col("d.sizes").cast("long").alias("size"))
    order = ["last", "doc_id", "h", "block", "i"]
    rows = written(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("block", "i", "size").mapInArrow(_summed, "block long, i int, base long, part int, size long"), "places")
    # One row for each partition.
    sums = rows.groupBy("part").agg(F.sum("size").alias("n")).orderBy("part").collect()
    before, at = {}, 0
    for r in sums:
        before[r["part"]] = at
        at += r["n"]
    starts = blocks.sparkSession.createDataFrame(list(before.items()), "part int, start long")
    rows = rows.join(F.broadcast(starts), "part").select("block", F.struct("i", (F.col("base") + F.col("start")).alias("base")).alias("d"))
    return rows.groupBy("block").agg(F.array_sort(F.collect_list("d")).alias("d")).select("block", F.col("d.base").alias("bases"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        size = b.column("size").to_numpy()
        ends = at + np.cumsum(size)
        at = int(ends[-1]) if len(ends) else at
        yield pa.RecordBatch.from_arrays([b.column("block"), b.column("i"), pa.array(ends - size), pa.array(np.full(len(size), part, np.int32)), b.column("size")], names=["block", "i", "base", "part", "size"])


# Stretches


class Cut:
    """The stretches of the documents in `data`, which end at `ends`: first and last window, anchor, hashes of anchor and whole."""

    words = Words()

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data, n = data, len(data)
        if n < LENGTH:
            self.first = self.last = self.anchor = np.zeros(0, np.int64)
            self.key = self.whole = np.zeros(0, np.uint64)
            return
        self.words.grow(n + 1)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), ((data.astype(np.uint64) + np.uint64(1)) * self.words.powers[:n]).cumsum(dtype=np.uint64)])
            grams = mixed_bits((self.sums[GRAM:] - self.sums[:-GRAM]) * self.words.inverse[: n - GRAM + 1])
            # The least of each SPAN: that of the end of one run of SPAN grams and the beginning of the next.
            ranked = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
            ranked = np.concatenate([ranked, np.full(-len(ranked) % SPAN, np.iinfo(np.uint64).max)]).reshape(-1, SPAN)
            ahead = np.minimum.accumulate(ranked, axis=1).ravel()
            behind = np.minimum.accumulate(ranked[:, ::-1], axis=1)[:, ::-1].ravel()
            windows = n - LENGTH + 1
            anchor = (np.minimum(behind[:windows], ahead[SPAN - 1 : SPAN - 1 + windows]) & PLACE).astype(np.int64)
            del ranked, ahead, behind
            # Windows that end beyond their document are none.
            cover = np.zeros(n + 1, np.int32)
            starts = np.concatenate([[0], ends[:-1]])
            np.add.at(cover, np.maximum(ends - LENGTH + 1, starts), 1)
            np.add.at(cover, ends, -1)
            valid = cover.cumsum()[:windows] == 0
            begins = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | ~valid[:-1]]) & valid
            self.first = np.flatnonzero(begins)
            self.last = np.flatnonzero(np.concatenate([(anchor[1:] != anchor[:-1]) | ~valid[1:], [True]]) & valid)
            self.anchor = anchor[self.first]
            self.key = grams[self.anchor]
            self.whole = self.hashed(self.first, self.last + LENGTH)

    def hashed(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the bytes from start to end."""
        with np.errstate(over="ignore"):
            return mixed_bits((self.sums[end] - self.sums[start]) * self.words.inverse[start] + (end - start).astype(np.uint64) * ODD)

    def halves(self, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The two halves of some stretches: (first window, where the core starts, end), where a half has windows."""
        first, last, anchor = self.first[of], self.last[of], self.anchor[of]
        ahead = np.flatnonzero(first <= anchor - REACH)
        yield first[ahead], anchor[ahead] - REACH, np.minimum(last[ahead], anchor[ahead] - REACH) + LENGTH
        first = np.maximum(first, anchor - REACH + 1)
        behind = np.flatnonzero(first <= last)
        yield first[behind], anchor[behind], last[behind] + LENGTH


def _pieces(row: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """A block's documents, some at a time: (the first one's number, their bytes, where each ends, its place less where it starts)."""
    data, sizes = np.frombuffer(row["data"], np.uint8), np.array(row["sizes"], np.int64)
    bases = np.array(row["bases"], np.int64)
    ends = np.cumsum(sizes)
    i = at = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(ends, at + PIECE, side="right")))
        inner = ends[i:j] - at
        yield i, data[at : int(ends[j - 1])], inner, bases[i:j] - (inner - sizes[i:j])
        i, at = j, int(ends[j - 1])


def _shift(inner: np.ndarray, shifts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What is added to a number of a byte in a piece to give its place."""
    return shifts[np.searchsorted(inner, at, side="right")]


MESSAGE = "key long, whole long, place long, block long"


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All stretches of a task, those that are equal in MESSAGES of them as one, the earliest."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def sent() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        key, whole, place, block = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((place, whole, key))
        key, whole = key[order], whole[order]
        first = np.concatenate([[True], (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])])[: len(key)]
        order = order[first]
        for i in range(0, len(order), 1 << 16):
            part = order[i : i + (1 << 16)]
            arrays = [key[first][i : i + (1 << 16)].view(np.int64), whole[first][i : i + (1 << 16)].view(np.int64), place[part], block[part]]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["key", "whole", "place", "block"])

    for row in _rows(batches):
        for _, data, inner, shifts in _pieces(row):
            cut = Cut(data, inner)
            held.append((cut.key, cut.whole, cut.first + _shift(inner, shifts, cut.first), np.full(len(cut.key), row["block"], np.int64)))
            size += len(cut.key)
            if size >= MESSAGES:
                yield from sent()
                size = 0
    yield from sent()
    trim()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, without copying their binaries into Python first."""
    for b in batches:
        for i in range(len(b)):
            yield {n: (b.column(n)[i].as_buffer() or b"") if pa.types.is_binary(b.schema.field(n).type) else b.column(n)[i].as_py() for n in b.schema.names}


def _by_block(block: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(block, values as bytes, sorted)."""
    if not len(block):
        return
    order = np.lexsort((values, block))
    block, values = block[order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    packed = [values[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(block)], strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(block[starts]), pa.array(packed, pa.binary())], names=["block", "found"])


def _earliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by anchor, whole and place -> for each block the places of stretches that are the earliest of their
    equals, times two, and one more where the anchor has others.  Of an anchor one stretch is held back at a time."""
    held: tuple | None = None  # the latest earliest stretch: key, whole, place, block, whether its anchor has had others
    blocks: list[np.ndarray] = []
    values: list[np.ndarray] = []
    size = 0
    for b in batches:
        if not len(b):
            continue
        key, whole, place, block = (b.column(n).to_numpy() for n in ("key", "whole", "place", "block"))
        if held is not None:
            key, whole, place, block = (np.concatenate([[h], x]) for h, x in zip(held[:4], (key, whole, place, block), strict=True))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])])
        key, place, block, last = key[new], place[new], block[new], whole[-1]
        same = np.concatenate([[held is not None and held[4]], key[1:] == key[:-1]])
        others = same | np.concatenate([same[1:], [False]])
        blocks.append(block[:-1])
        values.append(place[:-1] * 2 + others[:-1])
        size += len(block)
        held = key[-1], last, place[-1], block[-1], bool(same[-1])
        if size >= MESSAGES:
            yield from _by_block(np.concatenate(blocks), np.concatenate(values))
            blocks, values, size = [], [], 0
    if held is not None:
        blocks.append(np.array([held[3]]))
        values.append(np.array([held[2] * 2 + held[4]]))
    if blocks:
        yield from _by_block(np.concatenate(blocks), np.concatenate(values))
    trim()


HALF = "block long, spans binary, core long, ahead binary, behind binary, place long"


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block its repeats (spans: first place and number of windows), and the halves of its contested stretches."""
    schema = pa.schema([("block", pa.int64()), ("spans", pa.binary()), ("core", pa.int64()), ("ahead", pa.binary()), ("behind", pa.binary()), ("place", pa.int64())])
    for row in _rows(batches):
        known = np.sort(np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in row["found"] or ())]))
        spans = []
        for _, data, inner, shifts in _pieces(row):
            cut = Cut(data, inner)
            if not len(cut.first):
                continue
            place = cut.first + _shift(inner, shifts, cut.first)
            at = np.searchsorted(known, place * 2)
            found = known[np.minimum(at, len(known) - 1)] if len(known) else np.full(len(place), -1)
            earliest = found >> 1 == place
            spans.append(np.stack([place, cut.last - cut.first + 1], axis=1)[~earliest])
            for start, core, end in cut.halves(np.flatnonzero(earliest & (found & 1 == 1))):
                hashes = cut.hashed(core, core + LENGTH - REACH).view(np.int64)
                places = start + _shift(inner, shifts, start)
                raw = data.tobytes()
                # The nearest byte first, on both sides.
                ahead = [raw[a:b][::-1] for a, b in zip(start.tolist(), core.tolist(), strict=True)]
                behind = [raw[a:b] for a, b in zip((core + LENGTH - REACH).tolist(), end.tolist(), strict=True)]
                for i in range(0, len(start), 1 << 15):
                    part = slice(i, i + (1 << 15))
                    n = len(places[part])
                    arrays = [pa.array(np.full(n, row["block"])), pa.nulls(n, pa.binary()), pa.array(hashes[part]), pa.array(ahead[part], pa.binary()), pa.array(behind[part], pa.binary()), pa.array(places[part])]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        repeats = np.concatenate([np.zeros((0, 2), np.int64), *spans])
        yield pa.RecordBatch.from_pylist([{"block": row["block"], "spans": repeats.tobytes()}], schema=schema)
    trim()


# Sorting


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Binaries as rows of a matrix, and their lengths."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    n = np.diff(offsets)
    flat = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    out = np.zeros((len(column), width), np.uint8)
    row = np.repeat(np.arange(len(column)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    out[row, at] = flat[offsets[0] : offsets[-1]]
    return out, n


def _repeats(order: np.ndarray, common: np.ndarray, places: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Of suffixes in order, those that are windows and equal to one of a smaller place."""
    if not len(order):
        return order
    group = np.cumsum(common < REACH)
    order, group = order[windows], group[windows]
    by = np.lexsort((places[order], group))
    later = np.concatenate([[False], group[by][1:] == group[by][:-1]])[: len(by)]
    return order[by[later]]


def _small(columns: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    """Whole groups in memory."""
    core = columns[0]
    first = np.concatenate([[True], core[1:] != core[:-1]])
    alone = first & np.concatenate([first[1:], [True]])
    core, ahead, n_ahead, behind, n_behind, place, block = (x[~alone] for x in columns)
    if not len(core):
        return
    strings = Strings(np.cumsum(np.concatenate([[0], core[1:] != core[:-1]])), ahead, n_ahead, behind, n_behind)
    blocks, found = [], []
    for at, order, common in strings.orders():
        start = place + n_ahead - at
        repeats = _repeats(order, common, start, n_behind[order] + at >= REACH)
        found.append(start[repeats])
        blocks.append(block[repeats])
    yield from _by_block(np.concatenate(blocks), np.concatenate(found))


def _large(group: Spool, n: int, scratch: Scratch) -> Iterator[pa.RecordBatch]:
    """One group of n halves, by way of the disk."""
    columns: list[np.ndarray] = []
    at = 0
    for chunk in group.read():
        if not columns:
            columns = [np.memmap(scratch.path(), x.dtype, "w+", shape=(n, *x.shape[1:])) for x in chunk]
        for whole, x in zip(columns, chunk, strict=True):
            whole[at : at + len(x)] = x
        at += len(chunk[0])
    _, ahead, n_ahead, behind, n_behind, place, block = columns
    strings = Strings(np.zeros(n, np.int8), ahead, n_ahead, behind, n_behind)
    for at, chunks in strings.orders_on_disk(scratch):
        best: tuple[int, int] | None = None  # the earliest window of a run of equal ones that may go on
        for order, common in chunks:
            run = np.cumsum(common < REACH)
            windows = n_behind[order] + at >= REACH
            some, last = order[windows], run[-1]
            start, blocks, run = place[some] + n_ahead[some] - at, block[some], run[windows]
            if best is not None:
                start, blocks, run = np.insert(start, 0, best[0]), np.insert(blocks, 0, best[1]), np.insert(run, 0, 0)
            by = np.lexsort((start, run))
            later = np.concatenate([[False], run[by][1:] == run[by][:-1]])[: len(by)]
            yield from _by_block(blocks[by[later]], start[by[later]])
            ends = by[(run[by] == last) & ~later]
            best = (int(start[ends[0]]), int(blocks[ends[0]])) if len(ends) else None


def _sorted(memory: int, rows: int):
    """Halves sorted by core -> for each block the windows that are repeats.  Groups go together up to `rows` halves; one that is larger
    goes by way of the disk."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: list[tuple[np.ndarray, ...]] = []
        size = n = 0
        core = None
        with Scratch(memory) as scratch:
            group = Spool(scratch, memory)

            def small() -> Iterator[pa.RecordBatch]:
                columns = tuple(np.concatenate(x) for x in zip(*whole, strict=True))
                whole.clear()
                yield from _small(columns)

            def closed() -> Iterator[pa.RecordBatch]:
                """The group is over."""
                nonlocal size, n
                if n > rows:
                    yield from _large(group, n, scratch)
                elif n:
                    whole.extend(group.read())
                    size += n
                n = 0
                if size > rows:
                    yield from small()
                    size = 0

            for b in batches:
                if not len(b):
                    continue
                (ahead, n_ahead), (behind, n_behind) = _matrix(b.column("ahead"), REACH), _matrix(b.column("behind"), REACH)
                columns = (b.column("core").to_numpy(), ahead, n_ahead, behind, n_behind, b.column("place").to_numpy(), b.column("block").to_numpy())
                cuts = np.flatnonzero(columns[0][1:] != columns[0][:-1]) + 1
                # The first group may have begun before, the last may go on; those between are whole.
                a, z = (int(cuts[0]), int(cuts[-1])) if len(cuts) else (len(b), len(b))
                if core is not None and columns[0][0] != core:
                    yield from closed()
                group.add(*(x[:a] for x in columns))
                n += a
                if a < len(b):
                    yield from closed()
                    if a < z:
                        whole.append(tuple(x[a:z] for x in columns))
                        size += z - a
                    group.add(*(x[z:] for x in columns))
                    n += len(b) - z
                core = columns[0][-1]
            yield from closed()
            if whole:
                yield from small()
        trim()

    return sort


# Results


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each document what is removed, and the digest of what is left."""
    for row in _rows(batches):
        out = []
        spans = np.concatenate([np.zeros((0, 2), np.int64), *(np.frombuffer(x, np.int64).reshape(-1, 2) for x in row["spans"] or ())])
        marks = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in row["marks"] or ())])
        begins = np.concatenate([spans[:, 0], marks])
        ends = np.concatenate([spans[:, 0] + spans[:, 1], marks + 1]) + LENGTH - 1
        order = np.argsort(begins, kind="stable")
        begins, ends = begins[order], ends[order]
        for i, data, inner, shifts in _pieces(row):
            starts = np.concatenate([[0], inner[:-1]])
            cover = np.zeros(len(data) + 1, np.int32)
            for d in range(len(inner)):
                # Spans don't leave their document.
                base = int(shifts[d])
                a, z = np.searchsorted(begins, [base + int(starts[d]), base + int(inner[d])])
                np.add.at(cover, begins[a:z] - base, 1)
                np.add.at(cover, ends[a:z] - base, -1)
            gone = cover.cumsum()[:-1] > 0
            for d, (a, z) in enumerate(zip(starts.tolist(), inner.tolist(), strict=True)):
                g = gone[a:z]
                n = int(g.sum())
                runs = int((g[1:] & ~g[:-1]).sum() + g[0]) if n else 0
                out.append((row["ids"][i + d], z - a, n, runs, hashlib.sha256(data[a:z][~g].tobytes() if n else data[a:z]).hexdigest()))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.string() if k == 4 else pa.int64()) for k in range(5)], names=names)
    trim()


def dedup(docs: DataFrame, memory: int = 64 << 20, rows: int = PARTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row of docs (doc_id: long, text).

    Null and empty texts have no bytes; texts under LENGTH bytes stay whole.  Long texts are read whole.  Earlier is the
    smaller doc_id, null ids last; rows of one id are ordered by their text's hash, so that of equal rows one comes first and
    the others lose all.  No documents give none; other columns are ignored.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("h", F.xxhash64("text"))
    made = texts.mapInArrow(_blocks, "block long, ids array<long>, hashes array<long>, sizes array<int>, data binary")
    blocks = _bucketed(made, max(parts, docs.rdd.getNumPartitions()))
    bases = written(_places(blocks.select("block", "ids", "hashes", "sizes"), parts), "bases")

    def beside(light: DataFrame) -> DataFrame:
        """What belongs to a block, brought to its texts: the light side is what is shuffled and hashed."""
        return blocks.join(light.hint("shuffle_hash"), "block", "left")

    stretches = beside(bases).select("block", "sizes", "data", "bases").mapInArrow(_messages, MESSAGE)
    stretches = stretches.repartition(parts, "key").sortWithinPartitions("key", "whole", "place")
    found = _gathered(stretches.mapInArrow(_earliest, "block long, found binary"), "found")
    halves = written(beside(bases.join(found, "block", "left")).select("block", "sizes", "data", "bases", "found").mapInArrow(_halves, HALF), "halves")
    cores = halves.where("spans is null").select("core", "ahead", "behind", "place", "block").repartition(parts, "core").sortWithinPartitions("core")
    marks = _gathered(cores.mapInArrow(_sorted(memory, rows), "block long, found binary"), "marks")
    spans = halves.where("spans is not null").groupBy("block").agg(F.collect_list("spans").alias("spans"))
    light = bases.join(spans, "block", "left").join(marks, "block", "left")
    return beside(light).select("ids", "sizes", "data", "bases", "spans", "marks").mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _gathered(found: DataFrame, name: str) -> DataFrame:
    """What is found for a block: as many bytes as there are stretches in the block, eight each at most."""
    return found.groupBy("block").agg(F.collect_list("found").alias(name))
