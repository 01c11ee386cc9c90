"""Scoring by a weighted backoff automaton whose n-grams are counted over the whole corpus.

Smoothing: P(w | h) = (c(hw) + K * P(w | h')) / (c(h) + K), h' the context without its first word; at the end,
P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)).  It sums to one.  As an automaton: a context seen in training is a state; each
n-gram seen in training is an arc with its log-probability; every state has a failure arc to its shorter context, weighted
log10(K / (c(h) + K)).  What a text adds is what one reading from left to right with a carried state adds; a block's texts
are read at once, order by order, which gives the same arcs (Automaton.read() follows them one by one, for comparison).

How it runs: each task cuts its documents into blocks of some 300,000 words.  A block sends each distinct n-gram once,
with its training count here, to the bucket of the n-gram's hash.  A bucket sums them and answers a block only where the
corpus's count differs from the block's own.  So a block knows the exact counts of its own n-grams, builds the part of the
automaton that its documents can reach, and reads them.  Rows between tasks are packed arrays, so a frequent word costs
one number per block.  Nothing is capped or pruned.  The longest n-grams are counted in a pass of
their own, whose messages are sent when those of the shorter ones are gone from disk.  So texts are read three times; each block
carries a digest of its texts from each reading, so that a block that is cut otherwise another time is an error and never a wrong count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.common import remainder_of_five, slices
from arbora.llm.hashing import ODD, Words, lowered, mixed_bits
from arbora.session import tidied

#: Stand for the beginning of a text, which is only a context, and its end, which is a token.
BEGIN, END = np.uint64(1), np.uint64(2)
OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_words = Words()


def packed(sorted_ints: np.ndarray, counts: np.ndarray) -> bytes:
    """Differences of sorted numbers and their counts, byte by byte of all, compressed."""
    step = np.diff(sorted_ints.astype(np.uint64), prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    count = counts.astype("<u8").view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate([step, count], axis=1).T.tobytes())


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(16, -1).T
    step, count = (np.ascontiguousarray(x).view("<u8").ravel() for x in (planes[:, :8], planes[:, 8:]))
    return step.cumsum(dtype=np.uint64), count


class Block:
    """Documents as tokens, and the distinct n-grams of orders from `least` + 1 on with their training counts here."""

    def __init__(self, texts: list[bytes], train: np.ndarray, order: int, least: int = 0):
        data = lowered(np.frombuffer(b"\n".join(texts), np.uint8))
        h, start = _words(data)
        ends = np.cumsum([len(t) + 1 for t in texts])
        doc = np.searchsorted(ends, start, side="right")
        self.words = np.bincount(doc, minlength=len(texts))
        tokens = np.full(len(h) + 2 * len(texts), END, np.uint64)
        tokens[np.arange(len(h)) + 2 * doc + 1] = h
        self.first = np.concatenate([[0], np.cumsum(self.words + 2)])  # where each document's BEGIN stands
        tokens[self.first[:-1]] = BEGIN
        of = np.repeat(train, self.words + 2).astype(bool)
        depth = np.arange(len(tokens)) - np.repeat(self.first[:-1], self.words + 2)  # 0 at BEGIN
        keys = tokens
        self.where, self.keys, self.counts, self.at, self.ids = [], [], [], [], []
        for n in range(order):
            if n:
                with np.errstate(over="ignore"):
                    keys = np.concatenate([np.zeros(1, np.uint64), mixed_bits(keys[:-1] * ODD + tokens[1:])])
            if n < least:
                continue
            valid = np.flatnonzero(depth >= n)
            found, at, inverse = np.unique(keys[valid], return_index=True, return_inverse=True)
            ids = np.full(len(tokens), -1)
            ids[valid] = inverse
            self.keys.append(found)
            self.counts.append(np.bincount(inverse, of[valid], len(found)).astype(np.int64))
            self.at.append(valid[at])
            self.ids.append(ids)


class Automaton:
    """The states and arcs that a block's documents can reach, from the corpus's counts of the block's n-grams."""

    def __init__(self, block: Block, counts: list[np.ndarray], tokens: int, types: int, k: float):
        order = len(counts)
        sizes = [len(c) for c in counts]
        self.width = sizes[0]
        #: State 0 has no context; the others are n-grams of orders 1 to order - 1, in this numbering.
        self.base = base = np.concatenate([[1], 1 + np.cumsum(sizes)])
        ids = block.ids
        self.unigram = np.log10((counts[0] + 0.5) / (tokens + 0.5 * (types + 1)))
        chance = 10.0**self.unigram
        state_of = np.zeros(sizes[0], np.int64)
        self.fail, self.fail_weight = [np.zeros(1, np.int64)], [np.zeros(1)]
        keys, weights, following = [np.arange(sizes[0])], [self.unigram], []
        for n in range(order):
            at = block.at[n]
            if n:
                context = ids[n - 1][at - 1]
                seen = counts[n] > 0
                chance = (counts[n] + k * chance[ids[n - 1][at]]) / (counts[n - 1][context] + k)
                keys.append(((base[n - 1] + context) * self.width + ids[0][at])[seen])
                weights.append(np.log10(chance[seen]))
            shorter = state_of[ids[n - 1][at]] if n else np.zeros(sizes[0], np.int64)
            if n < order - 1:
                # An n-gram is a state if training has it, else what is read next goes on from its shorter context.
                self.fail.append(shorter)
                self.fail_weight.append(np.log10(k / (counts[n] + k)))
                state_of = np.where(counts[n] > 0, base[n] + np.arange(sizes[n]), shorter)
                following.append(state_of[seen] if n else state_of)
            else:
                following.append(shorter[seen] if n else shorter)
        self.block, self.seen = block, [np.append(c > 0, False) for c in counts]  # the last stands for no n-gram
        self.start = int(base[0] + ids[0][0]) if order > 1 and len(ids[0]) and self.seen[0][ids[0][0]] else 0
        self.keys, self.weights, self.following = keys, weights, following
        self.fail, self.fail_weight = np.concatenate(self.fail), np.concatenate(self.fail_weight)

    def read_all(self) -> np.ndarray:
        """The log-probability of each text of the block, all read from left to right at once.

        The state before a token is the longest context seen in training; what is added there is the weights of failure
        arcs from this state down to the longest whose arc has the token, and this arc's weight.
        """
        ids, first = self.block.ids, self.block.first
        at = np.delete(np.arange(first[-1]), first[:-1])
        total = np.zeros(len(at))
        open_ = np.ones(len(at), bool)
        for n in range(len(ids) - 1, -1, -1):
            gram = ids[n][at]
            have = gram >= 0
            # The state's failure arc is taken where the context of this order is a state but has no arc for the token.
            seen = have & self.seen[n][gram] if n else have
            take = np.flatnonzero(open_ & seen)
            place = np.cumsum(self.seen[n]) - 1 if n else np.arange(len(self.seen[0]))
            total[take] += self.weights[n][place[gram[take]]]
            open_[take] = False
            if n:
                context = ids[n - 1][at - 1]
                down = np.flatnonzero(open_ & (context >= 0) & self.seen[n - 1][context])
                total[down] += self.fail_weight[self.base[n - 1] + context[down]]
        return np.bincount(np.repeat(np.arange(len(self.block.words)), self.block.words + 1), total, len(self.block.words))

    def compile(self) -> None:
        """Tables for read()."""
        self.arcs = dict(zip(np.concatenate(self.keys).tolist(), range(sum(map(len, self.keys))), strict=True))
        self.lists = [np.concatenate(x).tolist() if isinstance(x, list) else x.tolist() for x in (self.weights, self.following, self.fail, self.fail_weight)]

    def read(self, words: list[int]) -> float:
        """The log-probability of one text, given as numbers of the block's words, arc by arc."""
        arc, (weights, following, fail, fail_weight), width = self.arcs.get, self.lists, self.width
        state, total = self.start, 0.0
        for w in words:
            a = arc(state * width + w)
            while a is None:
                total += fail_weight[state]
                state = fail[state]
                a = arc(state * width + w)
            total += weights[a]
            state = following[a]
        return total


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, list, list[bytes], list[bool]]]:
    """A task's rows (doc_id, held_out, text) as blocks of some `size` bytes: number, ids, texts, held_out."""
    number = TaskContext.get().partitionId() << 40
    ids, texts, held, n = [], [], [], 0
    for b in slices(batches):
        for doc_id, out, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            ids.append(doc_id)
            held.append(out)
            texts.append(data)
            n += len(data) + 1
            if n >= size:
                yield number, ids, texts, held
                number += 1
                ids, texts, held, n = [], [], [], 0
    if ids:
        yield number, ids, texts, held


def score(docs: DataFrame, held_out: int = 1, order: int = 3, k: float = 100.0, block_bytes: int = 2_000_000, bucket_bytes: int = 8_000_000) -> DataFrame:
    """A row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams), score.

    Both scores are log10 probabilities of the whole text and its end.  Trained on the rows of docs (doc_id, text) whose
    remainder isn't held_out.  Null texts are empty: one token, the end.  Null ids are trained on.  Repeated rows count
    again and are scored alike.  Where nothing is trained on, every token has the unknown word's probability, 1.  No
    rows give no rows.  Other columns are ignored.  Rows of docs must be dealt alike each time it is read, as files are;
    if they aren't, that is an error.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(remainder_of_five(docs["doc_id"].cast("long")) == held_out, F.lit(False)).alias("held_out"), docs["text"].alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << max(0, (total // bucket_bytes).bit_length())
    shift = 64 - (buckets.bit_length() - 1)

    def runs(keys: np.ndarray) -> list[tuple[int, int, int]]:
        """Buckets are ranges of hashes: (bucket, from, to) of those that sorted hashes are in."""
        if not len(keys):
            return []
        of = keys >> np.uint64(shift) if shift < 64 else np.zeros(len(keys), np.uint64)
        start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        return list(zip(of[start].tolist(), start.tolist(), [*start[1:].tolist(), len(keys)], strict=True))

    def digest(ids: list, texts: list[bytes], held: list[bool]) -> bytes:
        told = hashlib.blake2b(repr((ids, list(map(len, texts)), held)).encode(), digest_size=16)
        for t in texts:
            told.update(t)
        return told.digest()

    def counted(least: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, ids, texts, held in blocks(batches, block_bytes):
                block = Block(texts, ~np.array(held), most, least)
                out = [(-2 - number % buckets, number, digest(ids, texts, held))]
                for n, (keys, counts) in enumerate(zip(block.keys, block.counts, strict=True), least):
                    out += [(n * buckets + b, number, packed(keys[i:j], counts[i:j])) for b, i, j in runs(keys)]
                bucket, of, payload = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(of, pa.int64()), pa.array(payload, pa.binary())], ["bucket", "block", "payload"])

        return task

    def summed(group: pa.Table) -> pa.Table:
        bucket, of = group["bucket"][0].as_py(), group["block"].to_pylist()
        if bucket < 0:
            return pa.Table.from_arrays([group["bucket"], group["block"], group["payload"], *[pa.array([0] * len(of), pa.int64())] * 2], ["bucket", "block", "payload", "tokens", "types"])
        parts = [unpacked(x) for x in group["payload"].to_pylist()]
        keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        found, inverse = np.unique(keys, return_inverse=True)
        all_ = np.bincount(inverse, counts, len(found)).astype(np.int64)
        whole = all_[inverse]
        out, i = [], 0
        for number, (mine, _) in zip(of, parts, strict=True):
            j = i + len(mine)
            differ = np.flatnonzero(whole[i:j] != counts[i:j])
            if len(differ):
                out.append((bucket, number, packed(differ, whole[i:j][differ]), 0, 0))
            i = j
        if bucket < buckets:
            real = (all_ > 0) & (found != BEGIN)
            out.append((bucket, -1, None, int(all_[real].sum()), int(real.sum())))
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()], strict=True)], ["bucket", "block", "payload", "tokens", "types"])

    def answered(least: int, most: int) -> DataFrame:
        sent = rows.mapInArrow(counted(least, most), "bucket long, block long, payload binary").repartition(max(1, min((most - least) * buckets, 1 << 14)), "bucket")
        return tidied(sent.groupBy("bucket").applyInArrow(summed, "bucket long, block long, payload binary, tokens long, types long"), "ngrams")

    # The longest n-grams are counted by themselves, so that less lies on disk at once.
    answers = answered(0, max(1, order - 1))
    if order > 1:
        answers = answers.union(answered(order - 1, order))
    told = answers.where("block = -1").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    tokens, types = int(told[0]), int(told[1])

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, texts, held in blocks(batches, block_bytes):
            data = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(texts, pa.binary())], ["doc_id", "held_out", "text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, data.schema) as writer:
                writer.write_batch(data)
            payload = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([number], pa.int64()), pa.array([payload], pa.binary())], ["bucket", "block", "payload"])

    def scored(group: pa.Table) -> pa.Table:
        answer, own, told = [], None, set()
        for bucket, payload in zip(group["bucket"].to_pylist(), group["payload"].to_pylist(), strict=True):
            if bucket == -1:
                own = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(payload)).read_all()
            elif bucket < 0:
                told.add(payload)
            else:
                answer.append((bucket, payload))
        if own is None or told != {digest(own["doc_id"].to_pylist(), own["text"].to_pylist(), own["held_out"].to_pylist())}:
            raise RuntimeError("docs was cut into other blocks when it was read again")
        held = np.array(own["held_out"].to_pylist(), bool)
        block = Block(own["text"].to_pylist(), ~held, order)
        counts = [c.copy() for c in block.counts]
        at = [{b: i for b, i, _ in runs(k)} for k in block.keys]
        for bucket, payload in answer:
            n, b = divmod(bucket, buckets)
            where, count = unpacked(payload)
            counts[n][where.astype(np.int64) + at[n][b]] = count
        automaton = Automaton(block, counts, tokens, types, k)
        first, ids = block.first, block.ids[0]
        real = ids[np.concatenate([np.arange(i + 1, j) for i, j in zip(first, first[1:], strict=False)])]
        of = np.repeat(np.arange(len(held)), block.words + 1)
        base = np.bincount(of, automaton.unigram[real], len(held))
        known = np.bincount(of, counts[0][real] > 0, len(held)).astype(np.int64)
        columns = [own["doc_id"].combine_chunks(), own["held_out"].combine_chunks(), pa.array(block.words + 1, pa.int64()), pa.array(known), pa.array(np.full(len(held), tokens)), pa.array(base), pa.array(automaton.read_all())]
        return pa.Table.from_arrays(columns, [x.split()[0] for x in OUT.split(", ")])

    parts = max(1, min(1 << 14, 2 * total // block_bytes + 1))
    everything = rows.mapInArrow(texts_of, "bucket long, block long, payload binary").unionByName(answers.where("block >= 0").select("bucket", "block", "payload"))
    return everything.repartition(parts, "block").groupBy("block").applyInArrow(scored, OUT)
