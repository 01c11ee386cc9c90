"""Packing token sequences: vector bin packing by the dot-product heuristic.

An example asks for three things at once: tokens, one segment, and loss-bearing tokens.  A sequence has a limit on each.
The open sequence takes, again and again, the waiting example whose demand has the largest dot product with what the
sequence has left, as shares of the limits, among those that fit whole.  What then stays free is filled with the head of a
waiting example, whose tail waits on.  Each task packs what it reads, in one pass, with a window of waiting examples:
nothing is shuffled or gathered, and memory is bounded by the window and the longest text.

Sequences are padded to the capacity, except those whose length is a power of two.  So what is left at the end of a task,
or when the limit on segments closes a sequence early, goes into sequences of powers of two, and nothing is padded.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from arbora.llm.common import slices

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: The splitting pattern of the public byte-level BPE vocabulary, and the special token in its file.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Coder:
    """Ids of a text by a byte-level BPE file of the tokenizers library.

    Texts of Latin letters without special tokens go through a faster library with the ranks of the same file; all
    others through the file's own library, so that tables of character classes can't differ.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path, self.whole = path, None
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.special = [x["content"] for x in told["added_tokens"]]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte[c] for c in k): v for k, v in told["model"]["vocab"].items() if k not in self.special}
        # The ranks of the faster library are the ids, which must be in the order of the merges.
        merges = [x if isinstance(x, list) else x.split(" ") for x in told["model"]["merges"]]
        order = [told["model"]["vocab"]["".join(x)] for x in merges]
        plain = told["normalizer"] is None and not told["pre_tokenizer"].get("add_prefix_space") and all(a < b for a, b in zip(order, order[1:], strict=False))
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if plain else None

    def __call__(self, text: str) -> np.ndarray:
        if self.fast and (text.isascii() or max(text) < "ɐ") and not any(s in text for s in self.special):
            return np.array(self.fast.encode_ordinary(text), np.dtype("<u4"))
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.dtype("<u4"))


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """One for each Python worker."""
    return Coder(path)


class Packer:
    """Packs examples of one task.  add() and end() yield sequences: lists of (key, start, length)."""

    def __init__(self, capacity: int = 2048, max_segments: int = 256, max_loss: int | None = None, window: int = 128):
        if capacity < 1 or max_segments < 1 or window < 1:
            raise ValueError("capacity, max_segments and window are at least 1")
        self.capacity, self.segments, self.loss, self.window = capacity, max_segments, capacity if max_loss is None else max_loss, window
        if self.loss < 1:
            raise ValueError("max_loss is at least 1")
        self.keys: list = []
        room = 4 * window
        self.start, self.stop, self.prompt = np.zeros((3, room), np.int64)
        self.demand = np.zeros((room, 3))
        self.n = self.total = 0

    def add(self, key: object, tokens: int, prompt: int = 0) -> Iterator[list]:
        """An example whose tokens from `prompt` on bear loss."""
        if tokens > 0:
            self._put(key, 0, tokens, min(max(prompt, 0), tokens))
        while self.n >= self.window and self.total >= self.capacity:
            yield self._fill(self.capacity)

    def end(self) -> Iterator[list]:
        while self.n:
            yield self._fill(self.capacity if self.total >= self.capacity else 1 << (self.total.bit_length() - 1))

    def _put(self, key: object, start: int, end: int, prompt: int) -> None:
        if self.n == len(self.start):
            self.start, self.stop, self.prompt = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.stop, self.prompt))
            self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)])
        i = self.n
        self.keys.append(key)
        self.start[i], self.stop[i], self.prompt[i] = start, end, prompt
        self._weigh(i)
        self.n += 1
        self.total += end - start

    def _weigh(self, i: int) -> None:
        loss = self.stop[i] - max(self.start[i], self.prompt[i])
        self.demand[i] = (self.stop[i] - self.start[i]) / self.capacity, 1 / self.segments, max(0, loss) / self.loss

    def _take(self, i: int, length: int) -> tuple:
        """The first `length` tokens of what waits at i; the rest waits on."""
        start, end = int(self.start[i]), int(self.stop[i])
        piece = (self.keys[i], start, length, int(self.prompt[i]))
        self.total -= length
        if start + length < end:
            self.start[i] = start + length
            self._weigh(i)
            return piece
        last = self.n = self.n - 1
        self.keys[i] = self.keys[last]
        self.keys.pop()
        for x in (self.start, self.stop, self.prompt, self.demand):
            x[i] = x[last]
        return piece

    def _fill(self, target: int) -> list:
        pieces: list = []
        left, loss, segments = target, self.loss, self.segments
        while left and segments and self.n:
            rest = np.array([left / self.capacity, segments / self.segments, loss / self.loss])
            score = self.demand[: self.n] @ rest
            score[(self.demand[: self.n] > rest + 1e-9).any(axis=1)] = -1
            i = int(score.argmax())
            if score[i] >= 0:
                length = int(self.stop[i] - self.start[i])
            else:
                # None fits whole: cut the longest, by what the sequence has left of tokens and of loss.
                i = int(self.demand[: self.n, 0].argmax())
                free = max(0, int(self.prompt[i] - self.start[i]))
                length = min(left, int(self.stop[i] - self.start[i]), free + loss)
                if length <= 0:
                    break
            piece = self._take(i, length)
            pieces.append(piece)
            left, segments, loss = left - length, segments - 1, loss - self._loss(piece)
        used = target - left
        if left and used & (used - 1):
            # A limit closed it early: down to a power of two, the rest waits again.
            over = used - (1 << (used.bit_length() - 1))
            while over:
                key, start, length, prompt = pieces.pop()
                back = min(over, length)
                if back < length:
                    pieces.append((key, start, length - back, prompt))
                self._put(key, start + length - back, start + length, prompt)
                over -= back
        return [p[:3] for p in pieces]

    @staticmethod
    def _loss(piece: tuple) -> int:
        _, start, length, prompt = piece
        return max(0, start + length - max(start, prompt))


def pack(docs: DataFrame, tokenizer: str, end_id: int | None = 1, capacity: int = 2048, max_segments: int = 256, max_loss: int | None = None, window: int = 128, prompt: str | None = None) -> DataFrame:
    """Packs docs (doc_id, text and, for instruction data, a column `prompt`: so many ids of it bear no loss).

    A row for each piece: doc_id, start and length (in the document's ids, end_id after the text), ids_crc32 (of its
    ids as little-endian unsigned 32-bit numbers), doc_tokens, sequence_id and offset (from 0, without gaps).
    Null and empty texts: end_id alone (no row if that is None).  Null ids stay null.  Repeated rows are packed each by
    itself.  No rows give no rows; other columns are ignored.  Sequence ids hold the task's number, and depend on how
    the input is split, as they do for the order of ties.
    """
    told = docs.select(docs["doc_id"].cast("long"), docs["text"], *([docs[prompt].cast("long")] if prompt else []))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, packer = coder(tokenizer), Packer(capacity, max_segments, max_loss, window)
        base, n = TaskContext.get().partitionId() << 40, 0
        out: list[tuple] = []

        def place(sequences: Iterator[list]) -> None:
            nonlocal n
            for pieces in sequences:
                offset = 0
                for (doc_id, ids), start, length in pieces:
                    out.append((doc_id, start, length, zlib.crc32(ids[start : start + length].data), len(ids), base + n, offset))
                    offset += length
                n += 1

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 7
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in PIECES.split(", ")])

        for b in slices(batches):
            lead = b.column(2).to_pylist() if prompt else [0] * len(b)
            for doc_id, text, bare in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), lead, strict=True):
                ids = code(text) if text else np.zeros(0, np.dtype("<u4"))
                if end_id is not None:
                    ids = np.append(ids, np.dtype("<u4").type(end_id))
                place(packer.add((doc_id, ids), len(ids), bare or 0))
            if out:
                yield batch()
        place(packer.end())
        yield batch()

    return told.mapInArrow(task, PIECES)
