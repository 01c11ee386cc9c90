"""External induced sorting of the suffixes around anchors.

Strings that share a core (a run of bytes that is the same in all of them) meet in one group.  Those of their suffixes that
can be equal to a given depth begin equally far from the core, so only these need to be put in order.  As in any induced
sorting the order of some suffixes comes first, that of all others follows from it: the suffix a place earlier sorts by its
first byte and then by the rank of the suffix it was made from.

1. The suffixes at the core's end are sorted by the same induction, from the strings' ends towards the core.
2. From their order that of the suffixes 1, 2, 3 ... places before the core is induced.

Each step is one pass through a priority queue.  Suffixes are taken off in order, and for each the tuple of the suffix a place
earlier is pushed: (group, byte, string, common prefix), where the common prefix with the tuple that was pushed before it
under the same group and byte is one more than the least met between their sources.  The queue gives tuples back by (group,
byte) and, within these, in the order of pushes.  Batches of small groups are a queue that fits in memory: a stable sort.  A
group of any size goes through a queue that keeps runs on disk beyond a bound of memory, as do the order and the bytes.
The folder is the spill of one task, and goes with it; nothing else reads it.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np


class Scratch:
    """A task's folder for what doesn't fit in memory."""

    def __init__(self, memory: int = 128 << 20):
        self.memory, self.folder = memory, None

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        if self.folder is not None:
            self.folder.cleanup()

    def path(self) -> str:
        if self.folder is None:
            # Where Spark spills, if it says so.
            local = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
            self.folder = tempfile.TemporaryDirectory(dir=local if local and os.path.isdir(local) else None)
        handle, path = tempfile.mkstemp(dir=self.folder.name)
        os.close(handle)
        return path


class Spool:
    """Arrays that are appended, and read in the same order; beyond the bound they go to disk."""

    def __init__(self, scratch: Scratch, bound: int):
        self.scratch, self.bound, self.held, self.size, self.file = scratch, bound, [], 0, None

    def add(self, *columns: np.ndarray) -> None:
        self.held.append(columns)
        self.size += sum(c.nbytes for c in columns)
        if self.size > self.bound:
            self.file = self.file or open(self.scratch.path(), "w+b")  # noqa: SIM115
            for chunk in self.held:
                for c in chunk:
                    np.save(self.file, c)
                np.save(self.file, np.zeros(0, np.int8))
            self.held, self.size = [], 0

    def read(self) -> Iterator[tuple[np.ndarray, ...]]:
        """What was added; it is gone then."""
        if self.file is not None:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                columns = []
                while (c := np.load(self.file)).dtype != np.int8:
                    columns.append(c)
                yield tuple(columns)
            path = self.file.name
            self.file.close()
            os.unlink(path)
        yield from self.held
        self.held, self.size, self.file = [], 0, None


def least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low .. high] for each pair."""
    out = values[low].copy()
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    k, step, table = 0, 1, values
    while len(level) and (level >= k).any():
        now = level == k
        out[now] = np.minimum(table[low[now]], table[high[now] - step + 1])
        table = np.minimum(table[:-step], table[step:])
        k, step = k + 1, 2 * step
    return out


def pushed(groups: np.ndarray, chars: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step in memory, for any number of groups: (sources in the order of what they induce, its common prefixes)."""
    key = groups.astype(np.int64) << 8 | chars
    order = np.argsort(key, kind="stable")
    new = np.zeros(len(order), common.dtype)
    key = key[order]
    again = np.flatnonzero(key[1:] == key[:-1]) + 1
    new[again] = least(common, order[again - 1] + 1, order[again]) + 1
    return order, new


class Queue:
    """One step of one group of any size: tuples (byte, string, common prefix), a spool for each byte."""

    def __init__(self, scratch: Scratch, most: int):
        self.spools = [Spool(scratch, scratch.memory >> 8) for _ in range(256)]
        #: [v]: the last source whose common prefix is v at most; [c]: the last source that pushed under c.
        self.recent, self.last, self.rank = np.full(most + 1, -1), np.full(256, -1), 0

    def push(self, chars: np.ndarray, strings: np.ndarray, common: np.ndarray, skipped: np.ndarray) -> None:
        """Sources in order; those that are skipped (nothing stands before them) only count for common prefixes."""
        i = np.flatnonzero(~skipped)
        i = i[np.argsort(chars[i], kind="stable")]
        by = chars[i]
        first = np.concatenate([[True], by[1:] != by[:-1]])[: len(i)]
        new = np.zeros(len(i), common.dtype)
        f, o = np.flatnonzero(first), np.flatnonzero(~first)
        before = self.last[by[f]]
        between = np.minimum(np.searchsorted(self.recent, before, side="right"), np.minimum.accumulate(common)[i[f]] if len(i) else 0)
        new[f] = np.where(before < 0, 0, between + 1)
        new[o] = least(common, i[o - 1] + 1, i[o]) + 1
        ends = [*(f[1:] - 1), len(i) - 1] if len(i) else []
        for a, b in zip(f, ends, strict=True):
            self.spools[by[a]].add(strings[i[a : b + 1]], new[a : b + 1])
            self.last[by[a]] = self.rank + i[b]
        at = np.full(len(self.recent), -1)
        np.maximum.at(at, common, np.arange(self.rank, self.rank + len(common)))
        self.recent = np.maximum(self.recent, np.maximum.accumulate(at))
        self.rank += len(common)

    def pop(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for spool in self.spools:
            yield from spool.read()


class Strings:
    """Strings around cores: `left` bytes stand before the core and `right` behind it, both the nearest byte first."""

    def __init__(self, groups: np.ndarray, left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray):
        self.groups, self.left, self.n_left, self.right, self.n_right = groups, left, n_left, right, n_right

    def __len__(self) -> int:
        return len(self.groups)

    def orders(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(places before the core, strings in the order of their suffixes there, common prefixes with the one before), the
        core left out of the count; strings are sorted by group, which has a common prefix of 0 with the one before."""
        order, common = np.zeros(0, np.int64), np.zeros(0, np.int16)
        for at in range(self.right.shape[1] - 1, -1, -1):
            # What ends here begins no suffix further on, so it is the least of its group.
            order, common = self._with(np.flatnonzero(self.n_right == at + 1), order, common)
            step, common = pushed(self.groups[order], self.right[order, at], common)
            order = order[step]
        order, common = self._with(np.flatnonzero(self.n_right == 0), order, common)
        yield 0, order, common
        for at in range(self.left.shape[1]):
            more = self.n_left[order] > at
            if not more.any():
                return
            # A suffix that nothing stands before passes its common prefix on to the next one.
            stay = np.flatnonzero(more)
            low = np.concatenate([[0], stay[:-1] + 1])
            common = least(common, low, stay)
            order = order[stay]
            common[self.groups[order] != np.concatenate([[-1], self.groups[order[:-1]]])] = 0
            step, common = pushed(self.groups[order], self.left[order, at], common)
            order = order[step]
            yield at + 1, order, common

    def _with(self, ended: np.ndarray, order: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The empty suffixes of strings that end go before all others of their group; they have nothing in common."""
        if not len(ended):
            return order, common
        ended = ended[np.argsort(self.groups[ended], kind="stable")]
        where = np.searchsorted(self.groups[order], self.groups[ended], side="left")
        common = common.copy()
        heads = where[where < len(order)]
        common[heads[self.groups[order[heads]] == self.groups[ended[: len(heads)]]]] = 0
        return np.insert(order, where, ended), np.insert(common, where, 0)

    def orders_on_disk(self, scratch: Scratch, rows: int = 1 << 16) -> Iterator[tuple[int, Iterator[tuple[np.ndarray, np.ndarray]]]]:
        """orders() of one group, whose order is never whole in memory: (places before the core, chunks of (strings, common))."""
        most = self.right.shape[1] + self.left.shape[1] + 1
        now = Spool(scratch, scratch.memory)
        for at in range(self.right.shape[1] - 1, -1, -1):
            now = self._step(now, np.flatnonzero(self.n_right == at + 1), self.right, at, None, scratch, most, rows)
        ended = np.flatnonzero(self.n_right == 0)
        whole = Spool(scratch, scratch.memory)
        if len(ended):
            whole.add(ended, np.zeros(len(ended), np.int16))
        for i, (order, common) in enumerate(now.read()):
            if i == 0:
                common = common.copy()
                common[0] = 0
            whole.add(order, common)
        for at in range(self.left.shape[1] + 1):
            kept = Spool(scratch, scratch.memory)

            def passed(whole: Spool = whole, kept: Spool = kept) -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for chunk in whole.read():
                    kept.add(*chunk)
                    yield chunk

            chunks = passed()
            yield at, chunks
            for _ in chunks:
                continue
            if at == self.left.shape[1]:
                return
            whole = self._step(kept, np.zeros(0, np.int64), self.left, at, self.n_left, scratch, most, rows)

    def _step(self, now: Spool, ended: np.ndarray, bytes_: np.ndarray, at: int, n: np.ndarray | None, scratch: Scratch, most: int, rows: int) -> Spool:
        queue = Queue(scratch, most)
        for i in range(0, len(ended), rows):
            part = ended[i : i + rows]
            queue.push(bytes_[part, at], part, np.zeros(len(part), np.int16), np.zeros(len(part), bool))
        begun = len(ended) > 0
        for order, common in now.read():
            if begun:
                common, begun = common.copy(), False
                common[0] = 0
            for i in range(0, len(order), rows):
                part = order[i : i + rows]
                queue.push(bytes_[part, at] if bytes_.shape[1] else np.zeros(len(part), np.uint8), part, common[i : i + rows], n[part] <= at if n is not None else np.zeros(len(part), bool))
        out, first = Spool(scratch, scratch.memory), True
        for order, common in queue.pop():
            if first:
                common, first = common.copy(), False
                common[0] = 0
            out.add(order, common)
        return out
