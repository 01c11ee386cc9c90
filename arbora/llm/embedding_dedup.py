"""Near-duplicate vectors: spherical k-means cells, blocked cosine products of all cells that can hold a link, one
representative per group.

Centroids come from a bounded sample in the order of a hash of the ids; those closer to each other than a group of
near-duplicates is wide are merged, so that a dense group isn't cut up.  Every vector is a member of its nearest cell (its
home).  Cells are cut or packed, neighbours together, into blocks, and a vector visits every later block with a cell that
may hold a link of it: by the cell's radius (the triangle inequality) and by the plane between the centroids.  Nothing but
these bounds leaves a pair out, so the links are all links; where they rule out little, as on vectors spread evenly over
many dimensions, all pairs are compared.  Equal vectors are one, with a count.  A group of blocks that visits and a block
that is visited are a task.  A task returns counts of links and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.common import SALT, components, forest, grouped, salt, written
from arbora.llm.hashing import mixed_bits

#: Visits of a batch that are spelt out at a time.
CHUNK = 1 << 16
#: More than rounding adds to a cosine, or to the angle of one.
SURE = 1e-6


def normalised(x: np.ndarray) -> np.ndarray:
    """Rows of length one, of any finite size."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10, apart: float = 0.8, seed: int = 7) -> np.ndarray:
    """Centroids of unit rows x, no two with a cosine of `apart` or more."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(size > 1e-9, total / np.where(size > 1e-9, size, 1), c)
    kept: list[int] = []
    for i in range(len(c)):
        if not kept or (c[kept] @ c[i]).max() < apart:
            kept.append(i)
    return c[kept]


def chained(c: np.ndarray) -> np.ndarray:
    """An order of unit rows in which each is followed by the nearest that is left."""
    left, at = np.ones(len(c), bool), 0
    order = []
    for _ in range(len(c)):
        order.append(at)
        left[at] = False
        at = int(np.where(left, c @ c[at], -2.0).argmax())
    return np.array(order)


def spans(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each span of n numbers from first on: which span, and the numbers."""
    span = np.repeat(np.arange(len(n)), n)
    return span, np.arange(len(span)) - np.repeat(np.cumsum(n) - n, n) + first[span]


class Layout:
    """Cells in the order of centroids, cut and packed into blocks of about `block` members, and who has to visit whom.

    A unit is a cell of more than `block` members, cut into blocks, or a row of cells that make one block.  All that is kept
    is by cells and units, of which there are `most_cells` at most; blocks, which grow with the table, are ranges of a unit.
    """

    def __init__(self, centroids: np.ndarray, members: np.ndarray, radius: np.ndarray, threshold: float, block: int, group: int):
        self.centroids, self.radius, self.threshold, self.group = centroids, radius, threshold, group
        self.angle = float(np.arccos(np.clip(threshold, -1, 1)))
        starts, parts, held = [], [], block + 1
        for c, m in enumerate(members.tolist()):
            if m > block or held + m > block:
                starts.append(c)
                parts.append(max(1, -(-m // block)))
                held = 0
            held = block + 1 if m > block else held + m
        self.starts, self.parts = np.array(starts), np.array(parts)
        self.first = np.concatenate([[0], self.parts.cumsum()])
        self.unit = np.repeat(np.arange(len(starts)), np.diff([*starts, len(members)]))
        # Cells with members so far apart that none of them are linked.
        near = np.arccos(np.clip(centroids @ centroids.T, -1, 1)) <= radius[:, None] + radius[None, :] + self.angle + SURE
        #: [unit, unit]: whether any of their cells can hold a link.
        self.near = np.logical_or.reduceat(np.logical_or.reduceat(near, self.starts, axis=1), self.starts, axis=0)

    def own(self, home: np.ndarray, ids: np.ndarray) -> np.ndarray:
        unit = self.unit[home]
        return self.first[unit] + (mixed_bits(ids.astype(np.uint64)) % self.parts[unit].astype(np.uint64)).astype(np.int64)

    def hosts(self, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, group): the groups of visitors, up to the row's own, in which its block's members are needed."""
        blocks, row = np.unique(own, return_inverse=True)
        of = np.searchsorted(self.first, blocks, side="right") - 1
        for i, (block, unit) in enumerate(zip(blocks.tolist(), of.tolist(), strict=True)):
            near = np.flatnonzero(self.near[unit])
            near = near[self.first[near] <= block]
            low, high = self.first[near] // self.group, np.minimum((self.first[near + 1] - 1) // self.group, block // self.group)
            groups = np.unique(spans(low, high - low + 1)[1])
            rows = np.flatnonzero(row == i)
            step = max(1, CHUNK // max(1, len(rows)))
            for j in range(0, len(groups), step):
                some = groups[j : j + step]
                yield np.repeat(rows, len(some)), np.tile(some, len(rows))

    def visits(self, sims: np.ndarray, home: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, block): the later blocks that may hold a link of the row, by two bounds that are exact.

        A member is within the cell's radius, so the row is within that and the threshold's angle of the centroid.  And
        a member is on its own centroid's side of the plane between it and the row's home's.
        """
        cells = np.arccos(np.clip(sims, -1, 1)) <= self.radius + self.angle + SURE
        if self.threshold > 0:
            gap = np.sqrt(np.maximum(0, 2 - 2 * self.centroids[home] @ self.centroids.T))
            cells &= np.take_along_axis(sims, home[:, None], axis=1) - sims <= np.sin(self.angle) * gap + SURE
        row, unit = np.nonzero(np.logical_or.reduceat(cells, self.starts, axis=1))
        low = np.maximum(self.first[unit], own[row] + 1)
        n = np.maximum(self.first[unit + 1] - low, 0)
        ends = np.cumsum(n)
        at = 0
        while at < len(n):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
            span, block = spans(low[at:to], n[at:to])
            yield row[at:to][span], block
            at = to


def links(vectors: DataFrame, threshold: float = 0.9, per_cell: int = 400, most_cells: int = 4096, sample: int = 65_536, block: int = 4096, group: int = 4) -> tuple[DataFrame, DataFrame]:
    """vectors (rep: long, times: long, embedding: array of finite doubles, not all zero, of one length; rep unique)
    -> counts (rep, n: links to other vectors, equal ones counted) and edges (a, b) that connect what is linked.
    """
    spark = vectors.sparkSession
    n = vectors.count()
    empty = spark.createDataFrame([], "rep long, n long"), spark.createDataFrame([], "a long, b long")
    if not n:
        return empty
    k = max(1, min(most_cells, n // per_cell))
    told = vectors.orderBy(F.xxhash64("rep"), "rep").limit(min(sample, 64 * k)).select("embedding").toArrow()["embedding"].combine_chunks()
    centroids = spherical_kmeans(normalised(told.flatten().to_numpy(zero_copy_only=False).reshape(len(told), -1)), k)
    centroids = centroids[chained(centroids)]
    width = centroids.shape[1]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        for whole in batches:
            for i in range(0, len(whole), 1024):
                b = whole.slice(i, 1024)
                x = normalised(b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
                yield b, x, x @ centroids.T

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, radius = np.zeros(len(centroids), np.int64), np.zeros(len(centroids))
        for _, _, sims in read(batches):
            # Every home that rounding could choose.
            row, cell = np.nonzero(sims >= sims.max(axis=1, keepdims=True) - SURE)
            np.add.at(members, cell, 1)
            np.maximum.at(radius, cell, np.arccos(np.clip(sims[row, cell], -1, 1)))
        some = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(members[some]), pa.array(radius[some])], ["cell", "members", "radius"])

    # As many rows as there are cells.
    rows = vectors.select("rep", "times", "embedding")
    sizes = rows.mapInArrow(measured, "cell long, members long, radius double").groupBy("cell").agg(F.sum("members").alias("members"), F.max("radius").alias("radius")).collect()
    members, radius = np.zeros(len(centroids), np.int64), np.full(len(centroids), -np.inf)
    for r in sizes:
        members[r["cell"]], radius[r["cell"]] = r["members"], r["radius"]
    layout = Layout(centroids, members, radius, threshold, block, group)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x, sims in read(batches):
            home = sims.argmax(axis=1)
            own = layout.own(home, b.column(0).to_numpy())
            vector = pa.array([r.tobytes() for r in x], pa.binary())
            for member, found in ((False, layout.visits(sims, home, own)), (True, layout.hosts(own))):
                for row, at in found:
                    x_, y = (at, own[row]) if member else (own[row] // group, at)
                    for i in range(0, len(row), 4096):
                        part = slice(i, i + 4096)
                        take = pa.array(row[part])
                        yield pa.RecordBatch.from_arrays([pa.array(x_[part].astype(np.int32)), pa.array(y[part].astype(np.int32)), pa.array(np.full(len(take), member)), b.column(0).take(take), b.column(1).take(take), vector.take(take)], ["x", "y", "member", "rep", "times", "vector"])

    def compared(tile: pa.Table) -> pa.Table:
        member = tile["member"].to_numpy()
        ids = tile["rep"].to_numpy()
        times = tile["times"].to_numpy()
        vector = np.frombuffer(b"".join(tile["vector"].to_pylist()), float).reshape(-1, width)
        me = np.flatnonzero(member)
        # In their own group's tile the members are compared with each other, too.
        inner = len(ids) and tile["x"][0].as_py() == tile["y"][0].as_py() // group
        vi = np.arange(len(ids)) if inner else np.flatnonzero(~member)
        n, edges = np.zeros(len(ids), np.int64), []
        held = vector[me]
        for i in range(0, len(vi), 512):
            some = vi[i : i + 512]
            a, b = np.nonzero(vector[some] @ held.T >= threshold)
            a, b = some[a], me[b]
            other = ids[a] != ids[b]
            a, b = a[other], b[other]
            np.add.at(n, a, times[b])
            # Members that are compared with each other meet twice, a visitor and a member once.
            once = ~member[a]
            np.add.at(n, b[once], times[a[once]])
            if len(a):
                nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
                root = forest(inverse[: len(a)], inverse[len(a) :], len(nodes))
                edges.append(np.stack([nodes, nodes[root]]))
        out_a, out_b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if edges:
            a, b = np.concatenate(edges, axis=1)
            root = forest(a, b, len(ids))
            moved = np.flatnonzero(root != np.arange(len(ids)))
            out_a, out_b = ids[moved], ids[root[moved]]
        some = np.flatnonzero(n)
        return pa.Table.from_arrays([pa.array(np.concatenate([ids[some], out_a])), pa.array(np.concatenate([n[some], out_b])), pa.array([False] * len(some) + [True] * len(out_a), pa.bool_())], ["a", "b", "edge"])

    tiles = rows.mapInArrow(dealt, "x int, y int, member boolean, rep long, times long, vector binary").groupBy("x", "y")
    found = written(tiles.applyInArrow(compared, "a long, b long, edge boolean"), "cosines")
    return found.where("not edge").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("n")), found.where("edge and a != b").select("a", "b")


def dedup(vectors: DataFrame, threshold: float = 0.9, **how: int | float) -> DataFrame:
    """A row for each vec_id: vec_id, n_links, component_id, kept.

    Vectors (vec_id, embedding) that are null or empty, all zero, or hold null or non-finite components link with nothing, nor
    do vectors without an id, whose component_id is null and which are kept, nor vectors of different lengths with each
    other.  Rows of one id are one vector, the smallest that is valid.  Components are
    those of all links; a component's smallest id is kept.  No rows give no rows.
    """
    e = F.col("_e")
    valid = e.isNotNull() & (F.size(e) > 0) & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    given = vectors.select(vectors["vec_id"].cast("long").alias("_id"), vectors["embedding"].cast("array<double>").alias("_e")).withColumn("_e", F.when(valid, F.transform(e, lambda v: v + F.lit(0.0))))
    one = written(given.where("_id is not null").groupBy("_id").agg(F.min("_e").alias("_e")), "vectors")
    # Equal vectors may be a third of all: they are counted, and told their answer, salted.
    use = one.where("_e is not null").withColumn(SALT, salt(vectors.sparkSession, "_id"))
    same = written(grouped(use, ["_e"], [F.min("_id").alias("rep"), F.count("*").alias("times")], [F.min("rep").alias("rep"), F.sum("times").alias("times")]), "equal")
    reps = written(same.groupBy("rep").agg(F.first("times").alias("times"), F.first("_e").alias("embedding")), "distinct")
    counts, edges = links(reps.limit(0), threshold, **how)
    # Vectors of each length among themselves: tables have one, as a rule.
    for r in reps.groupBy(F.size("embedding").alias("l")).count().orderBy(F.desc("count"), "l").collect():
        more = links(reps.where(F.size("embedding") == r["l"]), threshold, **how)
        counts, edges = counts.union(more[0]), edges.union(more[1])
    comp = components(edges)
    told = reps.select("rep", "times").join(counts, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("rep", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    # The smallest id of a component is some representative's, since that is the smallest of its equals.
    linked = use.join(same.select("_e", SALT, "rep").join(told, "rep"), ["_e", SALT]).select("_id", "n_links", "component_id")
    alone = one.where("_e is null").select("_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    out = linked.unionByName(alone).select(F.col("_id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "_id").alias("component_id"))
    none = given.where("_id is null").select(F.col("_id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id")).unionByName(none.withColumn("kept", F.lit(True)))
