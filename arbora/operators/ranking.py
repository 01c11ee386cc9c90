"""Ranks, percentiles, AUC, leads, composite scores, centroids and twins.

A rank over a whole table doesn't sort it in one task: values are counted by value, the counts by ranges, and each
range's own ranks start at the sum of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbora.functions.vectors import cosine, norm, unit
from arbora.session import dropped, tidied, written


def _dealt(rows: DataFrame, order: list[Column], weight: Column) -> tuple[DataFrame, DataFrame]:
    """rows sorted by ranges with _part, and (_part, _start: the weight of all parts before): a row for each shuffle partition."""
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("_part", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    total, starts = 0, []
    for r in dealt.groupBy("_part").agg(weight.alias("n")).orderBy("_part").collect():
        starts.append((r["_part"], total))
        total += r["n"]
    return dealt, F.broadcast(spark.createDataFrame(starts, "_part int, _start long"))


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Adds the ordinal rank from 0 by order, which must be a total order.

    Rows are sorted across as many tasks as there are shuffle partitions, and numbered within them; each task's first number is the count of those before.
    """
    dealt, starts = _dealt(rows, order, F.count("*"))
    w = Window.partitionBy("_part").orderBy(*order)
    return dealt.withColumn("_n", F.row_number().over(w)).join(starts, "_part").withColumn(name, F.col("_start") + F.col("_n") - 1).drop("_part", "_n", "_start")


def percentile(rows: DataFrame, value: str, ties: str, name: str = "pct") -> DataFrame:
    """Ordinal rank / (n - 1), ties by another column; 0 for a single row."""
    n = rows.count()
    return ranked(rows, [F.col(value), F.col(ties)], "_rank").withColumn(name, F.col("_rank") / F.lit(max(n - 1, 1))).drop("_rank")


def auc(rows: DataFrame, score: str, positive: str) -> DataFrame:
    """One row (auc): of average ranks; null without both classes.

    Rows are counted by score first; what is then ranked has a row for each distinct score.
    """
    by = rows.where(F.col(score).isNotNull() & F.col(positive).isNotNull()).groupBy(F.col(score).alias("_s")).agg(F.count("*").alias("_n"), F.sum(F.col(positive).cast("long")).alias("_p"))
    by = _running(by, "_s", "_n").withColumn("_rank", F.col("_before") + (F.col("_n") + 1) / 2)
    told = by.agg(F.sum(F.col("_rank") * F.col("_p")).alias("s"), F.sum("_p").alias("p"), F.sum("_n").alias("n"))
    p, n = F.col("p"), F.col("n") - F.col("p")
    return told.select(F.when((p > 0) & (n > 0), (F.col("s") - p * (p + 1) / 2) / (p * n)).alias("auc"))


def _running(rows: DataFrame, order: str, weight: str) -> DataFrame:
    """Adds _before: the sum of weight over all rows of a smaller `order`, by ranges."""
    dealt, starts = _dealt(rows, [F.col(order)], F.sum(weight))
    w = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("_b", F.coalesce(F.sum(weight).over(w), F.lit(0))).join(starts, "_part").withColumn("_before", F.col("_start") + F.col("_b")).drop("_part", "_b", "_start")


def lead_over_held(scores: DataFrame, held: DataFrame) -> DataFrame:
    """scores (lemma, sense, score), held (lemma, sense) -> (lemma, best, lead): the best sense, and how far it leads
    the held one."""
    best = scores.groupBy("lemma").agg(F.max_by("sense", F.struct("score", "sense")).alias("best"), F.max("score").alias("top"))
    own = scores.join(held, ["lemma", "sense"]).select("lemma", F.col("score").alias("own"))
    return best.join(own, "lemma").select("lemma", "best", (F.col("top") - F.col("own")).alias("lead"))


def composite(rows: DataFrame, parts: list[Column], ties: str, name: str) -> DataFrame:
    """The percentile of the mean of percentiles of `parts`."""
    for i, part in enumerate(parts):
        rows = percentile(rows.withColumn("_v", part), "_v", ties, f"_p{i}").drop("_v")
    mean = reduce(lambda a, b: a + b, [F.col(f"_p{i}") for i in range(len(parts))]) / len(parts)
    return percentile(rows.withColumn("_v", mean), "_v", ties, name).drop("_v", *[f"_p{i}" for i in range(len(parts))])


def first_per_group(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows in the order of a keyed hash: the same on every run."""
    return rows.orderBy(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256), key).limit(n)


def centroids(rows: DataFrame, key: str, vector: str, places: int | None = None) -> DataFrame:
    """(key, centroid, n): the mean of each group's vectors, by place; places is the longest vector's, and is looked up if it isn't given.

    Each place is a mean of its own, so what a task sends on is one row for each group that it has seen.
    """
    if places is None:
        places = longest(rows, vector)
    told = rows.where(F.size(vector) > 0).groupBy(key).agg(F.count("*").alias("n"), F.max(F.size(vector)).alias("_size"), *[F.avg(F.get(vector, F.lit(i)).cast("double")).alias(f"_m{i}") for i in range(places)])
    return told.select(key, F.slice(F.array(*[F.col(f"_m{i}") for i in range(places)]).cast("array<double>"), F.lit(1), F.col("_size")).alias("centroid"), "n")


def longest(rows: DataFrame, vector: str) -> int:
    """How many places the longest vector has."""
    return max(rows.agg(F.max(F.size(vector))).first()[0] or 0, 0)


def sibling_distance(rows: DataFrame, key: str, name: str, vector: str, least: int = 3) -> DataFrame:
    """(name, distance): 1 - cosine to the mean of the group's other vectors, in groups of `least` or more."""
    mean = centroids(rows, key, vector).where(F.col("n") >= least)
    others = F.zip_with(F.col("centroid"), F.col(vector), lambda c, x: c * F.col("n") - x.cast("double"))
    return rows.join(mean, key).select(name, (1 - cosine(F.col(vector), others)).alias("distance"))


def misfit(rows: DataFrame, name: str, lowest_parent: str, distance: str) -> DataFrame:
    """How little a name fits its parents and mates, among rows that have a parent's similarity."""
    own = rows.where(F.col(lowest_parent).isNotNull())
    return composite(own, [-F.col(lowest_parent), F.coalesce(F.col(distance), F.lit(0.0))], name, "misfit")


def trap(rows: DataFrame, name: str, name_gloss: str, lead: str, sense_rank: str) -> DataFrame:
    """How likely a name misleads, among rows that have a gloss's similarity."""
    own = rows.where(F.col(name_gloss).isNotNull())
    return composite(own, [-F.col(name_gloss), F.coalesce(F.col(lead), F.lit(0.0)), F.coalesce(F.col(sense_rank), F.lit(0)).cast("double")], name, "trap")


def parent_similarities(edges: DataFrame, vectors: DataFrame) -> DataFrame:
    """edges (sub, sup), vectors (name, vector) -> (name, lowest, parents): a name's parents with their similarities, the most
    similar first, and the lowest of these; pairs of which one has no vector are left out."""
    low = vectors.select(F.col("name").alias("sub"), F.col("vector").alias("v"))
    top = vectors.select(F.col("name").alias("sup"), F.col("vector").alias("w"))
    told = edges.select("sub", "sup").distinct().join(low, "sub").join(top, "sup").select("sub", "sup", cosine(F.col("v"), F.col("w")).alias("sim")).where("sim is not null")
    every = F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("_s"), F.col("sup").alias("parent"), "sim")))
    return told.groupBy(F.col("sub").alias("name")).agg(F.min("sim").alias("lowest"), F.transform(every, lambda x: F.struct(x["parent"].alias("parent"), x["sim"].alias("sim"))).alias("parents"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Arrays of one length as rows."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean ones, of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (v @ pivots.T), 0))


#: What rounding may add to a distance that is a root.
EPSILON = 1e-6


def _in_cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds each vector's nearest pivot and its distance."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = _distances(_matrix(b.column("vector")), pivots) if len(b) else np.zeros((0, len(pivots)))
            cell = d.argmin(axis=1)
            columns = [pa.array(cell, pa.int32()), pa.array(d[np.arange(len(b)), cell], pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[*b.schema.names, "cell", "distance"])

    return vectors.mapInArrow(near, "name string, vector array<double>, cell int, distance double")


def _products(visits: DataFrame, pool: DataFrame, per_task: int) -> DataFrame:
    """visits (cell, name, vector) x pool (cell, name, vector) -> (name, twin, sim): the best of each visit, by blocks of both."""
    blocks = lambda df, c: df.groupBy("cell").agg(F.ceil(F.count("*") / per_task).cast("int").alias(c))
    # A row for each cell.
    sizes = F.broadcast(blocks(visits, "xs").join(blocks(pool, "ys"), "cell"))
    block = lambda n: F.pmod(F.xxhash64("name"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = visits.join(sizes, "cell").select("cell", block("xs").alias("x"), every("ys").alias("y"), F.lit(True).alias("own"), "name", "vector")
    b = pool.join(sizes, "cell").select("cell", every("xs").alias("x"), block("ys").alias("y"), F.lit(False).alias("own"), "name", "vector")

    def task(group: pa.Table) -> pa.Table:
        mine = np.array(group["own"].to_pylist(), bool)
        names, v = np.array(group["name"].to_pylist(), object), _matrix(group["vector"])
        out = []
        if mine.any() and not mine.all():
            i, j = np.flatnonzero(mine), np.flatnonzero(~mine)
            j = j[np.argsort(names[j].astype(str), kind="stable")]
            s = v[i] @ v[j].T
            s[names[i][:, None] == names[j][None, :]] = -2
            best = s.argmax(axis=1)
            out = [(names[p], names[j[q]], float(s[r, q])) for r, (p, q) in enumerate(zip(i, best, strict=True)) if s[r, q] > -2]
        columns = list(zip(*out, strict=True)) or [()] * 3
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.float64()), strict=True)], ["name", "twin", "sim"])

    return a.unionByName(b).groupBy("cell", "x", "y").applyInArrow(task, "name string, twin string, sim double")


def _units(pivots: np.ndarray, members: np.ndarray, block: int) -> np.ndarray:
    """For each cell its unit: cells that follow each other, each nearest to the one before, while they make one block."""
    left, at, unit, held, out = np.ones(len(pivots), bool), 0, 0, 0, np.zeros(len(pivots), np.int64)
    for _ in range(len(pivots)):
        left[at] = False
        if held and held + members[at] > block:
            unit, held = unit + 1, 0
        out[at], held = unit, held + members[at]
        at = int(np.where(left, pivots @ pivots[at], -np.inf).argmax())
    return out


def _by_blocks(met: DataFrame, pool: DataFrame, open_cells: Callable[[pa.RecordBatch], np.ndarray], unit: np.ndarray, own: np.ndarray, members: np.ndarray, least: float, block: int) -> DataFrame:
    """met (name, vector, cell, sim) x pool (cell, name, vector) -> (name, twin, sim): the best that a block of each holds, from `least` on, where a cell is open.

    Both are packed into blocks, a row each.  A task reads some blocks of both and compares each with each, so that nothing is shuffled or
    written for a pair of blocks: disk grows with the tables, whatever is open.
    """
    blocked = lambda df, n: df.withColumn("unit", F.element_at(F.lit(unit.tolist()), F.col("cell") + 1)).withColumn("part", F.pmod(F.xxhash64("name"), F.element_at(F.lit(np.maximum(1, -(-np.bincount(unit, n).astype(np.int64) // block)).tolist()), F.col("unit").cast("int") + 1)))

    def packed(group: pa.Table, units: np.ndarray) -> pa.Table:
        names = np.array(group["name"].to_pylist(), object)
        order = np.argsort(names, kind="stable")
        columns = [pa.array([x]) for x in (group["unit"][0].as_py(), group["part"][0].as_py())] + [pa.array([units.tolist()], pa.list_(pa.int64())), pa.array([names[order].tolist()], pa.list_(pa.string())), pa.array([_matrix(group["vector"])[order].astype(float).tobytes()], pa.binary())]
        return pa.Table.from_arrays(columns, names=["unit", "part", "units", "names", "vectors"])

    def visitors(group: pa.Table) -> pa.Table:
        open_ = np.zeros(len(unit), bool)
        for b in group.to_batches(max_chunksize=512):
            open_ |= open_cells(b).any(axis=0)
        return packed(group, np.unique(unit[open_]))

    layout = "unit long, part long, units array<long>, names array<string>, vectors binary"
    a = tidied(blocked(met, own).groupBy("unit", "part").applyInArrow(visitors, layout), "visitors")
    b = tidied(blocked(pool, members).groupBy("unit", "part").applyInArrow(lambda group: packed(group, unit[:0]), layout), "blocks")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of blocks; those of one visitor follow each other, and what they tell of it is one row a name."""
        at, names, v, sims, twins_ = None, [], None, None, None

        def told() -> pa.RecordBatch:
            some = np.flatnonzero(sims >= least) if at else []
            return pa.RecordBatch.from_arrays([pa.array([names[i] for i in some], pa.string()), pa.array([twins_[i] for i in some], pa.string()), pa.array([sims[i] for i in some], pa.float64())], names=["name", "twin", "sim"])

        for batch in batches:
            for i in range(len(batch)):
                row = lambda c, batch=batch, i=i: batch.column(c)[i]
                if at != (row("u").as_py(), row("p").as_py()):
                    yield told()
                    at, names = (row("u").as_py(), row("p").as_py()), row("own").as_py()
                    v = np.frombuffer(row("v").as_py(), float).reshape(len(names), -1)
                    sims, twins_ = np.full(len(names), -2.0), np.full(len(names), None, object)
                others = row("names").as_py()
                w = np.frombuffer(row("vectors").as_py(), float).reshape(len(others), -1)
                known = np.array(others, object)
                both = set(names) & set(others)
                for j in range(0, len(names), 1024):
                    s = v[j : j + 1024] @ w.T
                    for k, name in enumerate(names[j : j + 1024]) if both else ():
                        if name in both:
                            s[k, known == name] = -2
                    best = s.argmax(axis=1)
                    sim, twin = s[np.arange(len(s)), best], known[best]
                    old = sims[j : j + 1024]
                    better = sim > old
                    for k in np.flatnonzero((sim == old) & (sim > -2)):
                        better[k] = twin[k] < twins_[j + k]
                    rows = j + np.flatnonzero(better)
                    sims[rows], twins_[rows] = sim[better], twin[better]
        yield told()

    x = a.select(F.col("unit").alias("u"), F.col("part").alias("p"), "units", F.col("names").alias("own"), F.col("vectors").alias("v"))
    pairs = x.join(b.select("unit", "names", "vectors").hint("shuffle_replicate_nl"), F.array_contains("units", F.col("unit")))
    return pairs.select("u", "p", "own", "v", "names", "vectors").mapInArrow(compared, "name string, twin string, sim double")


def twins(own: DataFrame, pool: DataFrame, least: float = 0.9, per_task: int = 1024, most_pivots: int = 1024, most_visits: int = 1 << 16, most_open: float = 4, block: int = 4096) -> DataFrame:
    """own, pool (name, hub, vector) -> (name, twin, sim): the same hub is a twin of 1, the first by name; else the most similar of the
    pool from `least` on, by similarity and then name.  Names are their own twins never; names whose vector is null or has no length have twins by hub only.

    The pool is dealt to cells by its nearest pivot (a bounded sample, as many as the root of the pool).  Each vector visits
    its nearest cell first.  What it finds there, or `least`, bounds how far its twin can be; of the other cells it visits those that this
    leaves open by the triangle inequality (a cell's radii, and the plane between two pivots).  Nothing is missed.
    Where these are more than `most_open` for each vector, vectors aren't sent to them: blocks of vectors are compared with blocks (_by_blocks).
    """
    told = lambda df: df.where("vector is not null").where(norm(F.col("vector")) > 0).select("name", unit(F.col("vector")).alias("vector"))
    hubs = pool.where("hub != ''").select("hub", F.col("name").alias("twin")).distinct()
    first = hubs.groupBy("hub").agg(F.min("twin").alias("first"))
    second = hubs.join(first, "hub").where("twin != first").groupBy("hub").agg(F.min("twin").alias("second"))
    same = own.where("hub != ''").select("name", "hub").join(first.join(second, "hub", "left"), "hub")
    same = same.withColumn("twin", F.when(F.col("first") != F.col("name"), F.col("first")).otherwise(F.col("second"))).where("twin is not null").groupBy("name").agg(F.min("twin").alias("twin"))
    same = same.select("name", "twin", F.lit(1.0).alias("sim"))
    mine = written(told(own.join(same.select("name"), "name", "left_anti")).distinct(), "own")
    others = written(told(pool), "pool")
    n = others.count()
    if n == 0:
        return same
    sample = others.orderBy(F.xxhash64("name"), "name").limit(min(most_pivots, max(1, int(n**0.5)))).collect()
    pivots = np.array([r["vector"] for r in sample], float)
    cells = written(_in_cells(others, pivots), "cells")
    # A row for each pivot.
    low, high, members = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf), np.zeros(len(pivots), np.int64)
    for r in cells.groupBy("cell").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.count("*").alias("n")).collect():
        low[r["cell"]], high[r["cell"]], members[r["cell"]] = r["low"], r["high"], r["n"]
    dropped(others)
    limit = float(np.sqrt(max(2 - 2 * least, 0))) + EPSILON
    step = max(1, most_visits // len(pivots))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(cell, name, vector): the cells that are open, given the similarity found so far (null: the nearest cell only)."""
        for b in batches:
            # What one slice sends on is bounded, though each of its vectors may visit all cells.
            for i in range(0, len(b), step):
                yield from visited(b.slice(i, step))

    def open_cells(b: pa.RecordBatch) -> np.ndarray:
        """[row, cell]: whether the cell, not the nearest one, may hold something nearer than what was found."""
        d = _distances(_matrix(b.column("vector")), pivots)
        d[:, ~np.isfinite(low)] = np.inf
        found = b.column("sim").fill_null(-1.0).to_numpy(zero_copy_only=False)
        reach = np.minimum(np.sqrt(np.maximum(2 - 2 * found, 0)) + EPSILON, limit)
        with np.errstate(invalid="ignore"):
            bound = np.maximum(np.maximum(d - high, low - d), (d - d.min(axis=1, keepdims=True)) / 2)
        open_ = (bound <= reach[:, None] + EPSILON) & np.isfinite(low)
        open_[np.arange(len(b)), d.argmin(axis=1)] = False
        return open_

    def visited(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if "sim" in b.schema.names:
            row, cell = np.nonzero(open_cells(b))
        else:
            d = _distances(_matrix(b.column("vector")), pivots)
            d[:, ~np.isfinite(low)] = np.inf
            row, cell = np.arange(len(b)), d.argmin(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), b.column("name").take(pa.array(row)), b.column("vector").take(pa.array(row))], names=["cell", "name", "vector"])

    layout = "cell int, name string, vector array<double>"
    near = tidied(_products(mine.mapInArrow(visits, layout), cells, per_task), "near")
    best = near.groupBy("name").agg(F.max("sim").alias("sim"))
    met = tidied(_in_cells(mine, pivots).join(best, "name", "left"), "met")
    dropped(mine)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, open_ = np.zeros(len(pivots), np.int64), np.zeros(len(pivots), np.int64)
        for b in batches:
            for i in range(0, len(b), step):
                cell = b.column("cell").slice(i, step).to_numpy()
                np.add.at(own, cell, 1)
                np.add.at(open_, cell, open_cells(b.slice(i, step)).sum(axis=1))
        some = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (some, own, open_)], names=["cell", "own", "open"])

    # A row for each pivot.
    homes = met.mapInArrow(counted, "cell long, own long, open long").groupBy("cell").agg(F.sum("own").alias("own"), F.sum("open").alias("open")).collect()
    if sum(r["open"] for r in homes) <= most_open * sum(r["own"] for r in homes):
        further = _products(written(met.mapInArrow(visits, layout), "visits"), cells, per_task)
    else:
        visitors = np.zeros(len(pivots), np.int64)
        for r in homes:
            visitors[r["cell"]] = r["own"]
        further = written(_by_blocks(met, cells, open_cells, _units(pivots, members, block), visitors, members, least, block), "further")
    found = near.union(further).where(F.col("sim") >= least)
    found = found.groupBy("name").agg(F.min_by(F.struct("twin", F.least("sim", F.lit(1.0)).alias("sim")), F.struct(-F.col("sim"), "twin")).alias("x")).select("name", "x.twin", "x.sim")
    return same.union(found)
