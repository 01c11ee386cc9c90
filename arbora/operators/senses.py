"""Senses of the labels of a tree, each guided by what was chosen above it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.session import written

SENSES = "array<string>"


def guided_senses(tree: DataFrame, labels: DataFrame, candidates: DataFrame, above: DataFrame, picks: DataFrame | None = None, preferred: DataFrame | None = None) -> DataFrame:
    """Chooses a sense for each label (node, label) of a tree (node, parent), level by level from the top.

    candidates (node, label, sense) are what a label could mean, above (sense, above) says below what each sense lies.
    A single candidate is chosen.  Of several, those below a choice of the nearest ancestor that has choices stay, if there
    are any; then the one that is preferred (node, sense), if it is just one.  picks (node, label, sense) decide beforehand;
    a null sense says that the label means none of them and has no choice.

    Returns (node, label, sense, route, left): route is picked, refused, chosen, ambiguous or unmatched, left the sorted
    candidates that remain.  A tree's column `guides` (default true) keeps a node's choices from guiding others.  A node of
    several parents takes the smallest; nodes below no root (on a cycle, or absent from the tree) have no guide.
    Each level reads the guides of the level before, written to the shared folder.
    """
    silent = ~F.coalesce("guides", F.lit(True)) if "guides" in tree.columns else F.lit(False)
    edges = written(tree.where("node is not null").groupBy("node").agg(F.min("parent").alias("parent"), F.max(silent).alias("silent")), "parents")
    roots = edges.select(F.col("parent").alias("name")).where("name is not null").distinct().join(edges.where("parent is not null").select(F.col("node").alias("name")), "name", "left_anti")
    depth = _levels(edges.where("parent is not null").select("node", "parent"), roots)
    nodes = edges.join(labels.select("node").where("node is not null").distinct(), "node", "full").join(depth.withColumnRenamed("name", "node"), "node", "left")
    nodes = written(nodes.select("node", "parent", F.coalesce("silent", F.lit(False)).alias("silent"), F.coalesce("depth", F.lit(0)).alias("depth")), "nodes")

    keys = ["node", "label"]
    found = candidates.where("sense is not null").groupBy(*keys).agg(F.array_sort(F.collect_set(F.col("sense").cast("string"))).alias("left"))
    told = labels.select(*keys).where("node is not null and label is not null").distinct().join(found, keys, "left")
    if picks is None:
        told = told.withColumn("pick", F.lit(None).cast("struct<sense:string>"))
    else:
        told = told.join(picks.groupBy(*keys).agg(F.struct(F.min(F.col("sense").cast("string")).alias("sense")).alias("pick")), keys, "left")
    work = written(told.select(*keys, F.coalesce("left", F.array().cast(SENSES)).alias("left"), "pick").join(nodes.select("node", "depth"), "node"), "labels")
    above = above.select(F.col("sense").cast("string").alias("sense"), F.col("above").cast("string").alias("guide")).distinct()
    liked = None if preferred is None else preferred.select("node", F.col("sense").cast("string").alias("sense")).distinct()

    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    guides, out = None, []
    for level in range(deepest + 1):
        here = nodes.where(F.col("depth") == level)
        if guides is None:
            here = here.withColumn("guide", F.lit(None).cast(SENSES))
        else:
            here = here.join(guides.select(F.col("node").alias("parent"), "guide"), "parent", "left")
        rows = work.where(F.col("depth") == level).drop("depth").join(here.select("node", "guide"), "node")
        open_ = (F.size("left") > 1) & F.col("pick").isNull()
        if guides is not None:
            rows = _kept(rows, open_, rows.withColumn("guide", F.explode("guide")), above, ["sense", "guide"], False)
        if liked is not None:
            rows = _kept(rows, open_, rows, liked, ["node", "sense"], True)
        route = F.when(F.col("pick.sense").isNotNull(), "picked").when(F.col("pick").isNotNull(), "refused").when(F.size("left") == 1, "chosen").when(F.size("left") > 1, "ambiguous").otherwise("unmatched")
        sense = F.when(F.col("pick").isNotNull(), F.col("pick.sense")).when(F.size("left") == 1, F.col("left")[0])
        done = written(rows.select(*keys, sense.alias("sense"), route.alias("route"), "left"), "chosen")
        out.append(done)
        if level == deepest:
            break
        own = done.where("sense is not null").groupBy("node").agg(F.array_sort(F.collect_set("sense")).alias("own"))
        guides = written(here.join(own, "node", "left").select("node", F.coalesce(F.when(~F.col("silent"), F.col("own")), "guide").alias("guide")), "guides")
    whole = out[0]
    for part in out[1:]:
        whole = whole.union(part)
    return whole


def _levels(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(name, depth) of what is below roots (name), where each node has one parent: it is reached once, so that a level needn't be
    compared with those before."""
    level, depth = written(roots.select("name"), "roots"), 0
    out = level.withColumn("depth", F.lit(0))
    while True:
        below = written(edges.join(level.select(F.col("name").alias("parent")), "parent").select(F.col("node").alias("name")), "level")
        if below.isEmpty():
            return out
        level, depth = below, depth + 1
        out = out.union(level.withColumn("depth", F.lit(depth)))


def _kept(rows: DataFrame, open_: Column, spread: DataFrame, by: DataFrame, on: list[str], single: bool) -> DataFrame:
    """rows whose open candidates are only those that `by` has, where it has any (single: just one)."""
    held = spread.where(open_).withColumn("sense", F.explode("left")).join(by, on, "left_semi")
    held = held.groupBy("node", "label").agg(F.array_sort(F.collect_set("sense")).alias("held"))
    use = F.size("held") == 1 if single else F.size("held") > 0
    return rows.join(held, ["node", "label"], "left").withColumn("left", F.when(F.col("held").isNotNull() & use, F.col("held")).otherwise(F.col("left"))).drop("held")
