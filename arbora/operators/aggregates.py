"""Aggregations with an order of their own: best code, common prefix, majorities, merging by label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_code(rows: DataFrame, key: str, code: str, count: str) -> DataFrame:
    """One code for each key: the shortest, then the one with the fewest kinds, then the smallest."""
    return rows.groupBy(key).agg(F.min_by(code, F.struct(F.length(code), F.col(count), F.col(code))).alias(code))


def common_prefix(low: Column, high: Column) -> Column:
    """Of a sorted set, its smallest and largest share what all share."""
    n = F.least(F.length(low), F.length(high))
    same = F.filter(F.sequence(F.lit(0), n), lambda i: F.substring(low, F.lit(1), i) == F.substring(high, F.lit(1), i))
    return F.substring(low, F.lit(1), F.array_max(same))


def group_prefix(rows: DataFrame, key: str, code: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min(code).alias("_low"), F.max(code).alias("_high")).select(key, common_prefix(F.col("_low"), F.col("_high")).alias("prefix"))


def two_thirds(rows: DataFrame, key: str, choice: str, weight: str) -> DataFrame:
    """(key, choice): what holds at least two thirds of a key's weight."""
    held = rows.groupBy(key, choice).agg(F.sum(weight).alias("_n"))
    return held.withColumn("_all", F.sum("_n").over(Window.partitionBy(key))).where("3 * _n >= 2 * _all").select(key, choice)


SALT = "_salt"


def salted(rows: DataFrame, by: str) -> DataFrame:
    """rows with _salt, from what tells rows of one key apart: as many values as there are shuffle partitions."""
    return rows.withColumn(SALT, F.pmod(F.xxhash64(by), F.lit(max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))).cast("int"))


def per_salt(rows: DataFrame, keys: list[str], parts: list[Column], whole: list[Column]) -> DataFrame:
    """Aggregates of salted rows by keys, a row for each salt that a key has: (keys, _salt, whole).

    `parts` aggregate by key and salt, `whole` those by key.  What joins the result by keys and _salt meets its key's
    aggregate without all of the key's rows in one task, however many there are.
    """
    some = rows.groupBy(*keys, SALT).agg(*parts)
    return some.groupBy(*keys).agg(*whole, F.collect_list(SALT).alias("_salts")).withColumn(SALT, F.explode("_salts")).drop("_salts")


def merged_by_label(nodes: DataFrame) -> DataFrame:
    """nodes (id, label, ord, parents: array of ids) -> (id, label, parents): one node for each label, the first by ord;
    parents are those of all, pointed at the nodes that stay, without itself.

    A label that many nodes share is dealt to all tasks: its first node is found by salts, and joined back by them; a parent that
    many nodes have meets its own node the same way.
    """
    nodes = salted(nodes, "id")
    heads = per_salt(nodes, ["label"], [F.min(F.struct("ord", "id")).alias("_h")], [F.min("_h").alias("_h")]).select("label", SALT, F.col("_h.id").alias("head"))
    alias = nodes.join(heads, ["label", SALT]).select("id", "head", "parents", "label")
    up = salted(alias.select(F.col("head").alias("child"), F.explode("parents").alias("parent")).distinct(), "child")
    # Parents by salt: each one's node, for each salt of the children that name it.
    wanted = up.select("parent", SALT).distinct()
    to = wanted.join(alias.select(F.col("id").alias("parent"), F.col("head").alias("to")), "parent")
    up = up.join(to, ["parent", SALT]).where(F.col("child") != F.col("to")).groupBy(F.col("child").alias("head")).agg(F.array_sort(F.collect_set("to")).alias("parents"))
    kept = alias.where(F.col("id") == F.col("head")).select("head", "label").distinct()
    return kept.join(up, "head", "left").select(F.col("head").alias("id"), "label", F.coalesce("parents", F.array().cast("array<string>")).alias("parents"))


def coverage(rows: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows have each column: neither null nor empty."""
    return rows.agg(*[F.count(F.when(F.col(c) != "", 1)).alias(c) for c in columns])


def flag_counts(rows: DataFrame, flags: str) -> DataFrame:
    return rows.select(F.explode(F.split(flags, " ")).alias("flag")).where("flag != ''").groupBy("flag").agg(F.count("*").alias("n"))


def shown(values: Column, most: int = 3) -> Column:
    """The first few of a set, joined, with an ellipsis if there are more."""
    told = F.array_sort(F.array_distinct(values))
    return F.concat(F.array_join(F.slice(told, 1, most), "; "), F.when(F.size(told) > most, "; …").otherwise(""))
