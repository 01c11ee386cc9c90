"""Joins by identity, by unique label, by prefix, and by ordered precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbora.operators.aggregates import SALT, salted
from arbora.session import written


def label_matches(concepts: DataFrame, labels: DataFrame) -> DataFrame:
    """concepts (name, key) x labels (key, id) -> (name, ids): sorted ids under the name's key; qualified names (with a
    point) are left out."""
    return concepts.where(~F.col("name").contains(".")).join(labels.select("key", "id").distinct(), "key").groupBy("name").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def bounded_matches(concepts: DataFrame, labels: DataFrame, shown: int = 6) -> DataFrame:
    """As label_matches, with the first `shown` ids and n, how many there are: (name, ids, n).

    Ids of a key are counted, and its first ones found, by salts, so that a key may have any number of them; what meets the
    concepts is one row for each key.
    """
    told = salted(labels.where("key is not null and id is not null").select("key", "id").distinct(), "id")
    first = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
    some = told.withColumn("_n", first("key", SALT)).where(F.col("_n") <= shown).withColumn("_n", first("key")).where(F.col("_n") <= shown)
    ids = some.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    n = told.groupBy("key", SALT).agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("n"))
    return concepts.where(~F.col("name").contains(".")).select("name", "key").distinct().join(ids.join(n, "key"), "key").select("name", "ids", "n")


def unique_matches(matches: DataFrame) -> DataFrame:
    return matches.where(F.size("ids") == 1).select("name", F.col("ids")[0].alias("id"))


def ambiguous_matches(matches: DataFrame, shown: int = 6) -> DataFrame:
    """Names with several ids: the first of them, and how many there are."""
    n = F.col("n") if "n" in matches.columns else F.size("ids")
    return matches.where(n > 1).select("name", F.slice("ids", 1, shown).alias("ids"), n.cast("int").alias("n"))


def hub_join(concepts: DataFrame, mapping: DataFrame, nodes: DataFrame) -> DataFrame:
    """concepts (name, hub) with the id that mapping (hub, id) gives, if the id stands in nodes (id)."""
    return concepts.join(mapping.join(nodes.select("id").distinct(), "id", "left_semi"), "hub", "left")


def view(alignment: DataFrame, closed: DataFrame) -> DataFrame:
    """alignment (name, id, exact) and the closure of the ids -> pairs (sub, sup) that the source entails.

    Only exact alignments may stand above; a name that isn't exact is also below its own id; names of one id entail nothing.
    """
    above = alignment.where("exact and id is not null").select(F.col("id").alias("sup_id"), F.col("name").alias("sup")).distinct()
    up = closed.select(F.col("sub").alias("id"), F.col("sup").alias("sup_id"))
    own = alignment.where("not exact").select("name", F.col("id").alias("sup_id"))
    pairs = written(alignment.select("name", "id").join(up.where("id != sup_id"), "id").select("name", "sup_id").union(own).where("sup_id is not null").distinct(), "pairs")
    above = written(above.join(above.groupBy("sup").agg((F.count("*") > 1).alias("several")), "sup").select("sup_id", "sup", "several"), "above")
    # Only a name of several ids can be met twice; for the others nothing is gathered.
    once, again = (_in_blocks(pairs, above.where(F.col("several") == several)).where("name != sup").select(F.col("name").alias("sub"), "sup") for several in (False, True))
    return once.union(again.distinct())


def _in_blocks(pairs: DataFrame, above: DataFrame, size: int = 4096) -> DataFrame:
    """pairs (name, sup_id) and above (sup_id, sup) joined by sup_id, in blocks of some `size` rows of both, so that an id may have any
    number of either."""
    blocks = lambda df, n: df.groupBy("sup_id").agg(F.ceil(F.count("*") / size).cast("int").alias(n))
    sizes = blocks(pairs, "xs").join(blocks(above, "ys"), "sup_id")
    block = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = pairs.join(sizes, "sup_id").select("sup_id", block("name", "xs").alias("x"), every("ys").alias("y"), "name")
    b = above.join(sizes, "sup_id").select("sup_id", every("xs").alias("x"), block("sup", "ys").alias("y"), "sup")
    return a.join(b, ["sup_id", "x", "y"])


def overlaid(files: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The value of the last row of each key."""
    return files.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def overridden(value: Column, override: Column) -> Column:
    """`-` clears, anything else replaces, null and empty leave."""
    return F.when(override == "-", "").when(F.coalesce(override, F.lit("")) != "", override).otherwise(value)


def longest_prefix(codes: DataFrame, rules: DataFrame, lengths: list[int]) -> DataFrame:
    """codes (code) with the value of the longest rule (prefix, value) that the code begins with.

    One equality join by prefixes of each length, not a comparison of every code with every rule.
    """
    cut = codes.select("code", F.explode(F.array_distinct(F.array(*[F.substring("code", 1, n) for n in lengths]))).alias("prefix"))
    best = cut.join(rules, "prefix").groupBy("code").agg(F.max_by("value", F.length("prefix")).alias("value"), F.max_by("prefix", F.length("prefix")).alias("prefix"))
    return codes.join(best, "code", "left")


def prefix_parents(codes: DataFrame, cut: int = 1) -> DataFrame:
    """codes (code) -> edges to the code without its last character(s), where there is one."""
    return codes.select(F.col("code").alias("sub"), F.expr(f"substring(code, 1, length(code) - {int(cut)})").alias("sup")).join(codes.select(F.col("code").alias("sup")), "sup", "left_semi").select("sub", "sup")


def path_parents(paths: DataFrame) -> DataFrame:
    """paths (path: array) -> edges between a path and all of it but the last step."""
    up = paths.where(F.size("path") > 1).select(F.col("path").alias("sub"), F.slice("path", F.lit(1), F.size("path") - 1).alias("sup"))
    return up.join(paths.select(F.col("path").alias("sup")), "sup", "left_semi").select("sub", "sup")


def renamed(name: Column, renames: list[tuple[str, str]]) -> Column:
    """Renames in sequence: a name that one row frees may be taken by a later one."""
    if not renames:
        return name
    steps = F.array(*[F.struct(F.lit(a).alias("old"), F.lit(b).alias("new")) for a, b in renames])
    return F.aggregate(steps, name, lambda n, r: F.when(n == r["old"], r["new"]).otherwise(n))


def identity_collisions(entries: DataFrame) -> DataFrame:
    """entries (pack, name, ident) -> (kind, key, found): an identity under several names, a name under several
    identities, a name of a pack that the core has too."""
    by = lambda df, kind, key, found: df.groupBy(F.lit(kind).alias("kind"), F.col(key).alias("key")).agg(F.array_join(F.array_sort(F.collect_set(found)), " ").alias("found"), F.count_distinct(found).alias("n")).where("n > 1").select("kind", "key", "found")
    given = entries.where("ident is not null and ident != ''")
    core = entries.where("pack = 'core'").select("name").distinct()
    again = entries.where("pack != 'core'").join(core, "name", "left_semi").groupBy(F.lit("in-core").alias("kind"), F.col("name").alias("key")).agg(F.array_join(F.array_sort(F.collect_set("pack")), " ").alias("found"))
    return by(given, "names", "ident", "name").unionByName(by(given, "identities", "name", "ident")).unionByName(again)
