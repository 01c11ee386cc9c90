"""Selections, reports and small relations: candidates, review filters, exclusions, listings, orders and pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbora.functions import text
from arbora.operators import graph
from arbora.operators.ranking import ranked
from arbora.operators.rules import TOP, constrained
from arbora.session import written

# Columns and predicates.


def with_default(rows: DataFrame, column: str, default: str) -> DataFrame:
    """rows whose column is there, the default where it is missing or null."""
    have = F.coalesce(F.col(column), F.lit(default)) if column in rows.columns else F.lit(default)
    return rows.withColumn(column, have)


def labelled(nodes: DataFrame) -> DataFrame:
    """nodes (id, label) with the id for a label that is null or empty."""
    return nodes.withColumn("label", F.coalesce(F.nullif("label", F.lit("")), "id"))


def is_goods(code: Column, sections: str = "0-4", divisions: tuple[str, ...] = ("53",)) -> Column:
    """A code of digits in the sections of goods, or in one of the divisions that count as such."""
    return code.rlike("^[0-9]+$") & code.rlike(f"^(?:[{sections}]|" + "|".join(divisions) + ")")


def is_sourced(*witnesses: Column) -> Column:
    """Any of the witnesses says y."""
    return F.array_contains(F.array(*[F.coalesce(w, F.lit("")) for w in witnesses]), "y")


def subset(small: Column, large: Column) -> Column:
    return F.size(F.array_except(small, large)) == 0


# Candidates.


def candidates_left(found: DataFrame, extra: DataFrame, known: DataFrame, dropped: DataFrame, owned: DataFrame) -> DataFrame:
    """found (offset), and of extra (offset) those that are known: without what is dropped or owned already, each once."""
    whole = found.select("offset").unionByName(extra.select("offset").join(known.select("offset"), "offset", "left_semi")).distinct()
    return whole.join(dropped.select("offset"), "offset", "left_anti").join(owned.select("offset"), "offset", "left_anti")


def hinged(closed: DataFrame, names: DataFrame, hinges: DataFrame, barred: DataFrame) -> DataFrame:
    """names (name) at or below one of the hinges (name), and neither at nor below what is barred (name)."""
    at = names.select("name", F.col("name").alias("sup")).union(closed.select(F.col("sub").alias("name"), "sup").join(names, "name", "left_semi"))
    under = lambda tops: at.join(tops.select(F.col("name").alias("sup")), "sup", "left_semi").select("name")
    return names.join(under(hinges), "name", "left_semi").join(under(barred), "name", "left_anti")


def everyday_words(dominant: DataFrame, frequency: DataFrame, least: float) -> DataFrame:
    """dominant (lemma: nouns that dominate) of one alphabetic word, with a frequency (lemma, zipf) of at least `least`."""
    return dominant.where(F.col("lemma").rlike(r"(?U)^\p{L}+$")).join(frequency.where(F.col("zipf") >= least), "lemma")


def not_excluded(rows: DataFrame, placed: DataFrame, banned: list[str], field: str = "quantity") -> DataFrame:
    """rows (offset, instance, field, usage: array) that aren't placed (offset), no instance, of another field than that, and of
    no banned usage."""
    usage = F.coalesce("usage", F.array().cast("array<string>"))
    kept = rows.where(~F.coalesce("instance", F.lit(False)) & (F.col("field") != field) & ~F.arrays_overlap(usage, F.array(*[F.lit(b) for b in banned]).cast("array<string>")))
    return kept.join(placed.select("offset"), "offset", "left_anti")


def open_reviews(decided: DataFrame, reviewed: DataFrame, placed: DataFrame, direct: DataFrame | None = None, witness: str | None = None, pack: str | None = None, origins: DataFrame | None = None, branch: DataFrame | None = None) -> DataFrame:
    """decided (sub, sup, status, for: array) that wait for a review: single ones that nobody reviewed (sub, sup), whose sup is
    placed (name).  Where asked for: that are stated directly (sub, sup), by this witness alone, with an end that the pack
    has (origins: name, origin), with a sub below the branch (name)."""
    name = lambda df, end: df.select(F.col("name").alias(end)).distinct()
    rows = decided.where("status = 'single'").join(reviewed.select("sub", "sup"), ["sub", "sup"], "left_anti").join(name(placed, "sup"), "sup", "left_semi")
    if direct is not None:
        rows = rows.join(direct.select("sub", "sup"), ["sub", "sup"], "left_semi")
    if witness:
        rows = rows.where(F.col("for") == F.array(F.lit(witness)))
    if pack:
        own = origins.where(F.col("origin") == pack)
        ends = rows.join(name(own, "sub"), "sub", "left_semi").select("sub", "sup").union(rows.join(name(own, "sup"), "sup", "left_semi").select("sub", "sup")).distinct()
        rows = rows.join(ends, ["sub", "sup"], "left_semi")
    if branch is not None:
        rows = rows.join(name(branch, "sub"), "sub", "left_semi")
    return rows


def single_sourced(decided: DataFrame, sources: list[str], by_ruling: bool = False) -> DataFrame:
    """Accepted pairs for which exactly one source speaks (or none, but a ruling): (sub, sup, witness)."""
    told = F.array_intersect("for", F.array(*[F.lit(s) for s in sources]))
    rows = decided.where("status = 'accepted'").withColumn("_w", told).where(F.size("_w") <= 1)
    rows = rows if by_ruling else rows.where(F.size("_w") == 1)
    return rows.select("sub", "sup", F.coalesce(F.get("_w", F.lit(0)), F.lit("ruling")).alias("witness"))


def fenced(matches: DataFrame, closed: DataFrame, root: str) -> DataFrame:
    """matches (name, ...) whose name is the root or below it."""
    inside = closed.where(F.col("sup") == root).select(F.col("sub").alias("name"))
    return matches.join(inside, "name", "left_semi").unionByName(matches.where(F.col("name") == root)).distinct()


def focused(entries: DataFrame, key: str, pack: str) -> DataFrame:
    """entries (key, pack, ...) of the keys that the pack has part in."""
    return entries.join(entries.where(F.col("pack") == pack).select(key).distinct(), key, "left_semi")


def prefixed(codes: DataFrame, rules: DataFrame, extra: DataFrame, lengths: list[int], default: list[str]) -> DataFrame:
    """codes (code) with the values of the longest rule (prefix, values: array), the default if none fits, and with those of
    every extra rule (prefix, values) that fits united in: (code, values), sorted."""
    from arbora.operators.joins import longest_prefix

    best = longest_prefix(codes, rules.withColumnRenamed("values", "value"), lengths).select("code", F.coalesce("value", F.array(*[F.lit(x) for x in default])).alias("values"))
    cut = codes.select("code", F.explode(F.array_distinct(F.array(*[F.substring("code", 1, n) for n in lengths]))).alias("prefix"))
    more = cut.join(extra, "prefix").select("code", F.explode("values").alias("v"))
    return best.select("code", F.explode("values").alias("v")).union(more).groupBy("code").agg(F.array_sort(F.collect_set("v")).alias("values"))


def first_seen(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key, by order."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), order).alias("_r")).select("_r.*")


# Graph reports.


def tree_lines(edges: DataFrame, roots: DataFrame, sizes: DataFrame, depth: int, least: int = 0) -> DataFrame:
    """(key, depth, name, line): an indented listing down to a depth, in the order of key: children by cone, then name, those of
    at least `least`.  A name with several parents stands below each, with a note of how many more it has."""
    edges = written(graph.edges_of(edges), "edges")
    own = sizes.select("name", "cone").join(edges.groupBy(F.col("sub").alias("name")).agg((F.count("*") - 1).alias("more")), "name", "left").select("name", "cone", F.coalesce("more", F.lit(0)).alias("more"))
    step = F.struct((-F.col("cone")).alias("o"), F.col("name").alias("n"))
    level = written(roots.join(own, "name").select("name", "cone", "more", F.lit(0).alias("depth"), F.array(step).alias("key")), "lines")
    out = level
    down = edges.withColumnsRenamed({"sup": "name", "sub": "child"})
    for i in range(1, depth + 1):
        below = level.select("name", "key").join(down, "name").select(F.col("child").alias("name"), "key").join(own, "name").where(F.col("cone") >= least)
        level = written(below.select("name", "cone", "more", F.lit(i).alias("depth"), F.array_append("key", step).alias("key")), "lines")
        out = out.union(level)
    note = F.when(F.col("more") > 0, F.concat(F.lit("  (+"), F.col("more"), F.lit(" parent)"))).otherwise("")
    return out.select("key", "depth", "name", F.concat(F.repeat(F.lit("  "), F.col("depth")), "name", F.lit("  ["), "cone", F.lit("]"), note).alias("line"))


def cut_down(edges: DataFrame, roots: DataFrame, sizes: DataFrame, k: int, depth: int) -> DataFrame:
    """(sup, sub, level): from the roots, the k largest children of each name reached, down to a depth."""
    top = written(graph.top_children(edges, sizes, k).select("sup", "sub"), "children")
    level, out = roots.select("name"), None
    for i in range(1, depth + 1):
        found = written(top.join(level.distinct().withColumnRenamed("name", "sup"), "sup").select("sup", "sub", F.lit(i).alias("level")), "level")
        out = found if out is None else out.union(found)
        level = found.select(F.col("sub").alias("name"))
    return out.groupBy("sup", "sub").agg(F.min("level").alias("level"))


def store_names_above(names: DataFrame, closed: DataFrame) -> DataFrame:
    """names (name, offset) and the closure of offsets -> (name, reached): the names of a store that a walk up from each name's
    synset reaches."""
    own = names.where("offset is not null")
    up = own.join(closed.select(F.col("sub").alias("offset"), "sup").where("sub != sup"), "offset").select("name", F.col("sup").alias("offset"))
    return up.join(own.select(F.col("name").alias("reached"), "offset"), "offset").select("name", "reached").distinct()


def walks_in_turn(edges: DataFrame, roots: list[tuple[str, int]]) -> DataFrame:
    """(sub, sup): edges met by walking so many levels below each root, one root after the other, where what was seen before
    isn't walked from again; and every edge among all that was seen.  Roots are few: people list them."""
    edges = written(graph.edges_of(edges), "edges")
    spark = edges.sparkSession
    names = spark.createDataFrame([(r,) for r, _ in roots], "name string").distinct()
    seen, met = written(names, "seen"), []
    for root, depth in roots:
        front = spark.createDataFrame([(root,)], "name string")
        for _ in range(depth):
            found = written(edges.join(front.withColumnRenamed("name", "sup"), "sup", "left_semi").select("sub", "sup"), "met")
            met.append(found)
            front = written(found.select(F.col("sub").alias("name")).distinct().join(seen, "name", "left_anti"), "front")
            if front.isEmpty():
                break
            seen = written(seen.union(front), "seen")
    return reduce(DataFrame.union, met, graph.induced(edges, seen)).distinct()


def preorder(edges: DataFrame, roots: DataFrame, order: str) -> DataFrame:
    """(key, name) of a tree, edges (sub, sup, order): sorted by key, a name comes before all below it, and children come in
    turn, the last first."""
    w = Window.partitionBy("sup").orderBy(F.desc(order), F.desc("sub"))
    down = written(edges.withColumn("n", F.row_number().over(w)).select(F.col("sup").alias("name"), F.col("sub").alias("child"), "n"), "children")
    level = written(roots.select("name", F.array().cast("array<int>").alias("key")), "keys")
    out = level
    while not level.isEmpty():
        level = written(level.join(down, "name").select(F.col("child").alias("name"), F.array_append("key", F.col("n")).alias("key")), "keys")
        out = out.union(level)
    return out.select("key", "name")


def added_at_top(before: DataFrame, after: DataFrame) -> DataFrame:
    """(name): straight below the root afterwards, but not before."""
    top = lambda df: df.where(F.col("sup") == TOP).select(F.col("sub").alias("name")).distinct()
    return top(after).join(top(before), "name", "left_anti")


def mentions(edges: DataFrame) -> DataFrame:
    """edges (store, sub, sup) -> (name, store, sub, how): who has a name as a parent, or as what a term constrains."""
    parent = edges.where(F.col("sup") != TOP).select(F.col("sup").alias("name"), "store", "sub", F.lit("parent").alias("how"))
    term = edges.where(constrained(F.col("sup")) != F.col("sup")).select(constrained(F.col("sup")).alias("name"), "store", "sub", F.lit("argument").alias("how"))
    return parent.where(~F.col("name").contains("(")).union(term).distinct()


def with_glosses(edges: DataFrame, glosses: DataFrame, width: int = 70) -> DataFrame:
    """edges (sub, sup, ...) with the glosses (name, gloss) of both ends, cut to a width; none is empty."""
    out = edges
    for end in ("sub", "sup"):
        told = glosses.select(F.col("name").alias(end), F.substring("gloss", 1, width).alias(f"{end}_gloss"))
        out = out.join(told, end, "left").withColumn(f"{end}_gloss", F.coalesce(f"{end}_gloss", F.lit("")))
    return out


def degrees(edges: DataFrame) -> DataFrame:
    """One row: edges, names that have children, the most children of one."""
    by = graph.edges_of(edges).groupBy("sup").agg(F.count("*").alias("n"))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("edges"), F.count("*").alias("parents"), F.max("n").alias("most"))


def placed_with(accepted: DataFrame, extra: DataFrame, roots: DataFrame) -> DataFrame:
    """(name): what is placed if extra edges (sub, sup) count like accepted ones."""
    return graph.reachable(accepted.select("sub", "sup").union(extra.select("sub", "sup")), roots)


def shipped_entries(edges: DataFrame, core: DataFrame, shipped: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """edges (store, sub, sup) of packs -> what is generated for each shipped pack: own (store, sub, sup), borrowed (store, name)
    and uses (store, other).

    Own are entries with parents.  Borrowed are names without, that own entries mention and the core (name) doesn't have;
    if no other shipped pack owns one but a pack that isn't shipped does, its claim is carried as an own entry, from the
    first such pack.  Uses are the packs whose own entries the borrowed names are.
    """
    real = edges.where(F.col("sup") != TOP).select("store", "sub", "sup")
    here = F.col("store").isin(*shipped)
    said = real.where(here).select("store", constrained(F.col("sup")).alias("name")).distinct()
    bare = edges.where(here).groupBy("store", F.col("sub").alias("name")).agg(F.max(F.col("sup") != TOP).alias("real")).where("not real")
    bare = bare.select("store", "name").join(said, ["store", "name"], "left_semi").join(core.select("name"), "name", "left_anti").select("store", "name")
    owners = real.select(F.col("store").alias("other"), F.col("sub").alias("name")).distinct()
    pairs = bare.join(owners, "name").where("store != other")
    known = pairs.where(F.col("other").isin(*shipped)).select("store", "name").distinct()
    carried = pairs.join(known, ["store", "name"], "left_anti").groupBy("store", "name").agg(F.min("other").alias("other"))
    claims = carried.join(real.select(F.col("store").alias("other"), F.col("sub").alias("name"), "sup"), ["other", "name"]).select("store", F.col("name").alias("sub"), "sup")
    borrowed = bare.join(carried.select("store", "name"), ["store", "name"], "left_anti")
    uses = borrowed.join(owners, "name").where("store != other").select("store", "other").distinct()
    return real.where(here).union(claims), borrowed, uses


# Counts.


def single_source_counts(pairs: DataFrame) -> DataFrame:
    """pairs (for: array) -> (source, n): pairs that one source alone speaks for."""
    return pairs.where(F.size("for") == 1).groupBy(F.col("for")[0].alias("source")).agg(F.count("*").alias("n"))


def conditional_counts(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row: how many rows meet each condition; null counts as no."""
    return rows.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])


def excluded_by_top(types: DataFrame, name: str = "media_type") -> DataFrame:
    """(top, n): types of vendors, persons and experiments, by what they are below."""
    return types.where(F.col(name).rlike(r"^[^/]+/(?:vnd\.|prs\.|x-)")).groupBy(F.split_part(name, F.lit("/"), F.lit(1)).alias("top")).agg(F.count("*").alias("n"))


def precision_at(rows: DataFrame, score: str, ties: str, positive: str, top: int = 100) -> DataFrame:
    """One row: n, positives, base (their rate) and precision among the `top` rows of the largest scores, later ties first."""
    first = rows.orderBy(F.desc(score), F.desc(ties)).limit(top).agg(F.avg(F.col(positive).cast("double")).alias("precision"))
    whole = rows.agg(F.count("*").alias("n"), F.sum(F.col(positive).cast("long")).alias("positives"), F.avg(F.col(positive).cast("double")).alias("base"))
    return whole.join(F.broadcast(first))


def drift(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side): what stands on one side only, old or new."""
    a, b = old.select(*keys).distinct(), new.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("side", F.lit("old")).unionByName(b.join(a, keys, "left_anti").withColumn("side", F.lit("new")))


# Orders and pages.


def in_order(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with place, from 0, in a total order: a sorted report, sorted across tasks."""
    return ranked(rows, list(order), "place")


def by_weight(rows: DataFrame, counted: str, zipf: str, name: str) -> DataFrame:
    """The most usual first: by tags and ten times the frequency, then by name."""
    return in_order(rows, (F.col(counted) + 10 * F.col(zipf)).desc(), F.col(name).asc())


def shortest_first(rows: DataFrame, code: str) -> DataFrame:
    return in_order(rows, F.length(code).asc(), F.col(code).asc())


def page(rows: DataFrame, order: list[Column], skip: int, limit: int) -> DataFrame:
    return rows.orderBy(*order).offset(skip).limit(limit)


# Senses.


def sense_rank(names: DataFrame, senses: DataFrame) -> DataFrame:
    """names (name, lemma, offset), senses (lemma, offsets: array in order) -> names with rank from 1, null if it isn't there."""
    told = names.join(senses.select("lemma", "offsets"), "lemma", "left")
    return told.withColumn("rank", F.nullif(F.array_position("offsets", F.col("offset")).cast("int"), F.lit(0))).drop("offsets")


def sense_bag(synset: DataFrame, lemma: DataFrame, hyponyms: int = 30) -> DataFrame:
    """synset (offset, lemmas, gloss, examples, above: array), lemma (lemma, offset) -> (lemma, offset, word, n): the words that
    stand for a sense: its other lemmas, twice, its gloss, and without the lemma's own words its examples and the lemmas
    of what is above it and of the first hyponyms, by offset."""
    none = F.array().cast("array<string>")
    words = lambda c: F.flatten(F.transform(F.coalesce(c, F.array().cast("array<string>")), text.tokens))
    told = synset.select("offset", words(F.col("lemmas")).alias("mine"), text.tokens(F.coalesce("gloss", F.lit(""))).alias("gloss"), text.tokens(F.coalesce("examples", F.lit(""))).alias("examples"), F.coalesce("above", none).alias("above"))
    links = told.select("offset", F.explode("above").alias("to"))
    w = Window.partitionBy("to").orderBy("offset")
    below = links.withColumn("k", F.row_number().over(w)).where(F.col("k") <= hyponyms).select(F.col("to").alias("offset"), F.col("offset").alias("to"))
    around = links.union(below).join(told.select(F.col("offset").alias("to"), F.col("mine").alias("theirs")), "to").select("offset", F.explode("theirs").alias("word"))
    own = lemma.select("lemma", "offset", text.tokens(F.translate("lemma", "_", " ")).alias("own"))
    rows = own.join(told, "offset")
    free = ~F.array_contains("own", F.col("word"))
    say = lambda c, times, every: rows.select("lemma", "offset", "own", F.explode(c).alias("word")).where(F.lit(True) if every else free).select("lemma", "offset", "word", F.lit(times).alias("n"))
    near = own.join(around, "offset").where(free).select("lemma", "offset", "word", F.lit(1).alias("n"))
    whole = say("mine", 2, False).union(say("gloss", 1, True)).union(say("examples", 1, False)).union(near)
    return whole.groupBy("lemma", "offset", "word").agg(F.sum("n").alias("n"))


def later_targets(log: DataFrame) -> DataFrame:
    """log (seq, pack, sub, action, old, new) with what later rows on the same name do: readded (parents that they give) and
    removed (parents that they take away), sorted, and dropped."""
    w = Window.partitionBy("pack", "sub").orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    none = F.array().cast("array<string>")
    words = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), " "), lambda x: ~x.isin("", "-"))
    given = F.when(F.col("action").isin("move", "parent+", "add"), words("new")).otherwise(none)
    taken = F.when(F.col("action").isin("move", "cut"), words("old")).otherwise(none)
    told = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c).over(w)))), " ")
    return log.withColumns({"readded": told(given), "removed": told(taken), "dropped": F.coalesce(F.max(F.col("action") == "drop").over(w), F.lit(False))})


