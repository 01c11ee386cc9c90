"""Witnesses, the vote on each pair, evidence classes, and review queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arbora.session import written


def _none():
    return F.array().cast("array<string>")


def witnesses(stated: DataFrame) -> DataFrame:
    """stated (source, sub, sup) -> (sub, sup, for, against): sorted distinct sources of the pair and of its reverse.

    One aggregation by the unordered pair gives both sides, so that no join is needed.
    """
    flip = F.col("sub") > F.col("sup")
    low, high = F.least("sub", "sup"), F.greatest("sub", "sup")
    sides = stated.where("sub is not null and sup is not null and source is not null").groupBy(low.alias("low"), high.alias("high")).agg(
        F.array_sort(F.collect_set(F.when(~flip, F.col("source")))).alias("up"), F.array_sort(F.collect_set(F.when(flip, F.col("source")))).alias("down"))
    return both_ways(sides)


def both_ways(sides: DataFrame) -> DataFrame:
    """sides (low, high, up, down: sources that state high above low, or low above high) -> (sub, sup, for, against)."""
    both = F.when(F.col("low") == F.col("high"), F.array(F.struct("low", "high", F.col("up").alias("for"), F.col("up").alias("against")))).otherwise(F.array(
        F.struct("low", "high", F.col("up").alias("for"), F.col("down").alias("against")), F.struct(F.col("high").alias("low"), F.col("low").alias("high"), F.col("down").alias("for"), F.col("up").alias("against"))))
    return sides.select(F.explode(both).alias("x")).select(F.col("x.low").alias("sub"), F.col("x.high").alias("sup"), F.col("x.for").alias("for"), F.col("x.against").alias("against")).where(F.size("for") > 0)


def published(pairs: DataFrame, entailed: DataFrame) -> DataFrame:
    """Adds published to pairs (sub, sup): whether a published store entails them; such pairs stay accepted unless a ruling
    rejects them."""
    told = entailed.select("sub", "sup").distinct().withColumn("published", F.lit(True))
    return pairs.join(told, ["sub", "sup"], "left").withColumn("published", F.coalesce("published", F.lit(False)))


def ruled(stated: DataFrame, rulings: DataFrame) -> DataFrame:
    """Adds to stated the witness that each ruling (ruler, sub, sup, decision) is: an acceptance states the pair."""
    accept = rulings.where("decision = 'accept'")
    return stated.select("source", "sub", "sup").unionByName(accept.select(F.col("ruler").alias("source"), "sub", "sup"))


def last_verdicts(reviews: DataFrame, precedence: dict[str, int] | None = None) -> DataFrame:
    """reviews (sub, sup, decision, ord[, ruler]) -> (sub, sup, decision): a ruler of higher precedence wins, then the last."""
    rank = F.lit(0)
    for name, level in (precedence or {}).items():
        rank = F.when(F.col("ruler") == name, level).otherwise(rank)
    return reviews.groupBy("sub", "sup").agg(F.max_by("decision", F.struct(rank.alias("r"), "ord")).alias("decision"))


def status(pairs: DataFrame, least: int = 2) -> DataFrame:
    """Adds status, by the first rule that holds, to pairs with columns for, against (arrays), ruling ('accept', 'reject' or
    null), dissent, published and, for packs, base (both ends are in the base) and placed (sub is placed there):

    published and not rejected: accepted; both ends base (unless accepted and sub isn't placed): skipped; rejected or accepted
    by a ruling; any reversal: disputed; a dissent and fewer than `least` witnesses: dissented; `least` witnesses:
    accepted; else single.
    """
    has = lambda name, of=False: F.coalesce(F.col(name), F.lit(of)) if name in pairs.columns else F.lit(of)
    ruling = F.coalesce(F.col("ruling"), F.lit(""))
    enough = F.size("for") >= least
    told = (
        F.when(has("published") & (ruling != "reject"), "accepted")
        .when(has("base") & ~((ruling == "accept") & ~has("placed")), "skipped")
        .when(ruling == "reject", "rejected").when(ruling == "accept", "accepted")
        .when(F.size("against") > 0, "disputed")
        .when(has("dissent") & ~enough, "dissented")
        .when(enough, "accepted").otherwise("single")
    )
    contradicted = has("published") & (ruling == "") & (F.size("against") > 0)
    return pairs.withColumn("status", told).withColumn("contradicted", contradicted)


def evidence_class(entailed: DataFrame) -> DataFrame:
    """Adds class to (E, T, R: arrays of sources that entail the pair, could test it, entail its reverse)."""
    e, t, r = (F.size(F.col(c)) for c in ("E", "T", "R"))
    return entailed.withColumn("class", F.when((r > 0) & (e == 0), "reversed").when(e >= 2, "2+").when(e == 1, "1").when(t > 0, "0-testable").otherwise("0-untestable"))


def closure_check(pairs: DataFrame, entails: DataFrame, sources: list[str]) -> DataFrame:
    """pairs (sub, sup) with E, T, R and class.  A source can test a pair if both ends stand in it; sources keep their
    given order."""
    order = F.array(*[F.lit(s) for s in sources])
    in_order = lambda found: F.filter(order, lambda s: F.array_contains(F.coalesce(found, _none()), s))
    seen = entails.select("source", F.col("sub").alias("name")).union(entails.select("source", "sup")).groupBy("name").agg(F.collect_set("source").alias("known"))
    up = entails.groupBy("sub", "sup").agg(F.collect_set("source").alias("e"))
    told = pairs.join(up, ["sub", "sup"], "left").join(up.select(F.col("sup").alias("sub"), F.col("sub").alias("sup"), F.col("e").alias("r")), ["sub", "sup"], "left")
    told = told.join(seen.select(F.col("name").alias("sub"), F.col("known").alias("a")), "sub", "left").join(seen.select(F.col("name").alias("sup"), F.col("known").alias("b")), "sup", "left")
    both = F.array_intersect(F.coalesce("a", _none()), F.coalesce("b", _none()))
    return evidence_class(told.select("sub", "sup", in_order(F.col("e")).alias("E"), in_order(both).alias("T"), in_order(F.col("r")).alias("R")))


def review_queue(decided: DataFrame, placed: DataFrame, cycles: DataFrame) -> DataFrame:
    """(section, sub, sup) in the order of sections: cycle, contradicted, disputed, single with both ends placed, unplaced.

    All sections read what is decided, which is written once rather than decided for each.
    """
    decided = written(decided.select("sub", "sup", "status", "contradicted"), "decided")
    here = placed.select("name").distinct()
    single = decided.where("status = 'single'").join(here.withColumnRenamed("name", "sub"), "sub", "left_semi").join(here.withColumnRenamed("name", "sup"), "sup", "left_semi")
    missing = decided.select(F.col("sub").alias("name")).union(decided.select("sup")).distinct().join(here, "name", "left_anti")
    section = lambda df, n, name: df.select(F.lit(n).alias("section_ord"), F.lit(name).alias("section"), "sub", "sup")
    parts = [section(cycles, 0, "cycle"), section(decided.where("contradicted"), 1, "contradicted"), section(decided.where("status = 'disputed'"), 2, "disputed"), section(single, 3, "single")]
    first = Window.partitionBy("sub").orderBy("sup")
    hints = decided.join(missing.withColumnRenamed("name", "sub"), "sub", "left_semi").select("sub", "sup").distinct().withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= 8)
    hints = hints.groupBy("sub").agg(F.array_join(F.array_sort(F.collect_set("sup")), " ").alias("sup"))
    parts.append(section(missing.withColumnRenamed("name", "sub").join(hints, "sub", "left"), 4, "unplaced"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def judged(batch: DataFrame, rejects: DataFrame) -> DataFrame:
    """A batch (sub, sup) with decision: everything is accepted that isn't rejected.  A reject outside the batch is an error."""
    stray = rejects.join(batch, ["sub", "sup"], "left_anti").limit(5).collect()
    if stray:
        raise ValueError(f"rejects that aren't in the batch: {[(r['sub'], r['sup']) for r in stray]}")
    told = rejects.select("sub", "sup", F.lit("reject").alias("decision")).distinct()
    return batch.join(told, ["sub", "sup"], "left").withColumn("decision", F.coalesce("decision", F.lit("accept")))


def verdict(text):
    """'yes, but ...' -> true, 'n' -> false, anything else -> null."""
    word = F.regexp_extract(F.lower(F.trim(text)), "^([a-z]+)", 1)
    return F.when(word.isin("yes", "y"), True).when(word.isin("no", "n"), False)


def external_names(concepts: DataFrame, pack: str, base: DataFrame) -> DataFrame:
    """(name): what sibling packs have of their own: concepts (pack, name, origin) of others whose origin is neither base
    nor empty, without the base's (name) and this pack's own."""
    others = concepts.where((F.col("pack") != pack) & (F.coalesce("origin", F.lit("")) != "") & (F.col("origin") != "base")).select("name").distinct()
    own = concepts.where((F.col("pack") == pack) & (F.col("origin") == pack)).select("name")
    return others.join(base.select("name"), "name", "left_anti").join(own, "name", "left_anti")


def owned_edges(accepted: DataFrame, placed: DataFrame, concepts: DataFrame, base: DataFrame, external: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a pack writes: its own names (name), and their accepted parents (sub, sup) that are placed.

    Own are placed names beyond the base (name) that the pack has as concepts (name), makes a claim about, or that no
    sibling has (external: name); names that it only hangs things from stay borrowed.
    """
    mine = placed.select("name").distinct().join(base.select("name"), "name", "left_anti")
    claims = concepts.select("name").union(accepted.select("sub")).distinct()
    own = mine.join(claims, "name", "left_semi").union(mine.join(external.select("name"), "name", "left_anti")).distinct()
    edges = accepted.select("sub", "sup").distinct().join(own.withColumnRenamed("name", "sub"), "sub", "left_semi").join(placed.select(F.col("name").alias("sup")).distinct(), "sup", "left_semi")
    return own, edges.select("sub", "sup")
