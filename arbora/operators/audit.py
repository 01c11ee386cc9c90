"""Senses and names: first senses, dominance, audit flags and what they recommend, names for new synsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arbora.functions.vectors import cosine
from arbora.operators.ranking import centroids, first_per_group, longest, ranked


def gold_first_senses(counts: DataFrame, least: int = 5) -> DataFrame:
    """counts (lemma, offset, count) -> (lemma, offset): the first of two or more senses, tagged `least` times and twice
    as often as the next."""
    order = F.reverse(F.array_sort(F.collect_list(F.struct("count", "offset"))))
    told = counts.groupBy("lemma").agg(order.alias("s")).where(F.size("s") > 1)
    top, following = F.col("s")[0]["count"], F.col("s")[1]["count"]
    return told.where((top >= least) & (top >= 2 * following)).select("lemma", F.col("s")[0]["offset"].alias("offset"))


def first_senses(bags: DataFrame, words: DataFrame, vectors: DataFrame) -> DataFrame:
    """The direct method: bags (lemma, offset, word), words (lemma, key), vectors (word, vector) -> (lemma, offset, sim,
    place): senses by the cosine of the lemma's vector and the mean vector of the sense's bag, for two senses or more.  Cosines
    are compared to nine digits, so that the order of sums doesn't tell."""
    known = vectors.select("word", "vector")
    means = centroids(bags.join(known, "word").withColumn("sense", F.struct("lemma", "offset")), "sense", "vector", longest(known, "vector")).select("sense.lemma", "sense.offset", "centroid")
    own = words.join(known.select(F.col("word").alias("key"), "vector"), "key").select("lemma", "vector")
    told = means.join(own, "lemma").select("lemma", "offset", cosine(F.col("centroid"), F.col("vector")).alias("sim"))
    several = told.groupBy("lemma").agg(F.count("*").alias("n")).where("n > 1").select("lemma")
    return first_per_group(told.join(several, "lemma", "left_semi"), ["lemma"], [F.round("sim", 9).desc(), F.col("offset")], 1 << 30)


def neighbour_votes(similar: DataFrame, k: int = 50) -> DataFrame:
    """The neighbours' method: similar (lemma, voter, sense, sim) -> (lemma, sense, votes): each lemma's k most similar
    voters split one vote each among its senses, by their similarity to them, negative ones counting as none."""
    best = similar.groupBy("lemma", "voter").agg(F.max("sim").alias("near"))
    chosen = first_per_group(best, ["lemma"], [F.desc("near"), F.col("voter")], k).select("lemma", "voter")
    own = similar.join(chosen, ["lemma", "voter"], "left_semi").withColumn("w", F.greatest("sim", F.lit(0.0)))
    share = F.sum("w").over(Window.partitionBy("lemma", "voter"))
    return own.withColumn("vote", F.when(share > 0, F.col("w") / share).otherwise(0.0)).groupBy("lemma", "sense").agg(F.sum("vote").alias("votes"))


def noun_dominant(counts: DataFrame) -> DataFrame:
    """counts (lemma, pos, count) -> (lemma, n, v, a, r): lemmas whose noun uses are at least as many as any other's."""
    wide = counts.groupBy("lemma").pivot("pos", ["n", "v", "a", "r"]).sum("count").na.fill(0)
    return wide.where(F.col("n") >= F.greatest("v", "a", "r"))


def audit_flags(rows: DataFrame) -> DataFrame:
    """Adds flags and recommendation to rows (name, held, ref, everyday: array of offsets, ref_tags, held_tags, total_tags,
    holder, disjoint, off, leaf, used, senses):

    no-synset: nothing is held; rare-sense: the held sense isn't the reference nor everyday, and either an everyday sense
    exists or the reference has more tags; held-by: another name holds the reference; disjoint and off-wordnet as given;
    shrink: an unused leaf with senses, not everyday, of at most one tag.
    """
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    everyday = F.coalesce("everyday", F.array().cast("array<string>"))
    held_everyday = F.coalesce(F.array_contains(everyday, F.col("held")), F.lit(False))
    other = F.coalesce(F.col("held") != F.col("ref"), F.lit(False))
    rare = other & ~held_everyday & ((F.size(everyday) > 0) | (zero("ref_tags") > zero("held_tags")))
    held_by = F.coalesce(F.col("holder") != F.col("name"), F.lit(False))
    shrink = yes("leaf") & ~yes("used") & ~held_everyday & (zero("total_tags") <= 1) & (zero("senses") > 0)
    named = (("no-synset", F.col("held").isNull()), ("rare-sense", rare), ("held-by", held_by), ("disjoint", yes("disjoint")), ("off-wordnet", yes("off")), ("shrink", shrink))
    flags = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in named]))
    has = lambda n: F.array_contains("flags", n)
    advice = F.when(has("rare-sense"), F.when(has("held-by"), "rename").otherwise("resense")).when(has("disjoint"), "split").when(has("shrink"), "drop").otherwise("")
    return rows.withColumn("flags", flags).withColumn("recommendation", advice)


def trial_acceptance(rows: DataFrame) -> DataFrame:
    """Adds accepted to rows (ruling, standard, alone, sourced): a ruling decides; else a reading under the standard that is
    alone or sourced."""
    return rows.withColumn("accepted", F.coalesce("ruling", F.coalesce("standard", F.lit(False)) & (F.coalesce("alone", F.lit(False)) | F.coalesce("sourced", F.lit(False)))))


def media_route(registered: DataFrame, formats: DataFrame) -> DataFrame:
    """registered (media_type), formats (name, keys: array) -> (media_type, name, route): by subtype, under one format
    (picked), several (ambiguous) or none (unmatched)."""
    subtype = F.regexp_replace(F.split_part("media_type", F.lit("/"), F.lit(2)), r"^(?:vnd\.|x-|prs\.)", "")
    # Of the formats under a key it is told how many there are, and the first: keys and types meet as one row each.
    keyed = formats.select("name", F.explode("keys").alias("key")).where("name is not null").distinct()
    under = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("name").alias("first"))
    found = registered.select("media_type").distinct().withColumn("key", subtype).join(under, "key", "left")
    route = F.when(F.col("n") == 1, "picked").when(F.col("n") > 1, "ambiguous").otherwise("unmatched")
    return found.select("media_type", F.when(F.col("n") == 1, F.col("first")).alias("name"), route.alias("route"))


def media_rows(registered: DataFrame, formats: DataFrame, picks: DataFrame) -> DataFrame:
    """registered (media_type, label), formats (name, keys: array, the best first), picks (name, media_type, note) made by hand
    -> (name, media_type, note, how).

    A pick of `-` refuses a name: it has no row.  Other picks hold whether the name is a format or not (picked), unless the type
    isn't registered (unknown).  Of other formats the first key that is a registered subtype counts: under one type the row
    is made by name (named), under several it is left to people (ambiguous, without a type); without such a key there is none.
    The last pick of a name holds.
    """
    last = picks.withColumn("_at", F.monotonically_increasing_id()) if "ord" not in picks.columns else picks.withColumnRenamed("ord", "_at")
    last = last.groupBy("name").agg(F.max_by(F.struct("media_type", "note"), "_at").alias("p")).select("name", "p.media_type", "p.note")
    types = registered.select("media_type", "label").distinct()
    hand = last.where("media_type != '-'").join(types.withColumn("_there", F.lit(True)), "media_type", "left")
    note = F.when(F.trim(F.coalesce("note", F.lit(""))) != "", F.col("note")).otherwise(F.concat(F.lit("pick: "), F.col("label")))
    hand = hand.select("name", F.when(F.col("_there"), F.col("media_type")).alias("media_type"), F.when(F.col("_there"), note).alias("note"), F.when(F.col("_there"), "picked").otherwise("unknown").alias("how"))
    subtypes = types.where(F.col("media_type").contains("/")).groupBy(F.lower(F.substring_index("media_type", "/", -1)).alias("key")).agg(F.count("*").alias("n"), F.min(F.struct("media_type", "label")).alias("t"))
    free = formats.join(last.select("name"), "name", "left_anti").select("name", F.posexplode("keys").alias("at", "key")).withColumn("key", F.lower("key"))
    hit = free.join(subtypes, "key").groupBy("name").agg(F.min_by(F.struct("n", "t"), "at").alias("h"))
    one = F.col("h.n") == 1
    auto = hit.select("name", F.when(one, F.col("h.t.media_type")).alias("media_type"), F.when(one, F.concat(F.lit("by name: "), F.col("h.t.label"))).alias("note"), F.when(one, "named").otherwise("ambiguous").alias("how"))
    return hand.union(auto)


def named_in_turn(candidates: list[tuple[str, list[str]]], taken: set[str], ending: str) -> list[tuple[str, str]]:
    """Names for new synsets, one after the other: the first wanted name that is free, else the first with an ending, else
    that with a number.  Each choice is taken for all that follow, so this runs on the driver, over what people will read."""
    taken, out = set(taken), []
    for key, wanted in candidates:
        free = [w for w in wanted if w not in taken] or [f"{w}.{ending}" for w in wanted[:1] if f"{w}.{ending}" not in taken]
        n = 2
        while not free:
            free = [x for x in [f"{(wanted or ['unnamed'])[0]}.{ending}.{n}"] if x not in taken]
            n += 1
        taken.add(free[0])
        out.append((key, free[0]))
    return out


def majority_code(rows: DataFrame, key: str, code: str, titles: str) -> DataFrame:
    """(key, code): the codes' common prefix; if they share none, the prefix of those in the first digit that holds two
    thirds of the titles."""
    from arbora.operators.aggregates import group_prefix, two_thirds

    whole = group_prefix(rows, key, code)
    digit = rows.withColumn("_d", F.substring(code, 1, 1))
    major = two_thirds(digit, key, "_d", titles)
    within = group_prefix(digit.join(major, [key, "_d"], "left_semi"), key, code).withColumnRenamed("prefix", "_major")
    return whole.join(within, key, "left").select(key, F.when(F.col("prefix") != "", F.col("prefix")).otherwise(F.coalesce("_major", F.lit(""))).alias(code))


def occupation_route(rows: DataFrame, owned: DataFrame) -> DataFrame:
    """rows (offset, code), owned (offset, owner, name) -> (offset, code, name, route): no common code (spread), a code that
    begins with 0 (armed), a synset that the core (core) or a pack has (held), or a new row (new)."""
    code = F.coalesce("code", F.lit(""))
    route = F.when(code == "", "spread").when(code.startswith("0"), "armed").when(F.col("owner") == "core", "core").when(F.col("owner").isNotNull(), "held").otherwise("new")
    return rows.join(owned.groupBy("offset").agg(F.min(F.struct("owner", "name")).alias("o")).select("offset", "o.owner", "o.name"), "offset", "left").select("offset", code.alias("code"), "name", route.alias("route"))


def agreement(chosen: DataFrame, gold: DataFrame) -> DataFrame:
    """chosen (method, lemma, sense, lead), gold (lemma, sense) -> (method, part, n, agree): the share of lemmas whose sense
    is the gold one, of all, and of the half and the quarter with the largest leads (ties by lemma)."""
    rows = chosen.join(gold.withColumnRenamed("sense", "right"), "lemma").withColumn("ok", (F.col("sense") == F.col("right")).cast("double"))
    rows = ranked(rows, [F.col("method"), F.desc("lead"), F.col("lemma")], "_rank")
    sizes = rows.groupBy("method").agg(F.min("_rank").alias("_first"), F.count("*").alias("size"))
    told = rows.join(sizes, "method").select("method", "ok", (F.col("_rank") - F.col("_first") + 1).alias("place"), "size").withColumn("part", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(d).alias("d")) for n, d in (("all", 1), ("half", 2), ("quarter", 4))])))
    return told.where(F.col("place") * F.col("part.d") <= F.col("size")).groupBy("method", F.col("part.name").alias("part")).agg(F.count("*").alias("n"), F.avg("ok").alias("agree"))


class Naming:
    """Names of concepts, given one after the other: each choice is taken for all that follow.  It runs on the driver, over
    what people have selected.  names: name -> offset or None; queue: (name, why, offset) for people to look at."""

    def __init__(self, fixed: dict[str, str | None] | None = None):
        self.names: dict[str, str | None] = dict(fixed or {})
        self.of = {o: n for n, o in self.names.items() if o}
        self.queue: list[tuple[str, str, str]] = []

    def give(self, name: str, offset: str | None) -> None:
        self.names[name] = offset
        if offset:
            self.of[offset] = name

    def settled(self, senses: dict[str, str | None], overrides: dict[str, str]) -> None:
        """Names whose spelling is settled, with their first senses; an override replaces the sense, `-` by none.  Overrides
        of other names take their synsets too, before any candidate does."""
        for name in sorted(senses):
            offset = overrides.get(name, senses[name])
            if offset in (None, "", "-"):
                self.queue.append((name, "no sense", ""))
                self.give(name, None)
            elif offset in self.of:
                self.queue.append((name, f"same synset as {self.of[offset]}", offset))
            else:
                self.give(name, offset)
        for name, offset in overrides.items():
            if offset not in (None, "", "-") and name not in self.names and offset not in self.of:
                self.give(name, offset)

    def candidates(self, found: list[tuple[str, list[str], str]], by_hand: dict[str, str] | None = None, dropped: set[str] = frozenset()) -> None:
        """found (offset, names of its lemmas, field).  A name given by hand is as said; else the first lemma, if it is free;
        else another lemma that is neither taken nor any candidate's first; else the first with its field, or a number."""
        told = by_hand or {}
        rows = [(offset, lemmas, field) for offset, lemmas, field in found if offset not in dropped]
        spoken_for = {*told.values(), *(lemmas[0] for offset, lemmas, _ in rows if offset not in told)}
        for offset, lemmas, field in rows:
            if offset in self.of:
                continue
            choice = [told[offset]] if offset in told else [w for i, w in enumerate(lemmas) if w not in self.names and (i == 0 or w not in spoken_for)]
            name = choice[0] if choice else self.numbered(f"{lemmas[0]}.{field}")
            if offset not in told and name != lemmas[0]:
                self.queue.append((name, f"{lemmas[0]} is taken", offset))
            self.give(name, offset)

    def numbered(self, name: str) -> str:
        n = 1
        while (name if n == 1 else f"{name}.{n}") in self.names:
            n += 1
        return name if n == 1 else f"{name}.{n}"
