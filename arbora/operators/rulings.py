"""Rulings as relations: an ordered log of edits to stores, carried out by joins, in waves of rows that can't bear on each other.

What a row may do depends on four things, each a relation: what its pack holds of the name, what stands above and below it,
who else has it, and what later rows say of it.  The last is known from the log alone (a row gives way to later ones, so that
a log replayed on its own outcome changes nothing).  The others depend on earlier rows only where these edit the same
name, one that it mentions, or one above.  So the log falls into waves: a row waits for the earlier rows that it depends on,
and all rows of a wave are decided at once, by columns, and applied by one join.  Logs of rows that don't meet are one wave.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbora.operators import graph
from arbora.operators.rules import CORE, PLACING, TOP, constrained, heads, settled
from arbora.session import dropped, written

NAMES = "array<string>"
ENTRY = ["store", "name", "parents"]


def none() -> Column:
    return F.array().cast(NAMES)


def words(column: str) -> Column:
    """Names apart by spaces; `-` and null are none."""
    return F.filter(F.split(F.coalesce(F.trim(F.col(column)), F.lit("")), r"\s+"), lambda x: (x != "") & (x != "-"))


def without(a: Column, b: Column) -> Column:
    return F.filter(a, lambda x: ~F.array_contains(b, x))


def plain(a: Column) -> Column:
    return F.filter(a, lambda x: x != TOP)


def united(a: Column, b: Column) -> Column:
    """Both in order, without the top where there is anything else."""
    both = F.array_distinct(F.concat(a, b))
    return F.when(F.size(plain(both)) > 0, plain(both)).otherwise(F.slice(both, 1, 1))


def or_top(a: Column) -> Column:
    return F.when(F.size(a) > 0, a).otherwise(F.array(F.lit(TOP)))


def within(a: Column, *others: Column) -> Column:
    return F.forall(a, lambda x: F.array_contains(F.concat(*others), x))


def some(a: Column) -> Column:
    return F.size(a) > 0


def lone(a: Column) -> Column:
    """The top alone."""
    return (F.size(a) == 1) & (F.get(a, F.lit(0)) == TOP)


def same(a: Column, b: Column) -> Column:
    return within(a, b) & within(b, a)


# The log by itself.


def foreseen(log: DataFrame) -> DataFrame:
    """log (seq, pack, sub, action, old, new: arrays) with what later rows say: gone (of new, what is taken away again),
    onward (of old, what the name is moved to again), kept (what the last row that disowns it leaves, else null), and whether later
    rows drop it (here or in the core: drops; in the core: core_drops; anywhere: any_drops), promote or disown it."""
    w = Window.partitionBy("pack", "sub").orderBy("seq").rowsBetween(1, Window.unboundedFollowing)
    ever = lambda *actions: F.coalesce(F.max(F.col("action").isin(*actions)).over(w), F.lit(False))
    out = log.withColumn("promotes", ever("promote")).withColumn("disowns", ever("disown"))
    last = log.where("action = 'disown'").groupBy("pack", "sub").agg(F.max_by("new", "seq").alias("k")).select("pack", "sub", or_top(F.col("k")).alias("kept"))
    drops = log.where("action = 'drop'").groupBy(F.col("pack").alias("where"), F.col("sub").alias("x")).agg(F.max("seq").alias("at"))
    anywhere = drops.groupBy("x").agg(F.max("at").alias("at"))
    out = out.join(last, ["pack", "sub"], "left")
    by = lambda rows, column, name: rows.join(anywhere.select(F.col("x").alias(column), F.col("at").alias("_at")), column, "left").withColumn(name, F.coalesce(F.col("_at") > F.col("seq"), F.lit(False))).drop("_at")
    out = by(out, "sub", "any_drops")
    here = lambda rows, where, column, name: rows.join(drops.select(F.col("where").alias("_w"), F.col("x").alias("_x"), F.col("at").alias("_at")), (where == F.col("_w")) & (F.col(column) == F.col("_x")), "left").withColumn(name, F.coalesce(F.col("_at") > F.col("seq"), F.lit(False))).drop("_w", "_x", "_at")
    out = here(here(out, F.col("pack"), "sub", "_own"), F.lit(CORE), "sub", "core_drops").withColumn("drops", F.col("_own") | F.col("core_drops")).drop("_own")
    place = F.when(F.col("action") == "promote", CORE).otherwise(F.col("pack"))
    said = lambda actions, column: log.where(F.col("action").isin(*actions)).select("pack", "sub", F.explode(column).alias("x"), "seq").groupBy("pack", "sub", "x").agg(F.max("seq").alias("last"))
    away, towards = said(("move", "cut"), "old"), said(("move", "parent+", "add"), "new")
    new = out.select("seq", place.alias("pack"), "sub", F.explode("new").alias("x"))
    new = here(here(new.join(away, ["pack", "sub", "x"], "left"), F.col("pack"), "x", "_a"), F.lit(CORE), "x", "_b")
    gone = new.where((F.col("last") > F.col("seq")) | F.col("_a") | F.col("_b")).groupBy("seq").agg(F.collect_set("x").alias("gone"))
    onward = out.select("seq", "pack", "sub", F.explode("old").alias("x")).join(towards, ["pack", "sub", "x"]).where(F.col("last") > F.col("seq")).groupBy("seq").agg(F.collect_set("x").alias("onward"))
    out = out.join(gone, "seq", "left").join(onward, "seq", "left")
    return out.withColumn("gone", F.when(F.col("action").isin(*PLACING), F.coalesce("gone", none())).otherwise(none())).withColumn("onward", F.coalesce("onward", none()))


def mentioned(log: DataFrame) -> DataFrame:
    """(seq, sub, name): the names that a row reads besides its own: those in its terms, heads and arguments."""
    term = log.select("seq", "sub", F.explode(F.concat("old", "new")).alias("t")).where(F.col("t") != TOP)
    return term.select("seq", "sub", F.explode(F.array(heads(F.col("t")), constrained(F.col("t")))).alias("name")).distinct()


def depends(log: DataFrame, entries: DataFrame) -> DataFrame:
    """(seq, on): earlier rows that a row has to wait for."""
    reads = mentioned(log).select("seq", "name").union(log.select("seq", F.col("sub").alias("name"))).union(log.select("seq", heads(F.col("sub")))).distinct()
    # Whatever may come to stand above: what does now, and what any row may add.
    up = entries.select("name", F.explode("parents").alias("p")).union(log.select("sub", F.explode("new"))).where(F.col("p") != TOP)
    up = graph.edges_of(up.select(F.col("name").alias("sub"), F.explode(F.array(heads(F.col("p")), constrained(F.col("p")))).alias("sup")))
    above = graph.ancestors(up, reads.select("name").distinct())
    far = reads.join(above.select(F.col("sub").alias("name"), F.col("sup").alias("other")), "name").select("seq", F.col("other").alias("name"))
    reads = written(reads.union(far).distinct(), "reads")
    edits = log.select(F.col("seq").alias("on"), F.col("sub").alias("name"))
    # What an earlier row reads, a later one mustn't change before it.
    first = reads.select(F.col("seq").alias("on"), "name").join(log.select("seq", F.col("sub").alias("name")), "name").select("seq", "on")
    return reads.join(edits, "name").select("seq", "on").union(first).where("on < seq").distinct()


# One wave.


def above_of(entries: DataFrame, names: DataFrame) -> DataFrame:
    """(name, above: array): all that stands above names (name), in any store; a term leads on to its head."""
    told = entries.select(F.col("name").alias("sub"), F.explode("parents").alias("p")).where(F.col("p") != TOP).distinct()
    start = names.select("name", heads(F.col("name")).alias("sub")).distinct()
    reach = graph.ancestors(told.select("sub", heads(F.col("p")).alias("sup")), start.select(F.col("sub").alias("name")))
    reach = start.select("name", F.col("sub").alias("at")).union(start.join(reach, "sub").select("name", F.col("sup").alias("at"))).distinct()
    found = reach.join(told.select(F.col("sub").alias("at"), "p"), "at").select("name", F.explode(F.array(F.col("p"), heads(F.col("p")))).alias("x"))
    return found.groupBy("name").agg(F.collect_set("x").alias("above"))


def gathered(wave: DataFrame, entries: DataFrame, left_out: DataFrame, prelude: DataFrame) -> DataFrame:
    """A wave with what its decisions read: have and core (what its pack and the core hold of the name, else null), known (its
    terms that the pack may use), core_names (of its terms and own parents, those that are the core's), above, reach (name ->
    above, of terms and parents), owners, children, out (what was left out of it before)."""
    whole = entries.union(prelude.select(F.lit(None).cast("string").alias("store"), "name", "parents"))
    at = lambda store: entries.where(store).select(F.col("name").alias("sub"), F.col("parents"))
    own = entries.select(F.col("store").alias("pack"), F.col("name").alias("sub"), F.col("parents").alias("have"))
    rows = wave.join(own, ["pack", "sub"], "left").join(at(F.col("store") == CORE).withColumnRenamed("parents", "core"), "sub", "left")
    given = prelude.select(F.col("name").alias("sub"), or_top(F.array_sort("parents")).alias("given"))
    rows = rows.join(given, "sub", "left").withColumn("have", F.when(F.col("have").isNull() & F.col("action").isin(*ACTIONS) & ~F.col("action").isin("add", "drop"), F.col("given")).otherwise(F.col("have"))).drop("given")
    terms = rows.select("seq", "pack", F.explode(F.array_distinct(F.concat("new", F.coalesce("have", none())))).alias("t"))
    here = entries.groupBy("name").agg(F.max(F.col("store") == CORE).alias("in_core")).withColumn("there", F.lit(True))
    here = here.join(prelude.select("name").withColumn("_given", F.lit(True)), "name", "full")
    told = terms.withColumn("name", constrained(F.col("t"))).join(here, "name", "left")
    usable = (F.col("name") == TOP) | F.col("_given") | F.when(F.col("pack") == CORE, F.col("in_core")).otherwise(F.col("there"))
    known = told.where(F.coalesce(usable, F.lit(False))).groupBy("seq").agg(F.collect_set("t").alias("known"))
    plainly = terms.join(here.select(F.col("name").alias("t"), "in_core", "_given"), "t", "left")
    cores = plainly.groupBy("seq").agg(F.collect_set(F.when(F.col("in_core"), F.col("t"))).alias("core_names"), F.collect_set(F.when(F.col("_given"), F.col("t"))).alias("given_names"))
    above = written(above_of(whole, terms.select(F.col("t").alias("name")).union(rows.select("sub")).distinct()), "above")
    reach = terms.join(above.withColumnRenamed("name", "t"), "t").groupBy("seq").agg(F.map_from_entries(F.collect_list(F.struct("t", "above"))).alias("reach"))
    others = rows.select("seq", "pack", "sub").join(entries.select("store", F.col("name").alias("sub"), "parents"), "sub").where((F.col("store") != F.col("pack")) & ~lone(F.col("parents"))).groupBy("seq").agg(F.count("*").alias("owners"))
    hung = entries.select("store", "name", F.explode("parents").alias("p")).select("store", "name", F.explode(F.array_distinct(F.array(F.col("p"), constrained(F.col("p"))))).alias("sub"))
    below = hung.join(rows.where("action = 'drop'").select("sub"), "sub", "left_semi").groupBy("sub").agg(F.count("*").alias("children"))
    out = left_out.groupBy("pack", "sub").agg(F.collect_set("x").alias("out"))
    rows = rows.join(known, "seq", "left").join(cores, "seq", "left").join(above.select(F.col("name").alias("sub"), "above"), "sub", "left").join(reach, "seq", "left").join(others, "seq", "left").join(below, "sub", "left").join(out, ["pack", "sub"], "left")
    empty = {c: F.coalesce(c, none()) for c in ("known", "core_names", "given_names", "above", "out")}
    return rows.withColumns(empty | {"owners": F.coalesce("owners", F.lit(0)), "children": F.coalesce("children", F.lit(0))})


def outcome(what: str, why: Column | str = "", parents: Column | None = None, core: Column | None = None, gone: bool = False) -> Column:
    """What becomes of a row: what and why; what its pack then holds of the name (null: as before), and the core; whether it goes."""
    null = F.lit(None).cast(NAMES)
    told = F.lit(why) if isinstance(why, str) else why
    return F.struct(F.lit(what).alias("what"), told.alias("why"), (null if parents is None else parents).alias("parents"), (null if core is None else core).alias("core"), F.lit(gone).alias("gone"))


def refused(*why: Column | str) -> Column:
    return outcome("error", F.concat(*[F.lit(x) if isinstance(x, str) else x for x in why]))


def listed(a: Column) -> Column:
    return F.array_join(a, ", ")


ALREADY = "already"


def placed(parents: Column, then: str | None = None) -> Column:
    """The name below these parents, all of which it has or its pack knows; `then` replaces what is told of a change."""
    parents = F.array_distinct(parents)
    have = F.coalesce("have", none())
    strange = F.filter(parents, lambda p: ~F.array_contains(have, p) & ~F.array_contains(F.col("known"), p))
    made = or_top(plain(parents))
    kept = F.when(F.col("have").eqNullSafe(made), outcome(ALREADY, parents=made)).otherwise(outcome(then or "done", parents=made))
    return F.when(some(strange), refused(F.col("pack"), " knows no ", listed(strange))).otherwise(kept)


def ensured(wanted: Column) -> Column:
    """What another path implies is stored all the same, since later rows may take that path away."""
    store = F.col("have").isNotNull() & ~lone(wanted)
    return F.when(store, placed(united(F.coalesce("have", none()), wanted), ALREADY)).otherwise(outcome(ALREADY))


def reached(wanted: Column) -> Column:
    return within(wanted, F.coalesce("have", none()), F.col("above"))


def held(then: Column) -> Column:
    return F.when(F.col("have").isNull(), refused(F.col("sub"), " isn't in ", F.col("pack"))).otherwise(then)


def bare() -> Column:
    """Nothing, or the top alone."""
    return (F.size("have") == 0) | lone(F.col("have"))


def add() -> Column:
    wanted = or_top(F.col("wanted"))
    stray = ~lone(wanted) & ~reached(wanted)
    return F.when(F.col("have").isNull(), placed(wanted)).when(stray, refused(F.col("sub"), " is there, below ", listed(F.col("have")))).otherwise(ensured(wanted))


def parent() -> Column:
    wanted = F.col("wanted")
    return F.when(~some(wanted), outcome(ALREADY)).otherwise(held(F.when(reached(wanted), ensured(wanted)).otherwise(placed(united(F.col("have"), wanted)))))


def move() -> Column:
    have, target = F.coalesce("have", none()), plain(F.col("wanted"))
    leaving = F.filter("old", lambda p: F.array_contains(have, p))
    rest = without(have, leaving)
    # Later rows move on from where this one went.
    overtaken = F.when(~some(leaving) | within(F.col("old"), F.col("onward")), outcome(ALREADY)).otherwise(placed(F.when(some(rest), rest).otherwise(F.col("new"))))
    there = reached(target) & (some(target) | bare())
    stay = F.when(some(target) & ~lone(have), ensured(target)).otherwise(outcome(ALREADY))
    stray = refused(F.col("sub"), " isn't below ", listed(F.col("old")), " in ", F.col("pack"), ", nor where it should go")
    go = F.when(some(leaving), placed(F.concat(rest, target))).when(there, stay).when(some(target) & F.arrays_overlap("old", "out"), placed(united(have, target))).otherwise(stray)
    return F.when(some(F.col("new")) & ~some(F.col("wanted")), overtaken).otherwise(held(go))


def cut() -> Column:
    have = F.col("have")
    leaving = F.filter("old", lambda p: F.array_contains(have, p) & ~F.array_contains(F.col("onward"), p))
    rest = without(have, leaving)
    go = F.when(~some(leaving), outcome(ALREADY)).when(~some(plain(rest)), refused(F.col("sub"), " would have no parent left")).otherwise(placed(rest))
    return held(go)


def refine(across: bool) -> Column:
    have, core = F.coalesce("have", none()), F.coalesce("core", none())
    wanted = F.when(some(F.col("wanted")), F.col("wanted")).otherwise(F.col("new"))
    there = within(wanted, have) | (some(plain(have)) & reached(wanted))
    terms = F.filter(wanted, lambda x: x.contains("("))
    inner = F.filter(wanted, lambda x: F.array_contains(F.col("core_names"), x))
    kinds = F.filter(core, lambda c: (c != TOP) & ~c.contains("("))
    foreign = F.filter(wanted, lambda x: ~F.coalesce(F.arrays_overlap(F.element_at(F.col("reach"), x), kinds), F.lit(False)))
    go = F.when(there, ensured(wanted)).when(some(terms), refused(listed(terms), " is a term, and a refinement adds a kind")).when(some(inner), refused(listed(inner), " is a name of the core, where the edge belongs"))
    if not across:
        go = go.when(some(foreign), refused(listed(foreign), " is below no parent that ", F.col("sub"), " has in the core"))
    go = go.otherwise(placed(united(have, wanted)))
    strange = (F.col("pack") == CORE) | F.col("core").isNull()
    return F.when((F.col("pack") != CORE) & F.col("core").isNull() & F.col("core_drops"), outcome(ALREADY)).when(strange, refused(F.col("sub"), " isn't a name of the core that a pack refines")).when(~some(F.col("wanted")) & F.col("have").isNotNull(), outcome(ALREADY)).otherwise(go)


def promote() -> Column:
    have, core, wanted = F.coalesce("have", none()), F.coalesce("core", none()), F.col("wanted")
    foreign = F.filter(wanted, lambda x: (x != TOP) & ~F.array_contains(F.col("core_names"), x) & ~F.array_contains(F.col("given_names"), x))
    own = F.filter(have, lambda p: (p != TOP) & ~F.array_contains(F.col("core_names"), p))
    there = F.col("core").isNotNull() & within(wanted, core, F.col("above"), F.array(F.lit(TOP))) & (F.size(own) == F.size(plain(have)))
    stray = F.filter(own, lambda p: p.contains("(") | ~F.coalesce(F.arrays_overlap(F.element_at(F.col("reach"), p), wanted), F.lit(False)))
    made = outcome("done", parents=or_top(own), core=or_top(united(core, wanted)))
    return (
        F.when(F.col("pack") == CORE, refused("the core promotes nothing to itself")).when(some(F.col("new")) & ~some(wanted) & F.col("core").isNotNull(), outcome(ALREADY))
        .when(some(foreign), refused(listed(foreign), " aren't names of the core")).when(there, outcome(ALREADY)).when(F.col("have").isNull() & F.col("core").isNull(), refused(F.col("sub"), " isn't in ", F.col("pack")))
        .when(some(stray), refused(F.col("pack"), " would keep ", listed(stray), ", which are below none of ", listed(wanted))).otherwise(made)
    )


def disown() -> Column:
    have, kept = plain(F.coalesce("have", none())), plain(F.col("wanted"))
    there = same(have, kept) | (some(have) & within(have, kept) & reached(kept))
    go = F.when(there, outcome(ALREADY)).when(~reached(kept), refused(F.col("pack"), " can only keep parents it has, not ", listed(kept))).otherwise(outcome("done", parents=or_top(kept)))
    alone = F.when(F.col("any_drops"), outcome(ALREADY)).otherwise(refused("no other store owns ", F.col("sub")))
    return F.when(F.col("owners") == 0, alone).otherwise(go)


def drop() -> Column:
    borrowed = (F.col("pack") != CORE) & lone(F.col("have")) & ((F.col("owners") > 0) | F.col("core").isNotNull())
    return F.when(F.col("have").isNull() | borrowed, outcome(ALREADY)).when(F.col("children") > 0, refused(F.col("sub"), " has children")).otherwise(outcome("done", gone=True))


#: The decision table.
ACTIONS: dict[str, Callable[[], Column]] = {"add": add, "parent+": parent, "move": move, "cut": cut, "refine": lambda: refine(False), "refine-cross": lambda: refine(True), "promote": promote, "disown": disown, "drop": drop}


def decided(rows: DataFrame) -> DataFrame:
    """gathered() rows with outcome, and left (what is left out of them, since later rows take it away)."""
    action, have = F.col("action"), F.col("have")
    as_kept = F.col("kept").isNotNull() & (action != "disown") & same(F.coalesce(have, none()), F.coalesce("kept", none()))
    overtaken = as_kept | (have.isNull() & (action != "drop") & F.col("drops")) | ((have.isNull() | lone(have)) & (action != "promote") & F.col("promotes")) | (have.isNull() & action.isin("parent+", "move", "cut") & F.col("disowns"))
    overtaken = F.coalesce(overtaken, F.lit(False))
    rows = rows.withColumn("wanted", without(F.col("new"), F.col("gone")))
    told = F.when(~action.isin(*ACTIONS), refused("unknown action ", action)).when(overtaken, outcome(ALREADY))
    for name, column in ACTIONS.items():
        told = told.when(action == name, column())
    return rows.withColumn("outcome", told).withColumn("left", F.when(overtaken, none()).otherwise(F.col("gone")))


# Renames.


def hung_from(entries: DataFrame) -> DataFrame:
    """(store, name, at, p, sub): each parent of an entry, with the names it stands for: itself and what it constrains."""
    rows = entries.select("store", "name", F.posexplode("parents").alias("at", "p"))
    return rows.select("store", "name", "at", "p", F.explode(F.array_distinct(F.array(F.col("p"), constrained(F.col("p"))))).alias("sub"))


def named_anew(wave: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A wave of renames (seq, pack, old, new, kind, reuser) -> (seq, what, why), and the entries afterwards."""
    hung = written(hung_from(entries), "hung")
    there = entries.select("name").union(hung.select(F.col("sub"))).distinct()
    flag = lambda column, name: there.select(F.col("name").alias(column), F.lit(True).alias(name))
    below = hung.groupBy(F.col("sub").alias("old")).agg(F.count("*").alias("children"))
    rows = wave.join(flag("old", "is"), "old", "left").join(flag("reuser", "reused"), "reuser", "left").join(below, "old", "left")
    # Where the name that is to reuse this one is gone, both rows have run.
    ran = F.col("is").isNull() | (F.col("reuser").isNotNull() & F.col("reused").isNull())
    stuck = (F.col("kind") == "drop") & F.col("children").isNotNull()
    rows = rows.withColumn("what", F.when(ran, ALREADY).when(stuck, "error").otherwise("done"))
    rows = written(rows.withColumn("why", F.when(F.col("what") == "error", F.concat(F.col("old"), F.lit(" has children"))).otherwise("")), "renames")
    does = rows.where("what = 'done'")
    gone = does.where("kind = 'drop'").select(F.col("old").alias("name"))
    swap = does.where("kind != 'drop'").select("pack", F.col("old").alias("name"), "new", "kind")
    # What a pack has of a merged name goes to the core's.
    core = entries.where(F.col("store") == CORE).select(F.col("name").alias("new"))
    merged = swap.where((F.col("kind") == "merge") & (F.col("pack") != CORE)).join(core, "new", "left_semi").select(F.col("pack").alias("store"), "name", "new")
    moved = entries.join(gone, "name", "left_anti").join(swap.select("name", "new"), "name", "left").join(merged.select("store", "name", F.lit(CORE).alias("to")), ["store", "name"], "left")
    order = F.when(F.col("to").isNotNull(), 1).when(F.col("new").isNotNull(), 2).otherwise(0)
    moved = moved.select(F.coalesce("to", "store").alias("store"), F.coalesce("new", "name").alias("name"), order.alias("order"), "parents")
    united_ = moved.groupBy("store", "name").agg(F.transform(F.array_sort(F.collect_list(F.struct("order", "parents"))), lambda x: x["parents"]).alias("all"))
    united_ = united_.select("store", "name", F.when(F.size("all") == 1, F.get("all", F.lit(0))).otherwise(united(F.flatten("all"), none())).alias("parents"))
    # Parents that are renamed, or constrain what is; nothing stands above itself.
    inner = F.when(F.col("p") == F.col("old"), F.col("new")).otherwise(F.concat(heads(F.col("p")), F.lit("("), F.col("new"), F.lit(")")))
    swaps = hung_from(united_).join(swap.select(F.col("name").alias("sub"), F.col("name").alias("old"), "new"), "sub").select("store", "name", "at", inner.alias("q"))
    every = united_.join(swaps.select("store", "name").distinct(), ["store", "name"], "left_semi").select("store", "name", F.posexplode("parents").alias("at", "p")).join(swaps, ["store", "name", "at"], "left")
    told = every.groupBy("store", "name").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("q", "p").alias("p")))), lambda x: x["p"]).alias("all"))
    told = told.select("store", "name", or_top(F.filter(F.array_distinct("all"), lambda p: p != F.col("name"))).alias("parents"))
    out = united_.join(told.select("store", "name"), ["store", "name"], "left_anti").union(told)
    return rows.select("seq", "what", "why"), written(out.select(*ENTRY), "entries")


def waves(pending: DataFrame, waits: DataFrame, act: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """act(wave) -> (seq, what, why) of each row, for rows that wait for none that is pending, until there are none."""
    told = None
    while not pending.isEmpty():
        open_ = waits.join(pending.select(F.col("seq").alias("on")), "on", "left_semi").select("seq").distinct()
        wave = written(pending.join(open_, "seq", "left_anti"), "wave")
        said = act(wave)
        told = said if told is None else told.union(said)
        pending = written(pending.join(wave.select("seq"), "seq", "left_anti"), "pending")
    return told if told is not None else pending.select("seq", F.lit("").alias("what"), F.lit("").alias("why"))


def rename(edges: DataFrame, renames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """edges (store, sub, sup, ord), renames (seq: distinct, pack, old, new, kind: drop, merge or anything else) -> the stores
    afterwards, and (seq, what, why).

    A name goes wherever it is mentioned, in terms too; where the new one is there already, both are united.  Of a name that a
    later row gives to another, rows that have run aren't run again.
    """
    log = written(renames.select(F.col("seq").cast("long").alias("seq"), "pack", "old", "new", "kind"), "renames")
    later = log.select(F.col("seq").alias("s"), F.col("new").alias("old"), F.col("old").alias("r")).join(log.select("seq", "old"), "old").where("s > seq").groupBy("seq").agg(F.min_by("r", "s").alias("reuser"))
    log = log.join(later, "seq", "left")
    names = written(log.select("seq", F.explode(F.array("old", "new", "reuser")).alias("name")).where("name is not null").distinct(), "names")
    waits = names.join(names.select(F.col("seq").alias("on"), "name"), "name").where("on < seq").select("seq", "on").distinct()
    named = names.select("name").distinct()
    # Entries of the names, and those below or constraining them.
    below = edges.select("sub", F.explode(F.array(F.col("sup"), constrained(F.col("sup")))).alias("name")).join(named, "name", "left_semi").select(F.col("sub").alias("name"))
    needed = written(named.union(below).distinct().select(F.col("name").alias("sub")), "needed")
    entries = written(entries_of(edges.join(needed, "sub", "left_semi")), "entries")

    def act(wave: DataFrame) -> DataFrame:
        nonlocal entries
        said, entries = named_anew(wave, entries)
        return said

    said = waves(log, waits, act)
    return edges.join(needed, "sub", "left_anti").select("store", "sub", "sup", "ord").union(edges_of(entries)), said


def entries_of(edges: DataFrame) -> DataFrame:
    """(store, name, parents) of edges (store, sub, sup, ord)."""
    told = F.transform(F.array_sort(F.collect_list(F.struct("ord", "sup"))), lambda x: x["sup"])
    return edges.groupBy("store", F.col("sub").alias("name")).agg(F.array_distinct(told).alias("parents")).select(*ENTRY)


def edges_of(entries: DataFrame) -> DataFrame:
    return entries.select("store", F.col("name").alias("sub"), F.posexplode("parents").alias("ord", "sup")).select("store", "sub", "sup", "ord")


def replay(edges: DataFrame, rulings: DataFrame, prelude: Mapping[str, list[str]] | None = None, renames: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """edges (store, sub, sup, ord), rulings (seq: distinct, pack, sub, action, old, new: names apart by spaces) -> the stores
    afterwards (packs reduced against the core, stubs put right), and (seq, what, why): done, already or error of each row.

    Rows in error change nothing.  prelude: names that every store has, with their parents.  renames (see rename()) go before
    the rulings.  Only entries that the log touches, those above them, and those below what is dropped, take part in the waves.
    """
    spark = edges.sparkSession
    removed = rulings.where("action = 'drop'").select(F.col("sub").alias("name"))
    if renames is not None:
        edges = written(rename(edges, renames)[0], "stores")
        removed = removed.union(renames.select("old"))
    given = spark.createDataFrame([(n, list(ps)) for n, ps in (prelude or {}).items()], f"name string, parents {NAMES}")
    log = written(foreseen(rulings.select(F.col("seq").cast("long").alias("seq"), "pack", "sub", "action", words("old").alias("old"), words("new").alias("new"))), "log")
    named = mentioned(log).select("name").union(log.select("sub")).union(log.select(heads(F.col("sub")))).distinct()
    up = edges.where(F.col("sup") != TOP).select("sub", F.explode(F.array(heads(F.col("sup")), constrained(F.col("sup")))).alias("sup"))
    below = edges.select("sub", F.explode(F.array(F.col("sup"), constrained(F.col("sup")))).alias("name")).join(log.where("action = 'drop'").select(F.col("sub").alias("name")), "name", "left_semi").select(F.col("sub").alias("name"))
    needed = written(graph.reachable(up, named.union(below).distinct(), down=False).select(F.col("name").alias("sub")), "needed")
    entries = written(entries_of(edges.join(needed, "sub", "left_semi")), "entries")
    waits = written(depends(log, entries.select("name", "parents").union(given)), "waits")
    left_out = spark.createDataFrame([], "pack string, sub string, x string")

    def act(wave: DataFrame) -> DataFrame:
        nonlocal entries, left_out
        done = written(decided(gathered(wave, entries, left_out, given)).select("seq", "pack", "sub", "have", "outcome", "left"), "decided")
        # What the prelude gave a pack stays, whatever became of the row.
        kept = F.coalesce("outcome.parents", F.col("have"))
        own = done.where(kept.isNotNull() | F.col("outcome.gone")).select(F.col("pack").alias("store"), F.col("sub").alias("name"), F.when(~F.col("outcome.gone"), kept).alias("parents"))
        core = done.where("outcome.core is not null").select(F.lit(CORE).alias("store"), F.col("sub").alias("name"), F.col("outcome.core").alias("parents"))
        changed = written(own.union(core), "changed")
        after = written(entries.join(changed, ["store", "name"], "left_anti").union(changed.where("parents is not null")).select(*ENTRY), "entries")
        left_out = written(left_out.union(done.select("pack", "sub", F.explode("left").alias("x"))).distinct(), "left")
        dropped(entries)
        entries = after
        return done.select("seq", "outcome.what", "outcome.why")

    said = waves(log, waits, act)
    whole = edges.join(needed, "sub", "left_anti").select("store", "sub", "sup", "ord").union(edges_of(entries))
    return settled(written(whole, "stores"), removed, prelude or {}), said
