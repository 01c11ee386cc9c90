"""Subsumption graphs: edges (sub, sup), each `sub` below `sup`.

Recursion runs as semi-naive loops: each round joins only the pairs found last, subtracts what is known, and writes the
rest, so it ends on cycles and its lineage stays short.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbora.operators.ranking import ranked
from arbora.session import Grown, dropped, tidy, written


def edges_of(df: DataFrame, sub: str | Column = "sub", sup: str | Column = "sup") -> DataFrame:
    """Distinct edges; rows with a null end are no edges."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(col(sub).alias("sub"), col(sup).alias("sup")).where("sub is not null and sup is not null").distinct()


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("sub").alias("name")).union(edges.select("sup")).distinct()


def _grown(start: DataFrame, step: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """The least set that holds start and step(what was new).

    What is known lies in buckets by `keys`: a round shuffles only what it has found.  start has one row for each key.
    """
    known = Grown(start, keys)
    new = known.add(start.distinct())
    while not new.isEmpty():
        new = known.add(known.without(step(new)))
    return known.all()


def _hops(edges: DataFrame, sent: int = 4, rounds: Iterator[int] | None = None) -> Callable[[], DataFrame]:
    """Edges (sub, sup) as a round joins them (sup, above).  Spark may send small edges to all tasks, by way of the driver, in the
    first rounds only, so that what the driver is sent doesn't grow with rounds."""
    up, rounds = edges.select(F.col("sub").alias("sup"), F.col("sup").alias("above")), count() if rounds is None else rounds
    return lambda: up if next(rounds) < sent else up.hint("merge")


def closure(edges: DataFrame) -> DataFrame:
    """All pairs (sub, sup) with a path of at least one edge; on a cycle a node is below itself.

    A round goes on only over edges that begin where a path of so many edges ends.  Each round's are among those of the round
    before; once they are no longer halved, they stay.  When there are none, no path is longer.
    """
    known = Grown(edges.select("sub", "sup"), ["sub", "sup"])
    new = known.add(edges_of(edges))
    hop, n, narrows, rounds = new, new.count(), True, count()
    while not new.isEmpty():
        if narrows:
            ends = hop.select(F.col("sup").alias("sub")).distinct()
            narrow = written(hop.join(ends, "sub", "left_semi").select("sub", "sup"), "hop")
            left = narrow.count()
            if not left:
                break
            hop, n, narrows = narrow, left, 2 * left <= n
            up = _hops(hop, rounds=rounds)
        new = known.add(known.without(new.join(up(), "sup").select("sub", F.col("above").alias("sup"))))
    return known.all()


#: A row of sets() holds some of so many names following each other, as bits of long numbers.
WORDS = 4
BITS = [f"w{i}" for i in range(WORDS)]


def _sets(pairs: DataFrame) -> DataFrame:
    """Pairs (name, above), both numbers -> (name, block, w0 to w3): what is above a name, a bit for each."""
    word, bit = F.shiftright("above", 6) % WORDS, F.expr("shiftleft(1L, cast(above & 63 as int))")
    return pairs.groupBy("name", F.shiftright("above", 6 + WORDS.bit_length() - 1).alias("block")).agg(*[F.bit_or(F.when(word == i, bit).otherwise(F.lit(0).cast("long"))).alias(w) for i, w in enumerate(BITS)])


#: So many rows' names (a power of two) are united in one task; a task has so many names that go on, and rows they go on to, at most.
NEAR, VIA_ROWS, OVER_ROWS = 8, 1 << 15, 1 << 18
#: Rows that are joined at a time, within a task.
JOINED = 1 << 20
#: So many numbered names may be sent to all tasks.
MOST_SENT = 1 << 18


def _united(via: pa.Table, over: pa.Table) -> pa.Table:
    """via (name, block, bits: who is above), over (above, block, bits) -> (name, block, bits): what is above those above, united."""
    code = via["name"].combine_chunks().dictionary_encode()
    words = np.ascontiguousarray(np.stack([via[w].to_numpy() for w in BITS], axis=1).astype("<i8"))
    row, bit = np.nonzero(np.unpackbits(words.view(np.uint8).reshape(len(words), -1), axis=1, bitorder="little"))
    member, above = code.indices.to_numpy()[row].astype(np.int64), via["block"].to_numpy()[row] * (64 * WORDS) + bit
    order = np.argsort(over["above"].to_numpy(), kind="stable")
    top, (blocks, block) = over["above"].to_numpy()[order], np.unique(over["block"].to_numpy()[order], return_inverse=True)
    sets = [over[w].to_numpy()[order] for w in BITS]
    order = np.argsort(member, kind="stable")
    member, above = member[order], above[order]
    first = np.searchsorted(top, above, "left")
    n = np.searchsorted(top, above, "right") - first
    ends, at, out = np.cumsum(n), 0, []
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + JOINED, "right")))
        m = n[at:to]
        found = np.arange(m.sum()) + np.repeat(first[at:to] - np.cumsum(m) + m, m)
        key = np.repeat(member[at:to], m) * len(blocks) + block[found]
        order = np.argsort(key, kind="stable")
        key, found = key[order], found[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        out.append([key[starts], *[np.bitwise_or.reduceat(w[found], starts) if len(starts) else w[:0] for w in sets]])
        at = to
    key, *told = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * (1 + WORDS)
    name = code.dictionary.take(pa.array(key // max(1, len(blocks))))
    return pa.Table.from_arrays([name, pa.array(blocks[key % max(1, len(blocks))], pa.int64()), *[pa.array(w, pa.int64()) for w in told]], names=["name", "block", *BITS])


def _above(via: DataFrame, over: DataFrame) -> DataFrame:
    """_united() of all names: by as many names above that follow each other as NEAR rows hold, cut where they are met by many rows or lead to many."""
    rows = lambda df, n, most: df.groupBy("near").agg(F.ceil(F.count("*") / most).cast("int").alias(n))
    via, over = via.withColumn("near", F.floor(F.col("block") / NEAR)), over.withColumn("near", F.floor(F.col("above") / (64 * WORDS * NEAR)))
    sizes = rows(via, "xs", VIA_ROWS).join(rows(over, "ys", OVER_ROWS), "near")
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = via.join(sizes, "near").select("near", part("name", "xs").alias("x"), every("ys").alias("y"), "name", "block", *BITS)
    b = over.join(sizes, "near").select("near", every("xs").alias("x"), part("block", "ys").alias("y"), "above", "block", *BITS)
    keys = ["near", "x", "y"]

    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(lambda v, o: _united(v, o), ", ".join(["name string, block long", *[f"{w} long" for w in BITS]]))


def shared_closure(edges: DataFrame) -> DataFrame:
    """closure() for graphs in which a pair has many paths: what is above a name is held in sets, so that paths are united as bits.

    Names with any below them are numbered by length and alphabet, and a row holds what a name has of 256 numbers that follow each
    other.  A round meets a name's rows with those of the names above it by their numbers, and what it finds is united before it is
    shuffled, so that this is a row for each name and few blocks, where closure() has one for each pair and path.  The edges are read
    twice; nothing is shuffled for each of them but what a task's own don't unite.
    """
    edges = edges.select("sub", "sup").where("sub is not null and sup is not null")
    names = written(ranked(edges.select(F.col("sup").alias("name")).distinct(), [F.length("name"), F.col("name")], "id"), "names")
    # Bounded: else they are joined by sorting.
    ids = F.broadcast(names) if names.count() <= MOST_SENT else names
    any_ = lambda rows: rows.where(" or ".join(f"{w} != 0" for w in BITS))
    up = _sets(edges.join(ids.select(F.col("name").alias("sup"), F.col("id").alias("above")), "sup").select(F.col("sub").alias("name"), "above"))
    known = Grown(up, ["name", "block"], "sets")
    with tidy(edges.sparkSession):
        up = new = known.add(up)
    # Only what has anything above is gone on from.
    over = written(up.join(ids.select("name", F.col("id").alias("above")), "name").select("above", "block", *BITS), "over")
    inner = written(_sets(over.select(F.lit(0).alias("name"), "above").distinct()).select("block", *[F.col(w).alias(f"in_{w}") for w in BITS]), "inner")
    while not new.isEmpty():
        via = any_(new.join(inner, "block").select("name", "block", *[F.col(w).bitwiseAND(F.col(f"in_{w}")).alias(w) for w in BITS]))
        found = _above(via, over).groupBy("name", "block").agg(*[F.bit_or(w).alias(w) for w in BITS])
        before = known.all().groupBy("name", "block").agg(*[F.bit_or(w).alias(f"had_{w}") for w in BITS])
        fresh = found.join(before.hint("merge"), ["name", "block"], "left").select("name", "block", *[F.col(w).bitwiseAND(F.bitwise_not(F.coalesce(f"had_{w}", F.lit(0).cast("long")))).alias(w) for w in BITS])
        with tidy(edges.sparkSession):
            new = known.add(any_(fresh))
    dropped(over, inner)
    top = ids.select(F.col("name").alias("sup"), F.shiftright("id", 6 + WORDS.bit_length() - 1).alias("block"), (F.shiftright("id", 6) % WORDS).cast("int").alias("word"), F.col("id").bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    bits = F.when(F.col("word") == 0, F.col(BITS[0]))
    for i, w in enumerate(BITS[1:], 1):
        bits = bits.when(F.col("word") == i, F.col(w))
    return known.all().join(top, "block").where(F.getbit(bits, F.col("bit")) == 1).select(F.col("name").alias("sub"), "sup")


def in_store(store: Column, name: Column) -> Column:
    """A name of one store, as a name of its own."""
    return F.concat(F.length(store).cast("string"), F.lit(":"), store, name)


def without_store(name: Column) -> Column:
    """The name that in_store() was given."""
    n = F.split_part(name, F.lit(":"), F.lit(1))
    return F.substring(name, F.length(n) + n.cast("int") + 2, F.length(name))


def published_edges(stores: DataFrame) -> DataFrame:
    """Edges of published stores (store, sub, sup, published), each store's by itself: what one store states entails nothing
    together with another's."""
    told = stores.where("published")
    return edges_of(told, in_store(F.col("store"), F.col("sub")), in_store(F.col("store"), F.col("sup")))


def published_pairs(closed: DataFrame) -> DataFrame:
    """(sub, sup): what any published store entails, from the closure of published_edges()."""
    return closed.select(without_store(F.col("sub")).alias("sub"), without_store(F.col("sup")).alias("sup")).distinct()


def revised_closure(closed: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The closure of the edges `after`, from the closure of `before` and what differs.

    Edges that are gone: pairs with a path over one of them are set aside, and those of them that still have a path are found
    again, the shortest first (delete and rederive).  New edges: paths that begin with one are found first, by rounds over
    these alone; then the closure that was there is joined with them once.  Rounds grow with the new edges on a path and the
    length of what is found again, not with the graph.  What stays is written once, in the buckets of the closure that was
    there, and is shuffled only where the ends of what differs are too many to be sent to all tasks.
    """
    keys = ["sub", "sup"]
    side = lambda edges, n: edges.select(*keys).where("sub is not null and sup is not null").withColumn("side", F.lit(n))
    told = written(side(before, 1).union(side(after, 2)).groupBy(*keys).agg(F.bit_or("side").alias("side")), "sides")
    gone, more = (written(told.where(F.col("side") == n).select(*keys), name) for n, name in ((1, "gone"), (2, "more")))
    kept, grown = closed.select(*keys), Grown(closed.select(*keys), keys, "revised")
    if not gone.isEmpty():
        aside = written(_led_to(_onward(gone, kept), kept).distinct(), "aside")
        grown.add(kept.join(aside.hint("shuffle_hash"), keys, "left_anti"))
        sure = grown.all()
        # Edges that are needed: those that begin where a pair that was set aside begins.
        stay = written(told.where("side = 3").join(aside.select("sub").distinct(), "sub", "left_semi").select(*keys), "stay")
        hop = stay.select("sub", F.col("sup").alias("mid"))
        over = lambda pairs: hop.join(pairs.select(F.col("sub").alias("mid"), "sup"), "mid").select(*keys)
        start = aside.join(stay.union(over(_from(sure, stay))).distinct(), keys, "left_semi")
        grown.add(_grown(start, lambda new: over(new).join(aside, keys, "left_semi"), keys))
        dropped(aside, stay)
        kept = grown.all()
    elif not more.isEmpty():
        grown.add(kept)
    dropped(told)
    if more.isEmpty():
        return kept
    first = _onward(more, kept)
    step = first.select(F.col("sub").alias("mid"), "sup")
    paths_ = written(_grown(first, lambda new: new.select("sub", F.col("sup").alias("mid")).join(step, "mid").select(*keys), keys), "paths")
    grown.add(grown.without(_led_to(paths_, kept)))
    return grown.all()


def _from(closed: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs that begin where one of the edges ends; these ends are written, so that Spark knows whether they are few."""
    ends = written(edges.select(F.col("sup").alias("sub")).distinct(), "ends")
    return closed.join(ends, "sub", "left_semi").select("sub", "sup")


def _onward(edges: DataFrame, closed: DataFrame) -> DataFrame:
    """Pairs with a path that begins with one of the edges and goes on in the closure."""
    behind = edges.select("sub", F.col("sup").alias("mid")).join(_from(closed, edges).select(F.col("sub").alias("mid"), "sup"), "mid")
    return written(edges.union(behind.select("sub", "sup")).distinct(), "onward")


def _led_to(paths: DataFrame, closed: DataFrame) -> DataFrame:
    """The paths, and all pairs that lead to where one of them begins."""
    before = closed.select("sub", F.col("sup").alias("mid")).join(paths.select(F.col("sub").alias("mid"), "sup"), "mid")
    return paths.select("sub", "sup").union(before.select("sub", "sup"))


def ancestors(edges: DataFrame, names: DataFrame) -> DataFrame:
    """closure() from the given names (name) only."""
    edges = written(edges_of(edges), "edges")
    up = _hops(edges)
    start = edges.join(names.select(F.col("name").alias("sub")).distinct(), "sub", "left_semi")
    return _grown(start, lambda new: new.join(up(), "sup").select("sub", F.col("above").alias("sup")), ["sub", "sup"])


def reachable(edges: DataFrame, roots: DataFrame, down: bool = True) -> DataFrame:
    """Names reachable from roots (name), the roots included: placement of all that is below what is placed."""
    edges = written(edges_of(edges), "edges")
    a, b = ("sup", "sub") if down else ("sub", "sup")
    hop = edges.select(F.col(a).alias("name"), F.col(b).alias("next"))
    return _grown(roots.select("name"), lambda new: new.join(hop, "name").select(F.col("next").alias("name")), ["name"])


def depths(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(name, depth): the fewest edges from a root; level by level, so the first arrival is the least."""
    edges = written(edges_of(edges), "edges")
    hop = edges.select(F.col("sup").alias("name"), F.col("sub").alias("next"))
    return _grown(roots.select("name", F.lit(0).alias("depth")), lambda new: new.join(hop, "name").select(F.col("next").alias("name"), (F.col("depth") + 1).alias("depth")), ["name"])


def estimated_cone_sizes(edges: DataFrame, log_size: int = 14, exact: int = 64) -> DataFrame:
    """(name, cone): about how many distinct names are strictly below, without any pair of names; up to `exact` of them, just how many.

    Each name holds a sketch of what is below it (HyperLogLog, 2^log_size registers); sketches are united upwards, round by
    round, until none grows.  What travels is a sketch for each edge whose lower end has grown.  The relative standard error is
    1.04 / 2^(log_size/2): 0.8 % with 14.  A sketch tells names apart by 26 bits and a place, so among many small cones some
    would be one short; names with at most `exact` below them hold these as they are.  Names on a cycle count themselves, as do those
    above it.
    """
    edges = written(edges_of(edges), "edges")
    below = edges.groupBy(F.col("sup").alias("name")).agg(F.hll_sketch_agg("sub", F.lit(log_size)).alias("s"), F.count("*").alias("kids"))
    small = edges.join(below.where(F.col("kids") <= exact).select(F.col("name").alias("sup")), "sup", "left_semi").groupBy(F.col("sup").alias("name")).agg(F.array_sort(F.collect_list("sub")).alias("few"))
    size = F.when(F.col("few").isNotNull(), F.size("few").cast("long")).otherwise(F.hll_sketch_estimate("s"))
    now = written(below.drop("kids").join(small, "name", "left").withColumn("n", size), "sketches")
    grown = now
    while not grown.isEmpty():
        up = edges.select(F.col("sub").alias("name"), "sup").join(grown.select("name", "s", "few"), "name").select(F.col("sup").alias("name"), "s", "few")
        # Names that are held as they are have few edges below them, so that few such lists meet.
        both = now.select("name", "s", "few").join(up.select("name").distinct(), "name", "left_semi").union(up).join(now.select("name", F.col("few").isNotNull().alias("held")), "name")
        united = both.groupBy("name").agg(F.hll_union_agg("s").alias("s"), F.bool_and(F.col("held") & F.col("few").isNotNull()).alias("held"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("held"), F.col("few")))))).alias("few"))
        united = united.select("name", "s", F.when(F.col("held") & (F.size("few") <= exact), F.col("few")).alias("few")).withColumn("n", size)
        known = now.select("name", F.col("n").alias("before"), F.col("few").isNotNull().alias("held"))
        changed = written(united.join(known, "name").where((F.col("n") != F.col("before")) | (F.col("held") != F.col("few").isNotNull())).select("name", "s", "few", "n"), "grown")
        after = written(now.join(changed, "name", "left_anti").union(changed), "sketches")
        dropped(now)
        now, grown = after, changed
    return nodes_of(edges).join(now, "name", "left").select("name", F.coalesce("n", F.lit(0)).alias("cone"))


def cone_sizes(edges: DataFrame, closed: DataFrame | None = None) -> DataFrame:
    """(name, cone): how many distinct names are strictly below."""
    closed = closure(edges) if closed is None else closed
    counts = closed.where("sub != sup").groupBy(F.col("sup").alias("name")).agg(F.count("*").alias("cone"))
    return nodes_of(edges_of(edges)).join(counts, "name", "left").select("name", F.coalesce("cone", F.lit(0)).alias("cone"))


def top_cut(edges: DataFrame, roots: DataFrame, depth: int, least: int) -> DataFrame:
    """Names at a depth from 1 to `depth` with a cone of at least `least`."""
    return depths(edges, roots).where(F.col("depth").between(1, depth)).join(cone_sizes(edges), "name").where(F.col("cone") >= least)


def reduction(edges: DataFrame, closed: DataFrame | None = None) -> DataFrame:
    """Without edges that a sibling parent implies (for graphs without cycles).

    A name's only parent has no sibling, so only what is above the parents of names with several is closed.
    """
    if closed is not None:
        edges = edges_of(edges)
        return edges.join(_implied(edges, closed), ["sub", "sup"], "left_anti")
    edges = written(edges_of(edges), "reduced")
    several = edges.groupBy("sub").agg(F.count("*").alias("n")).where("n > 1").select("sub")
    siblings = written(edges.join(several, "sub", "left_semi"), "siblings")
    if siblings.isEmpty():
        return edges
    return edges.join(_implied(siblings, ancestors(edges, siblings.select(F.col("sup").alias("name")))), ["sub", "sup"], "left_anti")


def _implied(edges: DataFrame, closed: DataFrame) -> DataFrame:
    """Pairs (sub, sup) with a path that begins with one of the edges and goes on."""
    return edges.select("sub", F.col("sup").alias("mid")).join(closed.select(F.col("sub").alias("mid"), F.col("sup")), "mid").where("mid != sup").select("sub", "sup")


def merged(*stores: DataFrame) -> DataFrame:
    """The union of stores, reduced: the same in any order, and again when merged with itself."""
    whole = edges_of(stores[0])
    for s in stores[1:]:
        whole = whole.union(edges_of(s))
    return reduction(whole.distinct())


def conjunctive_get(closed: DataFrame, wanted: list[str]) -> DataFrame:
    """Names strictly below all that are wanted; wanting nothing gives every name."""
    if not wanted:
        return nodes_of(closed)
    return closed.where(F.col("sup").isin(*wanted) & (F.col("sub") != F.col("sup"))).groupBy(F.col("sub").alias("name")).agg(F.count_distinct("sup").alias("n")).where(F.col("n") == len(set(wanted))).select("name")


def stored_closure(closed: DataFrame) -> DataFrame:
    """A closure written by what stands above, sorted within its files: reading what is below a few names skips all others."""
    return written(closed.select("sub", "sup").repartitionByRange("sup").sortWithinPartitions("sup", "sub"), "closure")


def is_below(closed: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (sub, sup) with a column below."""
    told = closed.select("sub", "sup", F.lit(True).alias("below"))
    return pairs.join(told, ["sub", "sup"], "left").withColumn("below", F.coalesce("below", F.lit(False)))


def branches_of(closed: DataFrame, roots: DataFrame) -> DataFrame:
    """(name, branches): the roots at or above each name that has one, sorted."""
    roots = roots.select(F.col("name").alias("sup"))
    own = roots.select(F.col("sup").alias("sub"), "sup")
    return closed.join(roots, "sup", "left_semi").select("sub", "sup").union(own).groupBy(F.col("sub").alias("name")).agg(F.array_sort(F.collect_set("sup")).alias("branches"))


def top_children(edges: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """The k largest children of each parent by cone, then by name: (sup, sub, cone, place)."""
    w = Window.partitionBy("sup").orderBy(F.desc("cone"), "sub")
    return edges_of(edges).join(sizes.select(F.col("name").alias("sub"), "cone"), "sub").withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).select("sup", "sub", "cone", "place")


def nearest_placed(edges: DataFrame, names: DataFrame, placed: DataFrame) -> DataFrame:
    """(name, nearest, hops): the first placed name above, by hops and then by name."""
    edges = written(edges_of(edges), "edges")
    stop = placed.select(F.col("name").alias("at"))
    up = edges.select(F.col("sub").alias("at"), F.col("sup").alias("next"))
    step = lambda new: new.join(up, "at").select("name", F.col("next").alias("at"), (F.col("hops") + 1).alias("hops"))
    reached = _grown(names.select("name", F.col("name").alias("at"), F.lit(0).alias("hops")), lambda new: step(new.where("hops = 0").union(new.where("hops > 0").join(stop, "at", "left_anti").select("name", "at", "hops"))), ["name", "at"])
    found = reached.where("hops > 0").join(stop, "at", "left_semi")
    return found.groupBy("name").agg(F.min(F.struct("hops", "at")).alias("x")).select("name", F.col("x.at").alias("nearest"), F.col("x.hops").alias("hops"))


def owners(entries: DataFrame) -> DataFrame:
    """entries (store_ord, store, name, parents: array, stub) -> (name, owner, parents): the first store whose entry is
    no stub owns a name; parents are united and sorted."""
    owner = entries.groupBy("name").agg(F.min_by("store", F.when(~F.col("stub"), F.col("store_ord"))).alias("owner"))
    united = entries.select("name", F.explode("parents").alias("p")).distinct().groupBy("name").agg(F.array_sort(F.collect_set("p")).alias("parents"))
    return owner.join(united, "name", "left").select("name", "owner", F.coalesce("parents", F.array().cast("array<string>")).alias("parents"))


def disjoint_parents(edges: DataFrame, closed: DataFrame, tops: DataFrame) -> DataFrame:
    """(name, p, q): parents that share no ancestor-or-self below the tops."""
    edges = edges_of(edges)
    stop = tops.select(F.col("name").alias("x"))
    own = edges.select(F.col("sup").alias("p")).distinct()
    above = own.select("p", F.col("p").alias("x")).union(closed.select(F.col("sub").alias("p"), F.col("sup").alias("x")).join(own, "p", "left_semi")).join(stop, "x", "left_anti").distinct()
    pairs = edges.select(F.col("sub").alias("name"), F.col("sup").alias("p")).join(edges.select(F.col("sub").alias("name"), F.col("sup").alias("q")), "name").where("p < q")
    shared = pairs.select("p", "q").distinct().join(above, "p").join(above.select(F.col("p").alias("q"), "x"), ["q", "x"], "left_semi").select("p", "q").distinct()
    return pairs.join(shared, ["p", "q"], "left_anti").select("name", "p", "q")


def novelty(candidates: DataFrame, closed: DataFrame, branches: DataFrame) -> DataFrame:
    """candidates (sub, sup) with class: implied, loop, crossing (new, no branch in common) or within."""
    up = closed.select("sub", "sup", F.lit(True).alias("implied"))
    down = closed.select(F.col("sup").alias("sub"), F.col("sub").alias("sup"), F.lit(True).alias("loop"))
    told = candidates.join(up, ["sub", "sup"], "left").join(down, ["sub", "sup"], "left")
    told = told.join(branches.select(F.col("name").alias("sub"), F.col("branches").alias("a")), "sub", "left").join(branches.select(F.col("name").alias("sup"), F.col("branches").alias("b")), "sup", "left")
    none = F.array().cast("array<string>")
    share = F.arrays_overlap(F.coalesce("a", none), F.coalesce("b", none))
    kind = F.when(F.col("implied"), "implied").when(F.col("loop") | (F.col("sub") == F.col("sup")), "loop").when(share, "within").otherwise("crossing")
    return told.select("sub", "sup", kind.alias("class"))


def parent_shape(edges: DataFrame) -> DataFrame:
    """(parents, names): how many names have so many parents."""
    return edges_of(edges).groupBy("sub").agg(F.count("*").alias("parents")).groupBy("parents").agg(F.count("*").alias("names"))


def induced(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Edges with both ends among names: also the pruning of dangling edges."""
    own = names.select("name").distinct()
    return edges_of(edges).join(own.withColumnRenamed("name", "sub"), "sub", "left_semi").join(own.withColumnRenamed("name", "sup"), "sup", "left_semi").select("sub", "sup")


def bounded_walk(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """roots (name, reach): all within `reach` edges below a root, then every edge among them: (sub, sup)."""
    edges = written(edges_of(edges), "edges")
    hop = edges.select(F.col("sup").alias("name"), F.col("sub").alias("next"))
    seen = _grown(roots.select("name", F.col("reach").cast("int").alias("reach")), lambda new: new.where("reach > 0").join(hop, "name").select(F.col("next").alias("name"), (F.col("reach") - 1).alias("reach")), ["name", "reach"])
    return induced(edges, seen)


def paths(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(name, path): every path from a root, as an array; on trees and graphs with few paths.  Those that would close a
    cycle end there."""
    edges = written(edges_of(edges), "edges")
    level = roots.select("name", F.array("name").alias("path"))
    out = level
    while not level.isEmpty():
        level = written(level.join(edges.select(F.col("sup").alias("name"), F.col("sub").alias("next")), "name").where(~F.array_contains("path", F.col("next"))).select(F.col("next").alias("name"), F.array_append("path", F.col("next")).alias("path")), "paths")
        out = out.union(level)
    return out


def weak_components(edges: DataFrame, names: DataFrame) -> DataFrame:
    """(name, component): the smallest name that is connected, whichever way edges point; names alone are their own.

    Each round a name takes the smallest component that it or a neighbour has, and then that component's own, so that
    rounds grow as the log of the longest path.
    """
    told = _in_parts(edges)
    both = told.select(F.col("sub").alias("name"), "part").union(told.select("sup", "part")).distinct()
    return names.select("name").distinct().join(both, "name", "left").select("name", F.coalesce("part", "name").alias("component"))


def _in_parts(edges: DataFrame) -> DataFrame:
    """(part, sub, sup): edges with the smallest name of what they connect."""
    edges = edges.select("sub", "sup")
    both = edges.select(F.col("sub").alias("name"), F.col("sup").alias("other")).union(edges.select("sup", "sub"))
    now = written(both.groupBy("name").agg(F.least("name", F.min("other")).alias("component")), "components")
    while True:
        end = lambda e: now.select(F.col("name").alias(e), F.col("component").alias(f"of_{e}"))  # noqa: B023, E731
        told = written(edges.join(end("sub"), "sub").join(end("sup"), "sup").select("sub", "sup", "of_sub", "of_sup"), "links")
        if told.where("of_sub != of_sup").isEmpty():
            dropped(now)
            return told.select(F.col("of_sub").alias("part"), "sub", "sup")
        near = told.select(F.col("sub").alias("name"), F.least("of_sub", "of_sup").alias("component")).union(told.select("sup", F.least("of_sub", "of_sup")))
        least = written(near.groupBy("name").agg(F.min("component").alias("component")), "least")
        jumped = least.join(least.select(F.col("name").alias("component"), F.col("component").alias("further")), "component", "left")
        after = written(jumped.select("name", F.least("component", F.coalesce("further", "component")).alias("component")), "components")
        dropped(now, least, told)
        now = after


def topological(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Placement parents-first, with cycles broken: edges that stay, and those that are dropped.

    When no further name has all parents placed, the one with the fewest unplaced parents, then the smallest, loses them.
    Names that nothing waiting connects can't bear on each other, so all connected parts of what waits are placed, and lose
    parents, at once: rounds grow with the longest chain within a part and the names that lose parents in it, not with the
    number of parts or cycles.  A name's own loop counts as any other parent.
    """
    whole = written(edges_of(edges), "edges")
    kept = lost = whole.limit(0)
    #: Edges whose parent isn't placed, which are of names that aren't, either; once nothing is ready, with each name's part.
    open_, parts = whole, False
    # What has no parents is placed first; then it is told which names were placed last.
    marks = whole.select(F.col("sub").alias("sup"), F.lit(True).alias("waits")).distinct()
    while not open_.isEmpty():
        by = ["part", "sub"] if parts else ["sub"]
        seen = written(open_.join(marks, "sup", "left").select(*by, "sup", F.coalesce("waits", F.lit(open_ is not whole)).alias("waits")), "open")
        kept = kept.union(seen.where("not waits").select("sub", "sup"))
        left = written(seen.groupBy(*by).agg(F.count_if("waits").alias("n")), "left")
        ready = left.where("n = 0").select(F.col("sub").alias("name"))
        rest = seen.where("waits").select(*by, "sup")
        if not parts and ready.isEmpty():
            rest, parts = _in_parts(rest), True
            left = written(rest.groupBy("part", "sub").agg(F.count("*").alias("n")), "left")
        if parts:
            # Parts in which a name is ready wait for it; in each of the others one name loses its parents.
            loser = left.groupBy("part").agg(F.min(F.struct("n", "sub")).alias("x")).where("x.n > 0").select(F.col("x.sub").alias("sub"), F.lit(True).alias("loses"))
            loser = written(loser, "losers")
            told = written(rest.join(loser, "sub", "left"), "open")
            lost = lost.union(told.where("loses").select("sub", "sup"))
            rest, ready = told.where("loses is null").drop("loses"), ready.union(loser.select("sub"))
        open_, marks = rest, ready.select(F.col("name").alias("sup"), F.lit(False).alias("waits"))
    return kept, lost


def guarded_links(parents: dict[str, list[str]], candidates: list[tuple[str, str]]) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Adds candidate links one after the other, refusing those that would close a loop then: (added, refused).

    Each decision depends on all before, so it runs on the driver, for queues that people go through.
    """
    above: dict[str, set[str]] = {k: set(v) for k, v in parents.items()}

    def reaches(a: str, b: str) -> bool:
        seen, todo = set(), [a]
        while todo:
            n = todo.pop()
            if n == b:
                return True
            if n not in seen:
                seen.add(n)
                todo.extend(above.get(n, ()))
        return False

    added, refused = [], []
    for sub, sup in candidates:
        if reaches(sup, sub):
            refused.append((sub, sup))
        else:
            above.setdefault(sub, set()).add(sup)
            added.append((sub, sup))
    return added, refused


def content_hash(edges: DataFrame) -> DataFrame:
    """One row (h0 to h7): of the lines, whatever the order of rows.

    Lines are summed as a multiset, each of the eight 32-bit words of their sha256 by itself, so nothing is gathered.
    """
    line = F.sha2(F.concat_ws(" ", "sub", "sup"), 256)
    part = lambda i: F.coalesce(F.sum(F.conv(F.substring(line, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) % 4294967296
    return edges_of(edges).agg(*[part(i).cast("long").alias(f"h{i}") for i in range(8)])


def unattached(stores: DataFrame, edges: DataFrame, root: str = "*") -> DataFrame:
    """stores (store, name) -> (store, name, what): names that the union doesn't have (missing) or that don't reach its root
    (stranded)."""
    names = stores.where((F.col("name") != root) & F.col("name").isNotNull()).select("store", "name").distinct()
    there = nodes_of(edges_of(edges)).withColumn("there", F.lit(True))
    below = reachable(edges, edges.sparkSession.createDataFrame([(root,)], "name string")).withColumn("below", F.lit(True))
    told = names.join(there, "name", "left").join(below, "name", "left").where("below is null")
    return told.select("store", "name", F.when(F.col("there").isNull(), "missing").otherwise("stranded").alias("what"))


def numbered_tree(edges: DataFrame) -> DataFrame:
    """(name, pre, last): the places of a forest's names in preorder from 0, and the last place below each.

    Each name is stepped into and out of; these steps form one list (roots and children in the order of names), whose ranks
    come from pointer jumping: each round every step learns what its successor's successor knows, so rounds grow as the log
    of the number of names, whatever the depth.  A name lies below another if its place is between the other's two.
    edges are a forest's: each name has one parent at most.
    """
    edges = written(edges_of(edges), "edges")
    roots = nodes_of(edges).join(edges.select(F.col("sub").alias("name")), "name", "left_anti")
    # All names by parent, roots behind them; a name's next sibling has the next number, if it has the same parent.
    rows = edges.select(F.col("sub").alias("name"), F.col("sup").alias("parent")).union(roots.select("name", F.lit(None).cast(dict(edges.dtypes)["sup"])))
    placed = written(ranked(rows, [F.col("parent").asc_nulls_last(), F.col("name")], "at"), "siblings")
    following = placed.select((F.col("at") - 1).alias("at"), F.col("at").alias("next"), F.col("parent").alias("beside"))
    first = placed.join(placed.select((F.col("at") + 1).alias("at"), F.col("parent").alias("before"), F.lit(True).alias("has")), "at", "left").where("has is null or not (parent <=> before)").where("parent is not null")
    first = first.select(F.col("parent").alias("name"), F.col("at").alias("child"))
    beside = written(placed.join(following, "at", "left").select("at", "name", "parent", F.when(F.col("parent").eqNullSafe(F.col("beside")), F.col("next")).alias("next")), "beside")
    # One for each parent.
    ends = beside.where("next is null and parent is not null").select("at", "parent").join(placed.select(F.col("name").alias("parent"), F.col("at").alias("up")), "parent").select("at", "up")
    # Steps are numbers: into a name is twice its own, out of it one more.  What has no children is left as it is entered.
    into, out_of = lambda c: F.col(c) * 2, lambda c: F.col(c) * 2 + 1
    step = lambda at, then, n: F.struct(at.alias("step"), then.alias("next"), F.lit(n).cast("long").alias("n"))
    then = F.coalesce(into("next"), out_of("up"))
    steps = F.when(F.col("child").isNull(), F.array(step(into("at"), then, 1))).otherwise(F.array(step(into("at"), into("child"), 1), step(out_of("at"), then, 0)))
    now = written(beside.join(ends, "at", "left").join(first, "name", "left").select(F.explode(steps).alias("x")).select("x.*"), "steps")
    while not now.where("next is not null").isEmpty():
        ahead = now.select(F.col("step").alias("next"), F.col("next").alias("then"), F.col("n").alias("more"))
        # Steps that have reached the end of the list are known, and only looked up.
        jumped = now.where("next is not null").join(ahead, "next").select("step", F.col("then").alias("next"), (F.col("n") + F.col("more")).alias("n"))
        after = written(now.where("next is null").union(jumped), "steps")
        dropped(now)
        now = after
    total = roots.count() + edges.count()
    side = lambda odd, name: F.max(F.when(F.col("step") % 2 == odd, F.col("n"))).alias(name)
    told = now.groupBy(F.shiftright("step", 1).alias("at")).agg(side(0, "a"), side(1, "z")).join(placed.select("at", "name"), "at")
    # n counts the names that are stepped into from here on.
    return told.select("name", (F.lit(total) - F.col("a")).cast("long").alias("pre"), (F.lit(total) - F.coalesce(F.col("z") + 1, "a")).cast("long").alias("last"))


def within(tree: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (sub, sup) with below: whether sub lies strictly below sup in a numbered tree, by comparing places."""
    low = tree.select(F.col("name").alias("sub"), F.col("pre").alias("_at"))
    top = tree.select(F.col("name").alias("sup"), F.col("pre").alias("_from"), F.col("last").alias("_to"))
    told = pairs.join(low, "sub", "left").join(top, "sup", "left")
    return told.select(*pairs.columns, F.coalesce((F.col("_at") > F.col("_from")) & (F.col("_at") <= F.col("_to")), F.lit(False)).alias("below"))


def differing_parents(edges: DataFrame) -> DataFrame:
    """edges (store, sub, sup) -> (name, stores, sets): names of several stores with more than one set of parents."""
    each = edges.groupBy("store", "sub").agg(F.array_join(F.array_sort(F.collect_set("sup")), " ").alias("parents"))
    return each.groupBy(F.col("sub").alias("name")).agg(F.count("*").alias("stores"), F.count_distinct("parents").alias("sets")).where("stores > 1 and sets > 1")


def cone_without(closed: DataFrame, top: str, without: str) -> DataFrame:
    """(name): below `top` but neither below `without` nor it."""
    inside = closed.where(F.col("sup") == top).select(F.col("sub").alias("name"))
    out = closed.where(F.col("sup") == without).select(F.col("sub").alias("name"))
    return inside.where(F.col("name") != without).join(out, "name", "left_anti")
