"""Labels, graphs, votes and rulings on small cases."""

import pytest
from pyspark.sql import functions as F

from arbora.functions import text
from arbora.operators import aggregates, graph, joins, ranking, rules, votes


def one(spark, make, value):
    return spark.createDataFrame([(value,)], "v string").select(make(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(("given", "wanted"), [("PhysicalEntity", "physical-entity"), ("Physical_entity", "physical-entity"), ("physical entity", "physical-entity"), (" a / b ", "a-b"), ("***", "unnamed"), ("Men's", "men's")])
def test_normalise(spark, given, wanted):
    assert one(spark, text.normalise, given) == wanted


@pytest.mark.parametrize(("given", "wanted"), [("glasses", "glasses"), ("children", "child"), ("neckties", "necktie"), ("batteries", "battery"), ("boxes", "box"), ("heroes", "hero"), ("gloves", "glove"), ("toys", "toy"), ("bus", "bus"), ("tennis", "tennis"), ("glass", "glass"), ("pies", "pie"), ("lies", "lie")])
def test_singular(spark, given, wanted):
    assert one(spark, text.singular, given) == wanted == text.singular_of(given)


def test_bins_and_titles(spark):
    assert one(spark, text.singular_label, "Kitchen Appliances") == "kitchen appliance"
    assert one(spark, text.shared_head, "Fresh & Frozen Vegetables") == "vegetable"
    assert one(spark, text.shared_head, "Toasters & Grills") is None
    assert one(spark, text.split_bin, "Toasters & Grills") == ["toaster", "grill"]
    assert one(spark, text.split_bin, "Arts and Crafts and More") == []
    assert [tuple(x) for x in one(spark, text.index_phrases, "Engineer, civil: roads")] == [("engineer", False), ("civil engineer", True), ("civilengineer", True)]
    assert one(spark, text.local_name, "http://x.org/a#B") == "B"
    assert tuple(one(spark, text.term_parts, "in(box)")) == ("in", "box")
    assert text.kinds_of("Wheat and meslin, seed; horses and other equines n.e.c.") == ["wheat", "meslin", "horses"]
    assert text.kinds_of("Meat of pigs, frozen") == ["meat"]
    assert text.kinds_of("Red wine and red; twisted yarn and united") == ["red wine", "red", "twisted yarn", "united"]
    assert text.kinds_of("paper put up for sale, cut; feed") == ["paper", "feed"] and text.kinds_of(None) == []
    assert one(spark, text.media_keys, "-format") == ["-format"] and one(spark, text.media_keys, "png-format") == ["png-format", "png"]
    assert text.variants_of("fresh sea-fish")[:2] == ["fresh_sea-fish", "fresh_sea_fish"] and "sea_fish" in text.variants_of("fresh sea-fish")
    assert text.parents_listed("in(box) thing (a note)") == ["in(box)", "thing"]


EDGES = [("a", "b"), ("b", "c"), ("a", "c"), ("d", "c"), ("c", "top")]


def test_graph(spark):
    edges = spark.createDataFrame(EDGES, "sub string, sup string")
    assert graph.closure(edges).count() == 8
    assert {tuple(r) for r in graph.reduction(edges).collect()} == set(EDGES) - {("a", "c")}
    loop = spark.createDataFrame([("x", "y"), ("y", "x"), ("z", "x")], "sub string, sup string")
    assert {tuple(r) for r in graph.closure(loop).collect()} == {("x", "y"), ("y", "x"), ("x", "x"), ("y", "y"), ("z", "x"), ("z", "y")}
    kept, lost = graph.topological(loop)
    assert lost.collect() == [("x", "y")] and {tuple(r) for r in kept.collect()} == {("y", "x"), ("z", "x")}
    assert graph.closure(edges.limit(0)).count() == 0
    assert graph.content_hash(edges).first() == graph.content_hash(edges.orderBy(F.desc("sub"))).first()
    assert graph.merged(edges, edges).count() == graph.merged(edges).count()
    added, refused = graph.guarded_links({"a": ["b"]}, [("b", "c"), ("c", "a"), ("c", "d")])
    assert added == [("b", "c"), ("c", "d")] and refused == [("c", "a")]


@pytest.mark.parametrize(("n", "reversal", "ruling", "dissent", "published", "wanted"), [
    (2, False, None, False, False, "accepted"), (1, False, None, False, False, "single"), (1, False, None, True, False, "dissented"), (2, False, None, True, False, "accepted"),
    (3, True, None, False, False, "disputed"), (3, True, "accept", False, False, "accepted"), (5, False, "reject", False, False, "rejected"), (1, True, None, False, True, "accepted"), (2, False, "reject", False, True, "rejected"),
])
def test_status(spark, n, reversal, ruling, dissent, published, wanted):
    row = spark.createDataFrame([("a", "b", [str(i) for i in range(n)], ["r"] if reversal else [], ruling, dissent, published)], "sub string, sup string, `for` array<string>, against array<string>, ruling string, dissent boolean, published boolean")
    assert votes.status(row).first()["status"] == wanted


def test_votes_and_joins(spark):
    stated = spark.createDataFrame([("s1", "a", "b"), ("s2", "a", "b"), ("s1", "b", "a"), ("s1", "x", "x")], "source string, sub string, sup string")
    assert {(r["sub"], r["sup"]): (r["for"], r["against"]) for r in votes.witnesses(stated).collect()} == {("a", "b"): (["s1", "s2"], ["s1"]), ("b", "a"): (["s1"], ["s1", "s2"]), ("x", "x"): (["s1"], ["s1"])}
    with pytest.raises(ValueError, match="aren't in the batch"):
        votes.judged(stated.select("sub", "sup"), spark.createDataFrame([("q", "r")], "sub string, sup string"))
    assert [one(spark, votes.verdict, v) for v in ("Yes, but", "n", "maybe")] == [True, False, None]
    assert one(spark, lambda c: joins.renamed(c, [("a", "b"), ("c", "a")]), "c") == "a"
    codes = spark.createDataFrame([("k", "1234"), ("k", "1256"), ("m", "9")], "k string, c string")
    assert {tuple(r) for r in aggregates.group_prefix(codes, "k", "c").collect()} == {("k", "12"), ("m", "9")}


def test_ranks(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0)], "i int, v double")
    assert {r["i"]: r["pct"] for r in ranking.percentile(rows, "v", "i").collect()} == {3: 0.0, 1: 0.5, 2: 1.0}
    assert ranking.percentile(rows.limit(1), "v", "i").first()["pct"] == 0.0
    scores = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "s double, y int")
    assert ranking.auc(scores, "s", "y").first()["auc"] == pytest.approx(0.875)


def test_replay_is_idempotent(spark):
    edges = spark.createDataFrame([("core", "group", "agent", 0), ("core", "agent", "*", 0), ("core", "firm", "group", 0), ("pack", "club", "group", 0), ("pack", "group", "*", 0), ("pack", "team", "club", 0)], "store string, sub string, sup string, ord int")
    log = spark.createDataFrame([(0, "core", "group", "move", "agent", "*"), (1, "core", "firm", "parent+", "-", "agent"), (2, "pack", "club", "promote", "-", "group"), (3, "core", "guild", "add", "-", "firm"), (4, "core", "nothing", "cut", "a", "-")], "seq int, pack string, sub string, action string, old string, new string")
    names = spark.createDataFrame([(0, "pack", "team", "side", "respell")], "seq int, pack string, old string, new string, kind string")
    after, machine = rules.replay(edges, log, names)
    told = {(r["store"], r["sub"], r["sup"]) for r in after.collect()}
    assert {("core", "group", "*"), ("core", "firm", "agent"), ("core", "club", "group"), ("core", "guild", "firm"), ("pack", "side", "club")} <= told
    assert [e[0] for e in machine.errors] == [4]
    again, second = rules.replay(after, log, names)
    assert {(r["store"], r["sub"], r["sup"]) for r in again.collect()} == told
    assert {what for _, what in second.done} == {"already"}


STORES = {
    "core": {"entity": ["*"], "agent": ["entity"], "firm": ["agent"], "bank": ["firm"], "cell": ["entity"]},
    "pack": {"club": ["agent"], "agent": ["*"], "team": ["club"], "firm": ["club", "agent"], "kid": ["cell"], "cell": ["*"], "own": ["*"]},
    "side": {"club": ["agent"], "agent": ["*"]},
}


def machine_of(rows, prelude=None):
    m = rules.Replay({s: {n: list(p) for n, p in x.items()} for s, x in STORES.items()}, prelude or {})
    log = [rules.Ruling(p, s, a, tuple(o.split()), tuple(n.split())) for p, s, a, o, n in rows]
    m.log = rules.Log(log)
    for i, r in enumerate(log):
        m.rule(i, r.pack, r.sub, r.action, r.old, r.new, i)
    return m


@pytest.mark.parametrize(("row", "said", "at", "wanted"), [
    (("core", "guild", "add", "", "firm"), "done", "guild", ["firm"]),
    (("core", "firm", "add", "", "entity"), "already", "firm", ["agent", "entity"]),
    (("core", "firm", "add", "", "cell"), "error", "firm", ["agent"]),
    (("core", "guild", "add", "", "nowhere"), "error", "guild", None),
    (("core", "guild", "add", "", "club"), "error", "guild", None),
    (("pack", "team", "parent+", "", "cell"), "done", "team", ["club", "cell"]),
    (("pack", "team", "parent+", "", "agent"), "already", "team", ["club", "agent"]),
    (("pack", "nobody", "parent+", "", "cell"), "error", "nobody", None),
    (("pack", "team", "parent+", "", "in(cell)"), "done", "team", ["club", "in(cell)"]),
    (("pack", "team", "move", "club", "firm"), "done", "team", ["firm"]),
    (("pack", "team", "move", "cell", "agent"), "already", "team", ["club", "agent"]),
    (("pack", "team", "move", "cell", "bank"), "error", "team", ["club"]),
    (("pack", "firm", "cut", "club", ""), "done", "firm", ["agent"]),
    (("pack", "team", "cut", "club", ""), "error", "team", ["club"]),
    (("pack", "team", "cut", "cell", ""), "already", "team", ["club"]),
    (("pack", "bank", "refine", "", "team"), "error", "bank", None),
    (("pack", "bank", "refine-cross", "", "team"), "done", "bank", ["team"]),
    (("pack", "bank", "refine-cross", "", "in(cell)"), "error", "bank", None),
    (("pack", "bank", "refine-cross", "", "cell"), "error", "bank", None),
    (("core", "bank", "refine-cross", "", "team"), "error", "bank", ["firm"]),
    (("pack", "club", "promote", "", "agent"), "done", "club", ["*"]),
    (("pack", "club", "promote", "", "team"), "error", "club", ["agent"]),
    (("core", "bank", "promote", "", "agent"), "error", "bank", ["firm"]),
    (("pack", "club", "disown", "", ""), "done", "club", ["*"]),
    (("pack", "firm", "disown", "", "club"), "done", "firm", ["club"]),
    (("pack", "firm", "disown", "", "bank"), "error", "firm", ["club", "agent"]),
    (("pack", "own", "disown", "", ""), "error", "own", ["*"]),
    (("pack", "team", "drop", "", ""), "done", "team", None),
    (("core", "cell", "drop", "", ""), "error", "cell", ["entity"]),
    (("pack", "cell", "drop", "", ""), "already", "cell", ["*"]),
    (("pack", "nobody", "drop", "", ""), "already", "nobody", None),
    (("pack", "team", "swap", "", ""), "error", "team", ["club"]),
])
def test_each_action(row, said, at, wanted):
    m = machine_of([row])
    assert ([w for _, w in m.done] or ["error"]) == [said] and len(m.errors) == (said == "error")
    assert m.stores[row[0]].get(at) == wanted
    if said == "error":
        assert {s: x for s, x in m.stores.items() if x} == STORES


@pytest.mark.parametrize("rows", [
    [("pack", "team", "move", "club", "cell"), ("pack", "team", "move", "cell", "firm")],
    [("pack", "team", "parent+", "", "cell"), ("pack", "team", "cut", "cell", "")],
    [("core", "guild", "add", "", "firm"), ("core", "guild", "move", "firm", "cell")],
    [("core", "guild", "add", "", "firm"), ("core", "guild", "drop", "", "")],
    [("pack", "firm", "cut", "club", ""), ("pack", "firm", "parent+", "", "club")],
    [("pack", "team", "move", "club", "cell"), ("pack", "team", "promote", "", "agent")],
    [("pack", "bank", "refine-cross", "", "team"), ("pack", "bank", "move", "team", "club")],
    [("pack", "club", "parent+", "", "cell"), ("pack", "club", "disown", "", "")],
])
def test_later_rows_win_and_stay(rows):
    """Replayed on its own output, an earlier row doesn't bring back what a later one takes away."""
    once = machine_of(rows)
    assert not once.errors
    again = rules.Replay({s: {n: list(p) for n, p in x.items()} for s, x in once.stores.items()})
    again.log = once.log
    log = [rules.Ruling(p, s, a, tuple(o.split()), tuple(n.split())) for p, s, a, o, n in rows]
    for i, r in enumerate(log):
        again.rule(i, r.pack, r.sub, r.action, r.old, r.new, i)
    assert not again.errors and {w for _, w in again.done} == {"already"}
    assert {s: {n: set(p) for n, p in x.items()} for s, x in again.stores.items()} == {s: {n: set(p) for n, p in x.items()} for s, x in once.stores.items()}


def test_prelude_and_strictness(spark):
    m = machine_of([("core", "in", "parent+", "", "entity")], {"in": ["relation"], "relation": []})
    assert m.stores["core"]["in"] == ["relation", "entity"]
    edges = spark.createDataFrame([("core", "a", "*", 0)], "store string, sub string, sup string, ord int")
    log = spark.createDataFrame([(0, "core", "b", "move", "x", "a")], "seq int, pack string, sub string, action string, old string, new string")
    with pytest.raises(ValueError, match="b isn't in core"):
        rules.replay(edges, log, strict=True)


def test_what_follows_a_log(spark):
    rows = [("core", "shore", "*"), ("core", "coast", "shore"), ("core", "sea", "*"), ("p", "landfall", "coast"), ("p", "landfall", "shore"), ("p", "port", "in(sea)"), ("p", "port", "linear-dimension(length)"), ("p", "coast", "*"), ("q", "sea", "*"), ("q", "own", "*"), ("q", "gone", "*")]
    edges = spark.createDataFrame([(*r, 0) for r in rows], "store string, sub string, sup string, ord int")
    out = {(r["store"], r["sub"], r["sup"]) for r in rules.settled(edges, {"gone"}).collect()}
    assert out == set(rows) - {("p", "landfall", "shore"), ("q", "sea", "*"), ("q", "gone", "*")} | {("p", "sea", "*")}


def test_names_are_reused():
    """floor -> floor-surface, then storey -> floor: a second run leaves the new floor alone."""
    rows = [{"seq": 0, "pack": "core", "old": "floor", "new": "floor-surface", "kind": "sense"}, {"seq": 1, "pack": "core", "old": "storey", "new": "floor", "kind": "respell"}]
    m = rules.Replay({"core": {"floor": ["*"], "storey": ["*"], "tile": ["on(floor)"]}})
    rules.carry_out_renames(m, rows)
    assert m.stores["core"] == {"floor-surface": ["*"], "floor": ["*"], "tile": ["on(floor-surface)"]}
    rules.carry_out_renames(m, rows)
    assert m.stores["core"] == {"floor-surface": ["*"], "floor": ["*"], "tile": ["on(floor-surface)"]}


def test_paths_of_any_depth(spark):
    """A chain of 70 levels has a path for each name."""
    chain = spark.createDataFrame([(f"n{i + 1}", f"n{i}") for i in range(69)], "sub string, sup string")
    out = graph.paths(chain, spark.createDataFrame([("n0",)], "name string")).collect()
    assert sorted(len(r["path"]) for r in out) == list(range(1, 71))
