"""Guided senses, rewrites, pins, glosses and the compiler on small cases."""

from arbora.operators import revisions, rules, senses
from arbora.operators.rules import Replay


def test_guided_senses(spark):
    tree = spark.createDataFrame([("food", "root", True), ("fruit", "food", True), ("apple", "fruit", True), ("date", "fruit", True), ("bin", "root", False), ("nut", "bin", True)], "node string, parent string, guides boolean")
    labels = spark.createDataFrame([("food", "food"), ("apple", "apple"), ("date", "date"), ("bin", "bin"), ("nut", "nut"), ("fruit", "odd"), ("lone", "x"), (None, "x")], "node string, label string")
    given = [("food", "food", "f"), ("apple", "apple", "apple-f"), ("apple", "apple", "apple-firm"), ("date", "date", "day"), ("date", "date", "romance"), ("bin", "bin", "f"), ("nut", "nut", "nut-f"), ("nut", "nut", "nut-bolt"), ("lone", "x", "y"), ("lone", "x", None)]
    candidates = spark.createDataFrame(given, "node string, label string, sense string")
    above = spark.createDataFrame([("apple-f", "f"), ("nut-f", "f"), ("apple-f", "thing")], "sense string, above string")
    told = lambda df: {(r["node"], r["sense"], r["route"]) for r in df.collect()}
    plain = {("food", "f", "chosen"), ("apple", "apple-f", "chosen"), ("date", None, "ambiguous"), ("bin", "f", "chosen"), ("nut", None, "ambiguous"), ("fruit", None, "unmatched"), ("lone", "y", "chosen")}
    assert told(senses.guided_senses(tree, labels, candidates, above)) == plain
    picks = spark.createDataFrame([("food", "food", None), ("date", "date", "day")], "node string, label string, sense string")
    liked = spark.createDataFrame([("nut", "nut-bolt")], "node string, sense string")
    chosen = told(senses.guided_senses(tree, labels, candidates, above, picks, liked))
    assert {("food", None, "refused"), ("date", "day", "picked"), ("apple", None, "ambiguous"), ("nut", "nut-bolt", "chosen")} <= chosen
    assert senses.guided_senses(tree.limit(0), labels.limit(0), candidates, above).count() == 0


def test_guided_senses_write_what_is_read(spark, monkeypatch):
    """Each name's parent is found once, and the last level's choices guide nobody."""
    names = []
    monkeypatch.setattr(senses, "written", lambda df, name, f=senses.written: names.append(name) or f(df, name))
    tree = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "node string, parent string")
    labels = tree.selectExpr("node", "node as label")
    out = senses.guided_senses(tree, labels, labels.selectExpr("node", "label", "'s' as sense"), spark.createDataFrame([], "sense string, above string"))
    assert sorted(r["node"] for r in out.collect()) == ["b", "c", "x", "y"]
    assert names.count("parents") == 1 and names.count("chosen") == 3 and names.count("guides") == 2


def test_rewrites():
    m = Replay({"core": {"chain": ["*"], "in": ["*"]}, "pack": {"pool": ["coin", "box"], "coin": ["chain"], "box": ["*"], "lost": ["nowhere"], "old": ["coin"]}})
    revisions.rewrite(m, 0, "pack", "pool", "coin", "rewrite", "in(chain) chain")
    assert m.stores["pack"]["pool"] == ["box", "in(chain)", "chain"]
    revisions.rewrite(m, 1, "pack", "pool", "coin", "rewrite", "in(chain) chain")
    revisions.rewrite(m, 2, "pack", "lost", "gone", "rewrite", "chain")
    assert m.stores["pack"]["lost"] == ["chain"]
    revisions.rewrite(m, 3, "pack", "coin", "chain", "rewrite", "in(absent)")
    revisions.rewrite(m, 4, "pack", "coin", "chain", "rewrite", "box; and old ⊑ box")
    assert m.stores["pack"]["coin"] == ["box"] and m.stores["pack"]["old"] == ["coin", "box"]
    revisions.rewrite(m, 5, "pack", "old", "-", "rewrite", "(drop the name)")
    revisions.rewrite(m, 6, "pack", "old", "-", "rewrite", "(drop the name)")
    revisions.rewrite(m, 7, "pack", "box", "x", "rewrite", "(drop the name)")
    revisions.rewrite(m, 8, "pack", "coin", "chain", "keep", "whatever")
    revisions.rewrite(m, 9, "core", "chain", "*", "rewrite", "pool")
    assert m.done == [(0, "done"), (1, "already"), (2, "done"), (4, "done"), (5, "done"), (6, "already")]
    assert [s for s, _ in m.errors] == [3, 7, 9]


def test_pins():
    m = Replay({"core": {"force": ["degree", "thing"], "mass": ["linear-dimension"], "degree": ["*"], "thing": ["*"]}, "pack": {"amount-of-substance": ["count-dimension"], "odd": ["linear-dimension"]}})
    revisions.pin_heads(m, [(0, "force", "force", "degree"), (1, "absent", "x", None)])
    assert m.stores["core"]["force"] == ["thing", "linear-dimension(force)"] and [s for s, _ in m.errors] == [1]
    revisions.pin_heads(m, [(2, "force", "force", "degree")])
    assert (2, "already") in m.done
    made = revisions.pin_families(m, {"mass", "amount"})
    assert made == [("core", "mass", "linear-dimension(mass)"), ("pack", "amount-of-substance", "count-dimension(amount)")] and m.errors[-1][0] == -1


def test_glosses(spark):
    concepts = spark.createDataFrame([(0, "auto", "1"), (1, "car", "2"), (2, "van", "3"), (3, "bus", "4"), (4, "lorry", "5"), (5, "none", "")], "ord int, name string, offset string")
    texts = spark.createDataFrame([(str(i), f"g{i}") for i in range(1, 7)], "offset string, gloss string")
    over = spark.createDataFrame([(0, "bus", "-", ""), (1, "van", "-", "by hand"), (2, "new", "6", None)], "ord int, name string, offset string, gloss string")
    out = revisions.glosses(concepts, texts, [("auto", "car"), ("lorry", "truck")], over)
    assert {tuple(r) for r in out.collect()} == {("car", "g2", "2-n"), ("truck", "g5", "5-n"), ("van", "by hand", None), ("new", "g6", "6-n")}
    edges = spark.createDataFrame([("core", "car", "x"), ("core", "stub", "*"), ("p", "car", "y"), ("p", "van", "x"), ("q", "van", "x"), ("q", "new", "*"), ("p", "new", "*")], "store string, sub string, sup string")
    disowned, tops = (spark.createDataFrame([x], "store string, name string") for x in (("q", "van"), ("q", "new")))
    assert {tuple(r)[:2] for r in revisions.attached(edges, out, disowned, tops).collect()} == {("core", "car"), ("p", "van"), ("q", "new")}


def test_compiler():
    stores = {"core": {"thing": ["*"], "bank": ["thing"], "branch": ["bank"], "shore": ["thing"], "odd": ["thing", "bank"], "rare": ["thing"], "topic": ["about(bank)"]}, "pack": {"till": ["bank"]}}
    row = lambda name, action, args="", pack="core", apply="yes": {"pack": pack, "name": name, "action": action, "args": args, "reason": "why", "apply": apply}
    sheet = [row("bank", "rename", "bank-firm"), row("odd", "cut", "bank"), row("till", "move", "bank thing", "pack"), row("branch", "parent+", "shore"), row("shore", "drop"), row("rare", "drop"), row("thing", "cut", "x"), row("nobody", "move", "a b"), row("rare", "cut", "thing", apply="no")]
    out = revisions.compiled(stores, sheet, {("core", "bank"): ("a firm", "77-n")})
    kinds = [(r[1], r[2], r[3], r[4]) for r in out.rulings]
    assert kinds == [
        ("bank-firm", "add", "-", "thing"), ("branch", "move", "bank", "bank-firm"), ("odd", "move", "bank", "bank-firm"), ("topic", "move", "about(bank)", "about(bank-firm)"), ("till", "move", "bank", "bank-firm"), ("bank", "drop", "-", "-"),
        ("odd", "cut", "bank-firm", "-"), ("till", "move", "bank-firm", "thing"), ("branch", "parent+", "-", "shore"), ("rare", "drop", "-", "-"),
    ]
    assert out.senses == [("bank-firm", "77", "")] and len(out.skipped) == 3
    assert stores["core"]["branch"] == ["bank"]


def test_compiler_order():
    """A rename waits for the one that frees its target, and a doomed name is taken over in place."""
    stores = {"core": {"top": ["*"], "low": ["*"], "a": ["top"], "b": ["low"], "kid": ["b"], "c": ["low"], "d": ["top"], "leaf": ["d"]}}
    row = lambda name, action, args="": {"name": name, "action": action, "args": args, "apply": "yes"}
    out = revisions.compiled(stores, [row("a", "rename", "b"), row("b", "rename", "e"), row("c", "drop"), row("d", "split", "c | 12 low")])
    told = [(r[1], r[2], r[3], r[4]) for r in out.rulings]
    assert told == [("e", "add", "-", "low"), ("kid", "move", "b", "e"), ("b", "move", "low", "top"), ("a", "drop", "-", "-"), ("c", "move", "low", "top"), ("leaf", "move", "d", "c"), ("d", "move", "top", "low")]
    assert out.senses == [("d", "12", "")] and not out.skipped
    machine = Replay({s: {n: list(p) for n, p in x.items()} for s, x in stores.items()})
    for i, r in enumerate(out.rulings):
        machine.rule(i, r[0], r[1], r[2], [x for x in r[3].split() if x != "-"], [x for x in r[4].split() if x != "-"])
    assert not machine.errors and machine.stores["core"]["kid"] == ["e"]
    assert rules.TOP == "*"
