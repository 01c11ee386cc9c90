"""The rulings as relations against the machine that reads a log row by row."""

import random

import pytest

from arbora.operators import rules, rulings

STORES = {
    "core": {"entity": ["*"], "agent": ["entity"], "firm": ["agent"], "bank": ["firm"], "cell": ["entity"]},
    "pack": {"club": ["agent"], "agent": ["*"], "team": ["club"], "firm": ["club", "agent"], "kid": ["cell"], "cell": ["*"], "own": ["*"], "odd": ["in(cell)"]},
    "side": {"club": ["agent"], "agent": ["*"]},
}
WORDS = ["entity", "agent", "firm", "bank", "cell", "club", "team", "kid", "own", "odd", "new", "nowhere"]
LOG = "seq long, pack string, sub string, action string, old string, new string"
EDGES = "store string, sub string, sup string, ord int"
PRELUDE = {"in": ["relation"], "relation": []}


def spelt(universe, term):
    return term if term in ("*", "") else f"in({spelt(universe, term[3:-1])})" if term.startswith("in(") else f"u{universe}.{term}"


def stores_of(universes):
    return {s: {spelt(u, n): [spelt(u, p) for p in ps] for u in universes for n, ps in x.items()} for s, x in STORES.items()}


def machine_of(stores, log):
    """Every row in its turn."""
    m = rules.Replay({s: {n: list(p) for n, p in x.items()} for s, x in stores.items()}, PRELUDE)
    rows = [rules.Ruling(p, s, a, tuple(o.split()), tuple(n.split())) for _, p, s, a, o, n in log]
    m.log = rules.Log(rows)
    for seq, r, i in zip((x[0] for x in log), rows, range(len(rows)), strict=True):
        m.rule(seq, r.pack, r.sub, r.action, r.old, r.new, i)
    return m


def replayed(spark, stores, log):
    edges = spark.createDataFrame([(s, n, p, i) for s, x in stores.items() for n, ps in x.items() for i, p in enumerate(ps)], EDGES)
    return rulings.replay(edges, spark.createDataFrame(log, LOG), PRELUDE)


def compared(spark, stores, log):
    m = machine_of(stores, log)
    after, said = replayed(spark, stores, log)
    want = {seq: what for seq, what in m.done} | {seq: "error" for seq, _ in m.errors}
    got = {r["seq"]: r["what"] for r in said.collect()}
    assert {s: (got.get(s), w) for s, w in want.items() if got.get(s) != w} == {} and got.keys() == want.keys()
    settled = rules.settled(rules.edges_from(spark, m.stores), m.log.dropped_names, PRELUDE)
    assert {(r["store"], r["sub"], r["sup"]) for r in after.collect()} == {(r["store"], r["sub"], r["sup"]) for r in settled.collect()}
    return after, m


@pytest.mark.parametrize("seed", [0])
def test_random_logs(spark, seed):
    """Many small logs over names of their own, all at once."""
    rng = random.Random(seed)
    term = lambda: rng.choice([*WORDS, *WORDS, "*", f"in({rng.choice(WORDS)})"])
    some = lambda u, least: " ".join(spelt(u, term()) for _ in range(rng.randint(least, 2)))
    log = []
    for i in range(3):
        for u in range(80):
            action = rng.choice([*rulings.ACTIONS, "turn"])
            least = 0 if action in ("cut", "disown", "drop", "parent+", "move", "promote") else 1
            log.append((i * 1000 + u, rng.choice(["core", "pack", "pack", "side"]), spelt(u, rng.choice(WORDS[:-1])), action, some(u, 0), some(u, least)))
    compared(spark, stores_of(range(80)), log)


def test_rows_that_meet(spark):
    """Each row depends on the one before: moved on, put back, promoted, dropped below a parent that goes first."""
    rows = [
        ("pack", "team", "move", "club", "cell"), ("pack", "team", "move", "cell", "firm"), ("pack", "team", "parent+", "", "new"), ("pack", "new", "add", "", "club"), ("pack", "team", "parent+", "", "new"),
        ("pack", "kid", "drop", "", ""), ("pack", "cell", "drop", "", ""), ("core", "cell", "drop", "", ""), ("pack", "club", "promote", "", "agent"), ("side", "club", "disown", "", ""), ("pack", "bank", "refine-cross", "", "team"), ("pack", "bank", "cut", "team", ""),
        ("core", "in", "parent+", "", "entity"), ("pack", "in", "move", "relation", "entity"),
    ]
    log = [(i, p, s if s == "in" else spelt(0, s), a, " ".join(x if x == "relation" else spelt(0, x) for x in o.split()), spelt(0, n)) for i, (p, s, a, o, n) in enumerate(rows)]
    after, m = compared(spark, stores_of([0]), log)
    again, said = rulings.replay(after, spark.createDataFrame(log, LOG), PRELUDE)
    assert {(r["store"], r["sub"], r["sup"]) for r in again.collect()} == {(r["store"], r["sub"], r["sup"]) for r in after.collect()}
    assert "done" not in {r["what"] for r in said.collect()}


def test_nothing(spark):
    after, said = replayed(spark, stores_of([0]), [])
    assert said.collect() == [] and after.count() > 0


def test_rows_that_dont_meet_are_one_wave(spark):
    """A thousand rows about names of their own need as many jobs as ten."""

    def jobs(n):
        stores = {"core": {"top": ["*"], **{f"n{i}": ["top"] for i in range(n)}, **{f"m{i}": ["top"] for i in range(n)}}}
        log = [(i, "core", f"n{i}", "move", "top", f"m{i}") for i in range(n)]
        spark.sparkContext.setJobGroup(f"rows{n}", "")
        after, said = replayed(spark, stores, log)
        assert said.where("what = 'done'").count() == n and after.where("sup like 'm%'").count() == n
        ids = spark.sparkContext.statusTracker().getJobIdsForGroup(f"rows{n}")
        spark.sparkContext.setJobGroup("other", "")
        return len(ids)

    assert jobs(1000) <= jobs(10) + 10


@pytest.mark.parametrize("seed", [0])
def test_random_renames(spark, seed):
    """Many small logs of renames over names of their own, all at once."""
    rng = random.Random(seed)
    stores = stores_of(range(60))
    log = []
    for i in range(3):
        for u in range(60):
            old, new = rng.sample(WORDS, 2)
            log.append((i * 1000 + u, rng.choice(["core", "pack", "side"]), spelt(u, old), spelt(u, new), rng.choice(["respell", "sense", "merge", "merge", "drop"])))
    names = "seq long, pack string, old string, new string, kind string"
    edges = spark.createDataFrame([(s, n, p, i) for s, x in stores.items() for n, ps in x.items() for i, p in enumerate(ps)], EDGES)
    m = rules.Replay({s: {n: list(p) for n, p in x.items()} for s, x in stores.items()})
    rules.carry_out_renames(m, [dict(zip(("seq", "pack", "old", "new", "kind"), r, strict=True)) for r in log])
    after, said = rulings.rename(edges, spark.createDataFrame(log, names))
    want = {seq: what for seq, what in m.done} | {seq: "error" for seq, _ in m.errors}
    got = {r["seq"]: r["what"] for r in said.collect()}
    assert {s: (got.get(s), w) for s, w in want.items() if got.get(s) != w} == {}
    assert {(r["store"], r["sub"], r["sup"]) for r in after.collect()} == {(s, n, p) for s, x in m.stores.items() for n, ps in x.items() for p in ps}
