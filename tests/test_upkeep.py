"""Stores as a source, closures under change, many cycles, long trees, twins, hot labels, pulls and votes that go on."""

import os
import random
import shlex
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arbora.operators import aggregates, audit, graph, joins, ranking, votes
from arbora.plans import upkeep
from arbora.session import Grown
from arbora.sources import readers, store_source
from arbora.streaming import kept, pulls


def pairs(df):
    return {tuple(r) for r in df.collect()}


def stages_of(spark):
    """What the session's status store tells of its stages."""
    jvm = spark._jvm
    told = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, spark._sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return [told.apply(i) for i in range(told.size())]


def frame(spark, rows, schema="sub string, sup string"):
    return spark.createDataFrame(list(rows), schema)


def closed(edges):
    """Pairs with a path, by a search from every name."""
    up = {}
    for a, b in edges:
        up.setdefault(a, set()).add(b)
    out = set()
    for a in up:
        todo, seen = list(up[a]), set()
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += up.get(x, ())
        out |= {(a, x) for x in seen}
    return out


# Sessions.


def test_without_any_configuration(tmp_path):
    """A plain local session needs no setting: scratch tables go to a folder of their own."""
    code = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", "") == ""
from arbora.operators import graph
print(graph.closure(spark.createDataFrame([("a", "b"), ("b", "c")], "sub string, sup string")).count(), "pairs")
"""
    (tmp_path / "conf").mkdir()
    env = {k: v for k, v in os.environ.items() if not k.startswith("SPARK")} | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": os.getcwd()}
    out = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "3 pairs" in out.stdout, out.stderr[-2000:]


# Stores.

STORE = """# store v1
animal '*'
'sea horse' animal fish
"it's" 'sea horse'   'sea horse'

fish *\r
broken 'quote fish
#:meta 'sea horse' '{"gloss": "a fish; \\"upright\\"", "wn30": "02310334-n"}'
#:meta fish '{"wn30": 2512053}'
#:meta odd '[1]'
#:meta bad '{'
größe fish"""


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_store_source(spark, tmp_path, size):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.od").write_bytes(STORE.encode())
    (tmp_path / "s" / "_SUCCESS").write_bytes(b"no store")
    path = str(tmp_path / "s")
    edges = {("animal", "*"), ("sea horse", "animal"), ("sea horse", "fish"), ("it's", "sea horse"), ("fish", "*"), ("broken", "'quote"), ("broken", "fish"), ("größe", "fish")}
    rows = store_source.read(spark, path, range_bytes=size)
    assert sorted(tuple(r) for r in rows.collect()) == sorted(edges)
    assert pairs(store_source.read(spark, "file://" + path, range_bytes=size)) == edges
    assert {tuple(r) for r in readers.store(spark, path + "/a.od")[1].collect()} >= edges - {("fish", "*")}
    told = {r["name"]: r["parents"] for r in store_source.read(spark, path, "entries", range_bytes=size).collect()}
    assert told["it's"] == ["sea horse", "sea horse"] and told["fish"] == ["*"] and len(told) == 6
    meta = {tuple(r) for r in store_source.read(spark, path, "meta", range_bytes=size).collect()}
    assert meta == {("sea horse", 'a fish; "upright"', "02310334-n"), ("fish", None, "2512053"), ("odd", None, None), ("bad", None, None)}


def test_store_source_prunes_and_filters(spark, tmp_path):
    (tmp_path / "a.od").write_text(STORE)
    path = str(tmp_path / "a.od")
    assert store_source.read(spark, path, columns=["sup"]).columns == ["sup"] and store_source.read(spark, path, columns=["sup"]).distinct().count() == 5
    for on in ("true", "false"):
        spark.conf.set(store_source.PUSHDOWN, on)
        df = store_source.read(spark, path)
        assert pairs(df.where("sup = 'fish' and sub like 'se%'")) == {("sea horse", "fish")}
        assert pairs(df.where(F.col("sub").isin("it's", "fish") & (F.length("sup") > 1))) == {("it's", "sea horse")}
        assert {r["name"] for r in store_source.read(spark, path, "meta").where("wn30 = '02310334-n'").collect()} == {"sea horse"}
    spark.conf.unset(store_source.PUSHDOWN)
    reader = store_source.PushingReader({"path": path})
    left = list(reader.pushFilters([store_source.EqualTo(("sup",), "fish"), store_source.EqualTo(("x",), "y")]))
    assert len(left) == 1 and len([r for p in reader.partitions() for r in reader._rows(p)]) == 3
    with pytest.raises(ValueError):
        store_source.columns_of("edges", "name")


# Closures.


def test_known_pairs_are_not_shuffled(spark):
    """What is compared with all that is known is shuffled, what is known isn't."""
    known = Grown(frame(spark, []), ["sub", "sup"])
    known.add(frame(spark, [(str(i), str(i + 1)) for i in range(100)]))
    known.add(frame(spark, [(str(i), str(i + 2)) for i in range(100)]))
    new = known.without(frame(spark, [(str(i), str(i + 2)) for i in range(90, 110)]))
    plan = new._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "Bucketed: true" in line)
    assert new.count() == 10 and known.all().count() == 200
    above = plan[: plan.index(scan)].rsplit("Join", 1)[1]
    assert "Exchange" not in above


def test_closure_of_a_chain(spark):
    n = 40
    assert graph.closure(frame(spark, [(str(i), str(i + 1)) for i in range(n)])).count() == n * (n + 1) // 2


def test_later_rounds_send_no_edges_to_the_driver(spark):
    up = graph._hops(frame(spark, [("a", "b")]), 2)
    assert ["Hint" in up()._jdf.queryExecution().analyzed().toString() for _ in range(4)] == [False, False, True, True]


@pytest.mark.parametrize("seed", range(1))
def test_shared_closure(spark, seed):
    """Sets of more names than a row holds, with loops: as by a search."""
    rng = random.Random(seed)
    edges = {(f"n{rng.randint(0, 300)}", f"n{rng.randint(0, 300)}") for _ in range(1200)} | {("x", "x"), ("lone", "n1")}
    out = graph.shared_closure(frame(spark, edges))
    assert pairs(out) == closed(edges) and out.count() == len(closed(edges))
    assert graph.shared_closure(frame(spark, [])).count() == 0


def test_shared_closure_joins_no_pair_for_each_path(spark):
    """600 names below 30, all of which are below the same 200: 18,000 rows go on to these, not 3,600,000 pairs."""
    edges = frame(spark, [(f"p{i}", f"s{j}") for i in range(600) for j in range(30)] + [(f"s{j}", f"o{k}") for j in range(30) for k in range(200)])
    spark.range(1).count()
    before = max([s.stageId() for s in stages_of(spark)], default=-1)
    assert graph.shared_closure(edges).count() == 600 * 30 + 30 * 200 + 600 * 200
    assert max(s.shuffleWriteRecords() for s in stages_of(spark) if s.stageId() > before) < 100_000


def test_shared_closure_shuffles_no_row_for_each_path_and_block(spark):
    """600 names below 30, all of which are below the same 600: what is shuffled is united first, even if no table is sent to all tasks."""
    edges = frame(spark, [(f"p{i}", f"s{j}") for i in range(600) for j in range(30)] + [(f"s{j}", f"o{k}") for j in range(30) for k in range(600)])
    spark.range(1).count()
    before = max([s.stageId() for s in stages_of(spark)], default=-1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert graph.shared_closure(edges).count() == 600 * 30 + 30 * 600 + 600 * 600
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(s.shuffleWriteRecords() for s in stages_of(spark) if s.stageId() > before) < 10_000


def test_shared_closure_in_small_tasks(spark, monkeypatch):
    """The same whatever is united in a task, and whether numbers are sent or sorted."""
    rng = random.Random(3)
    edges = {(f"n{rng.randint(0, 700)}", f"n{rng.randint(0, 700)}") for _ in range(1100)} | {("x", "x")}
    for name, value in (("NEAR", 2), ("VIA_ROWS", 40), ("OVER_ROWS", 70), ("MOST_SENT", 0)):
        monkeypatch.setattr(graph, name, value)
    out = graph.shared_closure(frame(spark, edges))
    assert pairs(out) == closed(edges) and out.count() == len(closed(edges))


@pytest.mark.parametrize("joined", [1, 50, 1 << 20])
def test_united_in_slices(monkeypatch, joined):
    monkeypatch.setattr(graph, "JOINED", joined)
    rng = random.Random(4)
    below = {(n, rng.randint(0, 600)) for n in "abcdefgh" for _ in range(25)}
    above = {(a, rng.randint(0, 900)) for a in range(0, 600, 2) for _ in range(4)}

    def sets(rows, key, type_):
        words = {}
        for a, b in rows:
            words.setdefault((a, b // 256), [0] * 4)[b % 256 // 64] |= 1 << b % 64
        signed = [[w - (1 << 64) if w >> 63 else w for w in x] for x in words.values()]
        return pa.table({key: pa.array([a for a, _ in words], type_), "block": pa.array([b for _, b in words], pa.int64()), **{w: pa.array([x[i] for x in signed], pa.int64()) for i, w in enumerate(graph.BITS)}})

    got = graph._united(sets(below, "name", pa.string()), sets(above, "above", pa.int64())).to_pylist()
    told = {(r["name"], r["block"] * 256 + 64 * i + j) for r in got for i, w in enumerate(graph.BITS) for j in range(64) if r[w] >> j & 1}
    assert told == {(n, b) for n, x in below for a, b in above if a == x}


@pytest.mark.parametrize("seed", range(3))
def test_revised_closure(spark, seed):
    """Edges in and out, loops among them: as closing anew."""
    rng = random.Random(seed)
    edge = lambda: (f"n{rng.randint(0, 30)}", f"n{rng.randint(0, 30)}")
    before = {edge() for _ in range(40)}
    after = {e for e in before if rng.random() > 0.2} | {edge() for _ in range(6)}
    out = graph.revised_closure(frame(spark, closed(before)), frame(spark, before), frame(spark, after))
    assert pairs(out) == closed(after) and out.count() == len(closed(after))


def test_revised_closure_shuffles_what_differs(spark):
    """2,000 names below 20 below one: rounds go on over the 20 edges, and when one of these moves, what was known isn't shuffled anew."""
    inner = [(f"p{j}", "top") for j in range(20)]
    before = [(f"c{i}", f"p{i % 20}") for i in range(2000)] + inner
    after = [(a, "p1" if a == "c0" else b) for a, b in before] + [("top", "world")]
    conf = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(conf, "4k")
    try:
        known, seen = graph.closure(frame(spark, before)), max(s.stageId() for s in stages_of(spark))
        out = graph.revised_closure(known, frame(spark, before), frame(spark, after))
        assert pairs(out) == closed(after)
    finally:
        spark.conf.unset(conf)
    assert sum(s.shuffleWriteRecords() for s in stages_of(spark) if s.stageId() > seen) < 10_000


def test_revised_closure_of_nothing(spark):
    none, one = frame(spark, []), frame(spark, [("a", "b")])
    assert pairs(graph.revised_closure(none, none, one)) == {("a", "b")} and pairs(graph.revised_closure(one, one, none)) == set() == pairs(graph.revised_closure(none, none, none))


# Cycles.


def in_turn(edges):
    """The rule, one name after the other."""
    waiting = {}
    for a, b in edges:
        waiting.setdefault(a, set()).add(b)
    placed = {b for _, b in edges} - waiting.keys()
    lost = set()
    while waiting:
        ready = [n for n, ps in waiting.items() if ps <= placed]
        if not ready:
            n = min(waiting, key=lambda x: (len(waiting[x] - placed), x))
            lost |= {(n, p) for p in waiting[n] - placed}
            waiting[n] &= placed
            continue
        for n in ready:
            del waiting[n]
            placed.add(n)
    return set(edges) - lost, lost


@pytest.mark.parametrize("seed", range(4))
def test_cycles_as_in_turn(spark, seed):
    rng = random.Random(seed)
    edges = {(f"{p}{rng.randint(0, 7)}", f"{p}{rng.randint(0, 7)}") for p in "abc" for _ in range(10)} | {("a1", "root"), ("b1", "root")}
    kept_, lost = graph.topological(frame(spark, edges))
    assert (pairs(kept_), pairs(lost)) == in_turn(edges)


def test_many_cycles_need_no_more_jobs(spark):
    def jobs(n):
        spark.sparkContext.setJobGroup(f"cycles{n}", "")
        loops = [e for i in range(n) for e in ((f"a{i}", f"b{i}"), (f"b{i}", f"c{i}"), (f"c{i}", f"a{i}"))]
        kept_, lost = graph.topological(frame(spark, loops))
        count = lost.count()
        ids = spark.sparkContext.statusTracker().getJobIdsForGroup(f"cycles{n}")
        spark.sparkContext.setJobGroup("other", "")
        assert count == n and kept_.count() == 2 * n
        return len(ids)

    few = jobs(10)
    assert jobs(10_000) <= few * 1.3 + 10


def test_what_cycles_shuffle(spark):
    """Rows that are shuffled for each edge of many loops."""
    loops = [e for i in range(5000) for e in ((f"a{i}", f"b{i}"), (f"b{i}", f"a{i}"))]
    before = max([s.stageId() for s in stages_of(spark)], default=-1)
    kept_, lost = graph.topological(frame(spark, loops))
    assert kept_.count() == lost.count() == 5000
    assert sum(s.shuffleWriteRecords() for s in stages_of(spark) if s.stageId() > before) < 10 * len(loops)


# Trees.


def preorder(edges):
    down, subs = {}, {a for a, _ in edges}
    for a, b in edges:
        down.setdefault(b, []).append(a)
    out, at = {}, 0
    stack = [(n, False) for n in sorted({b for _, b in edges} - subs, reverse=True)]
    while stack:
        n, done = stack.pop()
        if done:
            out[n] = (out[n], at - 1)
            continue
        out[n] = at
        at += 1
        stack.append((n, True))
        stack += [(c, False) for c in sorted(down.get(n, ()), reverse=True)]
    return {(n, a, z) for n, (a, z) in out.items()}


def test_numbered_forest(spark):
    rng = random.Random(3)
    edges = {(f"n{i:03d}", f"n{rng.randint(0, i - 1):03d}") for i in range(1, 120) if i % 40}
    told = graph.numbered_tree(frame(spark, edges))
    assert pairs(told) == preorder(edges)
    wanted = [(f"n{rng.randint(0, 130):03d}", f"n{rng.randint(0, 130):03d}") for _ in range(200)]
    above = closed(edges)
    assert {(r["sub"], r["sup"]): r["below"] for r in graph.within(told, frame(spark, wanted)).collect()} == {p: p in above for p in wanted}


def test_a_deep_tree(spark):
    """A chain of 100,000 levels with a leaf at each, in as many rounds as its length has binary digits."""
    n = 100_000
    i = spark.range(1, n).select(F.lpad(F.col("id").cast("string"), 7, "0").alias("i"), F.lpad((F.col("id") - 1).cast("string"), 7, "0").alias("up"))
    edges = i.select(F.concat(F.lit("n"), "i").alias("sub"), F.concat(F.lit("n"), "up").alias("sup")).union(i.select(F.concat(F.lit("l"), "i"), F.concat(F.lit("n"), "i")))
    told = graph.numbered_tree(edges).cache()
    # Leaves come before the chain goes on (l before n).
    level = F.substring("name", 2, 9).cast("long")
    want = F.when(F.col("name").startswith("l"), 2 * level).when(level == 0, 0).otherwise(2 * level - 1)
    last = F.when(F.col("name").startswith("l"), 2 * level).otherwise(2 * n - 2)
    assert told.count() == 2 * n - 1 and told.where((F.col("pre") != want) | (F.col("last") != last)).count() == 0


def test_estimated_cones(spark):
    """Sketches over a graph with many ways to the same names: within 5 % of the exact cones."""
    n = 300
    edges = [(f"a{i}", f"b{j}") for i in range(n) for j in {i % 17, i % 5, i % 3}] + [(f"b{j}", f"c{j % 4}") for j in range(17)] + [(f"c{j}", "top") for j in range(4)]
    about = {r["name"]: r["cone"] for r in graph.estimated_cone_sizes(frame(spark, edges)).collect()}
    exact = {}
    for a, b in closed(set(edges)):
        exact[b] = exact.get(b, 0) + 1
    assert about.keys() == {x for e in edges for x in e} and all(abs(v - exact.get(k, 0)) <= 0.05 * exact.get(k, 0) for k, v in about.items())
    loop = {r["name"]: r["cone"] for r in graph.estimated_cone_sizes(frame(spark, [("a", "b"), ("b", "a"), ("a", "c")])).collect()}
    assert loop == {"a": 2, "b": 2, "c": 2}


# Twins.


@pytest.mark.parametrize("least", [0.9, 0.3])
def test_twins_as_all_pairs(spark, least):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(12, 8))
    v = middles[rng.integers(0, 12, 260)] + 0.25 * rng.normal(size=(260, 8))
    hubs = [f"h{i}" if i % 40 == 0 else f"h{i - 1}" if i % 40 == 1 else None if i % 3 else "" for i in range(260)]
    rows = [(f"v{i:03d}", hubs[i], v[i].tolist()) for i in range(258)] + [("none", None, None), ("zero", None, [0.0] * 8), ("hub", "h80", None)]
    df = spark.createDataFrame(rows, "name string, hub string, vector array<double>")
    own, pool = df.where("name < 'v150' or name = 'hub'"), df.where("name > 'v050' or name in ('hub', 'none', 'zero')")
    a, b = ({r["name"]: (r["hub"], r["vector"]) for r in x.collect()} for x in (own, pool))
    want = {}
    for n, (hub, x) in a.items():
        same = sorted(m for m, (h, _) in b.items() if hub and h == hub and m != n)
        if same:
            want[n] = (same[0], 1.0)
            continue
        told = sorted((-round(float(np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y)), 9), m) for m, (_, y) in b.items() if m != n and x and y and any(y))
        if told and -told[0][0] >= least:
            want[n] = (told[0][1], -told[0][0])
    for size in (1024, 16):
        got = {r["name"]: (r["twin"], round(r["sim"], 9)) for r in ranking.twins(own, pool, least, size).collect()}
        assert got == want
    assert ranking.twins(own, pool.limit(0), least).count() == 0 == ranking.twins(own.limit(0), pool, least).count()


def test_twins_by_blocks_as_by_cells(spark):
    """The same twins whether vectors are sent to cells or blocks are compared with blocks; names that occur twice and hubs among them."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(400, 6))
    rows = [(f"v{i if i % 37 else i + 1:03d}", f"h{i // 50}" if i % 50 < 2 else "", x.tolist()) for i, x in enumerate(v)] + [("none", "", None), ("zero", "", [0.0] * 6)]
    df = spark.createDataFrame(rows, "name string, hub string, vector array<double>")
    own, pool = df.where("name < 'v300'"), df.where("name > 'v100'")
    for least in (0.95, -1.0):
        told = lambda **how: {(r["name"], r["twin"], round(r["sim"], 9)) for r in ranking.twins(own, pool, least, **how).collect()}  # noqa: B023, E731
        by_cells = told(most_open=1e9)
        assert len(by_cells) > 50 and told(most_open=-1, block=7) == by_cells == told(most_open=-1)


def test_spread_vectors_are_not_sent_to_all_cells(spark):
    """Where bounds rule out little, what is shuffled and written is the tables a few times, not a row for each cell."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(f"v{i}", "", x.tolist()) for i, x in enumerate(rng.normal(size=(900, 16)))], "name string, hub string, vector array<double>").cache()
    df.count()
    before = max([s.stageId() for s in stages_of(spark)], default=-1)
    assert ranking.twins(df, df, 0.1).count() > 800
    assert max(max(s.shuffleWriteRecords(), s.outputRecords()) for s in stages_of(spark) if s.stageId() > before) < 4 * 900


def test_cells_leave_most_pairs_out(spark):
    """On vectors in clusters the products grow more slowly than all pairs."""
    rng = np.random.default_rng(2)

    def products(n):
        v = rng.normal(size=(n // 20, 8)).repeat(20, axis=0) + 0.05 * rng.normal(size=(n, 8))
        df = spark.createDataFrame([(f"v{i:05d}", None, x.tolist()) for i, x in enumerate(v)], "name string, hub string, vector array<double>")
        seen = []
        whole = ranking._products

        def counted(visits, pool, per_task):
            seen.append(visits.groupBy("cell").count().join(pool.groupBy("cell").agg(F.count("*").alias("m")), "cell").agg(F.sum(F.col("count") * F.col("m")).alias("n")).first()["n"] or 0)
            return whole(visits, pool, per_task)

        ranking._products = counted
        try:
            assert ranking.twins(df, df, 0.9).count() == n
        finally:
            ranking._products = whole
        return sum(seen)

    few, many = products(500), products(2000)
    assert many < 2000 * 2000 / 4 and many < 12 * few


# Hot labels.


def test_merging_under_a_hot_label(spark):
    rows = [(f"i{k:04d}", "same" if k % 3 == 0 else f"l{k % 50}", k, [f"i{(k * 7) % 900:04d}", "i0000", f"x{k}"]) for k in range(900)] + [("z", None, 0, ["i0001"]), ("y", "alone", 5, None)]
    heads, alias = {}, {}
    for i, label, o, _ in rows:
        if label is not None:
            heads[label] = min(heads.get(label, (o, i)), (o, i))
    alias = {i: heads[label][1] for i, label, _, _ in rows if label is not None}
    want = {h: (label, sorted({alias[p] for i, lab, _, ps in rows if lab == label for p in ps or () if p in alias and alias[p] != h})) for label, (_, h) in heads.items()}
    got = {r["id"]: (r["label"], r["parents"]) for r in aggregates.merged_by_label(spark.createDataFrame(rows, "id string, label string, ord int, parents array<string>")).collect()}
    assert got == want


def test_matches_of_a_hot_label(spark):
    labels = [("hot", f"i{k:05d}") for k in range(5000)] + [("one", "a"), ("one", "a"), ("two", "b"), ("two", "a"), (None, "c"), ("none", None)]
    concepts = [("x", "hot"), ("y", "one"), ("z", "two"), ("q.r", "one"), ("w", "none"), ("v", None)]
    told = joins.bounded_matches(frame(spark, concepts, "name string, key string"), frame(spark, labels, "key string, id string"))
    assert {r["name"]: (r["ids"], r["n"]) for r in told.collect()} == {"x": ([f"i{k:05d}" for k in range(6)], 5000), "y": (["a"], 1), "z": (["a", "b"], 2)}
    assert pairs(joins.unique_matches(told)) == {("y", "a")} and joins.ambiguous_matches(told).count() == 2


def test_a_hot_key_is_dealt_to_all_tasks(spark):
    rows = aggregates.salted(spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("label")), "id")
    per = rows.where("label = 'hot'").groupBy(aggregates.SALT).count().collect()
    assert len(per) == 8 and max(r["count"] for r in per) < 2 * 10_000 / 8


# Picks by hand.


def test_media_rows(spark):
    registered = frame(spark, [("text/a", "A"), ("image/b", "B"), ("text/b", "B"), ("text/C", "C"), ("odd", "O")], "media_type string, label string")
    formats = spark.createDataFrame([("f1", ["a-file", "a"]), ("f2", ["b"]), ("f3", ["zzz"]), ("f4", ["c", "b"]), ("f5", ["a"]), ("f6", ["a"])], "name string, keys array<string>")
    picks = frame(spark, [("f5", "-", None, 0), ("f6", "text/a", "x", 0), ("f6", "text/C", " ", 1), ("new", "image/b", "why", 0), ("bad", "no/such", None, 0)], "name string, media_type string, note string, ord int")
    got = {r["name"]: (r["media_type"], r["note"], r["how"]) for r in audit.media_rows(registered, formats, picks).collect()}
    assert got == {"f1": ("text/a", "by name: A", "named"), "f2": (None, None, "ambiguous"), "f4": ("text/C", "by name: C", "named"), "f6": ("text/C", "pick: C", "picked"), "new": ("image/b", "why", "picked"), "bad": (None, None, "unknown")}


# Streams.


def test_a_pull_goes_on_after_a_failure(spark, tmp_path):
    ids = spark.createDataFrame([(str(i),) for i in range(60)] + [("3",), (None,)], "id string")
    chunks, answers, checkpoint, calls = (str(tmp_path / n) for n in ("chunks", "answers", "checkpoint", "calls"))
    os.makedirs(calls)
    pulls.deal(ids, "id", 5, chunks, 12)
    down = str(tmp_path / "down")

    def ask(values):
        import os
        import uuid

        open(f"{calls}/{'-'.join(values)}.{uuid.uuid4().hex}", "w").close()
        if os.path.exists(down) and len(os.listdir(calls)) > 7:
            raise ValueError("the source is gone")
        return [(v, f"label {v}") for v in values]

    def run():
        return pulls.pull(spark, chunks, ask, "id string, label string", answers, checkpoint, files_at_once=2, tries=1)

    open(down, "w").close()
    with pytest.raises(Exception, match="gone"):
        run().awaitTermination()
    before = {r["id"] for r in spark.read.schema("id string, label string").parquet(answers).collect()}
    asked = len(os.listdir(calls))
    assert 0 < len(before) < 60
    os.unlink(down)
    run().awaitTermination()
    told = [tuple(r) for r in spark.read.schema("id string, label string").parquet(answers).collect()]
    assert sorted(told) == sorted((str(i), f"label {i}") for i in range(60))
    again = [f.split(".")[0].split("-") for f in sorted(os.listdir(calls), key=lambda f: os.path.getmtime(f"{calls}/{f}"))[asked:]]
    assert not before & {v for values in again for v in values}
    run().awaitTermination()
    assert len(os.listdir(calls)) == asked + len(again)


def test_kept_votes_end_as_the_batch(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice("stuv"), f"n{rng.randint(0, 6)}", f"n{rng.randint(0, 6)}", rng.random() < 0.7, i) for i in range(400)] + [(None, "n0", "n1", True, 1000), ("s", None, "n1", True, 1001), ("s", "n0", "n1", None, 1002)]
    rng.shuffle(rows)
    schema = "source string, sub string, sup string, stated boolean, ord long"
    df = spark.createDataFrame(rows, schema)
    df.repartition(5).write.parquet(str(tmp_path / "log"))
    session = spark.newSession()
    session.conf.set(*kept.STORE)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    stream = lambda: session.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "log"))
    kept.keep(stream(), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    told = lambda df: sorted((r["sub"], r["sup"], r["for"], r["against"]) for r in df.collect())
    assert told(kept.current(spark, str(tmp_path / "out"))) == told(kept.votes_of(df))
    more = [("w", "n1", "n0", True, 2000), ("s", "n0", "n1", True, 2001)]
    spark.createDataFrame(more, schema).write.mode("append").parquet(str(tmp_path / "log"))
    kept.keep(stream(), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert told(kept.current(spark, str(tmp_path / "out"))) == told(kept.votes_of(spark.createDataFrame(rows + more, schema)))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), max_size=12))
def test_the_rule_in_turn_leaves_no_cycle(edges):
    kept_, _ = in_turn({(f"n{a}", f"n{b}") for a, b in edges})
    assert not any(a == b for a, b in closed(kept_))


def test_kept_votes_are_an_aggregation_of_spark(spark, tmp_path):
    """No row of the state is read or written by Python: a voice would cost some milliseconds."""
    schema = "source string, sub string, sup string, stated boolean, ord long"
    spark.createDataFrame([(f"s{i}", "a", "b", i % 3 > 0, i) for i in range(300)], schema).write.parquet(str(tmp_path / "log"))
    session = spark.newSession()
    session.conf.set(*kept.STORE)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    query = kept.keep(session.readStream.schema(schema).parquet(str(tmp_path / "log")), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert [o["operatorName"] for o in query.lastProgress["stateOperators"]] == ["stateStoreSave"]
    assert [(r["sub"], r["sup"], len(r["for"]), r["against"]) for r in kept.current(spark, str(tmp_path / "out")).collect()] == [("a", "b", 200, [])]


def test_a_lookup_reads_the_part_of_its_chunk(spark, tmp_path):
    """Chunks are of one part, and other parts' answers aren't opened."""
    ids = spark.range(3000).select(F.col("id").cast("string").alias("id"))
    parts = readers.parts_of(3000, 10)
    ids.withColumn("label", F.concat(F.lit("l"), "id")).withColumn("p", readers.part_of(F.col("id"), parts)).write.partitionBy("p").parquet(str(tmp_path / "answers"))
    ask = upkeep.looked_up_in(str(tmp_path / "answers"), parts)
    assert parts == 5
    for r in readers.chunked(ids, "id", 10).limit(20).collect():
        (own,) = {zlib.crc32(v.encode()) % parts for v in r["values"]}
        hidden = [p for p in range(parts) if p != own]
        for p in hidden:
            os.rename(tmp_path / "answers" / f"p={p}", tmp_path / f"p={p}")
        assert ask(r["values"]) == [(v, f"l{v}") for v in r["values"]]
        for p in hidden:
            os.rename(tmp_path / f"p={p}", tmp_path / "answers" / f"p={p}")
    assert ask(["none"]) == []


def test_types_and_formats_meet_as_one_row_each(spark):
    """Many formats under a key, and a type that is registered many times, make no pairs."""
    registered = spark.range(3000).select(F.lit("image/x-a").alias("media_type")).union(frame(spark, [("image/b",), (None,)], "media_type string"))
    formats = spark.range(3000).select(F.concat(F.lit("f"), "id").alias("name"), F.array(F.lit("a"), F.lit("a")).alias("keys")).union(frame(spark, [("g", ["b", "b"]), (None, ["b"])], "name string, keys array<string>"))
    out = audit.media_route(registered, formats)
    assert pairs(out) == {("image/x-a", None, "ambiguous"), ("image/b", "g", "picked"), (None, None, "unmatched")}
    assert "collect_set" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_a_queue_is_decided_once(spark):
    """All sections read what was decided from where it was written."""
    calls = spark.sparkContext.accumulator(0)
    told = F.udf(lambda x: (calls.add(1), x)[1], "string").asNondeterministic()
    rows = frame(spark, [("a", "b", "single", False), ("a", "c", "disputed", True), ("d", "a", "accepted", False)], "sub string, sup string, status string, contradicted boolean")
    out = votes.review_queue(rows.withColumn("status", told("status")), frame(spark, [("a",), ("b",)], "name string"), rows.limit(0).select("sub", "sup"))
    assert pairs(out.drop("section_ord")) == {("contradicted", "a", "c"), ("disputed", "a", "c"), ("single", "a", "b"), ("unplaced", "c", None), ("unplaced", "d", "a")}
    assert calls.value == 3


def test_reduction_closes_what_siblings_need(spark, monkeypatch):
    """A tree has no siblings, so that nothing is closed; else the closure begins at parents of names with several."""
    tree = frame(spark, [("a", "b"), ("b", "c"), ("d", "c")])
    monkeypatch.setattr(graph, "closure", lambda edges: pytest.fail("closed"))
    monkeypatch.setattr(graph, "ancestors", lambda edges, names: pytest.fail("closed"))
    assert pairs(graph.reduction(tree)) == {("a", "b"), ("b", "c"), ("d", "c")}
    monkeypatch.undo()
    rng = random.Random(8)
    edges = {(f"n{b}", f"n{a}") for a, b in (sorted(rng.sample(range(25), 2)) for _ in range(70))}
    whole = closed(edges)
    assert pairs(graph.reduction(frame(spark, edges))) == {(a, b) for a, b in edges if not any(a == x and m != b and (m, b) in whole for x, m in edges)}


def test_lines_without_quotes(spark):
    """The short way parts lines as shlex does."""
    for line in ("a b", " a\tb\r", "a\x0bb c d", "#a b", "a 'b c' d", "a \\b", 'a "b', "", "é ~ * ( ) ;|&"):
        try:
            wanted = shlex.split(line, comments=False)
        except ValueError:
            wanted = line.split()
        assert store_source.fields(line) == wanted == readers._split_quoted(line)


def test_centroids_send_no_places(spark):
    """Vectors of any lengths, with nulls; a row for each group is shuffled, not one for each place."""
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0]), ("a", [None, 4.0, 5.0]), ("b", [1.0]), ("c", []), ("c", None)], "k string, v array<double>")
    out = ranking.centroids(df, "k", "v")
    assert {(r["k"], tuple(r["centroid"]), r["n"]) for r in out.collect()} == {("a", (2.0, 3.0, 5.0), 3), ("b", (1.0,), 1)}
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_small_cones_are_exact(spark):
    """Two names that a sketch doesn't tell apart count as two."""
    names = spark.range(90000).select(F.concat(F.lit("x"), "id").alias("x"))
    alike = names.groupBy("x").agg(F.hll_sketch_agg("x", F.lit(14)).alias("s")).groupBy("s").agg(F.collect_list("x").alias("x")).where(F.size("x") > 1).first()["x"][:2]
    edges = [(x, "top") for x in alike] + [("top", "all")] + [(f"y{i}", "all") for i in range(61)]
    assert {r["name"]: r["cone"] for r in graph.estimated_cone_sizes(frame(spark, edges)).where("cone > 0").collect()} == {"top": 2, "all": 64}
    told = {r["name"]: r["cone"] for r in graph.estimated_cone_sizes(frame(spark, edges), exact=8).where("cone > 0").collect()}
    assert told["top"] == 2 and abs(told["all"] - 64) <= 2


def test_view_as_all_pairs(spark):
    """Names of several ids, names that are aligned twice, and an id of many names: each pair once, in blocks of a bounded size."""
    rng = random.Random(9)
    rows = [(f"a{rng.randint(0, 40)}", f"i{rng.randint(0, 5)}", rng.random() < 0.5) for _ in range(120)] + [("z", None, True), ("z", None, False), (None, "i1", True)]
    above = {("i0", "i1"), ("i1", "i2"), ("i0", "i2"), ("i3", "i2"), ("i4", "i4")}
    wanted = {(n, m) for n, i, e in rows for m, j, f in rows if f and n and m and i and j and n != m and (((i, j) in above and i != j) or (not e and i == j))}
    df, up = spark.createDataFrame(rows, "name string, id string, exact boolean"), frame(spark, above)
    got = joins.view(df, up).collect()
    assert len(got) == len(wanted) and {tuple(r) for r in got} == wanted
    pairs_, tops = frame(spark, [(f"n{i}", "i") for i in range(50)], "name string, sup_id string"), frame(spark, [("i", f"m{i}") for i in range(50)], "sup_id string, sup string")
    blocks = joins._in_blocks(pairs_, tops, 8)
    assert blocks.count() == 2500 and blocks.select("x", "y").distinct().count() == 49


def test_a_slice_of_visits_is_bounded(spark):
    """However many cells are open, what a task holds at once is bounded; nothing is missed by that."""
    rng = np.random.default_rng(5)
    rows = [(f"v{i}", "", [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    df = spark.createDataFrame(rows, "name string, hub string, vector array<double>")
    told = lambda **more: {(r["name"], r["twin"], round(r["sim"], 9)) for r in ranking.twins(df, df, 0.1, **more).collect()}
    assert told(most_visits=17) == told()


def test_steps_of_a_tree_are_numbers(spark, monkeypatch):
    """What is jumped over has no names, and one step for each name without children."""
    seen = []
    real = graph.written
    monkeypatch.setattr(graph, "written", lambda df, name: (seen.append((name, df)), real(df, name))[1])
    edges = [("b", "a"), ("c", "a"), ("d", "b"), ("e", "b"), ("g", "f")]
    got = {tuple(r) for r in graph.numbered_tree(frame(spark, edges)).collect()}
    assert got == {("a", 0, 4), ("b", 1, 3), ("d", 2, 2), ("e", 3, 3), ("c", 4, 4), ("f", 5, 6), ("g", 6, 6)}
    steps = [df for name, df in seen if name == "steps"]
    assert set(dict(steps[0].dtypes).values()) == {"bigint"} and steps[0].count() == 7 + 3
