"""The operators as queries over the star-schema tables, with the same in SQL where SQL can express them.

Names carry a letter for their table, so that keys don't collide: o:1 below c:7 below n:3 below r:0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.functions import text
from arbora.operators import aggregates, audit, graph, joins, ranking, revisions, rules, senses, votes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """t.orders and so on."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def named(letter: str, column: str) -> Column:
    return F.concat(F.lit(f"{letter}:"), F.col(column).cast("string"))


# Graphs.


def geo_rows(t: Tables) -> DataFrame:
    """geo's edges as the tables have them: what makes them distinct itself needs no geo()."""
    edge = lambda df, a, b: df.select(named(*a).alias("sub"), named(*b).alias("sup"))
    up = edge(t.nation, ("n", "n_nationkey"), ("r", "n_regionkey"))
    for df, a, b in ((t.customer, ("c", "c_custkey"), ("n", "c_nationkey")), (t.supplier, ("s", "s_suppkey"), ("n", "s_nationkey")), (t.orders, ("o", "o_orderkey"), ("c", "o_custkey"))):
        up = up.union(edge(df, a, b))
    return up


def geo(t: Tables) -> DataFrame:
    return graph.edges_of(geo_rows(t))


GEO = """geo AS (SELECT 'n:'||n_nationkey AS sub, 'r:'||n_regionkey AS sup FROM nation UNION SELECT 'c:'||c_custkey, 'n:'||c_nationkey FROM customer
UNION SELECT 's:'||s_suppkey, 'n:'||s_nationkey FROM supplier UNION SELECT 'o:'||o_orderkey, 'c:'||o_custkey FROM orders)"""
CLOSED = "closed AS (SELECT sub, sup FROM {0} UNION SELECT closed.sub, {0}.sup FROM closed JOIN {0} ON closed.sup = {0}.sub)"
GEO_CLOSED = f"WITH RECURSIVE {GEO}, {CLOSED.format('geo')}"
DEPTHS = "depths AS (SELECT 'r:'||r_regionkey AS name, 0 AS depth FROM region UNION SELECT geo.sub, depth + 1 FROM depths JOIN geo ON geo.sup = depths.name)"
CONES = "cones AS (SELECT name, coalesce(n, 0) AS cone FROM (SELECT sub AS name FROM geo UNION SELECT sup FROM geo) LEFT JOIN (SELECT sup AS name, count(*) AS n FROM closed GROUP BY sup) USING (name))"


def goods(t: Tables) -> DataFrame:
    """Parts below a brand and a type, and these below roots."""
    part = t.part.select(named("p", "p_partkey").alias("part"), named("b", "p_brand").alias("brand"), named("t", "p_type").alias("type"))
    pairs = F.array(*[F.struct(a.alias("sub"), b.alias("sup")) for a, b in ((F.col("part"), F.col("brand")), (F.col("part"), F.col("type")), (F.col("brand"), F.lit("brand")), (F.col("type"), F.lit("type")), (F.lit("brand"), F.lit("goods")), (F.lit("type"), F.lit("goods")))])
    return graph.edges_of(part.select(F.explode(pairs).alias("x")).select("x.sub", "x.sup"))


GOODS = """goods AS (SELECT 'p:'||p_partkey AS sub, 'b:'||p_brand AS sup FROM part UNION SELECT 'p:'||p_partkey, 't:'||p_type FROM part UNION SELECT 'b:'||p_brand, 'brand' FROM part
UNION SELECT 't:'||p_type, 'type' FROM part UNION SELECT 'brand', 'goods' FROM part UNION SELECT 'type', 'goods' FROM part)"""
GOODS_CLOSED = f"WITH RECURSIVE {GOODS}, {CLOSED.format('goods')}"


def regions(t: Tables) -> DataFrame:
    return t.region.select(named("r", "r_regionkey").alias("name"))


@query(f"{GEO_CLOSED} SELECT sub, sup FROM closed")
def closure_geo(t: Tables) -> DataFrame:
    return graph.closure(geo(t))


@query(f"WITH RECURSIVE {GEO}, {DEPTHS} SELECT name, min(depth) AS depth FROM depths GROUP BY name")
def depth_geo(t: Tables) -> DataFrame:
    return graph.depths(geo(t), regions(t))


@query(f"{GEO_CLOSED}, {CONES} SELECT name, cone FROM cones")
def cone_size(t: Tables) -> DataFrame:
    return graph.cone_sizes(geo(t))


@query(f"{GEO_CLOSED}, {CONES}, {DEPTHS} SELECT name, depth, cone FROM (SELECT name, min(depth) AS depth FROM depths GROUP BY name) JOIN cones USING (name) WHERE depth BETWEEN 1 AND 2 AND cone >= 10")
def top_cut(t: Tables) -> DataFrame:
    return graph.top_cut(geo(t), regions(t), 2, 10)


@query(f"{GOODS_CLOSED} SELECT sub, sup FROM closed WHERE sub IN (SELECT 'p:'||p_partkey FROM part)")
def ancestors_multi(t: Tables) -> DataFrame:
    return graph.ancestors(goods(t), t.part.select(named("p", "p_partkey").alias("name")))


SHORTCUTS = "more AS (SELECT sub, sup FROM goods UNION SELECT 'p:'||p_partkey, 'goods' FROM part UNION SELECT 'p:'||p_partkey, 'brand' FROM part)"


def shortcuts(t: Tables) -> DataFrame:
    part = t.part.select(named("p", "p_partkey").alias("sub"))
    return part.withColumn("sup", F.lit("goods")).union(part.withColumn("sup", F.lit("brand")))


@query(f"WITH RECURSIVE {GOODS}, {SHORTCUTS}, {CLOSED.format('more')} SELECT sub, sup FROM more WHERE NOT EXISTS (SELECT 1 FROM more AS m JOIN closed AS c ON c.sub = m.sup WHERE m.sub = more.sub AND c.sup = more.sup)")
def reduction_dag(t: Tables) -> DataFrame:
    return graph.reduction(goods(t).union(shortcuts(t)))


@query("WITH RECURSIVE e AS (SELECT 'c:'||c_custkey AS sub, 'c:'||(c_custkey // 2) AS sup FROM customer WHERE c_custkey > 1 UNION SELECT 'c:'||c_custkey, 'c:'||(c_custkey * 5) FROM customer WHERE c_custkey < 10), " + CLOSED.format("e") + " SELECT sub, sup FROM closed")
def cyclic_reach(t: Tables) -> DataFrame:
    """Customers below the one of half their number, and the first ones below one of five times theirs: loops, which all reach."""
    k = F.col("c_custkey")
    one = lambda rows, to: rows.select(named("c", "c_custkey").alias("sub"), F.concat(F.lit("c:"), to.cast("string")).alias("sup"))
    return graph.closure(one(t.customer.where("c_custkey > 1"), F.floor(k / 2)).union(one(t.customer.where("c_custkey < 10"), k * 5)))


@query(f"{GOODS_CLOSED} SELECT sub AS name FROM closed WHERE sup IN ('brand', 'goods') GROUP BY sub HAVING count(DISTINCT sup) = 2")
def conjunctive_get(t: Tables) -> DataFrame:
    return graph.conjunctive_get(graph.closure(goods(t)), ["brand", "goods"])


@query(f"{GEO_CLOSED} SELECT p.sub, p.sup, c.sub IS NOT NULL AS below FROM (SELECT 'c:'||c_custkey AS sub, 'r:'||(c_custkey % 5) AS sup FROM customer) AS p LEFT JOIN closed AS c ON c.sub = p.sub AND c.sup = p.sup")
def is_below(t: Tables) -> DataFrame:
    return graph.is_below(graph.closure(geo(t)), candidates(t))


def candidates(t: Tables) -> DataFrame:
    return t.customer.select(named("c", "c_custkey").alias("sub"), F.concat(F.lit("r:"), (F.col("c_custkey") % 5).cast("string")).alias("sup"))


@query("""SELECT 'p:'||l_partkey AS name, arg_min(l_returnflag, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) FILTER (WHERE l_quantity >= 10) AS owner,
array_to_string(list_sort(list(DISTINCT 's:'||l_suppkey)), ' ') AS parents FROM lineitem GROUP BY l_partkey""")
def owner_first(t: Tables) -> DataFrame:
    order = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    entries = t.lineitem.select(order.alias("store_ord"), F.col("l_returnflag").alias("store"), named("p", "l_partkey").alias("name"), F.array(named("s", "l_suppkey")).alias("parents"), (F.col("l_quantity") < 10).alias("stub"))
    return graph.owners(entries).withColumn("parents", F.array_join("parents", " "))


@query(f"{GEO_CLOSED}, told AS (SELECT sub AS name, sup AS branch FROM closed WHERE sup LIKE 'r:%' UNION SELECT 'r:'||r_regionkey, 'r:'||r_regionkey FROM region) SELECT name, array_to_string(list_sort(list(DISTINCT branch)), ' ') AS branches FROM told GROUP BY name")
def branches_of(t: Tables) -> DataFrame:
    return graph.branches_of(graph.closure(geo(t)), regions(t)).withColumn("branches", F.array_join("branches", " "))


@query(f"{GEO_CLOSED}, {CONES} SELECT sup, sub, cone, place FROM (SELECT sup, sub, cone, row_number() OVER (PARTITION BY sup ORDER BY cone DESC, sub) AS place FROM geo JOIN cones ON cones.name = geo.sub) WHERE place <= 3")
def topk_children(t: Tables) -> DataFrame:
    return graph.top_children(geo(t), graph.cone_sizes(geo(t)), 3)


@query(f"""WITH RECURSIVE {GEO}, placed AS (SELECT 'n:'||n_nationkey AS name FROM nation WHERE n_regionkey = 1 UNION SELECT 'r:'||r_regionkey FROM region),
walk AS (SELECT sub AS name, sup AS at, 1 AS hops FROM geo UNION SELECT walk.name, geo.sup, hops + 1 FROM walk JOIN geo ON geo.sub = walk.at WHERE walk.at NOT IN (SELECT name FROM placed))
SELECT w.name, w.at AS nearest, w.hops FROM walk AS w JOIN placed ON placed.name = w.at WHERE w.name LIKE 'o:%' OR w.name LIKE 'c:%'""")
def nearest_placed(t: Tables) -> DataFrame:
    placed = t.nation.where("n_regionkey = 1").select(named("n", "n_nationkey").alias("name")).union(regions(t))
    names = t.orders.select(named("o", "o_orderkey").alias("name")).union(t.customer.select(named("c", "c_custkey").alias("name")))
    return graph.nearest_placed(geo(t), names, placed)


@query(f"WITH RECURSIVE {GEO}, seen AS (SELECT 'r:'||r_regionkey AS name FROM region WHERE r_regionkey < 2 UNION SELECT geo.sub FROM seen JOIN geo ON geo.sup = seen.name) SELECT name FROM seen")
def placement_fixpoint(t: Tables) -> DataFrame:
    return graph.reachable(geo(t), t.region.where("r_regionkey < 2").select(named("r", "r_regionkey").alias("name")))


@query(f"WITH {GEO}, own AS (SELECT 'c:'||c_custkey AS name FROM customer WHERE c_acctbal > 0 UNION SELECT 'n:'||n_nationkey FROM nation) SELECT sub, sup FROM geo WHERE sub IN (SELECT name FROM own) AND sup IN (SELECT name FROM own)")
def semi_prune(t: Tables) -> DataFrame:
    return graph.induced(geo(t), t.customer.where("c_acctbal > 0").select(named("c", "c_custkey").alias("name")).union(t.nation.select(named("n", "n_nationkey").alias("name"))))


@query(f"WITH {GOODS} SELECT parents, count(*) AS names FROM (SELECT sub, count(*) AS parents FROM goods GROUP BY sub) GROUP BY parents")
def parent_histogram(t: Tables) -> DataFrame:
    return graph.parent_shape(goods(t))


@query(f"""{GOODS_CLOSED}, above AS (SELECT sub AS p, sup AS x FROM closed WHERE sup != 'goods' UNION SELECT sup, sup FROM goods WHERE sup != 'goods')
SELECT a.sub AS name, a.sup AS p, b.sup AS q FROM goods AS a JOIN goods AS b ON a.sub = b.sub AND a.sup < b.sup WHERE NOT EXISTS (SELECT 1 FROM above AS u JOIN above AS v ON u.x = v.x WHERE u.p = a.sup AND v.p = b.sup)""")
def disjoint_parents(t: Tables) -> DataFrame:
    tops = t.spark.range(1).select(F.lit("goods").alias("name"))
    return graph.disjoint_parents(goods(t), graph.closure(goods(t)), tops)


@query(f"""{GEO_CLOSED}, cand AS (SELECT 'c:'||c_custkey AS sub, 'r:'||(c_custkey % 5) AS sup FROM customer UNION ALL SELECT 'n:'||c_nationkey, 'c:'||c_custkey FROM customer UNION ALL SELECT 'c:'||c_custkey, 'n:'||(c_custkey % 25) FROM customer),
branch AS (SELECT sub AS name, sup AS b FROM closed WHERE sup LIKE 'r:%' UNION SELECT 'r:'||r_regionkey, 'r:'||r_regionkey FROM region)
SELECT sub, sup, CASE WHEN (sub, sup) IN (SELECT (sub, sup) FROM closed) THEN 'implied' WHEN sub = sup OR (sup, sub) IN (SELECT (sub, sup) FROM closed) THEN 'loop'
WHEN x.b = y.b THEN 'within' ELSE 'crossing' END AS class FROM cand LEFT JOIN branch AS x ON x.name = sub LEFT JOIN branch AS y ON y.name = sup""")
def novelty(t: Tables) -> DataFrame:
    closed = graph.closure(geo(t))
    customer = named("c", "c_custkey")
    more = candidates(t).union(t.customer.select(named("n", "c_nationkey"), customer)).union(t.customer.select(customer, F.concat(F.lit("n:"), (F.col("c_custkey") % 25).cast("string"))))
    return graph.novelty(more, closed, graph.branches_of(closed, regions(t)))


@query(f"WITH {GEO}, h AS (SELECT sha256(sub||' '||sup) AS h FROM geo) SELECT " + ", ".join(f"CAST(sum(('0x'||substr(h, {1 + 8 * i}, 8))::BIGINT) % 4294967296 AS BIGINT) AS h{i}" for i in range(8)) + " FROM h")
def content_hash(t: Tables) -> DataFrame:
    return graph.content_hash(geo(t))


@query(f"""WITH RECURSIVE {GEO}, walk AS (SELECT 'r:'||r_regionkey AS name, 'r:'||r_regionkey AS path FROM region UNION ALL SELECT geo.sub, path||' > '||geo.sub FROM walk JOIN geo ON geo.sup = walk.name) SELECT name, path FROM walk""")
def path_listing(t: Tables) -> DataFrame:
    return graph.paths(geo(t), regions(t)).withColumn("path", F.array_join("path", " > "))


# Votes.

STATED = """stated AS (SELECT l_returnflag||l_linestatus AS source, 'k:'||l_partkey AS sub, 'k:'||(l_suppkey * 3) AS sup FROM lineitem)"""
WITNESSES = """w AS (SELECT sub, sup, list_sort(list(DISTINCT source)) AS f FROM stated GROUP BY sub, sup), pairs AS (SELECT w.sub, w.sup, w.f AS "for", coalesce(r.f, []) AS against FROM w LEFT JOIN w AS r ON r.sub = w.sup AND r.sup = w.sub)"""
RULED = """verdicts AS (SELECT sub, sup, arg_max(decision, ord) AS decision FROM (SELECT 'k:'||user_id AS sub, 'k:'||CAST(floor(value) AS BIGINT) AS sup, CASE WHEN event_type = 'purchase' THEN 'accept' ELSE 'reject' END AS decision, event_id AS ord
FROM events WHERE event_type IN ('purchase', 'error')) GROUP BY sub, sup)"""
DECIDED = """decided AS (SELECT p.sub, p.sup, CASE WHEN coalesce(v.decision, '') = 'reject' THEN 'rejected' WHEN v.decision = 'accept' THEN 'accepted' WHEN len(against) > 0 THEN 'disputed'
WHEN list_contains("for", 'AF') AND len("for") < 2 THEN 'dissented' WHEN len("for") >= 2 THEN 'accepted' ELSE 'single' END AS status FROM pairs AS p LEFT JOIN verdicts AS v ON v.sub = p.sub AND v.sup = p.sup)"""


def key(column: Column) -> Column:
    return F.concat(F.lit("k:"), column.cast("string"))


def stated(t: Tables) -> DataFrame:
    return t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("source"), key(F.col("l_partkey")).alias("sub"), key(F.col("l_suppkey") * 3).alias("sup"))


def verdicts(t: Tables) -> DataFrame:
    told = t.events.where("event_type in ('purchase', 'error')")
    return told.select(key(F.col("user_id")).alias("sub"), key(F.floor("value")).alias("sup"), F.when(F.col("event_type") == "purchase", "accept").otherwise("reject").alias("decision"), F.col("event_id").alias("ord"))


def decided(t: Tables) -> DataFrame:
    pairs = votes.witnesses(stated(t)).join(votes.last_verdicts(verdicts(t)).withColumnRenamed("decision", "ruling"), ["sub", "sup"], "left")
    return votes.status(pairs.withColumn("dissent", F.array_contains("for", "AF")))


@query(f"""WITH {STATED}, {WITNESSES} SELECT sub, sup, array_to_string("for", ' ') AS "for", array_to_string(against, ' ') AS against FROM pairs""")
def witness_sets(t: Tables) -> DataFrame:
    return votes.witnesses(stated(t)).select("sub", "sup", F.array_join("for", " ").alias("for"), F.array_join("against", " ").alias("against"))


@query(f"WITH {STATED}, {WITNESSES}, {RULED}, {DECIDED} SELECT sub, sup, status FROM decided")
def consensus_status(t: Tables) -> DataFrame:
    return decided(t).select("sub", "sup", "status")


@query(f"WITH {STATED}, {WITNESSES}, {RULED}, {DECIDED} SELECT status, count(*) AS n FROM decided GROUP BY status")
def status_histogram(t: Tables) -> DataFrame:
    return decided(t).groupBy("status").agg(F.count("*").alias("n"))


EVIDENCE = """f AS (SELECT substr(source, 1, 1) AS source, sub, sup FROM stated), known AS (SELECT sub AS name, source FROM f UNION SELECT sup, source FROM f),
told AS (SELECT p.sub, p.sup, (SELECT list_sort(list(DISTINCT source)) FROM f WHERE f.sub = p.sub AND f.sup = p.sup) AS e,
(SELECT list_sort(list(DISTINCT a.source)) FROM known AS a JOIN known AS b ON a.source = b.source WHERE a.name = p.sub AND b.name = p.sup) AS t,
(SELECT list_sort(list(DISTINCT source)) FROM f WHERE f.sub = p.sup AND f.sup = p.sub) AS r FROM (SELECT DISTINCT 'k:'||c_custkey AS sub, 'k:'||(c_nationkey * 2) AS sup FROM customer) AS p),
classed AS (SELECT sub, sup, coalesce(array_to_string(e, ' '), '') AS "E", coalesce(array_to_string(t, ' '), '') AS "T", coalesce(array_to_string(r, ' '), '') AS "R",
CASE WHEN r IS NOT NULL AND e IS NULL THEN 'reversed' WHEN len(e) >= 2 THEN '2+' WHEN len(e) = 1 THEN '1' WHEN t IS NOT NULL THEN '0-testable' ELSE '0-untestable' END AS class FROM told)"""


def checked(t: Tables) -> DataFrame:
    pairs = t.customer.select(key(F.col("c_custkey")).alias("sub"), key(F.col("c_nationkey") * 2).alias("sup")).distinct()
    return votes.closure_check(pairs, stated(t).withColumn("source", F.substring("source", 1, 1)), ["A", "N", "R"])


@query(f"WITH {STATED}, {EVIDENCE} SELECT * FROM classed")
def evidence_class(t: Tables) -> DataFrame:
    return checked(t).select("sub", "sup", *[F.array_join(c, " ").alias(c) for c in ("E", "T", "R")], "class")


@query(f"""WITH {STATED}, {EVIDENCE} SELECT sub, count(*) FILTER (WHERE class = '1') AS n1, count(*) FILTER (WHERE class = '2+') AS n2, count(*) FILTER (WHERE class = 'reversed') AS reversed,
count(*) FILTER (WHERE class LIKE '0%') AS n0 FROM classed GROUP BY sub""")
def closure_pivot(t: Tables) -> DataFrame:
    told = checked(t).withColumn("class", F.when(F.col("class").startswith("0"), "0").otherwise(F.col("class")))
    wide = told.groupBy("sub").pivot("class", ["1", "2+", "reversed", "0"]).count().na.fill(0)
    return wide.select("sub", F.col("1").alias("n1"), F.col("`2+`").alias("n2"), "reversed", F.col("0").alias("n0"))


@query(f"""WITH {STATED}, {WITNESSES}, {RULED}, {DECIDED}, placed AS (SELECT 'k:'||(n_nationkey * 2) AS name FROM nation),
missing AS (SELECT sub AS name FROM decided UNION SELECT sup FROM decided EXCEPT SELECT name FROM placed)
SELECT 'disputed' AS section, sub, sup FROM decided WHERE status = 'disputed' UNION ALL SELECT 'single', sub, sup FROM decided WHERE status = 'single' AND sub IN (SELECT name FROM placed) AND sup IN (SELECT name FROM placed)
UNION ALL SELECT 'unplaced', name, (SELECT array_to_string(list_slice(list_sort(list(DISTINCT sup)), 1, 8), ' ') FROM decided WHERE sub = name) FROM missing""")
def review_queue(t: Tables) -> DataFrame:
    told = decided(t)
    placed = t.nation.select(key(F.col("n_nationkey") * 2).alias("name"))
    return votes.review_queue(told, placed, told.limit(0).select("sub", "sup")).drop("section_ord")


@query("SELECT sub, sup, decision FROM (SELECT user_id AS sub, event_type AS sup, arg_max(value, event_id) AS decision FROM events GROUP BY user_id, event_type)")
def last_verdict(t: Tables) -> DataFrame:
    return votes.last_verdicts(t.events.select(F.col("user_id").alias("sub"), F.col("event_type").alias("sup"), F.col("value").alias("decision"), F.col("event_id").alias("ord")))


# Joins.


@query("SELECT 'p:'||p_partkey AS name, CASE WHEN k = 1 THEN label ELSE label||'.'||k END AS label FROM (SELECT p_partkey, replace(p_name, ' ', '-') AS label, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k FROM part)")
def name_collisions(t: Tables) -> DataFrame:
    part = t.part.withColumn("label", text.normalise(F.col("p_name")))
    place = ranking.first_per_group(part, ["label"], [F.col("p_partkey")], 1 << 62)
    return place.select(named("p", "p_partkey").alias("name"), F.when(F.col("place") == 1, F.col("label")).otherwise(F.concat_ws(".", "label", F.col("place").cast("string"))).alias("label"))


MATCHES = "m AS (SELECT name, list_sort(list(DISTINCT id)) AS ids FROM (SELECT 's:'||s_suppkey AS name, 'NATION_'||(s_suppkey % 40) AS key FROM supplier) JOIN (SELECT n_name AS key, 'n:'||n_nationkey AS id FROM nation UNION ALL SELECT 'NATION_'||r_regionkey, 'r:'||r_regionkey FROM region) USING (key) GROUP BY name)"


def matches(t: Tables) -> DataFrame:
    concepts = t.supplier.select(named("s", "s_suppkey").alias("name"), F.concat(F.lit("NATION_"), (F.col("s_suppkey") % 40).cast("string")).alias("key"))
    labels = t.nation.select(F.col("n_name").alias("key"), named("n", "n_nationkey").alias("id")).union(t.region.select(F.concat(F.lit("NATION_"), F.col("r_regionkey").cast("string")), named("r", "r_regionkey")))
    return joins.bounded_matches(concepts, labels)


@query(f"WITH {MATCHES} SELECT name, ids[1] AS id FROM m WHERE len(ids) = 1")
def unique_label_match(t: Tables) -> DataFrame:
    return joins.unique_matches(matches(t))


@query(f"WITH {MATCHES} SELECT name, array_to_string(ids[1:6], ' ') AS ids, len(ids) AS n FROM m WHERE len(ids) > 1")
def ambiguous_queue(t: Tables) -> DataFrame:
    return joins.ambiguous_matches(matches(t)).select("name", F.array_join("ids", " ").alias("ids"), F.col("n").cast("long").alias("n"))


@query("SELECT o_orderkey AS name, o_custkey AS hub, m.id FROM orders LEFT JOIN (SELECT c_custkey AS hub, c_nationkey AS id FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)) AS m ON m.hub = o_custkey")
def hub_join(t: Tables) -> DataFrame:
    concepts = t.orders.select(F.col("o_orderkey").alias("name"), F.col("o_custkey").alias("hub"))
    return joins.hub_join(concepts, t.customer.select(F.col("c_custkey").alias("hub"), F.col("c_nationkey").alias("id")), t.nation.where("n_regionkey < 3").select(F.col("n_nationkey").alias("id"))).select("name", "hub", "id")


@query("""WITH RECURSIVE a AS (SELECT 's:'||s_suppkey AS name, 'n:'||s_nationkey AS id, s_suppkey % 3 = 0 AS exact FROM supplier UNION ALL SELECT n_name, 'n:'||n_nationkey, true FROM nation UNION ALL SELECT r_name, 'r:'||r_regionkey, true FROM region),
c AS (SELECT 'n:'||n_nationkey AS sub, 'r:'||n_regionkey AS sup FROM nation), up AS (SELECT name, sup AS at FROM a JOIN c ON c.sub = a.id UNION SELECT name, id FROM a WHERE NOT exact)
SELECT DISTINCT up.name AS sub, b.name AS sup FROM up JOIN a AS b ON b.id = up.at AND b.exact WHERE up.name != b.name""")
def source_view(t: Tables) -> DataFrame:
    one = lambda df, name, letter, k, exact: df.select(name.alias("name"), named(letter, k).alias("id"), exact.alias("exact"))
    aligned = one(t.supplier, named("s", "s_suppkey"), "n", "s_nationkey", F.col("s_suppkey") % 3 == 0).union(one(t.nation, F.col("n_name"), "n", "n_nationkey", F.lit(True))).union(one(t.region, F.col("r_name"), "r", "r_regionkey", F.lit(True)))
    return joins.view(aligned, graph.closure(t.nation.select(named("n", "n_nationkey").alias("sub"), named("r", "n_regionkey").alias("sup"))))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def baseline_anti(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def overlay_priority(t: Tables) -> DataFrame:
    return joins.overlaid(t.events, ["user_id"], "value", "event_id")


@query("WITH c AS (SELECT CAST(p_partkey AS VARCHAR) AS code FROM part) SELECT code AS sub, substr(code, 1, length(code) - 1) AS sup FROM c WHERE substr(code, 1, length(code) - 1) IN (SELECT code FROM c)")
def prefix_parent(t: Tables) -> DataFrame:
    return joins.prefix_parents(t.part.select(F.col("p_partkey").cast("string").alias("code")))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS code, arg_max(n_name, length(prefix)) AS value, max(prefix) AS prefix FROM orders LEFT JOIN (SELECT CAST(n_nationkey AS VARCHAR) AS prefix, n_name FROM nation WHERE n_nationkey % 3 != 2) ON starts_with(CAST(o_orderkey AS VARCHAR), prefix) GROUP BY o_orderkey")
def longest_prefix_rule(t: Tables) -> DataFrame:
    rules_ = t.nation.where("n_nationkey % 3 != 2").select(F.col("n_nationkey").cast("string").alias("prefix"), F.col("n_name").alias("value"))
    return joins.longest_prefix(t.orders.select(F.col("o_orderkey").cast("string").alias("code")), rules_, [1, 2])


@query("""WITH e AS (SELECT CASE WHEN p_size < 5 THEN 'core' ELSE p_brand END AS pack, p_name AS name, 'i'||(p_partkey % 500) AS ident FROM part)
SELECT 'names' AS kind, ident AS key, array_to_string(list_sort(list(DISTINCT name)), ' ') AS found FROM e GROUP BY ident HAVING count(DISTINCT name) > 1
UNION ALL SELECT 'identities', name, array_to_string(list_sort(list(DISTINCT ident)), ' ') FROM e GROUP BY name HAVING count(DISTINCT ident) > 1
UNION ALL SELECT 'in-core', name, array_to_string(list_sort(list(DISTINCT pack)), ' ') FROM e WHERE pack != 'core' AND name IN (SELECT name FROM e WHERE pack = 'core') GROUP BY name""")
def identity_collisions(t: Tables) -> DataFrame:
    return joins.identity_collisions(t.part.select(F.when(F.col("p_size") < 5, "core").otherwise(F.col("p_brand")).alias("pack"), F.col("p_name").alias("name"), F.concat(F.lit("i"), (F.col("p_partkey") % 500).cast("string")).alias("ident")))


@query("SELECT p_partkey, split_part(p_name, ' ', 2) AS family, n FROM part JOIN (SELECT split_part(p_name, ' ', 2) AS f, count(*) AS n FROM part GROUP BY 1) ON f = split_part(p_name, ' ', 2)")
def family_join(t: Tables) -> DataFrame:
    family = F.split_part("p_name", F.lit(" "), F.lit(2))
    sizes = t.part.groupBy(family.alias("family")).agg(F.count("*").alias("n"))
    return t.part.select("p_partkey", family.alias("family")).join(sizes, "family").select("p_partkey", "family", "n")


# Aggregations.


@query("SELECT p_brand, arg_min(p_name, {'l': length(p_name), 's': p_size, 'n': p_name}) AS p_name FROM part GROUP BY p_brand")
def argmin_code(t: Tables) -> DataFrame:
    return aggregates.best_code(t.part, "p_brand", "p_name", "p_size")


@query("SELECT c_mktsegment, lo[1:(SELECT max(i) FROM range(0, 40) AS t(i) WHERE substr(lo, 1, i) = substr(hi, 1, i) AND i <= length(lo))] AS prefix FROM (SELECT c_mktsegment, min(c_name) AS lo, max(c_name) AS hi FROM customer GROUP BY c_mktsegment)")
def common_prefix(t: Tables) -> DataFrame:
    return aggregates.group_prefix(t.customer, "c_mktsegment", "c_name")


@query("SELECT l_orderkey, l_returnflag FROM (SELECT l_orderkey, l_returnflag, sum(l_quantity) AS n, sum(sum(l_quantity)) OVER (PARTITION BY l_orderkey) AS total FROM lineitem GROUP BY l_orderkey, l_returnflag) WHERE 3 * n >= 2 * total")
def two_thirds(t: Tables) -> DataFrame:
    return aggregates.two_thirds(t.lineitem, "l_orderkey", "l_returnflag", "l_quantity")


@query("""WITH n AS (SELECT 'p:'||p_partkey AS id, p_brand||p_size AS label, p_partkey AS ord, 'p:'||(p_partkey // 2) AS parent FROM part), h AS (SELECT label, arg_min(id, ord) AS head FROM n GROUP BY label), a AS (SELECT id, head FROM n JOIN h USING (label))
SELECT h.head AS id, h.label, coalesce(array_to_string(list_sort(list(DISTINCT b.head) FILTER (WHERE b.head != h.head)), ' '), '') AS parents FROM h JOIN n USING (label) LEFT JOIN a AS b ON b.id = n.parent GROUP BY h.head, h.label""")
def merge_by_label(t: Tables) -> DataFrame:
    half = F.concat(F.lit("p:"), F.floor(F.col("p_partkey") / 2).cast("string"))
    nodes = t.part.select(named("p", "p_partkey").alias("id"), F.concat("p_brand", F.col("p_size").cast("string")).alias("label"), F.col("p_partkey").alias("ord"), F.array(half).alias("parents"))
    return aggregates.merged_by_label(nodes).withColumn("parents", F.array_join("parents", " "))


@query("SELECT count(nullif(c_name, '')) AS c_name, count(nullif(c_mktsegment, '')) AS c_mktsegment FROM customer")
def coverage(t: Tables) -> DataFrame:
    return aggregates.coverage(t.customer, ["c_name", "c_mktsegment"])


@query("SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS flag FROM part) WHERE flag != '' GROUP BY flag")
def flag_counts(t: Tables) -> DataFrame:
    return aggregates.flag_counts(t.part, "p_name")


# Ranking and vectors.


@query("SELECT c_custkey, round((row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1) / (SELECT count(*) - 1 FROM customer), 6) AS pct FROM customer")
def percentile_rank(t: Tables) -> DataFrame:
    return ranking.percentile(t.customer, "c_acctbal", "c_custkey").select("c_custkey", F.round("pct", 6).alias("pct"))


@query("""WITH r AS (SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS r FROM documents JOIN labels USING (doc_id))
SELECT round((sum(r) FILTER (WHERE quality = 1) - count(*) FILTER (WHERE quality = 1) * (count(*) FILTER (WHERE quality = 1) + 1) / 2.0) / (count(*) FILTER (WHERE quality = 1) * count(*) FILTER (WHERE quality = 0)), 6) AS auc FROM r""")
def auc(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return ranking.auc(rows, "n_chars", "quality").select(F.round("auc", 6).alias("auc"))


@query("""WITH s AS (SELECT l_partkey AS lemma, l_suppkey AS sense, sum(l_quantity) AS score FROM lineitem GROUP BY 1, 2), h AS (SELECT lemma, min(sense) AS sense FROM s GROUP BY lemma)
SELECT b.lemma, b.best, b.top - s.score AS lead FROM (SELECT lemma, arg_max(sense, {'a': score, 'b': sense}) AS best, max(score) AS top FROM s GROUP BY lemma) AS b JOIN h USING (lemma) JOIN s ON s.lemma = h.lemma AND s.sense = h.sense""")
def lead_over_held(t: Tables) -> DataFrame:
    scores = t.lineitem.groupBy(F.col("l_partkey").alias("lemma"), F.col("l_suppkey").alias("sense")).agg(F.sum("l_quantity").alias("score"))
    return ranking.lead_over_held(scores, scores.groupBy("lemma").agg(F.min("sense").alias("sense")))


@query("""WITH p AS (SELECT c_custkey, row_number() OVER (ORDER BY -c_acctbal, c_custkey) - 1 AS a, row_number() OVER (ORDER BY c_nationkey, c_custkey) - 1 AS b, count(*) OVER () - 1 AS n FROM customer)
SELECT c_custkey, round((row_number() OVER (ORDER BY (a / n + b / n) / 2, c_custkey) - 1) / n, 6) AS misfit FROM p""")
def composite_score(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.col("c_acctbal"), F.col("c_nationkey").cast("double").alias("c_nationkey"))
    return ranking.misfit(rows, "c_custkey", "c_acctbal", "c_nationkey").select("c_custkey", F.round("misfit", 6).alias("misfit"))


@query("SELECT event_id, coalesce(array_to_string(list_sort(list_distinct(list(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))), ' '), '') AS later FROM events")
def later_rows(t: Tables) -> DataFrame:
    log = t.events.select(F.col("event_id").alias("seq"), F.lit("core").alias("pack"), F.col("user_id").alias("sub"), F.col("event_type").alias("action"))
    return rules.later_rows(log).select(F.col("seq").alias("event_id"), "later")


@query("""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), s AS (SELECT a.vec_id AS x, b.vec_id AS y, list_cosine_similarity(a.e, b.e) AS sim FROM v AS a JOIN v AS b ON a.vec_id != b.vec_id)
SELECT CAST(x AS VARCHAR) AS name, arg_max(CAST(y AS VARCHAR), sim) AS twin, round(max(sim), 6) AS sim FROM s WHERE sim >= 0.2 GROUP BY x""")
def cosine_twin(t: Tables) -> DataFrame:
    rows = t.embeddings.select(F.col("vec_id").cast("string").alias("name"), F.lit("").alias("hub"), F.col("embedding").alias("vector"))
    return ranking.twins(rows, rows, 0.2).withColumn("sim", F.round("sim", 6))


@query("""WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), u AS (SELECT label, i, sum(e[i]) AS s, count(*) AS n FROM v, range(1, 65) AS t(i) GROUP BY label, i)
SELECT vec_id, round(1 - sum(e[i] * (s - e[i])) / sqrt(sum(e[i] * e[i]) * sum((s - e[i]) * (s - e[i]))), 6) AS distance FROM v JOIN u USING (label) WHERE n >= 3 GROUP BY vec_id""")
def sibling_distance(t: Tables) -> DataFrame:
    return ranking.sibling_distance(t.embeddings, "label", "vec_id", "embedding").withColumn("distance", F.round("distance", 6))


@query("SELECT * FROM customer ORDER BY sha256('7|'||c_custkey), c_custkey LIMIT 100")
def seeded_sample(t: Tables) -> DataFrame:
    return ranking.seeded_sample(t.customer, "c_custkey", 100, 7)


# Labels.

NORMAL = r"lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '([a-z0-9])([A-Z])', '\1-\2', 'g'), '[\s_/]+', '-', 'g'), '[^A-Za-z0-9.''-]', '', 'g'), '-{{2,}}', '-', 'g'), '^-+|-+$', '', 'g'))"


@query(f"SELECT c_custkey, {NORMAL.format('c_name')} AS a, {NORMAL.format('c_mktsegment')} AS b FROM customer")
def normalise_labels(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.normalise(F.col("c_name")).alias("a"), text.normalise(F.col("c_mktsegment")).alias("b"))


IRREGULAR = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in text.IRREGULAR.items()) + "}"
KEEP = ", ".join(f"'{w}'" for w in sorted(text.KEEP))


@query(f"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) SELECT w, CASE WHEN w IN ({KEEP}) THEN w WHEN ({IRREGULAR})[w] IS NOT NULL THEN ({IRREGULAR})[w]
WHEN regexp_matches(w, '^(neck|bow|hog)?ties$') THEN w[:-2] WHEN w LIKE '%ies' AND length(w) > 4 THEN w[:-4]||'y' WHEN regexp_matches(w, '(ches|shes|sses|xes|zes)$') OR (w LIKE '%oes' AND length(w) > 4) THEN w[:-3]
WHEN (w LIKE '%ves' AND length(w) > 4) OR regexp_matches(w, '(^|[^sui])s$') THEN w[:-2] ELSE w END AS singular FROM w""")
def singular(t: Tables) -> DataFrame:
    words = t.documents.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("w")).distinct()
    return words.select("w", text.singular(F.col("w")).alias("singular"))


STOPS = ", ".join(f"'{w}'" for w in sorted(text.STOP))


@query(f"SELECT doc_id, CAST(len(list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda x: x NOT IN ({STOPS}))) AS INTEGER) AS n FROM documents")
def tokens(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.size(text.tokens(F.col("text"))).alias("n"))


@query(f"""WITH w AS (SELECT unnest(list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda x: x NOT IN ({STOPS}))) AS w FROM documents), c AS (SELECT w, count(*) AS n FROM w GROUP BY w)
SELECT w, n, round(log10(n * 1e9 / (SELECT sum(n) FROM c)), 6) AS zipf FROM c""")
def zipf(t: Tables) -> DataFrame:
    counts = t.documents.select(F.explode(text.tokens(F.col("text"))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("w", "n", F.round(text.zipf(F.col("n"), F.col("total")), 6).alias("zipf"))


@query("SELECT page_id, CASE WHEN contains(url, '#') THEN split_part(url, '#', -1) ELSE split_part(url, '/', -1) END AS local FROM pages")
def url_local(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.local_name(F.col("url")).alias("local"))


@query("""WITH b AS (SELECT p_partkey, lower(split_part(p_name, ' ', 2)) AS head, lower(split_part(p_name, ' ', 1)) AS q FROM part)
SELECT p_partkey, unnest([head, q||' '||head, q||head]) AS phrase, unnest([false, true, true]) AS specific FROM b""")
def inverted_title(t: Tables) -> DataFrame:
    title = F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(", "), F.split_part("p_name", F.lit(" "), F.lit(1)))
    return t.part.select("p_partkey", F.explode(text.index_phrases(title)).alias("x")).select("p_partkey", "x.phrase", "x.specific")


# Audits.


@query("""WITH c AS (SELECT l_partkey AS lemma, 's:'||l_suppkey AS offset, CAST(sum(l_linenumber) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY lemma ORDER BY n DESC, "offset" DESC) AS k FROM c)
SELECT a.lemma, a."offset" FROM r AS a JOIN r AS b ON a.lemma = b.lemma AND a.k = 1 AND b.k = 2 WHERE a.n >= 5 AND a.n >= 2 * b.n""".replace("AS offset,", 'AS "offset",'))
def gold_senses(t: Tables) -> DataFrame:
    counts = t.lineitem.groupBy(F.col("l_partkey").alias("lemma"), named("s", "l_suppkey").alias("offset")).agg(F.sum("l_linenumber").alias("count"))
    return audit.gold_first_senses(counts)


@query("""WITH w AS (SELECT user_id AS lemma, count(*) FILTER (WHERE event_type = 'click') AS n, count(*) FILTER (WHERE event_type = 'view') AS v, count(*) FILTER (WHERE event_type = 'error') AS a, count(*) FILTER (WHERE event_type = 'purchase') AS r FROM events
WHERE event_type != 'signup' GROUP BY user_id) SELECT lemma, n, v, a, r FROM w WHERE n >= greatest(v, a, r)""")
def noun_dominance(t: Tables) -> DataFrame:
    pos = F.when(F.col("event_type") == "click", "n").when(F.col("event_type") == "view", "v").when(F.col("event_type") == "error", "a").otherwise("r")
    return audit.noun_dominant(t.events.where("event_type != 'signup'").groupBy(F.col("user_id").alias("lemma"), pos.alias("pos")).agg(F.count("*").alias("count")))


@query("""WITH s AS (SELECT o_custkey AS lemma, o_orderstatus AS sense, o_orderkey % 7 AS voter, max(o_totalprice) / 1e6 - 0.2 AS sim FROM orders GROUP BY 1, 2, 3), b AS (SELECT lemma, voter, row_number() OVER (PARTITION BY lemma ORDER BY max(sim) DESC, voter) AS k FROM s GROUP BY lemma, voter),
w AS (SELECT s.lemma, s.sense, s.voter, greatest(s.sim, 0) AS w, sum(greatest(s.sim, 0)) OVER (PARTITION BY s.lemma, s.voter) AS total FROM s JOIN b ON b.lemma = s.lemma AND b.voter = s.voter WHERE k <= 3)
SELECT lemma, sense, round(sum(CASE WHEN total > 0 THEN w / total ELSE 0 END), 6) AS votes FROM w GROUP BY lemma, sense""")
def neighbour_votes(t: Tables) -> DataFrame:
    rows = t.orders.groupBy(F.col("o_custkey").alias("lemma"), F.col("o_orderstatus").alias("sense"), (F.col("o_orderkey") % 7).alias("voter")).agg((F.max("o_totalprice") / 1e6 - 0.2).alias("sim"))
    return audit.neighbour_votes(rows, 3).withColumn("votes", F.round("votes", 6))


@query("""WITH r AS (SELECT 's:'||l_suppkey AS k, CAST(l_partkey AS VARCHAR) AS c, l_linenumber AS n FROM lineitem), w AS (SELECT k, min(c) AS lo, max(c) AS hi FROM r GROUP BY k), d AS (SELECT k, c[1] AS d, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY k) AS total FROM r GROUP BY k, c[1]),
m AS (SELECT r.k, min(c) AS lo, max(c) AS hi FROM r JOIN d ON d.k = r.k AND d.d = r.c[1] WHERE 3 * d.n >= 2 * total GROUP BY r.k), p AS (SELECT w.k, lo[1:(SELECT max(i) FROM range(0, 20) AS t(i) WHERE substr(lo, 1, i) = substr(hi, 1, i) AND i <= length(lo))] AS prefix FROM w),
q AS (SELECT m.k, lo[1:(SELECT max(i) FROM range(0, 20) AS t(i) WHERE substr(lo, 1, i) = substr(hi, 1, i) AND i <= length(lo))] AS prefix FROM m) SELECT p.k, CASE WHEN p.prefix != '' THEN p.prefix ELSE coalesce(q.prefix, '') END AS c FROM p LEFT JOIN q USING (k)""")
def majority_code(t: Tables) -> DataFrame:
    rows = t.lineitem.select(named("s", "l_suppkey").alias("k"), F.col("l_partkey").cast("string").alias("c"), F.col("l_linenumber").alias("n"))
    return audit.majority_code(rows, "k", "c", "n")


@query("""WITH home AS (SELECT c_custkey AS k, c_mktsegment = 'BUILDING' AS two, 'n:'||c_nationkey AS nation FROM customer),
c AS (SELECT DISTINCT o_orderkey AS k, o_custkey, l_suppkey, 'n:'||s_nationkey AS nation FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey),
n AS (SELECT c.k, count(*) AS every, count(*) FILTER (WHERE home.nation = c.nation AND NOT two) AS near, min(l_suppkey) AS s, min(l_suppkey) FILTER (WHERE home.nation = c.nation AND NOT two) AS t FROM c LEFT JOIN home ON home.k = o_custkey GROUP BY c.k),
r AS (SELECT 'o:'||o_orderkey AS node, CASE WHEN every > 1 AND near > 0 THEN near ELSE coalesce(every, 0) END AS n, coalesce(t, s) AS s FROM orders LEFT JOIN n ON k = o_orderkey)
SELECT node, CASE WHEN n = 1 THEN 's:'||s END AS sense, CASE n WHEN 0 THEN 'unmatched' WHEN 1 THEN 'chosen' ELSE 'ambiguous' END AS route, CAST(n AS INTEGER) AS n_left FROM r
UNION ALL SELECT 'c:'||k, CASE WHEN NOT two THEN nation END, CASE WHEN two THEN 'ambiguous' ELSE 'chosen' END, CASE WHEN two THEN 2 ELSE 1 END FROM home""")
def guided_senses(t: Tables) -> DataFrame:
    """An order means one of its suppliers, guided by its customer's nation; BUILDING customers mean two nations."""
    o, c = named("o", "o_orderkey"), named("c", "c_custkey")
    tree = t.orders.select(o.alias("node"), named("c", "o_custkey").alias("parent")).union(t.customer.select(c, F.lit("all")))
    labels = t.orders.select(o.alias("node"), F.lit("supply").alias("label")).union(t.customer.select(c, F.lit("home")))
    supply = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    other = t.customer.where("c_mktsegment = 'BUILDING'").select(c, F.lit("home"), F.concat(F.lit("n:"), ((F.col("c_nationkey") + 1) % 25).cast("string")))
    candidates = supply.select(named("o", "l_orderkey").alias("node"), F.lit("supply").alias("label"), named("s", "l_suppkey").alias("sense")).union(t.customer.select(c, F.lit("home"), named("n", "c_nationkey"))).union(other)
    above = t.supplier.select(named("s", "s_suppkey").alias("sense"), named("n", "s_nationkey").alias("above"))
    return senses.guided_senses(tree, labels, candidates, above).select("node", "sense", "route", F.size("left").alias("n_left"))


# Revisions.


@query("""WITH r AS (SELECT 'n:'||n_nationkey AS sub, n_nationkey AS k, 'r:'||n_regionkey AS old, 'r:'||((n_regionkey + 1) % 5) AS new FROM nation)
SELECT 'core' AS pack, CASE WHEN k % 4 = 2 THEN sub||'-x' ELSE sub END AS sub, CASE k % 4 WHEN 0 THEN 'move' WHEN 1 THEN 'parent+' WHEN 2 THEN 'add' ELSE 'drop' END AS action,
CASE WHEN k % 4 = 0 THEN old ELSE '-' END AS old, CASE WHEN k % 4 < 2 THEN new WHEN k % 4 = 2 THEN old ELSE '-' END AS new FROM r
UNION ALL SELECT 'core', sub, 'drop', '-', '-' FROM r WHERE k % 4 = 2""")
def decision_compiler(t: Tables) -> DataFrame:
    """Nations are moved, filed twice, renamed or dropped."""
    rows = t.nation.orderBy("n_nationkey").collect()
    regions = {f"r:{r['r_regionkey']}": ["*"] for r in t.region.collect()}
    stores = {"core": {**regions, **{f"n:{r['n_nationkey']}": [f"r:{r['n_regionkey']}"] for r in rows}}}
    sheet = []
    for r in rows:
        old, new, k = f"r:{r['n_regionkey']}", f"r:{(r['n_regionkey'] + 1) % 5}", r["n_nationkey"]
        action, args = (("move", f"{old} {new}"), ("parent+", new), ("rename", f"n:{k}-x"), ("drop", ""))[k % 4]
        sheet.append({"pack": "core", "name": f"n:{k}", "action": action, "args": args, "apply": "yes"})
    rulings = [x[:5] for x in revisions.compiled(stores, sheet).rulings]
    return t.spark.createDataFrame(rulings, "pack string, sub string, action string, old string, new string")


@query("SELECT 'core' AS store, 'n:'||n_nationkey AS sub, CASE WHEN n_nationkey % 3 = 0 THEN 'in(r:'||n_regionkey||')' ELSE 'r:'||n_regionkey END AS sup FROM nation UNION ALL SELECT 'core', 'r:'||r_regionkey, '*' FROM region UNION ALL SELECT 'core', 'in', '*'")
def role_rewrites(t: Tables) -> DataFrame:
    """Every third nation is in its region rather than a kind of it."""
    n, r = named("n", "n_nationkey"), named("r", "n_regionkey")
    one = lambda df, a, b: df.select(F.lit("core").alias("store"), a.alias("sub"), b.alias("sup"), F.lit(0).alias("ord"))
    edges = one(t.nation, n, r).union(one(t.region, named("r", "r_regionkey"), F.lit("*"))).union(t.spark.createDataFrame([("core", "in", "*", 0)], "store string, sub string, sup string, ord int"))
    text_ = F.concat(F.lit("in("), r, F.lit(")"))
    rewrites = t.nation.where("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("seq"), F.lit("core").alias("pack"), n.alias("sub"), r.alias("old"), F.lit("rewrite").alias("action"), text_.alias("text"))
    none = t.spark.createDataFrame([], "seq long, pack string, sub string, action string, old string, new string")
    return revisions.revised(edges, none, rewrites=rewrites)[0].select("store", "sub", "sup")


@query("""WITH g AS (SELECT 's:'||s_suppkey AS name, max(p_partkey) AS p FROM supplier JOIN part ON p_partkey % 50 = s_suppkey % 50 GROUP BY 1)
SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'core' ELSE 'pack' END AS store, name, CASE WHEN s_suppkey % 7 = 0 THEN 'by hand' ELSE p_name END AS gloss, CASE WHEN s_suppkey % 7 != 0 THEN p||'-n' END AS wn30
FROM supplier JOIN g ON name = 's:'||s_suppkey JOIN part ON p_partkey = p WHERE s_suppkey % 5 != 0 AND NOT (s_suppkey % 2 = 1 AND s_suppkey % 3 = 0)""")
def gloss_owners(t: Tables) -> DataFrame:
    """Suppliers are named after parts; even ones are the core's, a third of the others disowned, a fifth without gloss."""
    s = named("s", "s_suppkey")
    # Of a supplier's parts the last of each size: the last of these is the last of all, and they are no more as parts grow.
    last = t.part.groupBy((F.col("p_partkey") % 50).alias("k"), "p_size").agg(F.max("p_partkey").alias("p_partkey"))
    concepts = t.supplier.join(last, F.col("k") == F.col("s_suppkey") % 50).select(F.col("p_partkey").alias("ord"), s.alias("name"), F.col("p_partkey").cast("string").alias("offset"))
    definitions = t.part.select(F.col("p_partkey").cast("string").alias("offset"), F.col("p_name").alias("gloss"))
    by_hand = t.supplier.where("s_suppkey % 7 = 0 or s_suppkey % 5 = 0").select(F.col("s_suppkey").alias("ord"), s.alias("name"), F.lit("-").alias("offset"), F.when(F.col("s_suppkey") % 5 != 0, "by hand").alias("gloss"))
    texts = revisions.glosses(concepts, definitions, [], by_hand)
    edges = t.supplier.where("s_suppkey % 2 = 0").select(F.lit("core").alias("store"), s.alias("sub"), named("n", "s_nationkey").alias("sup"))
    edges = edges.union(t.supplier.select(F.lit("pack"), s, named("n", "s_nationkey")))
    disowned = t.supplier.where("s_suppkey % 3 = 0").select(F.lit("pack").alias("store"), s.alias("name"))
    none = t.spark.createDataFrame([], "store string, name string")
    return revisions.attached(edges, texts, disowned, none)


# Checks.


@query("""WITH e AS (SELECT 'c:'||c_custkey AS sub, c_nationkey AS n FROM customer), s AS (SELECT 'orders' AS store, 'c:'||o_custkey AS name FROM orders UNION SELECT 'customers', 'c:'||c_custkey FROM customer)
SELECT store, name, CASE WHEN n IS NULL THEN 'missing' ELSE 'stranded' END AS what FROM s LEFT JOIN e ON sub = name WHERE n IS NULL OR n % 3 = 0""")
def unattached(t: Tables) -> DataFrame:
    """Customers hang below nations, every third of which hangs below no region."""
    edges = t.customer.select(named("c", "c_custkey").alias("sub"), named("n", "c_nationkey").alias("sup")).union(t.nation.where("n_nationkey % 3 != 0").select(named("n", "n_nationkey"), F.lit("*")))
    stores = t.orders.select(F.lit("orders").alias("store"), named("c", "o_custkey").alias("name")).union(t.customer.select(F.lit("customers"), named("c", "c_custkey")))
    return graph.unattached(stores, edges)


@query("""WITH e AS (SELECT l_returnflag AS store, l_partkey AS p, string_agg(DISTINCT 's:'||l_suppkey, ' ' ORDER BY 's:'||l_suppkey) AS parents FROM lineitem GROUP BY 1, 2)
SELECT 'p:'||p AS name, count(*) AS stores, count(DISTINCT parents) AS sets FROM e GROUP BY p HAVING count(*) > 1 AND count(DISTINCT parents) > 1""")
def differing_parents(t: Tables) -> DataFrame:
    return graph.differing_parents(t.lineitem.select(F.col("l_returnflag").alias("store"), named("p", "l_partkey").alias("sub"), named("s", "l_suppkey").alias("sup")))


@query("SELECT 'c:'||c_custkey AS name FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 1 AND n_nationkey != 2 UNION SELECT 's:'||s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 1 AND n_nationkey != 2 UNION SELECT 'n:'||n_nationkey FROM nation WHERE n_regionkey = 1 AND n_nationkey != 2 UNION SELECT 'o:'||o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 1 AND n_nationkey != 2")
def cone_without(t: Tables) -> DataFrame:
    return graph.cone_without(graph.closure(geo(t)), "r:1", "n:2")


@query("""WITH c AS (SELECT l_shipdate_m AS method, l_partkey AS lemma, l_suppkey AS sense, lead FROM (SELECT l_returnflag AS l_shipdate_m, l_partkey, l_suppkey, l_quantity AS lead, row_number() OVER (PARTITION BY l_returnflag, l_partkey ORDER BY l_quantity DESC, l_suppkey) AS k FROM lineitem) WHERE k = 1),
g AS (SELECT l_partkey AS lemma, min(l_suppkey) AS r FROM lineitem GROUP BY 1), r AS (SELECT c.method, CASE WHEN sense = r THEN 1.0 ELSE 0.0 END AS ok, row_number() OVER (PARTITION BY method ORDER BY lead DESC, c.lemma) AS k, count(*) OVER (PARTITION BY method) AS n FROM c JOIN g ON g.lemma = c.lemma)
SELECT method, part, count(*) AS n, round(avg(ok), 6) AS agree FROM r CROSS JOIN (VALUES ('all', 1), ('half', 2), ('quarter', 4)) AS p(part, d) WHERE k * d <= r.n GROUP BY method, part""".replace("count(*) AS n, round(avg(ok), 6) AS agree", "CAST(count(*) AS BIGINT) AS n, round(avg(CAST(ok AS DOUBLE)), 6) AS agree"))
def sense_agreement(t: Tables) -> DataFrame:
    best = ranking.first_per_group(t.lineitem.select(F.col("l_returnflag").alias("method"), F.col("l_partkey").alias("lemma"), F.col("l_suppkey").alias("sense"), F.col("l_quantity").alias("lead")), ["method", "lemma"], [F.desc("lead"), F.col("sense")], 1)
    gold = t.lineitem.groupBy(F.col("l_partkey").alias("lemma")).agg(F.min("l_suppkey").alias("sense"))
    return audit.agreement(best, gold).withColumn("agree", F.round("agree", 6))


@query("""WITH p AS (SELECT 's:'||s_suppkey AS sub, 'n:'||s_nationkey AS sup FROM supplier WHERE s_suppkey % 4 != 0), placed AS (SELECT DISTINCT sup AS name FROM p UNION SELECT 's:'||s_suppkey FROM supplier WHERE s_suppkey % 3 != 0)
SELECT sub, sup FROM p WHERE sub IN (SELECT name FROM placed)""")
def owned_edges(t: Tables) -> DataFrame:
    """Suppliers are the pack's names, nations the base's; a third isn't placed, a fourth has no accepted parent."""
    accepted = t.supplier.where("s_suppkey % 4 != 0").select(named("s", "s_suppkey").alias("sub"), named("n", "s_nationkey").alias("sup"))
    placed = accepted.select(F.col("sup").alias("name")).union(t.supplier.where("s_suppkey % 3 != 0").select(named("s", "s_suppkey")))
    base = t.nation.select(named("n", "n_nationkey").alias("name"))
    concepts = t.supplier.select(named("s", "s_suppkey").alias("name"))
    return votes.owned_edges(accepted, placed, concepts, base, base.limit(0))[1]
