"""Predicates, selections, reports, orders, rulings and titles as queries, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.functions import text
from arbora.operators import audit, graph, joins, rules, selection, votes
from arbora.operators import rulings as rulings_
from arbora.plans.queries import GEO, GEO_CLOSED, GOODS, IRREGULAR, KEEP, STOPS, Tables, candidates, geo, goods, named, query, regions, shortcuts

# Predicates and candidates.


@query("SELECT p_partkey, coalesce(CASE WHEN p_size % 3 > 0 THEN p_brand END, 'core') AS pack, 'none' AS kind FROM part")
def column_defaults(t: Tables) -> DataFrame:
    """A column with nulls, and one that isn't there."""
    rows = t.part.select("p_partkey", F.when(F.col("p_size") % 3 > 0, F.col("p_brand")).alias("pack"))
    return selection.with_default(selection.with_default(rows, "pack", "core"), "kind", "none")


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey||'' WHEN s_suppkey % 3 = 1 THEN s_suppkey||'' ELSE s_name END AS label FROM supplier")
def labels_or_ids(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return selection.labelled(t.supplier.select(k.cast("string").alias("id"), F.when(k % 3 == 0, "").when(k % 3 == 2, F.col("s_name")).alias("label"))).select(F.col("id").cast("long").alias("id"), "label")


@query("""SELECT DISTINCT o AS "offset" FROM (SELECT l_partkey AS o FROM lineitem WHERE l_linenumber = 1 UNION SELECT o_custkey FROM orders WHERE o_custkey IN (SELECT p_partkey FROM part)) WHERE o NOT IN (SELECT p_partkey FROM part WHERE p_size < 10) AND o NOT IN (SELECT s_suppkey FROM supplier)""")
def candidate_synsets(t: Tables) -> DataFrame:
    """Parts of first lines, and customers' numbers that are parts', without small parts and suppliers' numbers."""
    of = lambda df, c: df.select(F.col(c).alias("offset"))
    return selection.candidates_left(of(t.lineitem.where("l_linenumber = 1"), "l_partkey"), of(t.orders, "o_custkey"), of(t.part, "p_partkey"), of(t.part.where("p_size < 10"), "p_partkey"), of(t.supplier, "s_suppkey"))


@query("SELECT code FROM (SELECT CASE WHEN p_partkey % 11 = 0 THEN 'x'||p_partkey ELSE p_partkey||'' END AS code FROM part) WHERE regexp_matches(code, '^[0-9]+$') AND (code[1] IN ('0', '1', '2', '3', '4') OR starts_with(code, '53'))")
def goods_codes(t: Tables) -> DataFrame:
    code = F.when(F.col("p_partkey") % 11 == 0, F.concat(F.lit("x"), F.col("p_partkey"))).otherwise(F.col("p_partkey").cast("string"))
    return t.part.select(code.alias("code")).where(selection.is_goods(F.col("code")))


@query(f"""{GEO_CLOSED}, n AS (SELECT sub AS name FROM geo), up AS (SELECT sub AS name, sup FROM closed UNION SELECT name, name FROM n)
SELECT name FROM n WHERE name IN (SELECT name FROM up WHERE sup IN ('r:0', 'r:1', 'n:3')) AND name NOT IN (SELECT name FROM up WHERE sup IN ('n:5', 'n:1'))""")
def hinge_predicate(t: Tables) -> DataFrame:
    """What is below regions 0 and 1 or nation 3, and not below nations 5 and 1."""
    names = lambda *x: t.spark.createDataFrame([(n,) for n in x], "name string")
    return selection.hinged(graph.closure(geo(t)), geo(t).select(F.col("sub").alias("name")), names("r:0", "r:1", "n:3"), names("n:5", "n:1"))


@query("""WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents), c AS (SELECT w, count(*) AS n, count(*) FILTER (WHERE length(w) % 2 = 0) AS e FROM w GROUP BY w), z AS (SELECT w, n, round(log10(n * 1e9 / (SELECT sum(n) FROM c)), 6) AS zipf FROM c)
SELECT w AS lemma, zipf FROM z WHERE zipf >= 4 AND length(w) % 3 > 0""")
def everyday_words(t: Tables) -> DataFrame:
    """Usual words: those whose length isn't a multiple of three count as nouns."""
    words = t.documents.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("lemma")).groupBy("lemma").agg(F.count("*").alias("n"))
    total = words.agg(F.sum("n").alias("total"))
    zipf = words.join(F.broadcast(total)).select("lemma", F.round(text.zipf(F.col("n"), F.col("total")), 6).alias("zipf"))
    counts = words.select("lemma", F.explode(F.array(F.struct(F.lit("n").alias("pos"), (F.length("lemma") % 3).alias("count")), F.struct(F.lit("v").alias("pos"), F.lit(1).alias("count")))).alias("x")).select("lemma", "x.pos", "x.count")
    return selection.everyday_words(audit.noun_dominant(counts).select("lemma"), zipf, 4)


@query("""SELECT p_partkey AS "offset", CASE WHEN p_size % 5 = 0 THEN 'quantity' ELSE p_brand END AS field FROM part WHERE p_size % 5 != 0 AND p_partkey % 7 != 0 AND p_partkey NOT IN (SELECT s_suppkey FROM supplier) AND p_type NOT IN (SELECT min(p_type) FROM part)""")
def exclusions(t: Tables) -> DataFrame:
    """Not placed, no instance, no quantity, of no banned usage."""
    rows = t.part.select(F.col("p_partkey").alias("offset"), (F.col("p_partkey") % 7 == 0).alias("instance"), F.when(F.col("p_size") % 5 == 0, "quantity").otherwise(F.col("p_brand")).alias("field"), F.array("p_type").alias("usage"))
    banned = [t.part.agg(F.min("p_type")).first()[0]]
    return selection.not_excluded(rows, t.supplier.select(F.col("s_suppkey").alias("offset")), banned).select("offset", "field")


#: Parts below suppliers as lineitems say, by return flag; keys are the tables' own, so that pairs grow with them.
PAIRS = """st AS (SELECT l_returnflag||l_linestatus AS source, 'p:'||l_partkey AS sub, 's:'||l_suppkey AS sup FROM lineitem),
w AS (SELECT sub, sup, list_sort(list(DISTINCT source)) AS f FROM st GROUP BY sub, sup), d AS (SELECT sub, sup, f, CASE WHEN len(f) >= 2 THEN 'accepted' ELSE 'single' END AS status FROM w)"""


def stated_pairs(t: Tables) -> DataFrame:
    return t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("source"), named("p", "l_partkey").alias("sub"), named("s", "l_suppkey").alias("sup"))


def pairs(t: Tables) -> DataFrame:
    return votes.status(votes.witnesses(stated_pairs(t)).withColumn("ruling", F.lit(None).cast("string")))


@query(f"""WITH {PAIRS} SELECT sub, sup, array_to_string(f, ' ') AS "for", '' AS against, status FROM d""")
def whole_key_votes(t: Tables) -> DataFrame:
    """The vote on pairs of whole keys, which grow with the tables."""
    return pairs(t).select("sub", "sup", F.array_join("for", " ").alias("for"), F.array_join("against", " ").alias("against"), "status")


@query(f"""WITH {PAIRS} SELECT sub, sup FROM d WHERE status = 'single' AND (sub, sup) NOT IN (SELECT ('p:'||l_partkey, 's:'||l_suppkey) FROM lineitem WHERE l_linenumber = 2) AND sup IN (SELECT 's:'||s_suppkey FROM supplier WHERE s_suppkey % 4 != 0)
AND f = ['AF'] AND (sub, sup) IN (SELECT ('p:'||l_partkey, 's:'||l_suppkey) FROM lineitem WHERE l_quantity > 5) AND (sub IN (SELECT 'p:'||p_partkey FROM part WHERE p_size < 25) OR sup IN (SELECT 'p:'||p_partkey FROM part WHERE p_size < 25)) AND sub IN (SELECT 'p:'||p_partkey FROM part WHERE p_partkey % 3 != 0)""")
def waiting_reviews(t: Tables) -> DataFrame:
    """Single pairs that nobody reviewed, placed, stated directly, by one witness, of one pack, in one branch."""
    of = lambda df: df.select(named("p", "l_partkey").alias("sub"), named("s", "l_suppkey").alias("sup"))
    part = named("p", "p_partkey").alias("name")
    placed = t.supplier.where("s_suppkey % 4 != 0").select(named("s", "s_suppkey").alias("name"))
    origins = t.part.select(part, F.when(F.col("p_size") < 25, "pack").otherwise("base").alias("origin"))
    return selection.open_reviews(pairs(t), of(t.lineitem.where("l_linenumber = 2")).distinct(), placed, of(t.lineitem.where("l_quantity > 5")).distinct(), "AF", "pack", origins, t.part.where("p_partkey % 3 != 0").select(part)).select("sub", "sup")


@query(f"""WITH {PAIRS}, n AS (SELECT sub, sup, list_filter(['AF', 'RF'], lambda x: list_contains(f, x)) AS s FROM d WHERE status = 'accepted') SELECT sub, sup, coalesce(s[1], 'ruling') AS witness FROM n WHERE len(s) <= 1""")
def single_sourced(t: Tables) -> DataFrame:
    """Accepted pairs of one source only, or of none, of two that count as such."""
    return selection.single_sourced(pairs(t), ["AF", "RF"], by_ruling=True)


@query(f"{GEO_CLOSED} SELECT name, id FROM (SELECT 'c:'||c_custkey AS name, c_mktsegment AS id FROM customer UNION ALL SELECT 'r:'||r_regionkey, r_name FROM region) WHERE name = 'r:2' OR name IN (SELECT sub FROM closed WHERE sup = 'r:2')")
def fenced_matches(t: Tables) -> DataFrame:
    found = t.customer.select(named("c", "c_custkey").alias("name"), F.col("c_mktsegment").alias("id")).union(t.region.select(named("r", "r_regionkey"), "r_name"))
    return selection.fenced(found, graph.closure(geo(t)), "r:2")


@query("SELECT 'yes' AS given, 'true' AS ok, count(*) AS n FROM events WHERE event_type = 'click' UNION ALL SELECT 'n, but', 'false', count(*) FROM events WHERE event_type = 'view' UNION ALL SELECT 'perhaps', 'unclear', count(*) FROM events WHERE event_type NOT IN ('click', 'view')")
def tri_state(t: Tables) -> DataFrame:
    told = t.events.select(F.when(F.col("event_type") == "click", "yes").when(F.col("event_type") == "view", "n, but").otherwise("perhaps").alias("given"))
    return told.groupBy("given", F.coalesce(votes.verdict(F.col("given")).cast("string"), F.lit("unclear")).alias("ok")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_orderstatus = 'F' OR o_orderpriority LIKE '1%' OR o_custkey % 5 = 0 AS sourced FROM orders")
def sourced_rows(t: Tables) -> DataFrame:
    y = lambda c: F.when(c, "y")
    return t.orders.select("o_orderkey", selection.is_sourced(y(F.col("o_orderstatus") == "F"), y(F.col("o_orderpriority").startswith("1")), y(F.col("o_custkey") % 5 == 0)).alias("sourced"))


@query("SELECT l_partkey AS key, l_returnflag AS pack, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A')")
def focused_collisions(t: Tables) -> DataFrame:
    return selection.focused(t.lineitem.select(F.col("l_partkey").alias("key"), F.col("l_returnflag").alias("pack"), "l_suppkey"), "key", "A")


@query("""WITH c AS (SELECT p_partkey||'' AS code FROM part) SELECT code, array_to_string(list_sort(list_distinct(CASE WHEN starts_with(code, '53') THEN ['art'] WHEN code[1] = '1' THEN ['base', 'phenomenon'] ELSE ['base'] END || CASE WHEN starts_with(code, '12') THEN ['writing'] ELSE [] END)), ' ') AS "values" FROM c""")
def hinges_of_codes(t: Tables) -> DataFrame:
    """The longest rule that fits a code, the default without one, and an extra rule's values united in."""
    rule = lambda rows: t.spark.createDataFrame(rows, "prefix string, values array<string>")
    codes = t.part.select(F.col("p_partkey").cast("string").alias("code"))
    return selection.prefixed(codes, rule([("1", ["base", "phenomenon"]), ("53", ["art"])]), rule([("12", ["writing"])]), [1, 2], ["base"]).withColumn("values", F.array_join("values", " "))


@query("SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def first_of_user(t: Tables) -> DataFrame:
    return selection.first_seen(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("SELECT o_orderkey AS name, CASE WHEN o_custkey % 7 = 0 THEN '' WHEN o_custkey % 3 = 0 THEN 'by hand' ELSE o_orderstatus END AS id FROM orders")
def overridden_cells(t: Tables) -> DataFrame:
    """`-` clears, a value replaces, an empty cell leaves."""
    cell = F.when(F.col("o_custkey") % 7 == 0, "-").when(F.col("o_custkey") % 3 == 0, "by hand").otherwise("")
    return t.orders.select(F.col("o_orderkey").alias("name"), joins.overridden(F.col("o_orderstatus"), cell).alias("id"))


@query("SELECT sub, sup, CASE WHEN k % 5 = 0 THEN 'reject' ELSE 'accept' END AS decision FROM (SELECT 'c:'||c_custkey AS sub, 'n:'||c_nationkey AS sup, c_custkey AS k FROM customer)")
def judged_batch(t: Tables) -> DataFrame:
    """Everything in a batch is accepted that isn't rejected."""
    batch = t.customer.select(named("c", "c_custkey").alias("sub"), named("n", "c_nationkey").alias("sup"))
    return votes.judged(batch, t.customer.where("c_custkey % 5 = 0").select(named("c", "c_custkey").alias("sub"), named("n", "c_nationkey").alias("sup")))


@query("SELECT user_id AS sub, event_type AS sup, arg_max(CASE WHEN value > 50 THEN 'accept' ELSE 'reject' END, event_id + CASE WHEN user_id % 2 = event_id % 2 THEN 1000000000 ELSE 0 END) AS decision FROM events GROUP BY user_id, event_type")
def ruling_precedence(t: Tables) -> DataFrame:
    """One ruler's verdicts outrank all others'; among equals the last counts."""
    ruler = F.when(F.col("user_id") % 2 == F.col("event_id") % 2, "chief").otherwise("other")
    rows = t.events.select(F.col("user_id").alias("sub"), F.col("event_type").alias("sup"), F.when(F.col("value") > 50, "accept").otherwise("reject").alias("decision"), F.col("event_id").alias("ord"), ruler.alias("ruler"))
    return votes.last_verdicts(rows, {"chief": 1})


# Graph reports.

WALK = f"WITH RECURSIVE {GEO}, size AS (SELECT sup AS name, count(*) AS n FROM geo GROUP BY sup)"


def direct_sizes(t: Tables) -> DataFrame:
    edges = geo(t)
    names = edges.select(F.col("sub").alias("name")).union(edges.select("sup")).distinct()
    return names.join(edges.groupBy(F.col("sup").alias("name")).agg(F.count("*").alias("cone")), "name", "left").na.fill(0, ["cone"])


@query(f"""{WALK}, w AS (SELECT 'r:'||r_regionkey AS name, 0 AS depth, 'r:'||r_regionkey AS path FROM region UNION ALL SELECT geo.sub, depth + 1, path||'/'||geo.sub FROM w JOIN geo ON geo.sup = w.name WHERE depth < 2)
SELECT CAST(depth AS INTEGER) AS depth, w.name, path, repeat('  ', depth)||w.name||'  ['||coalesce(n, 0)||']' AS line FROM w LEFT JOIN size ON size.name = w.name""")
def tree_listing(t: Tables) -> DataFrame:
    """An indented listing, with sizes; keys end in the names on the way."""
    out = selection.tree_lines(geo(t), regions(t), direct_sizes(t), 2)
    return out.select("depth", "name", F.array_join(F.transform("key", lambda s: s["n"]), "/").alias("path"), "line")


@query(f"""WITH {GOODS}, m AS (SELECT sub, count(*) - 1 AS more FROM goods GROUP BY sub) SELECT 'goods/'||g.sup||'/'||g.sub AS path, '    '||g.sub||'  ['||(SELECT count(*) FROM goods AS k WHERE k.sup = g.sub)||']'||CASE WHEN more > 0 THEN '  (+'||more||' parent)' ELSE '' END AS line FROM goods AS g JOIN m ON m.sub = g.sub WHERE g.sup IN ('brand', 'type')""")
def tree_listing_shared(t: Tables) -> DataFrame:
    """The second level of goods below their root: names of several parents are told so."""
    edges = goods(t)
    names = edges.select(F.col("sub").alias("name")).union(edges.select("sup")).distinct()
    sizes = names.join(edges.groupBy(F.col("sup").alias("name")).agg(F.count("*").alias("cone")), "name", "left").na.fill(0, ["cone"])
    out = selection.tree_lines(edges, t.spark.createDataFrame([("goods",)], "name string"), sizes, 2).where("depth = 2")
    return out.select(F.array_join(F.transform("key", lambda s: s["n"]), "/").alias("path"), "line")


@query(f"""{WALK}, k AS (SELECT sub, sup, row_number() OVER (PARTITION BY sup ORDER BY coalesce(n, 0) DESC, sub) AS place FROM geo LEFT JOIN size ON size.name = geo.sub),
w AS (SELECT sup, sub, 1 AS level FROM k WHERE place <= 2 AND sup LIKE 'r:%' UNION ALL SELECT k.sup, k.sub, level + 1 FROM w JOIN k ON k.sup = w.sub AND place <= 2 WHERE level < 3) SELECT sup, sub, CAST(level AS INTEGER) AS level FROM w""")
def cut_down(t: Tables) -> DataFrame:
    """The two largest children of each name, three levels down from regions."""
    return selection.cut_down(geo(t), regions(t), direct_sizes(t), 2, 3)


@query(f"""{GEO_CLOSED}, n AS (SELECT 'shop'||c_custkey AS name, 'c:'||c_custkey AS o FROM customer UNION ALL SELECT 'land'||n_nationkey, 'n:'||n_nationkey FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'part'||r_regionkey, 'r:'||r_regionkey FROM region)
SELECT DISTINCT a.name, b.name AS reached FROM n AS a JOIN closed ON closed.sub = a.o JOIN n AS b ON b.o = closed.sup""")
def names_above(t: Tables) -> DataFrame:
    """The store's names that a walk up from each name's synset reaches."""
    one = lambda df, word, letter, k: df.select(F.concat(F.lit(word), F.col(k)).alias("name"), named(letter, k).alias("offset"))
    names = one(t.customer, "shop", "c", "c_custkey").union(one(t.nation.where("n_nationkey % 2 = 0"), "land", "n", "n_nationkey")).union(one(t.region, "part", "r", "r_regionkey"))
    return selection.store_names_above(names, graph.closure(geo(t)))


@query(f"""WITH {GEO}, s AS (SELECT 'n:'||n_nationkey AS name FROM nation WHERE n_regionkey = 1 UNION SELECT 'r:1' UNION SELECT 'n:3' UNION SELECT sub FROM geo WHERE sup = 'n:3' UNION SELECT sub FROM geo WHERE sup IN (SELECT sub FROM geo WHERE sup = 'n:3'))
SELECT sub, sup FROM geo WHERE sub IN (SELECT name FROM s) AND sup IN (SELECT name FROM s)""")
def walks_in_turn(t: Tables) -> DataFrame:
    """One level below region 1, then two below nation 3, with all edges among what was seen."""
    return selection.walks_in_turn(geo(t), [("r:1", 1), ("n:3", 2)])


@query("""WITH c AS (SELECT n_nationkey AS k, n_regionkey AS r, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC) AS i, 6 - row_number() OVER (PARTITION BY 0 ORDER BY n_nationkey) AS x FROM nation)
SELECT 'n:'||k AS name, (5 - r)||'/'||i AS key FROM c UNION ALL SELECT 'r:'||r_regionkey, (5 - r_regionkey)||'' FROM region UNION ALL SELECT 'world', ''""")
def preorder(t: Tables) -> DataFrame:
    """World, regions and nations, so that names come before all below them, the last child first."""
    edges = t.region.select(named("r", "r_regionkey").alias("sub"), F.lit("world").alias("sup"), F.col("r_regionkey").alias("o")).union(t.nation.select(named("n", "n_nationkey"), named("r", "n_regionkey"), "n_nationkey"))
    return selection.preorder(edges, t.spark.createDataFrame([("world",)], "name string"), "o").select("name", F.array_join("key", "/").alias("key"))


@query("SELECT 's:'||s_suppkey AS name FROM supplier WHERE s_nationkey % 2 = 0 AND s_suppkey % 3 != 0")
def added_at_top(t: Tables) -> DataFrame:
    top = lambda df: df.select(named("s", "s_suppkey").alias("sub"), F.lit("*").alias("sup"))
    return selection.added_at_top(top(t.supplier.where("s_suppkey % 3 = 0")), top(t.supplier.where("s_nationkey % 2 = 0")))


@query("""SELECT 'n:'||s_nationkey AS name, 'pack' AS store, 's:'||s_suppkey AS sub, CASE WHEN s_suppkey % 2 = 0 THEN 'argument' ELSE 'parent' END AS how FROM supplier""")
def mentions(t: Tables) -> DataFrame:
    """Every second supplier is in its nation, the others are kinds of it."""
    n = named("n", "s_nationkey")
    sup = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("in("), n, F.lit(")"))).otherwise(n)
    return selection.mentions(t.supplier.select(F.lit("pack").alias("store"), named("s", "s_suppkey").alias("sub"), sup.alias("sup")))


@query("SELECT 'c:'||c_custkey AS sub, 'n:'||c_nationkey AS sup, left(c_name, 10) AS sub_gloss, '' AS sup_gloss FROM customer")
def glossed_edges(t: Tables) -> DataFrame:
    edges = t.customer.select(named("c", "c_custkey").alias("sub"), named("n", "c_nationkey").alias("sup"))
    return selection.with_glosses(edges, t.customer.select(named("c", "c_custkey").alias("name"), F.col("c_name").alias("gloss")), 10)


@query(f"WITH {GEO}, d AS (SELECT sup, count(*) AS n FROM geo GROUP BY sup) SELECT CAST(sum(n) AS BIGINT) AS edges, count(*) AS parents, max(n) AS most FROM d")
def degrees(t: Tables) -> DataFrame:
    return selection.degrees(geo(t))


@query("SELECT 'r:0' AS name UNION SELECT 'n:'||n_nationkey FROM nation WHERE n_regionkey = 0 UNION SELECT 's:'||s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 0 UNION SELECT 's:'||s_suppkey FROM supplier WHERE s_suppkey % 5 = 0")
def placed_with_extra(t: Tables) -> DataFrame:
    """Extra edges place every fifth supplier below region 0."""
    accepted = t.nation.select(named("n", "n_nationkey").alias("sub"), named("r", "n_regionkey").alias("sup")).union(t.supplier.select(named("s", "s_suppkey"), named("n", "s_nationkey")))
    extra = t.supplier.where("s_suppkey % 5 = 0").select(named("s", "s_suppkey").alias("sub"), F.lit("r:0").alias("sup"))
    return selection.placed_with(accepted, extra, t.spark.createDataFrame([("r:0",)], "name string"))


def shipped(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Packs by return flag; A and R are shipped; suppliers divisible by three are owned by N alone, others by R."""
    s, r = named("s", "l_suppkey"), F.col("l_returnflag")
    edges = t.lineitem.where(r.isin("A", "R")).select(r.alias("store"), named("p", "l_partkey").alias("sub"), s.alias("sup"))
    edges = edges.union(t.lineitem.where(r == "A").select(r, s, F.lit("*")))
    edges = edges.union(t.supplier.select(F.when(F.col("s_suppkey") % 3 == 0, "N").otherwise("R"), named("s", "s_suppkey"), F.lit("top")))
    return selection.shipped_entries(edges.distinct(), t.spark.createDataFrame([("s:1",)], "name string"), ["A", "R"])


SHIPPED = "u AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'A' AND l_suppkey != 1)"


@query(f"""WITH {SHIPPED} SELECT DISTINCT l_returnflag AS store, 'p:'||l_partkey AS sub, 's:'||l_suppkey AS sup FROM lineitem WHERE l_returnflag IN ('A', 'R') UNION SELECT 'R', 's:'||s_suppkey, 'top' FROM supplier WHERE s_suppkey % 3 != 0
UNION SELECT 'A', 's:'||k, 'top' FROM u JOIN supplier ON s_suppkey = k WHERE k % 3 = 0""")
def shipped_own(t: Tables) -> DataFrame:
    """Own entries; the claim of an owner that isn't shipped is carried."""
    return shipped(t)[0].distinct()


@query(f"WITH {SHIPPED} SELECT 'A' AS store, 's:'||k AS name FROM u WHERE k % 3 != 0 OR k NOT IN (SELECT s_suppkey FROM supplier)")
def shipped_borrowed(t: Tables) -> DataFrame:
    return shipped(t)[1]


@query(f"WITH {SHIPPED} SELECT DISTINCT 'A' AS store, 'R' AS other FROM u JOIN supplier ON s_suppkey = k WHERE k % 3 != 0")
def shipped_uses(t: Tables) -> DataFrame:
    return shipped(t)[2]


# Counts.


@query(f"WITH {PAIRS} SELECT f[1] AS source, count(*) AS n FROM d WHERE len(f) = 1 GROUP BY f[1]")
def single_source_counts(t: Tables) -> DataFrame:
    return selection.single_source_counts(pairs(t))


@query("SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_totalprice > 1000 AND o_orderstatus != 'F') AS dear, count(*) FILTER (WHERE o_custkey IS NULL) AS nobody FROM orders")
def conditional_counts(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return selection.conditional_counts(t.orders, {"f": status == "F", "dear": (F.col("o_totalprice") > 1000) & (status != "F"), "nobody": F.col("o_custkey").isNull()})


@query("SELECT lower(p_brand) AS top, count(*) AS n FROM part WHERE p_size % 4 < 2 GROUP BY p_brand")
def excluded_by_top(t: Tables) -> DataFrame:
    """Half the parts' types are a vendor's or an experiment's."""
    kind = F.when(F.col("p_size") % 4 == 0, "vnd.x").when(F.col("p_size") % 4 == 1, "x-y").otherwise("z")
    return selection.excluded_by_top(t.part.select(F.concat_ws("/", F.lower("p_brand"), kind).alias("media_type")))


@query("""WITH r AS (SELECT c_custkey, c_acctbal AS s, c_nationkey % 4 = 0 AS y FROM customer), f AS (SELECT y FROM r ORDER BY s DESC, c_custkey DESC LIMIT 100)
SELECT count(*) AS n, CAST(sum(CAST(y AS INTEGER)) AS BIGINT) AS positives, round(avg(CAST(y AS DOUBLE)), 6) AS base, round((SELECT avg(CAST(y AS DOUBLE)) FROM f), 6) AS precision FROM r""")
def precision_at_100(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.col("c_acctbal").alias("s"), (F.col("c_nationkey") % 4 == 0).alias("y"))
    return selection.precision_at(rows, "s", "c_custkey", "y").select("n", "positives", F.round("base", 6).alias("base"), F.round("precision", 6).alias("precision"))


@query("SELECT k, side FROM (SELECT o_custkey AS k, 'old' AS side FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) GROUP BY o_custkey UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_custkey % 2 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders))")
def drift(t: Tables) -> DataFrame:
    return selection.drift(t.orders.select(F.col("o_custkey").alias("k")), t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k")), ["k"])


@query("""WITH s AS (SELECT l_orderkey AS k, list(DISTINCT l_suppkey) FILTER (WHERE l_linenumber <= 2) AS a, list(DISTINCT l_suppkey) FILTER (WHERE l_quantity > 10) AS b FROM lineitem GROUP BY l_orderkey)
SELECT k, coalesce(list_has_all(coalesce(b, []), coalesce(a, [])), true) AS within FROM s""")
def subset_test(t: Tables) -> DataFrame:
    """Are the suppliers of an order's first two lines among those of its large lines?"""
    by = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(F.when(F.col("l_linenumber") <= 2, F.col("l_suppkey"))).alias("a"), F.collect_set(F.when(F.col("l_quantity") > 10, F.col("l_suppkey"))).alias("b"))
    return by.select("k", selection.subset(F.col("a"), F.col("b")).alias("within"))


@query("SELECT 'p:'||l_partkey AS name, CASE WHEN count(DISTINCT l_suppkey) <= 3 THEN string_agg(DISTINCT 's'||lpad(l_suppkey||'', 6, '0'), '; ' ORDER BY 's'||lpad(l_suppkey||'', 6, '0')) ELSE array_to_string(list_sort(list(DISTINCT 's'||lpad(l_suppkey||'', 6, '0')))[1:3], '; ')||'; …' END AS shown FROM lineitem GROUP BY l_partkey")
def first_three(t: Tables) -> DataFrame:
    from arbora.operators import aggregates

    s = F.concat(F.lit("s"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0"))
    return t.lineitem.groupBy(named("p", "l_partkey").alias("name")).agg(F.collect_set(s).alias("s")).select("name", aggregates.shown(F.col("s")).alias("shown"))


# Orders and pages.


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_name, c_custkey) - 1 AS place FROM customer")
def sorted_report(t: Tables) -> DataFrame:
    return selection.in_order(t.customer.select("c_custkey", "c_mktsegment", "c_name"), F.col("c_mktsegment").asc(), F.col("c_name").asc(), F.col("c_custkey").asc()).select("c_custkey", "place")


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_size + 10 * p_retailprice DESC, p_partkey) - 1 AS place FROM part")
def weighted_order(t: Tables) -> DataFrame:
    return selection.by_weight(t.part.select("p_partkey", "p_size", "p_retailprice"), "p_size", "p_retailprice", "p_partkey").select("p_partkey", "place")


@query("SELECT code, row_number() OVER (ORDER BY length(code), code) - 1 AS place FROM (SELECT p_partkey||'' AS code FROM part)")
def shortest_first(t: Tables) -> DataFrame:
    return selection.shortest_first(t.part.select(F.col("p_partkey").cast("string").alias("code")), "code").select("code", "place")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 40 LIMIT 25")
def page_of_rows(t: Tables) -> DataFrame:
    return selection.page(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 40, 25)


# Senses.


@query("""WITH s AS (SELECT l_orderkey AS k, list(l_partkey ORDER BY l_linenumber, l_partkey) AS o FROM lineitem GROUP BY l_orderkey) SELECT o_orderkey AS name, CAST(coalesce(list_position(o, o_custkey), 0) AS INTEGER) AS rank FROM orders LEFT JOIN s ON k = o_orderkey""")
def sense_ranks(t: Tables) -> DataFrame:
    """The place of an order's customer number among its parts' numbers, if it is one."""
    order = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda s: s["l_partkey"])
    senses = t.lineitem.groupBy(F.col("l_orderkey").alias("lemma")).agg(order.alias("offsets"))
    names = t.orders.select(F.col("o_orderkey").alias("name"), F.col("o_orderkey").alias("lemma"), F.col("o_custkey").alias("offset"))
    return selection.sense_rank(names, senses).select("name", F.coalesce("rank", F.lit(0)).alias("rank"))


@query(f"""WITH s AS (SELECT p_partkey AS o, CASE WHEN p_partkey > 1 THEN p_partkey // 2 END AS up, lower(p_name) AS n, p_type AS g FROM part), tok AS (SELECT o, up, list_filter(regexp_extract_all(n, '[a-z]+'), lambda x: x NOT IN ({STOPS})) AS mine, list_filter(regexp_extract_all(lower(g), '[a-z]+'), lambda x: x NOT IN ({STOPS})) AS gloss,
list_filter(regexp_extract_all(split_part(n, ' ', 1), '[a-z]+'), lambda x: x NOT IN ({STOPS})) AS own FROM s),
w AS (SELECT o, unnest(mine) AS word, own, 2 AS n, false AS every FROM tok UNION ALL SELECT o, unnest(gloss), own, 1, true FROM tok UNION ALL SELECT a.o, unnest(b.mine), a.own, 1, false FROM tok AS a JOIN tok AS b ON b.o = a.up UNION ALL SELECT a.o, unnest(b.mine), a.own, 1, false FROM tok AS a JOIN tok AS b ON b.up = a.o)
SELECT o AS "offset", word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE every OR NOT list_contains(own, word) GROUP BY o, word""")
def sense_bags(t: Tables) -> DataFrame:
    """Parts as senses of the first word of their name, below the part of half their number."""
    p, name = F.col("p_partkey"), F.lower("p_name")
    synset = t.part.select(p.alias("offset"), F.array(name).alias("lemmas"), F.col("p_type").alias("gloss"), F.lit("").alias("examples"), F.when(p > 1, F.array(F.floor(p / 2))).alias("above"))
    lemma = t.part.select(F.split_part(name, F.lit(" "), F.lit(1)).alias("lemma"), p.alias("offset"))
    return selection.sense_bag(synset, lemma).select("offset", "word", F.col("n").cast("long").alias("n"))


@query("""WITH l AS (SELECT event_id AS i, user_id AS s, event_type AS e, CAST(floor(value) AS BIGINT)||'' AS v FROM events) SELECT i AS seq, coalesce(array_to_string(list_sort(list_distinct(list(v) FILTER (WHERE e IN ('click', 'view')) OVER w)), ' '), '') AS readded,
coalesce(array_to_string(list_sort(list_distinct(list('o'||v) FILTER (WHERE e IN ('click', 'error')) OVER w)), ' '), '') AS removed, coalesce(bool_or(e = 'purchase') OVER w, false) AS dropped FROM l WINDOW w AS (PARTITION BY s, i % 40 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""")
def later_targets(t: Tables) -> DataFrame:
    """Events as rulings: clicks move, views add a parent, errors cut, purchases drop."""
    e, v = F.col("event_type"), F.floor("value").cast("string")
    action = F.when(e == "click", "move").when(e == "view", "parent+").when(e == "error", "cut").when(e == "purchase", "drop").otherwise("disown")
    log = t.events.select(F.col("event_id").alias("seq"), (F.col("event_id") % 40).alias("pack"), F.col("user_id").alias("sub"), action.alias("action"), F.concat(F.lit("o"), v).alias("old"), v.alias("new"))
    return selection.later_targets(log).select("seq", "readded", "removed", "dropped")


# Rulings: suppliers hang below nations in the core, customers below nations in a pack; each action in its turn.

RULED = """e AS (SELECT 'core' AS store, 'n:'||n_nationkey AS sub, 'r:'||n_regionkey AS sup FROM nation UNION ALL SELECT 'core', 'r:'||r_regionkey, '*' FROM region UNION ALL SELECT 'pack', 's:'||s_suppkey, 'n:'||s_nationkey FROM supplier
UNION ALL SELECT 'pack', 't:'||s_suppkey, 's:'||s_suppkey FROM supplier UNION ALL SELECT 'pack', 'n:'||n_nationkey, '*' FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier))"""


def ruled_stores(t: Tables) -> DataFrame:
    one = lambda df, store, a, b: df.select(F.lit(store).alias("store"), a.alias("sub"), b.alias("sup"), F.lit(0).alias("ord"))
    s, n = named("s", "s_suppkey"), named("n", "s_nationkey")
    edges = one(t.nation, "core", named("n", "n_nationkey"), named("r", "n_regionkey")).union(one(t.region, "core", named("r", "r_regionkey"), F.lit("*")))
    edges = edges.union(one(t.supplier, "pack", s, n)).union(one(t.supplier, "pack", named("t", "s_suppkey"), s))
    return edges.union(one(t.supplier.select("s_nationkey").distinct(), "pack", n, F.lit("*")))


def rulings(t: Tables, action: str, sub: Column, old: Column | str = "-", new: Column | str = "-", rows: DataFrame | None = None, pack: str = "pack") -> DataFrame:
    rows = t.supplier.where("s_suppkey % 5 = 0") if rows is None else rows
    word = lambda c: F.lit(c) if isinstance(c, str) else c
    key = F.col(rows.columns[0])
    return rows.select(key.cast("long").alias("seq"), F.lit(pack).alias("pack"), sub.alias("sub"), F.lit(action).alias("action"), word(old).alias("old"), word(new).alias("new"))


def after(t: Tables, *logs: DataFrame) -> DataFrame:
    """The stores after the logs, one after the other; a row that is refused is an error."""
    log = logs[0]
    for i, x in enumerate(logs[1:]):
        log = log.union(x.withColumn("seq", F.col("seq") + (i + 1) * 10**9))
    stores, said = rulings_.replay(ruled_stores(t), log)
    if not said.where("what = 'error'").isEmpty():
        raise ValueError("a row was refused")
    return stores.select("store", "sub", "sup")


def ruled_sql(changes: str, gone: str = "") -> str:
    return f"WITH {RULED} SELECT store, sub, sup FROM e {('WHERE NOT (' + gone + ')') if gone else ''} {changes}"




def supplier() -> Column:
    return named("s", "s_suppkey")


def nation() -> Column:
    return named("n", "s_nationkey")


FIFTH = "store = 'pack' AND sub LIKE 's:%' AND CAST(substr(sub, 3) AS BIGINT) % 5 = 0"


@query(ruled_sql("UNION ALL SELECT 'core', 'x:'||n_nationkey, 'n:'||n_nationkey FROM nation"))
def rule_add(t: Tables) -> DataFrame:
    return after(t, rulings(t, "add", named("x", "n_nationkey"), new=named("n", "n_nationkey"), rows=t.nation, pack="core"))


@query(ruled_sql("UNION ALL SELECT 'pack', 's:'||s_suppkey, 'r:'||((n_regionkey + 1) % 5) FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 5 = 0 UNION SELECT 'pack', 'r:'||((n_regionkey + 1) % 5), '*' FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 5 = 0"))
def rule_parent(t: Tables) -> DataFrame:
    """Every fifth supplier gets another region as a further parent, which the pack then borrows."""
    rows = t.supplier.where("s_suppkey % 5 = 0").join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    return after(t, rulings(t, "parent+", supplier(), new=F.concat(F.lit("r:"), (F.col("n_regionkey") + 1) % 5), rows=rows))


MOVED = "UNION ALL SELECT 'pack', 's:'||s_suppkey, 'n:'||((s_nationkey + 1) % 25) FROM supplier WHERE s_suppkey % 5 = 0 UNION SELECT 'pack', 'n:'||((s_nationkey + 1) % 25), '*' FROM supplier WHERE s_suppkey % 5 = 0"
IDLE = "store = 'pack' AND sup = '*' AND sub NOT IN (SELECT 'n:'||s_nationkey FROM supplier WHERE s_suppkey % 5 != 0)"


@query(ruled_sql(MOVED, f"({FIFTH}) OR ({IDLE})"))
def rule_move(t: Tables) -> DataFrame:
    """Every fifth supplier moves to the next nation; stubs come and go with them."""
    return after(t, rulings(t, "move", supplier(), nation(), F.concat(F.lit("n:"), (F.col("s_nationkey") + 1) % 25)))


@query(ruled_sql(MOVED, f"({FIFTH}) OR ({IDLE})"))
def rule_move_twice(t: Tables) -> DataFrame:
    """A later row moves on from where an earlier one went: the same as one move."""
    via = F.concat(F.lit("n:"), (F.col("s_nationkey") + 7) % 25)
    return after(t, rulings(t, "move", supplier(), nation(), via), rulings(t, "move", supplier(), via, F.concat(F.lit("n:"), (F.col("s_nationkey") + 1) % 25)))


@query(ruled_sql(MOVED, f"({FIFTH}) OR ({IDLE})"))
def rule_cut(t: Tables) -> DataFrame:
    """Every fifth supplier gets a further nation and then loses its own."""
    top = F.concat(F.lit("n:"), (F.col("s_nationkey") + 1) % 25)
    return after(t, rulings(t, "parent+", supplier(), new=top), rulings(t, "cut", supplier(), nation()))


@query(ruled_sql("UNION ALL SELECT 'pack', 'm:'||n_nationkey, 'r:'||n_regionkey FROM nation UNION ALL SELECT 'pack', 'n:'||n_nationkey, 'm:'||n_nationkey FROM nation UNION SELECT 'pack', 'r:'||n_regionkey, '*' FROM nation", "store = 'pack' AND sub LIKE 'n:%' AND sup = '*'"))
def rule_refine(t: Tables) -> DataFrame:
    """The pack puts a level between nations and their regions."""
    m, r = named("m", "n_nationkey"), named("r", "n_regionkey")
    return after(t, rulings(t, "add", m, new=r, rows=t.nation), rulings(t, "refine", named("n", "n_nationkey"), new=m, rows=t.nation))


@query(ruled_sql("UNION ALL SELECT 'pack', 'n:'||n_nationkey, 's:'||min(s_suppkey) FROM nation, supplier WHERE n_nationkey % 5 = 4 GROUP BY n_nationkey", "store = 'pack' AND sub LIKE 'n:%' AND sup = '*' AND CAST(substr(sub, 3) AS BIGINT) % 5 = 4"))
def rule_refine_cross(t: Tables) -> DataFrame:
    """A claim across branches, which refine would refuse."""
    first = t.supplier.agg(F.min("s_suppkey")).first()[0]
    return after(t, rulings(t, "refine-cross", named("n", "n_nationkey"), new=f"s:{first}", rows=t.nation.where("n_nationkey % 5 = 4")))


@query(ruled_sql("UNION ALL SELECT 'core', 's:'||s_suppkey, 'n:'||s_nationkey FROM supplier WHERE s_suppkey % 5 = 0 UNION ALL SELECT 'pack', 's:'||s_suppkey, '*' FROM supplier WHERE s_suppkey % 5 = 0", f"({FIFTH}) OR ({IDLE})"))
def rule_promote(t: Tables) -> DataFrame:
    """Every fifth supplier becomes the core's; the pack keeps a stub, since tills hang from it."""
    return after(t, rulings(t, "promote", supplier(), new=nation()))


@query(ruled_sql("UNION ALL SELECT 'side', 's:'||s_suppkey, 'n:'||s_nationkey FROM supplier WHERE s_suppkey % 5 = 0 UNION SELECT 'side', 'n:'||s_nationkey, '*' FROM supplier WHERE s_suppkey % 5 = 0 UNION ALL SELECT 'pack', 's:'||s_suppkey, '*' FROM supplier WHERE s_suppkey % 5 = 0", f"({FIFTH}) OR ({IDLE})"))
def rule_disown(t: Tables) -> DataFrame:
    """A second pack takes every fifth supplier, and the first gives up its copies."""
    return after(t, rulings(t, "add", supplier(), new=nation(), pack="side"), rulings(t, "disown", supplier()))


@query(ruled_sql("", "store = 'pack' AND sub LIKE 't:%' AND CAST(substr(sub, 3) AS BIGINT) % 5 = 0"))
def rule_drop(t: Tables) -> DataFrame:
    return after(t, rulings(t, "drop", named("t", "s_suppkey")))


@query(ruled_sql("UNION ALL SELECT 'pack', 'x:'||s_suppkey, 's:'||s_suppkey FROM supplier WHERE s_suppkey % 5 != 0"))
def rule_add_then_drop(t: Tables) -> DataFrame:
    """Names for all suppliers, of which every fifth is dropped again: what a later row drops doesn't come back."""
    x = named("x", "s_suppkey")
    return after(t, rulings(t, "add", x, new=supplier(), rows=t.supplier), rulings(t, "drop", x))


@query("""SELECT s_suppkey AS seq, CASE s_suppkey % 6 WHEN 0 THEN 'done' WHEN 1 THEN 'error' WHEN 2 THEN 'error' WHEN 3 THEN 'already' WHEN 4 THEN 'error' ELSE 'done' END AS what FROM supplier""")
def rule_outcomes(t: Tables) -> DataFrame:
    """What rows do: a further parent, an unknown one, an unknown action, a move to where a name is, a drop of what has
    children, a drop of what has none."""
    k = F.col("s_suppkey") % 6
    action = F.when(k < 2, "parent+").when(k == 2, "turn").when(k == 3, "move").otherwise("drop")
    sub = F.when(k == 5, named("t", "s_suppkey")).otherwise(supplier())
    old = F.when(k == 3, F.concat(F.lit("n:"), (F.col("s_nationkey") + 1) % 25)).otherwise("-")
    new = F.when(k == 0, F.concat(F.lit("n:"), (F.col("s_nationkey") + 1) % 25)).when(k == 1, "nowhere").when(k == 3, nation()).otherwise("-")
    log = t.supplier.select(F.col("s_suppkey").cast("long").alias("seq"), F.lit("pack").alias("pack"), sub.alias("sub"), action.alias("action"), old.alias("old"), new.alias("new"))
    return rulings_.replay(ruled_stores(t), log)[1].select("seq", "what")


RENAMED = "UNION ALL SELECT 'pack', 't:'||s_suppkey, 'z:'||s_suppkey FROM supplier WHERE s_suppkey % 5 = 0 UNION ALL SELECT 'pack', 'z:'||s_suppkey, 'n:'||s_nationkey FROM supplier WHERE s_suppkey % 5 = 0"


@query(ruled_sql(RENAMED, f"({FIFTH}) OR (store = 'pack' AND sub LIKE 't:%' AND CAST(substr(sub, 3) AS BIGINT) % 5 = 0)"))
def rename_rows(t: Tables) -> DataFrame:
    """Every fifth supplier has another name, wherever it is mentioned."""
    names = t.supplier.where("s_suppkey % 5 = 0").select(F.col("s_suppkey").alias("seq"), F.lit("pack").alias("pack"), supplier().alias("old"), named("z", "s_suppkey").alias("new"), F.lit("respell").alias("kind"))
    none = t.spark.createDataFrame([], "seq long, pack string, sub string, action string, old string, new string")
    return rulings_.replay(ruled_stores(t), none, renames=names)[0].select("store", "sub", "sup")


@query("""WITH m AS (SELECT n_nationkey AS k, n_regionkey AS r, (n_regionkey + n_nationkey % 2) % 5 AS new FROM nation) SELECT 'core' AS store, 'n:'||k AS sub, 'r:'||new AS sup FROM m UNION ALL SELECT 'core', 'r:'||r_regionkey, '*' FROM region
UNION ALL SELECT 'pack', 's:'||s_suppkey, 'n:'||s_nationkey FROM supplier UNION SELECT 'pack', 'n:'||s_nationkey, '*' FROM supplier""")
def ruling_replay(t: Tables) -> DataFrame:
    """Nations move between regions by a log; a pack borrows their names."""
    one = lambda df, store, a, b: df.select(F.lit(store).alias("store"), a.alias("sub"), b.alias("sup"), F.lit(0).alias("ord"))
    edges = one(t.nation, "core", named("n", "n_nationkey"), named("r", "n_regionkey")).union(one(t.region, "core", named("r", "r_regionkey"), F.lit("*"))).union(one(t.supplier, "pack", supplier(), nation()))
    to = F.concat(F.lit("r:"), ((F.col("n_regionkey") + F.col("n_nationkey") % 2) % 5).cast("string"))
    return rulings_.replay(edges, rulings(t, "move", named("n", "n_nationkey"), named("r", "n_regionkey"), to, t.nation, "core"))[0].select("store", "sub", "sup")


# Titles.

QUALIFIERS = ", ".join(f"'{w}'" for w in sorted(text.QUALIFIERS))
CLAUSES = "|".join(text.CLAUSES)
#: Titles from parts' names: several kinds, clauses, residues and qualifiers in turn.
TITLES = """CASE p_partkey % 6 WHEN 0 THEN p_name||' and '||lower(p_type)||' goods, fresh or chilled; other things' WHEN 1 THEN p_name||' (x, y), of '||p_type||'; parts of '||p_brand||' n.e.c.' WHEN 2 THEN p_type||', '||p_name||', or other '||p_brand
WHEN 3 THEN p_name||' of '||p_brand||' and '||p_type||', '||p_type||'; the like' WHEN 4 THEN 'raw '||p_name||', other '||p_type||', whether or not '||p_brand ELSE p_name||', similar '||p_type||'; '||p_type||' used in '||p_name||', '||p_brand END"""


def title() -> Column:
    return F.expr(TITLES)


@query(f"""WITH t AS (SELECT p_partkey AS k, regexp_replace(regexp_replace(lower({TITLES}), '"|\\([^)]*\\)|\\bn\\.e\\.c\\.?', '', 'g'), '\\s+', ' ', 'g') AS title FROM part),
s AS (SELECT k, j, trim(x, ' ,.') AS seg FROM (SELECT k, unnest(string_split(title, ';')) AS x, unnest(range(1, len(string_split(title, ';')) + 1)) AS j FROM t)),
p AS (SELECT k, j, i, trim(x) AS piece FROM (SELECT k, j, unnest(string_split(seg, ',')) AS x, unnest(range(1, len(string_split(seg, ',')) + 1)) AS i FROM s) WHERE trim(x) != ''),
h AS (SELECT *, split_part(piece, ' ', 1) AS first, regexp_replace(piece, ' (?:{CLAUSES}) .*$', '') AS head FROM p),
b AS (SELECT k, j, min(i) FILTER (WHERE (i > 1 AND first != 'other' AND first IN ({QUALIFIERS})) OR starts_with(piece, 'the like') OR starts_with(piece, 'similar')) AS stop, min(i) FILTER (WHERE head != piece) AS cut FROM h GROUP BY k, j),
n AS (SELECT h.k, h.j, i, unnest(regexp_split_to_array(head, ' and | or ')) AS x FROM h JOIN b ON b.k = h.k AND b.j = h.j WHERE (stop IS NULL OR i < stop) AND (cut IS NULL OR i <= cut))
SELECT DISTINCT k AS p_partkey, trim(x, ' -') AS kind FROM n WHERE trim(x, ' -') != '' AND NOT regexp_matches(trim(x, ' -'), '^(?:other |the like|similar |like )') AND len(list_filter(string_split(trim(x, ' -'), ' '), lambda w: w NOT IN ({QUALIFIERS}))) > 0""")
def kinds(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.explode(text.kinds(title())).alias("kind"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE true END AS is_union FROM part""")
def union_titles(t: Tables) -> DataFrame:
    """Titles of two kinds, of one, and of one beside a residue."""
    told = F.expr("CASE p_partkey % 3 WHEN 0 THEN 'Cats and dogs' WHEN 1 THEN 'Cats (and other pets), fresh' ELSE 'Cats; other pets' END")
    return t.part.select("p_partkey", text.is_union(told, text.kinds(told)).alias("is_union"))


def singular_sql(w: str) -> str:
    return f"""CASE WHEN {w} IN ({KEEP}) THEN {w} WHEN ({IRREGULAR})[{w}] IS NOT NULL THEN ({IRREGULAR})[{w}] WHEN regexp_matches({w}, '^(neck|bow|hog)?ties$') THEN {w}[:-2] WHEN {w} LIKE '%ies' AND length({w}) > 4 THEN {w}[:-4]||'y'
WHEN regexp_matches({w}, '(ches|shes|sses|xes|zes)$') OR ({w} LIKE '%oes' AND length({w}) > 4) THEN {w}[:-3] WHEN ({w} LIKE '%ves' AND length({w}) > 4) OR regexp_matches({w}, '(^|[^sui])s$') THEN {w}[:-2] ELSE {w} END"""


@query(f"""WITH p AS (SELECT p_partkey, 'fresh '||p_name||'s' AS item, regexp_replace('fresh '||p_name||'s', '^(?:{'|'.join(text.LEADING)})+', '') AS bare FROM part), x AS (SELECT p_partkey, item AS phrase FROM p UNION ALL SELECT p_partkey, bare FROM p), l AS (SELECT *, string_split(phrase, ' ') AS ws FROM x),
f AS (SELECT p_partkey, ws[:-2] AS lead, ws[len(ws)] AS w FROM l), g AS (SELECT p_partkey, lead, {singular_sql('w')} AS w FROM f UNION SELECT p_partkey, lead, w FROM f UNION SELECT p_partkey, lead, w[:-2] FROM f WHERE w LIKE '%s' AND w NOT LIKE '%ss')
SELECT DISTINCT p_partkey, unnest([array_to_string(lead || [w], '_'), replace(array_to_string(lead || [w], '_'), '-', '_'), array_to_string(lead || [w], '-')]) AS key FROM g""")
def variants(t: Tables) -> DataFrame:
    """Keys under which a kind is looked up: with and without its leading modifier, singular, plural, and spelt three ways."""
    return t.part.select("p_partkey", F.explode(text.variants(F.concat(F.lit("fresh "), F.col("p_name"), F.lit("s")))).alias("key"))


@query(f"""WITH w AS (SELECT p_partkey, lower(p_name)||'s' AS x FROM part), l AS (SELECT p_partkey, string_split(x, ' ') AS ws FROM w) SELECT p_partkey, array_to_string(ws[:-2] || [{singular_sql('ws[len(ws)]')}], ' ') AS label FROM l""")
def singular_labels(t: Tables) -> DataFrame:
    """Names with a plural's ending, whose last word becomes singular again."""
    return t.part.select("p_partkey", text.singular_label(F.concat("p_name", F.lit("s"))).alias("label"))


# Graphs whose SQL restates the operator.


@query(f"""WITH RECURSIVE {GOODS}, more AS (SELECT sub, sup FROM goods UNION SELECT 'p:'||p_partkey, 'goods' FROM part UNION SELECT 'p:'||p_partkey, 'brand' FROM part), closed AS (SELECT sub, sup FROM more UNION SELECT closed.sub, more.sup FROM closed JOIN more ON closed.sup = more.sub)
SELECT sub, sup FROM more WHERE NOT EXISTS (SELECT 1 FROM more AS m JOIN closed AS c ON c.sub = m.sup WHERE m.sub = more.sub AND c.sup = more.sup)""")
def merge_union(t: Tables) -> DataFrame:
    """Three stores united and reduced, whatever their order and however often."""
    return graph.merged(shortcuts(t), goods(t), goods(t))


@query(f"""WITH RECURSIVE {GEO}, walk AS (SELECT 'r:'||r_regionkey AS name, 2 AS left FROM region UNION SELECT geo.sub, walk.left - 1 FROM walk JOIN geo ON geo.sup = walk.name WHERE walk.left > 0), seen AS (SELECT DISTINCT name FROM walk)
SELECT sub, sup FROM geo WHERE sub IN (SELECT name FROM seen) AND sup IN (SELECT name FROM seen)""")
def bounded_walk(t: Tables) -> DataFrame:
    return graph.bounded_walk(geo(t), regions(t).withColumn("reach", F.lit(2)))


@query("""WITH RECURSIVE steps(i, old, new) AS (VALUES (1, 'NATION_0', 'x'), (2, 'NATION_1', 'NATION_0'), (3, 'x', 'NATION_2')), r AS (SELECT n_nationkey, n_name AS name, 1 AS i FROM nation UNION ALL SELECT n_nationkey, CASE WHEN name = steps.old THEN steps.new ELSE name END, r.i + 1 FROM r JOIN steps ON steps.i = r.i)
SELECT n_nationkey, name FROM r WHERE i = 4""")
def rename_chain(t: Tables) -> DataFrame:
    """Renames in sequence: a name that one row frees is taken by a later one."""
    return t.nation.select("n_nationkey", joins.renamed(F.col("n_name"), [("NATION_0", "x"), ("NATION_1", "NATION_0"), ("x", "NATION_2")]).alias("name"))


@query("""WITH first AS (SELECT n_regionkey AS r, min(n_nationkey) AS n FROM nation GROUP BY n_regionkey), e AS (SELECT 'n:'||n_nationkey AS sub, 'r:'||n_regionkey AS sup FROM nation UNION ALL SELECT 'r:'||r, 'n:'||n FROM first) SELECT sub, sup FROM e LEFT JOIN first ON 'r:'||r = sup WHERE n IS NULL OR sub > 'n:'||n""")
def cycle_break(t: Tables) -> DataFrame:
    """Nations below regions, and each region below its first nation: five loops.  Names that wait lose their parent in the order
    of their names, until a region's first nation has done so and the region is placed; its other nations then keep it."""
    back = t.nation.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("n_nationkey")).select(named("r", "n_regionkey").alias("sub"), named("n", "n_nationkey").alias("sup"))
    kept, _ = graph.topological(t.nation.select(named("n", "n_nationkey").alias("sub"), named("r", "n_regionkey").alias("sup")).union(back))
    return kept


@query("WITH RECURSIVE e AS (SELECT DISTINCT 'p:'||l_partkey AS sub, 's:'||l_suppkey AS sup FROM lineitem UNION SELECT DISTINCT 's:'||l_suppkey, 'o:'||(l_orderkey // 100) FROM lineitem), closed AS (SELECT sub, sup FROM e UNION SELECT closed.sub, e.sup FROM closed JOIN e ON closed.sup = e.sub) SELECT sub, sup FROM closed")
def whole_key_closure(t: Tables) -> DataFrame:
    """A closure whose graph grows with the tables: parts below suppliers below hundreds of orders."""
    s = named("s", "l_suppkey")
    hundred = F.concat(F.lit("o:"), F.floor(F.col("l_orderkey") / 100).cast("string"))
    return graph.shared_closure(t.lineitem.select(named("p", "l_partkey").alias("sub"), s.alias("sup")).union(t.lineitem.select(s, hundred)))


@query(f"{GEO_CLOSED} SELECT sub AS name FROM closed WHERE sup IN ('r:1', 'n:2') GROUP BY sub HAVING count(DISTINCT sup) = 2")
def stored_get(t: Tables) -> DataFrame:
    """A conjunctive get from a stored closure, dealt by what stands above: only the wanted names' rows are read."""
    return graph.conjunctive_get(graph.stored_closure(graph.closure(geo(t))), ["r:1", "n:2"])


@query("""WITH p AS (SELECT 'c:'||c_custkey AS sub, 'r:'||(c_custkey % 5) AS sup, c_custkey % 3 AS k FROM customer) SELECT sub, sup, CASE k WHEN 0 THEN 'accepted' WHEN 1 THEN 'skipped' ELSE 'single' END AS status FROM p""")
def pack_votes(t: Tables) -> DataFrame:
    """Published pairs are accepted, pairs of the base's names skipped, others need witnesses."""
    rows = candidates(t).withColumn("k", F.expr("cast(substring(sub, 3) as bigint) % 3")).select("sub", "sup", F.array(F.lit("x")).alias("for"), F.array().cast("array<string>").alias("against"), F.lit(None).cast("string").alias("ruling"), (F.col("k") == 0).alias("published"), (F.col("k") == 1).alias("base"))
    return votes.status(rows).select("sub", "sup", "status")
