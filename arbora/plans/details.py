"""Scalar rules, routes, flags and names as queries, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.functions import text
from arbora.operators import audit, graph, joins, ranking, votes
from arbora.plans.files import fresh
from arbora.plans.queries import Tables, named, query
from arbora.session import staged


def word(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# Labels and terms.


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'item'||p_size WHEN 1 THEN 'thing'||p_size WHEN 2 THEN NULL ELSE NULL END AS head FROM part")
def shared_heads(t: Tables) -> DataFrame:
    """'Fresh & Frozen Items' shares a head; two kinds, or a single one, don't."""
    k, n = F.col("p_partkey") % 4, F.col("p_size")
    label = F.when(k == 0, word("Fresh & Frozen Item", n)).when(k == 1, word("Painted & Other Thing", n)).when(k == 2, word("Toasters & Grills ", n)).otherwise(word("Item", n))
    return t.part.select("p_partkey", text.shared_head(label).alias("head"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'toaster grill'||p_size WHEN 1 THEN 'big pot small pan'||p_size ELSE '' END AS kinds FROM part")
def split_bins(t: Tables) -> DataFrame:
    k, n = F.col("p_partkey") % 3, F.col("p_size")
    label = F.when(k == 0, word("Toasters & Grill", n)).when(k == 1, word("Big Pots and Small Pan", n)).otherwise(word("One Two Three & Four", n))
    return t.part.select("p_partkey", F.array_join(text.split_bin(label), " ").alias("kinds"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'in' ELSE p_name END AS head, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS arg, CASE WHEN p_partkey % 2 = 0 THEN 'in('||CASE WHEN p_brand = 'Brand#11' THEN 'first' ELSE p_brand END||')' ELSE p_name END AS renamed FROM part")
def term_rules(t: Tables) -> DataFrame:
    """A term's parts, and a rename that reaches into it."""
    term = F.when(F.col("p_partkey") % 2 == 0, word("in(", F.col("p_brand"), ")")).otherwise(F.col("p_name"))
    part = text.term_parts(term)
    return t.part.select("p_partkey", part["head"].alias("head"), part["arg"].alias("arg"), text.renamed_term(term, F.lit("Brand#11"), F.lit("first")).alias("renamed"))


@query("SELECT o_orderkey, lpad(o_orderkey||'', CAST(greatest(length(o_orderkey||''), 6) AS INTEGER), '0') AS code FROM orders")
def zero_filled(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", text.zero_filled(F.col("o_orderkey").cast("string"), 6).alias("code"))


@query("SELECT p_partkey, left(p_name, 6) AS gloss, CASE WHEN p_size % 2 = 0 THEN p_type||': '||p_name ELSE p_type END AS told FROM part")
def gloss_rules(t: Tables) -> DataFrame:
    """A gloss without its examples and trailing semicolons, cut; a name with its gloss, or alone."""
    return t.part.select("p_partkey", text.gloss_head(word(F.col("p_name"), ';; "an example"; "more"'), 6).alias("gloss"), text.head_of_gloss_text(F.col("p_type"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise("")).alias("told"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'x'||p_size||'-file-format x'||p_size||' x'||p_size||'-file' WHEN 1 THEN 'x'||p_size||'-syntax x'||p_size WHEN 2 THEN '-file' ELSE 'x'||p_size END AS keys FROM part")
def media_keys(t: Tables) -> DataFrame:
    """A format's name, then without each end that it has; a name that is only an end stays."""
    k, n = F.col("p_partkey") % 4, F.col("p_size")
    name = F.when(k == 0, word("x", n, "-file-format")).when(k == 1, word("x", n, "-syntax")).when(k == 2, "-file").otherwise(word("x", n))
    return t.part.select("p_partkey", F.array_join(text.media_keys(name), " ").alias("keys"))


@query("SELECT o_orderkey, o_orderkey % 3 = 0 AS dead, CASE o_orderkey % 4 WHEN 0 THEN 'tops' WHEN 1 THEN 'time' WHEN 2 THEN 'food' ELSE '99' END AS field FROM orders")
def marks_and_fields(t: Tables) -> DataFrame:
    """Registered names that are marked as dead; lexicographer files by number, also without zeros."""
    k = F.col("o_orderkey")
    name = F.when(k % 3 == 0, F.when(k % 2 == 0, "x - deprecated").otherwise("X (OBSOLETED)")).otherwise("x")
    code = F.when(k % 4 == 0, "3").when(k % 4 == 1, "28").when(k % 4 == 2, "13").otherwise("99")
    return t.orders.select("o_orderkey", text.is_dead(name).alias("dead"), text.lexfile_name(code).alias("field"))


@query("SELECT s_suppkey, 'n:'||s_nationkey AS parent FROM supplier UNION ALL SELECT s_suppkey, 'in(r:'||s_nationkey % 5||')' FROM supplier WHERE s_suppkey % 2 = 0")
def parent_columns(t: Tables) -> DataFrame:
    """Names and terms of a parents column, before notes."""
    said = F.when(F.col("s_suppkey") % 2 == 0, word(named("n", "s_nationkey"), " in(r:", F.col("s_nationkey") % 5, ") (a note, with words)")).otherwise(word(named("n", "s_nationkey"), "; a remark"))
    return t.supplier.select("s_suppkey", F.explode(text.parents(said)).alias("parent"))


@query("""SELECT r_name||'/'||n_name||CASE WHEN c_custkey IS NULL THEN '' ELSE '/'||c_name END AS sub, r_name||CASE WHEN c_custkey IS NULL THEN '' ELSE '/'||n_name END AS sup FROM region JOIN nation ON n_regionkey = r_regionkey JOIN (SELECT NULL AS c_custkey, NULL AS c_name, n_nationkey AS k FROM nation UNION ALL SELECT c_custkey, c_name, c_nationkey FROM customer) ON k = n_nationkey""")
def path_parents(t: Tables) -> DataFrame:
    """Paths below the path without their last step."""
    top = t.region.select("r_regionkey", F.array("r_name").alias("path"))
    mid = t.nation.join(top, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.array_append("path", F.col("n_name")).alias("path"))
    low = t.customer.join(mid, F.col("c_nationkey") == F.col("n_nationkey")).select(F.array_append("path", F.col("c_name")).alias("path"))
    edges = joins.path_parents(top.select("path").union(mid.select("path")).union(low))
    return edges.select(F.array_join("sub", "/").alias("sub"), F.array_join("sup", "/").alias("sup"))


# Audits, routes and names.


@query("""WITH r AS (SELECT p_partkey AS k, p_size % 4 AS a, p_size % 3 AS b FROM part) SELECT k AS name, array_to_string(list_filter([CASE WHEN a = 0 THEN 'no-synset' END, CASE WHEN a IN (1, 2) AND b != 2 THEN 'rare-sense' END, CASE WHEN a = 1 THEN 'held-by' END, CASE WHEN k % 5 = 0 THEN 'disjoint' END,
CASE WHEN k % 7 = 0 THEN 'off-wordnet' END, CASE WHEN k % 2 = 0 AND b != 2 THEN 'shrink' END], lambda x: x IS NOT NULL), ' ') AS flags,
CASE WHEN a IN (1, 2) AND b != 2 THEN CASE WHEN a = 1 THEN 'rename' ELSE 'resense' END WHEN k % 5 = 0 THEN 'split' WHEN k % 2 = 0 AND b != 2 THEN 'drop' ELSE '' END AS recommendation FROM r""")
def audit_flags(t: Tables) -> DataFrame:
    """Parts as names: what they hold differs from the reference by size; every third size's sense is an everyday one."""
    k, a, b = F.col("p_partkey"), F.col("p_size") % 4, F.col("p_size") % 3
    held = F.when(a == 3, "ref").when(a > 0, "own")
    rows = t.part.select(
        k.alias("name"), held.alias("held"), F.lit("ref").alias("ref"), F.when(b == 2, F.array(F.lit("own"), F.lit("ref"))).otherwise(F.array(F.lit("other"))).alias("everyday"), F.lit(0).alias("ref_tags"), F.lit(0).alias("held_tags"),
        F.lit(1).alias("total_tags"), F.when(a == 1, F.lit(-1).cast("long")).otherwise(k).alias("holder"), (k % 5 == 0).alias("disjoint"), (k % 7 == 0).alias("off"), (k % 2 == 0).alias("leaf"), F.lit(False).alias("used"), F.lit(2).alias("senses"),
    )
    # Names that hold nothing aren't everyday, whatever the everyday senses are.
    out = audit.audit_flags(rows.withColumn("leaf", F.col("leaf") & (b_of(rows) != 2)))
    return out.select("name", F.array_join("flags", " ").alias("flags"), "recommendation")


def b_of(rows: DataFrame) -> Column:
    """2 for rows whose everyday senses are theirs."""
    return F.when(F.array_contains("everyday", "own"), 2).otherwise(0)


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN true WHEN o_orderkey % 7 = 1 THEN false ELSE o_orderkey % 2 = 0 AND (o_orderkey % 3 = 0 OR o_orderkey % 5 = 0) END AS accepted FROM orders")
def trial_acceptance(t: Tables) -> DataFrame:
    """A ruling decides; else a reading that is alone or sourced."""
    k = F.col("o_orderkey")
    rows = t.orders.select(k.alias("k"), F.when(k % 7 == 0, True).when(k % 7 == 1, False).alias("ruling"), (k % 2 == 0).alias("standard"), (k % 3 == 0).alias("alone"), F.when(k % 5 == 0, True).alias("sourced"))
    return audit.trial_acceptance(rows).select("k", "accepted")


@query("""WITH f AS (SELECT 'f'||s_suppkey AS name, 's'||(s_suppkey % 40) AS key FROM supplier), m AS (SELECT 'image/'||CASE p_partkey % 3 WHEN 0 THEN 'vnd.' WHEN 1 THEN 'x-' ELSE '' END||'s'||(p_partkey % 60)||'' AS media_type, 's'||(p_partkey % 60) AS key FROM part),
g AS (SELECT media_type, list_sort(list(DISTINCT name) FILTER (WHERE name IS NOT NULL)) AS n FROM m LEFT JOIN f USING (key) GROUP BY media_type) SELECT media_type, CASE WHEN len(n) = 1 THEN n[1] END AS name, CASE WHEN coalesce(len(n), 0) = 0 THEN 'unmatched' WHEN len(n) = 1 THEN 'picked' ELSE 'ambiguous' END AS route FROM g""")
def media_routes(t: Tables) -> DataFrame:
    """Types of vendors and experiments by subtype: under one format, several or none."""
    k = F.col("p_partkey")
    kind = word("image/", F.when(k % 3 == 0, "vnd.").when(k % 3 == 1, "x-").otherwise(""), "s", k % 60)
    formats = t.supplier.select(word("f", F.col("s_suppkey")).alias("name"), F.array(word("s", F.col("s_suppkey") % 40)).alias("keys"))
    return audit.media_route(t.part.select(kind.alias("media_type")), formats)


@query("""WITH o AS (SELECT 'i'||(s_suppkey % 30) AS "offset", CASE WHEN s_suppkey % 4 = 0 THEN 'core' ELSE 'p'||s_suppkey END AS owner, 's'||s_suppkey AS name FROM supplier), b AS (SELECT "offset", arg_min(owner, {'o': owner, 'n': name}) AS owner, arg_min(name, {'o': owner, 'n': name}) AS name FROM o GROUP BY "offset"),
r AS (SELECT 'i'||p_partkey AS "offset", CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '0'||p_size ELSE p_size||'' END AS code FROM part) SELECT r."offset", code, name, CASE WHEN code = '' THEN 'spread' WHEN starts_with(code, '0') THEN 'armed' WHEN owner = 'core' THEN 'core' WHEN owner IS NOT NULL THEN 'held' ELSE 'new' END AS route FROM r LEFT JOIN b USING ("offset")""")
def occupation_routes(t: Tables) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    rows = t.part.select(word("i", k).alias("offset"), F.when(k % 5 == 1, word("0", F.col("p_size"))).when(k % 5 > 1, F.col("p_size").cast("string")).alias("code"))
    owned = t.supplier.select(word("i", s % 30).alias("offset"), F.when(s % 4 == 0, "core").otherwise(word("p", s)).alias("owner"), word("s", s).alias("name"))
    return audit.occupation_route(rows, owned)


@query("SELECT DISTINCT p_name AS name FROM part WHERE p_brand != 'Brand#11' AND p_size % 4 > 1 AND p_name NOT IN (SELECT p_name FROM part WHERE p_size = 1) AND p_name NOT IN (SELECT p_name FROM part WHERE p_brand = 'Brand#11' AND p_size % 4 > 1)")
def external_names(t: Tables) -> DataFrame:
    """What sibling packs have of their own, without the base's names and this pack's."""
    origin = F.when(F.col("p_size") % 4 == 0, "base").when(F.col("p_size") % 4 == 1, "").otherwise(F.col("p_brand"))
    concepts = t.part.select(F.col("p_brand").alias("pack"), F.col("p_name").alias("name"), origin.alias("origin"))
    return votes.external_names(concepts, "Brand#11", t.part.where("p_size = 1").select(F.col("p_name").alias("name")))


@query("SELECT 'n:'||n_nationkey AS sub, 'r:'||n_regionkey AS sup, 'added' AS what FROM nation UNION ALL SELECT 'r:'||n_regionkey, 'n:'||min(n_nationkey), 'refused' FROM nation GROUP BY n_regionkey")
def guarded_links(t: Tables) -> DataFrame:
    """Links are added one after the other, and refused where they would close a loop by then."""
    rows = t.nation.orderBy("n_nationkey").collect()
    first: dict[int, int] = {}
    for r in rows:
        first.setdefault(r["n_regionkey"], r["n_nationkey"])
    wanted = [(f"n:{r['n_nationkey']}", f"r:{r['n_regionkey']}") for r in rows] + [(f"r:{a}", f"n:{b}") for a, b in first.items()]
    added, refused = graph.guarded_links({}, wanted)
    return t.spark.createDataFrame([(*x, "added") for x in added] + [(*x, "refused") for x in refused], "sub string, sup string, what string")


@query("""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), b AS (SELECT l_orderkey AS lemma, l_suppkey AS o, l_partkey AS w FROM lineitem), m AS (SELECT lemma, o, i, avg(e[i]) AS x FROM b JOIN v ON vec_id = w, range(1, 65) AS t(i) GROUP BY lemma, o, i),
s AS (SELECT m.lemma, m.o, sum(x * e[i]) / sqrt(sum(x * x) * sum(e[i] * e[i])) AS sim FROM m JOIN v ON vec_id = m.lemma GROUP BY m.lemma, m.o), c AS (SELECT *, count(*) OVER (PARTITION BY lemma) AS n, row_number() OVER (PARTITION BY lemma ORDER BY round(sim, 9) DESC, o) AS place FROM s)
SELECT lemma, o AS "offset", round(sim, 6) AS sim, CAST(place AS INTEGER) AS place FROM c WHERE n > 1""")
def first_senses(t: Tables) -> DataFrame:
    """Orders as lemmas, their suppliers as senses, their parts as words of the senses' bags: by the cosine of means."""
    bags = t.lineitem.select(F.col("l_orderkey").alias("lemma"), F.col("l_suppkey").alias("offset"), F.col("l_partkey").alias("word"))
    words = t.orders.select(F.col("o_orderkey").alias("lemma"), F.col("o_orderkey").alias("key"))
    return audit.first_senses(bags, words, t.embeddings.select(F.col("vec_id").alias("word"), F.col("embedding").alias("vector"))).withColumn("sim", F.round("sim", 6))


@query("""WITH p AS (SELECT c_custkey, row_number() OVER (ORDER BY -c_acctbal, c_custkey) - 1 AS a, row_number() OVER (ORDER BY c_nationkey, c_custkey) - 1 AS b, row_number() OVER (ORDER BY c_custkey % 7, c_custkey) - 1 AS c, count(*) OVER () - 1 AS n FROM customer)
SELECT c_custkey, round((row_number() OVER (ORDER BY (a / n + b / n + c / n) / 3, c_custkey) - 1) / n, 6) AS trap FROM p""")
def trap_score(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("lead"), (F.col("c_custkey") % 7).alias("rank"))
    return ranking.trap(rows, "c_custkey", "c_acctbal", "lead", "rank").select("c_custkey", F.round("trap", 6).alias("trap"))


@query("SELECT c_custkey, c_nationkey FROM customer")
def staged_once(t: Tables) -> DataFrame:
    """A stage that is extracted once: a second call reads what the first has written."""
    path = fresh(t, "stage")
    staged(t.spark, path, lambda: t.customer.select("c_custkey", "c_nationkey"))
    return staged(t.spark, path, lambda: t.customer.limit(0).select("c_custkey", "c_nationkey"))
