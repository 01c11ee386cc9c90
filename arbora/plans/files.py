"""Sources and sinks as queries: tables are written in each format, read back, and compared with the tables' own SQL."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.plans.queries import GEO, Tables, geo, named, query
from arbora.session import scratch_dir, written
from arbora.sources import readers, sinks


def fresh(t: Tables, name: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def lines(t: Tables, name: str, *parts: DataFrame, one: bool = False) -> str:
    """Writes text lines (value), the parts one after the other, in a file for each, or in a single one."""
    path = fresh(t, name)
    for i, p in enumerate(parts):
        (p.coalesce(1) if one else p).select("value").write.mode("append").text(path if not one else f"{path}/{i:02d}")
    return path if not one or len(parts) > 1 else f"{path}/00"


def lit_lines(t: Tables, *values: str) -> DataFrame:
    return t.spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)


def line(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]).alias("value")


# Stores.


@query(f"WITH {GEO} SELECT sub, sup FROM geo")
def file_store(t: Tables) -> DataFrame:
    """Written as a store, reduced, and read again."""
    path = fresh(t, "store")
    sinks.write_store(geo(t), path, names=t.region.select(named("r", "r_regionkey").alias("name")))
    return readers.store(t.spark, path)[1]


@query("SELECT 'r:'||r_regionkey AS name FROM region UNION SELECT 'n:'||n_nationkey FROM nation")
def file_store_names(t: Tables) -> DataFrame:
    """Names without parents have lines, too."""
    path = fresh(t, "store")
    sinks.write_store(t.nation.select(named("n", "n_nationkey").alias("sub"), named("r", "n_regionkey").alias("sup")), path, names=t.region.select(named("r", "r_regionkey").alias("name")))
    return readers.store(t.spark, path)[0]


@query("""SELECT 'n:'||n_nationkey AS sub, 'in(r:'||n_regionkey||')' AS sup FROM nation UNION ALL SELECT 'c:'||c_custkey, 'n:'||c_nationkey FROM customer UNION ALL SELECT 'in', '*'
UNION ALL SELECT 'r:'||r_regionkey, '*' FROM region""")
def file_canonical(t: Tables) -> DataFrame:
    """A canonical store: the prelude first, stubs for what terms need, glosses; its edges."""
    edges = t.nation.select(named("n", "n_nationkey").alias("sub"), line("in(r:", F.col("n_regionkey"), ")").alias("sup")).union(t.customer.select(named("c", "c_custkey"), named("n", "c_nationkey")))
    prelude = t.spark.createDataFrame([("in", None)], "sub string, sup string")
    path = fresh(t, "canonical")
    sinks.write_canonical(edges, edges.select(F.col("sub").alias("name")), glosses(t), prelude, path)
    return readers.store(t.spark, path)[1]


def glosses(t: Tables) -> DataFrame:
    return t.customer.select(named("c", "c_custkey").alias("name"), F.col("c_name").alias("gloss"), line(F.col("c_custkey"), "-n").alias("wn30"))


@query("SELECT 'c:'||c_custkey AS name, c_name AS gloss, c_custkey||'-n' AS wn30 FROM customer")
def file_canonical_meta(t: Tables) -> DataFrame:
    path = fresh(t, "canonical")
    edges = t.customer.select(named("c", "c_custkey").alias("sub"), named("n", "c_nationkey").alias("sup"))
    sinks.write_canonical(edges, edges.select(F.col("sub").alias("name")), glosses(t), t.spark.createDataFrame([], "sub string, sup string"), path)
    return readers.store(t.spark, path)[2]


# Tables.


@query("SELECT 's:'||s_suppkey AS sub, 'n:'||s_nationkey AS sup, s_name||' \"quoted\"' AS note FROM supplier")
def file_raw_table(t: Tables) -> DataFrame:
    """Tab-separated without quotes, with comments and a header."""
    head = lit_lines(t, "# a comment", "sub\tsup\tnote", "")
    path = lines(t, "raw", head, t.supplier.select(line(named("s", "s_suppkey"), "\t", named("n", "s_nationkey"), "\t", F.col("s_name"), ' "quoted"')))
    return readers.raw_table(t.spark, path, ["sub", "sup", "note"]).drop("_ord")


@query("SELECT s_name AS name, 'a \"b\" c' AS note FROM supplier")
def file_quoted_table(t: Tables) -> DataFrame:
    """CSV quotes; a comment that a spreadsheet has quoted is still one."""
    head = lit_lines(t, '"# a comment\twith tabs"', "name\tnote")
    path = lines(t, "quoted", head, t.supplier.select(line('"', F.col("s_name"), '"\t"a ""b"" c"')))
    return readers.quoted_table(t.spark, path, ["name", "note"])


@query("SELECT o_orderkey||'' AS sub, o_custkey||'' AS sup FROM orders")
def file_pairs(t: Tables) -> DataFrame:
    path = fresh(t, "pairs")
    sinks.write_pairs(t.orders.select(F.col("o_orderkey").alias("sub"), F.col("o_custkey").alias("sup")), path)
    return t.spark.read.csv(path, sep="\t", header=True, schema="sub string, sup string")


@query("SELECT 'orders' AS section, o_orderkey||'' AS sub, o_custkey||'' AS sup FROM orders UNION ALL SELECT 'customers', c_custkey||'', c_nationkey||'' FROM customer")
def file_sections(t: Tables) -> DataFrame:
    """Sections under one header, after comments, in the order that is asked for."""
    path = fresh(t, "sections")
    one = lambda df, a, b: df.select(F.col(a).cast("string").alias("sub"), F.col(b).cast("string").alias("sup"))
    sinks.write_sections([("orders", one(t.orders, "o_orderkey", "o_custkey")), ("customers", one(t.customer, "c_custkey", "c_nationkey"))], path, ["made by a query"])
    return readers.raw_table(t.spark, path, ["section", "sub", "sup"]).drop("_ord")


@query("SELECT 0 AS part, n_nationkey||'' AS value FROM nation WHERE n_nationkey < 10 UNION ALL SELECT 2, n_nationkey||'' FROM nation WHERE n_nationkey >= 15 UNION ALL SELECT 1, r_name FROM region UNION ALL SELECT 1, '# begin' UNION ALL SELECT 1, '# end'")
def file_section_replaced(t: Tables) -> DataFrame:
    """The lines between two markers are replaced, the hand-written ones around them stay."""
    key = F.col("n_nationkey")
    old = t.nation.select(key.cast("long").alias("_ord"), key.cast("string").alias("value"))
    marks = t.spark.createDataFrame([(9.5, "# begin"), (14.5, "# end")], "_ord double, value string")
    old = old.select(F.col("_ord").cast("double").alias("_ord"), "value").union(marks).select((F.col("_ord") * 2).cast("long").alias("_ord"), "value")
    new = t.region.select(F.col("r_regionkey").cast("long").alias("_ord"), F.col("r_name").alias("value"))
    return sinks.replaced_section(old, new, "# begin", "# end").select("part", "value")


@query("SELECT n_name AS value FROM nation WHERE n_nationkey > 12")
def file_kept_below(t: Tables) -> DataFrame:
    """What people wrote below the marker of a generated file."""
    rows = t.nation.select(F.when(F.col("n_nationkey") == 12, "# by hand").otherwise(F.col("n_name")).alias("value"), F.col("n_nationkey").alias("_ord"))
    return sinks.kept_below(rows, "# by hand").select("value")


@query("SELECT c_custkey, c_name, o AS orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS o FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey")
def file_columns_renewed(t: Tables) -> DataFrame:
    """A column of an earlier run is computed anew, the others stay."""
    old = t.customer.select("c_custkey", F.lit(-1).cast("long").alias("orders"), "c_name")
    return sinks.with_columns_of(old, t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders")), "c_custkey")


@query("SELECT c_custkey, c_mktsegment FROM customer UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 2 = 0")
def file_appended(t: Tables) -> DataFrame:
    """A batch of judgements is appended to a table."""
    path = fresh(t, "judged")
    rows = t.customer.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_mktsegment")
    sinks.write_pairs(rows, path)
    sinks.write_pairs(rows.where("c_custkey % 2 = 0"), path, mode="append")
    return t.spark.read.csv(path, sep="\t", header=True, schema="c_custkey long, c_mktsegment string")


@query("SELECT 'customers by c_mktsegment' AS what, c_mktsegment AS item, count(*) AS n FROM customer GROUP BY ALL UNION ALL SELECT 'customers by c_nationkey', c_nationkey||'', count(*) FROM customer GROUP BY ALL")
def file_report(t: Tables) -> DataFrame:
    return sinks.report(t.customer, "customers", ["c_mktsegment", "c_nationkey"])


@query("SELECT p_partkey, p_name FROM part")
def file_json(t: Tables) -> DataFrame:
    path = fresh(t, "json")
    sinks.write_json(t.part.select("p_partkey", "p_name"), path)
    return t.spark.read.schema("p_partkey long, p_name string").json(path)


@query("""SELECT 0 AS ord, 'digraph {' AS value UNION ALL SELECT 3, '}' UNION ALL SELECT 2, '  "n:'||n_nationkey||'" -> "r:'||n_regionkey||'";' FROM nation UNION ALL SELECT 1, '  "r:'||r_regionkey||'" [color="grey"];' FROM region""")
def file_dot(t: Tables) -> DataFrame:
    edges = t.nation.select(named("n", "n_nationkey").alias("sub"), named("r", "n_regionkey").alias("sup"))
    return sinks.dot_lines(edges, t.region.select(named("r", "r_regionkey").alias("name"), F.lit("grey").alias("colour")))


@query(f"""WITH {GEO}, c AS (SELECT sup AS name, count(*) AS n FROM geo GROUP BY sup) SELECT name, CAST(n AS BIGINT) AS cone, '{{"parents":['||coalesce('"'||(SELECT min(sup) FROM geo WHERE sub = name)||'"', '')||'],"children":["'||
(SELECT string_agg(g.sub, '","' ORDER BY coalesce(k.n, 0) DESC, g.sub) FROM geo AS g LEFT JOIN c AS k ON k.name = g.sub WHERE g.sup = c.name)||'"],"n":'||n||'}}' AS data FROM c""")
def file_atlas(t: Tables) -> DataFrame:
    """What a page shows of each name that has children, with direct children as the size."""
    edges = geo(t)
    direct = edges.groupBy(F.col("sup").alias("name")).agg(F.count("*").alias("cone"))
    sizes = edges.select(F.col("sub").alias("name")).union(edges.select("sup")).distinct().join(direct, "name", "left").na.fill(0, ["cone"])
    return sinks.atlas(edges, sizes).where("cone > 0")


# Lexical databases.

#: Parts as synsets: offset p_partkey, two lemmas, hypernym the part of half its number, an instance link for every seventh.
SYNSETS = """syn AS (SELECT p_partkey AS p, lpad(p_partkey||'', 8, '0') AS "offset", CASE WHEN p_partkey % 2 = 0 THEN 'artifact' ELSE 'quantity' END AS field, ['W'||p_partkey, 'size_'||p_size] AS lemmas,
CASE WHEN p_partkey > 1 THEN [lpad((p_partkey // 2)||'', 8, '0')] ELSE [] END AS above, p_partkey % 7 = 0 AND p_partkey > 1 AS instance, CASE WHEN p_partkey % 3 = 0 THEN ['07075172'] ELSE [] END AS usage, p_name AS gloss FROM part)"""


def synset_file(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    off = lambda c: F.lpad(c.cast("string"), 8, "0")
    link = F.when(p > 1, F.concat(F.when(p % 7 == 0, "@i ").otherwise("@ "), off(F.floor(p / 2)), F.lit(" n 0000 "))).otherwise("")
    usage = F.when(p % 3 == 0, F.lit(";u 07075172 n 0000 ")).otherwise("")
    n = (p > 1).cast("int") + (p % 3 == 0).cast("int")
    value = line(off(p), " ", F.when(p % 2 == 0, "06").otherwise("23"), " n 02 W", p, " 0 size_", F.col("p_size"), " 0 ", F.lpad(n.cast("string"), 3, "0"), " ", link, usage, "| ", F.col("p_name"), '; "an example"; "and more"')
    path = lines(t, "data", lit_lines(t, "  1 This software and database is being provided", "  2 under a license"), t.part.select(value))
    return readers.synsets(t.spark, path)


@query(f"""WITH {SYNSETS} SELECT "offset", field, array_to_string(lemmas, ' ') AS lemmas, array_to_string(above, ' ') AS above, instance, array_to_string(usage, ' ') AS usage FROM syn""")
def file_synsets(t: Tables) -> DataFrame:
    found = readers.links_of(synset_file(t))
    return found.select("offset", "field", *[F.array_join(c, " ").alias(c) for c in ("lemmas", "above")], "instance", F.array_join("usage", " ").alias("usage"))


@query(f"""WITH {SYNSETS} SELECT "offset" AS sub, above[1] AS sup FROM syn WHERE len(above) > 0 AND NOT instance""")
def file_hypernyms(t: Tables) -> DataFrame:
    return readers.hypernyms(synset_file(t))


@query(f"""WITH {SYNSETS} SELECT "offset", field, lower(array_to_string(lemmas, ' ')) AS words, array_to_string(above, ' ') AS above, gloss, 'an example and more' AS examples FROM syn""")
def file_audited(t: Tables) -> DataFrame:
    """Words in lower case, glosses without examples, examples without quotes."""
    return readers.audited(synset_file(t)).select("offset", "field", F.array_join("words", " ").alias("words"), F.array_join("above", " ").alias("above"), "gloss", "examples")


@query(f"""WITH {SYNSETS} SELECT lower(l) AS lemma, string_agg("offset", ' ' ORDER BY "offset") AS offsets FROM (SELECT unnest(lemmas) AS l, "offset" FROM syn) GROUP BY lower(l)""")
def file_lemma_index(t: Tables) -> DataFrame:
    return readers.lemma_index(synset_file(t)).select("lemma", F.array_join("offsets", " ").alias("offsets"))


@query(f"""WITH {SYNSETS} SELECT "offset" FROM syn WHERE instance""")
def file_instances(t: Tables) -> DataFrame:
    return readers.links_of(synset_file(t)).where("instance").select("offset")


@query(f"""WITH {SYNSETS} SELECT 'c:'||s_suppkey AS name, 'size '||p_size AS words FROM supplier JOIN part ON p_partkey = s_suppkey""")
def file_synonyms(t: Tables) -> DataFrame:
    """The other words of each concept's synset."""
    concepts = t.supplier.select(line("w", F.col("s_suppkey")).alias("name"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("wordnet"))
    return sinks.synonyms(concepts, synset_file(t)).select(F.concat(F.lit("c:"), F.expr("substring(name, 2)")).alias("name"), F.array_join("words", " ").alias("words"))


@query(f"""WITH {SYNSETS} SELECT 'c:'||s_suppkey AS name, 'w'||s_suppkey||' size-'||p_size AS words FROM supplier JOIN part ON p_partkey = s_suppkey""")
def file_generated_words(t: Tables) -> DataFrame:
    """What a finding aid is generated from: other words with dashes."""
    concepts = t.supplier.select(line("c:", F.col("s_suppkey")).alias("name"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("wordnet"))
    return sinks.generated_words(concepts, synset_file(t)).select("name", F.array_join("words", " ").alias("words"))


SENSES = """s AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS rank, lpad(l_partkey||'', 8, '0') AS "offset" FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey) = 1),
n AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY rank) AS rank, "offset" FROM s)"""


@query(f"""WITH {SENSES} SELECT 'w'||k AS lemma, CAST(rank AS INTEGER) AS rank, "offset" FROM n""")
def file_sense_index(t: Tables) -> DataFrame:
    """Orders as lemmas, their parts as senses, in the order of line numbers."""
    one = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    rows = one.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", F.lpad(F.col("p").cast("string"), 8, "0").alias("o")))), lambda s: s["o"]).alias("o"))
    value = line("w", F.col("l_orderkey"), " n ", F.size("o"), " 2 @ ~ ", F.size("o"), " 0 ", F.array_join("o", " "))
    return readers.sense_index(t.spark, lines(t, "index", lit_lines(t, "  1 a licence"), rows.select(value)))


@query("""SELECT 'w'||l_orderkey||'%1:0'||l_linenumber||':00::' AS sense_key, 'w'||l_orderkey AS lemma, '1' AS pos, lpad(l_partkey||'', 8, '0') AS "offset", CAST(CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE l_suppkey END AS BIGINT) AS count FROM lineitem""")
def file_sense_counts(t: Tables) -> DataFrame:
    return readers.sense_counts(t.spark, sense_key_file(t))


def sense_key_file(t: Tables) -> str:
    count = F.when(F.col("l_linenumber") % 2 == 0, "").otherwise(F.concat(F.lit(" "), F.col("l_suppkey").cast("string")))
    return lines(t, "sense", t.lineitem.select(line("w", F.col("l_orderkey"), "%1:0", F.col("l_linenumber"), ":00:: ", F.lpad(F.col("l_partkey").cast("string"), 8, "0"), " ", F.col("l_linenumber"), count)))


@query("""SELECT "offset" FROM (SELECT lpad(min(l_partkey) OVER (PARTITION BY l_orderkey)||'', 8, '0') AS "offset", l_orderkey FROM lineitem WHERE l_linenumber = 1) WHERE l_orderkey % 5 = 0""")
def file_core_senses(t: Tables) -> DataFrame:
    """A list of usual nouns by sense keys; verbs and unknown keys are left out."""
    o = F.col("l_orderkey")
    listed = t.lineitem.where("l_linenumber = 1 and l_orderkey % 5 < 2").select(line(F.when(o % 5 == 0, "n").otherwise("v"), " [w", o, "%1:01:00::] [word]"))
    path = lines(t, "core", listed, lit_lines(t, "n [nobody%1:01:00::] [nobody]", "x"))
    return readers.core_senses(t.spark, path, readers.sense_counts(t.spark, sense_key_file(t))).select("offset")


# Ontologies.


@query("SELECT DISTINCT 'P'||l_partkey AS sub, 'S'||l_suppkey AS sup FROM lineitem")
def file_kif(t: Tables) -> DataFrame:
    """Clauses at the start of a line, some over two lines; others and comments say nothing."""
    clause = t.lineitem.select(line("(subclass P", F.col("l_partkey"), F.when(F.col("l_linenumber") == 1, "\n  S").otherwise(" S"), F.col("l_suppkey"), ")"))
    return readers.kif(t.spark, lines(t, "kif", clause, t.nation.select(line("  (subclass N", F.col("n_nationkey"), " X)")), lit_lines(t, "; (subclass A B)", "(instance A B)")))


@query("""SELECT lpad(p_partkey||'', 8, '0') AS "offset", 'T'||p_size AS term, CASE WHEN p_partkey % 2 = 0 THEN '=' ELSE '+' END AS rel FROM part""")
def file_kif_mapping(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    rows = t.part.select(line(F.lpad(p.cast("string"), 8, "0"), " 06 n 01 w 0 000 | gloss &%T", F.col("p_size"), F.when(p % 2 == 0, "=").otherwise("+")))
    return readers.kif_mapping(t.spark, lines(t, "mapping", lit_lines(t, ";; &%Comment= here", "00000000 nothing"), rows))


@query("SELECT 'C_'||c_custkey AS sub, 'N_'||c_nationkey AS sup FROM customer")
def file_ntriples(t: Tables) -> DataFrame:
    pair = line("<http://x.org/C_", F.col("c_custkey"), "> <http://www.w3.org/2000/01/rdf-schema#subClassOf> <http://x.org/N_", F.col("c_nationkey"), "> .")
    other = line("<http://x.org/C_", F.col("c_custkey"), '> <http://www.w3.org/2000/01/rdf-schema#label> "x" .')
    path = fresh(t, "nt")
    t.customer.select(F.explode(F.array(pair, other)).alias("value")).write.option("compression", "gzip").text(path)
    return readers.ntriples(t.spark, path)[1]


@query("SELECT 'N'||n_nationkey AS sub, 'R'||n_regionkey AS sup FROM nation")
def file_owl(t: Tables) -> DataFrame:
    """RDF/XML classes; links to classes that aren't there are left out."""
    head = '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:owl="http://www.w3.org/2002/07/owl#">'
    regions = t.region.select(line('<owl:Class rdf:about="http://x.org/o#R', F.col("r_regionkey"), '"><rdfs:label xml:lang="en">', F.col("r_name"), "</rdfs:label></owl:Class>"))
    nations = t.nation.select(line('<owl:Class rdf:about="http://x.org/o#N', F.col("n_nationkey"), '"><rdfs:subClassOf rdf:resource="http://x.org/o#R', F.col("n_regionkey"), '"/><rdfs:subClassOf rdf:resource="http://x.org/o#Gone"/></owl:Class>'))
    whole = lit_lines(t, head).union(regions).union(nations).union(lit_lines(t, "</rdf:RDF>"))
    return readers.owl_classes(t.spark, lines(t, "owl", whole, one=True))[1]


@query("SELECT 'N'||n_nationkey AS sub, 'R'||n_regionkey AS sup FROM nation")
def file_turtle(t: Tables) -> DataFrame:
    head = lit_lines(t, "@prefix owl: <http://www.w3.org/2002/07/owl#> .", "@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .", "@prefix : <http://x.org/o#> .")
    regions = t.region.select(line(":R", F.col("r_regionkey"), ' a owl:Class ; rdfs:label "', F.col("r_name"), '"@en .'))
    nations = t.nation.select(line(":N", F.col("n_nationkey"), " a owl:Class ; rdfs:subClassOf :R", F.col("n_regionkey"), ", :Gone ."))
    return readers.owl(t.spark, lines(t, "turtle", head.union(regions).union(nations), one=True), "R0")[1]


@query("SELECT 'N'||n_nationkey AS sub, 'R'||n_regionkey AS sup FROM nation")
def file_json_ld(t: Tables) -> DataFrame:
    """Parents as an object, a list or a string."""
    node = lambda a, up: F.concat(F.lit('{"@type": "rdfs:Class", "@id": "schema:'), a, F.lit('", "rdfs:label": "x"'), up, F.lit("}"))
    ref = F.concat(F.lit('{"@id": "schema:R'), F.col("n_regionkey"), F.lit('"}'))
    k = F.col("n_nationkey") % 3
    up = F.concat(F.lit(', "rdfs:subClassOf": '), F.when(k == 0, ref).when(k == 1, F.concat(F.lit("["), ref, F.lit(', {"@id": "schema:Gone"}]'))).otherwise(F.concat(F.lit('"schema:R'), F.col("n_regionkey"), F.lit('"'))))
    nodes = t.nation.select(node(F.concat(F.lit("N"), F.col("n_nationkey")), up).alias("v")).union(t.region.select(node(F.concat(F.lit("R"), F.col("r_regionkey")), F.lit(""))))
    # Two small tables make one document.
    whole = nodes.agg(line('{"@graph": [', F.array_join(F.collect_list("v"), ", "), "]}"))
    return readers.json_ld(t.spark, lines(t, "jsonld", whole, one=True))[1]


@query("""SELECT 'n:'||n_nationkey AS sub, 'r:'||n_regionkey AS sup FROM nation WHERE n_regionkey < 4 UNION ALL SELECT 'r:'||r_regionkey, 'top' FROM region WHERE r_regionkey < 4""")
def file_graph_pulls(t: Tables) -> DataFrame:
    """Two pulls together; ends that neither has a label for are left out, roots without a parent hang below the top."""
    def pull(name: str, roots: list[str], labels: dict[str, str], edges: list[list[str]]) -> str:
        return lines(t, name, lit_lines(t, json.dumps({"roots": roots, "labels": labels, "edges": edges})), one=True)

    regions = [f"r:{r['r_regionkey']}" for r in t.region.collect()]
    nations = [(f"n:{r['n_nationkey']}", f"r:{r['n_regionkey']}") for r in t.nation.collect()]
    one = pull("pull", [r for r in regions if r != "r:4"], {r: r for r in regions if r != "r:4"}, [])
    two = pull("pull", [], {n: n for n, _ in nations}, [list(e) for e in nations])
    return readers.graph_pulls(t.spark, [one, two], "top")[1]


@query("""SELECT lpad((p_partkey % 997)||'', 8, '0') AS "offset", 'Q'||min(p_partkey) AS qid FROM part WHERE p_partkey % 997 != 3 GROUP BY p_partkey % 997""")
def file_bridge(t: Tables) -> DataFrame:
    """Ids of the newer release to those of the older: the first id that says an offset has it, unknown ones say nothing."""
    p = F.col("p_partkey")
    ids = t.part.select(line("Q", p).alias("qid"), line("9", F.lpad((p % 997).cast("string"), 7, "0"), "-n").alias("wordnet"), p.alias("ord")).union(t.part.select(line("X", p), F.lit("1-v"), F.lit(0).cast("long")))
    bridge = t.part.where("p_partkey % 997 != 3").select(line("9", F.lpad((p % 997).cast("string"), 7, "0")).alias("new"), F.lpad((p % 997).cast("string"), 8, "0").alias("offset")).distinct()
    return readers.bridged(ids, bridge)


# Product, code and registry lists.

def goods_file(t: Tables) -> str:
    """Lines in the order of brands and sizes, so that the first of a label is known."""
    brand = t.part.select(F.expr("cast(substring(p_brand, 7) as int)").alias("i"), F.col("p_size").cast("int").alias("s")).distinct()
    top = F.when(F.col("i") % 2 == 1, F.concat(F.lit("Cups"), "i", F.lit(" & Mugs"), "i")).otherwise(F.concat(F.lit("Brand"), "i"))
    rows = brand.select("i", F.lit(-1).alias("s")).distinct().union(brand).withColumn("top", top)
    value = line(F.concat(F.lit("b"), F.col("i")), F.when(F.col("s") < 0, "").otherwise(F.concat(F.lit("s"), F.col("s"))), " - ", F.col("top"), F.when(F.col("s") < 0, "").otherwise(F.concat(F.lit(" > Size"), F.col("s"))))
    return lines(t, "paths", lit_lines(t, "# version").union(rows.orderBy("i", "s").select(value)).coalesce(1), one=True)


@query("""WITH b AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS i FROM part), k AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS i, CAST(p_size AS INTEGER) AS s FROM part), f AS (SELECT s, min(i) AS i FROM k GROUP BY s)
SELECT 'b'||i AS id, CASE WHEN i % 2 = 1 THEN 'cups'||i||' & mugs'||i ELSE 'brand'||i END AS label FROM b UNION ALL SELECT 'b'||i||'a', 'cups'||i FROM b WHERE i % 2 = 1 UNION ALL SELECT 'b'||i||'b', 'mugs'||i FROM b WHERE i % 2 = 1
UNION ALL SELECT 'b'||i||'s'||s, 'size'||s FROM f UNION ALL SELECT 'root', 'root'""")
def file_taxonomy_nodes(t: Tables) -> DataFrame:
    """Paths of brands and sizes: bins stay beside their kinds, sizes of all brands are one node, the first."""
    return readers.taxonomy(t.spark, goods_file(t))[0]


@query("""WITH b AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS i FROM part), k AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS i, CAST(p_size AS INTEGER) AS s FROM part), f AS (SELECT s, min(i) AS i FROM k GROUP BY s)
SELECT 'b'||i AS sub, 'root' AS sup FROM b UNION ALL SELECT 'b'||i||x, 'root' FROM b, (VALUES ('a'), ('b')) AS v(x) WHERE i % 2 = 1 UNION ALL SELECT 'b'||f.i||'s'||f.s, 'b'||k.i FROM f JOIN k ON k.s = f.s""")
def file_taxonomy_edges(t: Tables) -> DataFrame:
    return readers.taxonomy(t.spark, goods_file(t))[1]


#: Regions and nations as codes: 0 to 4 are goods, 5 to 9 services; titles of several kinds are bins.
CODES = """c AS (SELECT r_regionkey||'' AS code, 'Tools and toys; other things' AS title FROM region UNION ALL SELECT (5 + r_regionkey)||'', 'Care and cure' FROM region UNION ALL SELECT r_regionkey||(n_nationkey % 10)||'', 'Kind '||n_nationkey FROM region JOIN nation ON n_regionkey = r_regionkey AND n_nationkey < 20
UNION ALL SELECT '53', 'Roads and rails' UNION ALL SELECT '531', 'Roads')"""


@query(f"""WITH {CODES}, d AS (SELECT DISTINCT code, title FROM c), p AS (SELECT code, title, CASE WHEN length(code) = 1 THEN CASE WHEN code >= '5' THEN 'services' ELSE 'goods' END WHEN code = '53' THEN 'goods' ELSE code[:-2] END AS parent FROM d)
SELECT code AS sub, parent AS sup FROM p UNION ALL SELECT code||x, parent FROM p, (VALUES ('a'), ('b')) AS v(x) WHERE code IN (SELECT parent FROM p) AND (code < '5' OR code = '53') AND length(code) < 3 AND (length(code) = 1 OR code = '53') UNION ALL SELECT 'services', 'root' UNION ALL SELECT 'goods', 'root'""")
def file_product_codes(t: Tables) -> DataFrame:
    q = t.region.join(t.nation.where("n_nationkey < 20"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.region.select(F.col("r_regionkey").cast("string").alias("c"), F.lit("Tools and toys; other things").alias("x")).union(t.region.select((F.col("r_regionkey") + 5).cast("string"), F.lit("Care and cure")))
    rows = rows.union(q.select(line(F.col("r_regionkey"), F.col("n_nationkey") % 10), line("Kind ", F.col("n_nationkey")))).union(t.spark.createDataFrame([("53", "Roads and rails"), ("531", "Roads")], "c string, x string")).distinct()
    path = fresh(t, "codes")
    rows.select(F.col("c").alias("Code"), F.col("x").alias("Title")).coalesce(1).write.csv(path, header=True, encoding="ISO-8859-1")
    return readers.product_codes(t.spark, path)[1]


@query("""SELECT lpad(n_regionkey||'', 1, '0') AS code, 'region '||n_regionkey AS title FROM nation GROUP BY n_regionkey UNION ALL SELECT lpad(n_nationkey||'', 2, '0'), n_name FROM nation""")
def file_level_list(t: Tables) -> DataFrame:
    """A wide table of two levels; codes lose their zeros in the file and get them back; other versions are left out."""
    path = fresh(t, "levels")
    rows = t.nation.select(F.lit("08").alias("version"), F.col("n_regionkey").alias("major"), line("region ", F.col("n_regionkey")).alias("major_label"), F.col("n_nationkey").alias("minor"), F.col("n_name").alias("minor_label"))
    rows.union(rows.select(F.lit("88"), F.lit(7), F.lit("old"), F.lit(77), F.lit("old"))).write.csv(path, header=True)
    return readers.level_list(t.spark, path, [("major", "major_label", 1), ("minor", "minor_label", 2)], F.col("version") == "08")


@query("SELECT 'image/Type-'||p_partkey AS media_type, 'image' AS top, p_partkey % 10 = 0 AS dead FROM part WHERE p_partkey % 3 != 0")
def file_registry(t: Tables) -> DataFrame:
    """Templates as they are spelt; rows without one are placeholders; a top type whose file is missing is left out."""
    folder, p = fresh(t, "registry"), F.col("p_partkey")
    rows = t.part.select(F.when(p % 10 == 0, F.concat(F.lit("t"), p, F.lit(" - DEPRECATED, see x"))).otherwise(F.concat(F.lit("t"), p)).alias("Name"), F.when(p % 3 == 0, F.when(p % 2 == 0, "").otherwise("none")).otherwise(F.concat(F.lit("image/Type-"), p)).alias("Template"))
    rows.write.csv(f"{folder}/image.csv", header=True, emptyValue="")
    return readers.registry(t.spark, folder, ["image", "audio"])


# Selections, snapshots and pulls.


@query("SELECT 's:'||s_suppkey AS name FROM supplier")
def file_roots(t: Tables) -> DataFrame:
    return readers.roots(t.spark, lines(t, "roots", lit_lines(t, "# roots", "", "  "), t.supplier.select(line(named("s", "s_suppkey"), F.when(F.col("s_suppkey") % 2 == 0, "  # why").otherwise("")))))


@query("SELECT 's:'||s_suppkey AS name, CAST(s_nationkey % 4 AS INTEGER) AS depth FROM supplier")
def file_roots_with_depth(t: Tables) -> DataFrame:
    return readers.roots_with_depth(t.spark, lines(t, "roots", lit_lines(t, "# roots"), t.supplier.select(line(named("s", "s_suppkey"), "\t", F.col("s_nationkey") % 4)))).drop("_ord")


@query("SELECT n_name AS value FROM nation WHERE n_nationkey < 20")
def file_snapshot(t: Tables) -> DataFrame:
    """A file as it was at an earlier snapshot."""
    root = fresh(t, "snapshots")
    for name, rows in (("a1", t.nation.where("n_nationkey < 20")), ("b2", t.nation)):
        rows.select(F.col("n_name").alias("value")).write.text(f"{root}/{name}/names")
    return readers.at_snapshot(t.spark, root, "a1", "names")


@query("""WITH c AS (SELECT s_suppkey AS k, 'name'||s_suppkey AS name, s_suppkey // 2 AS o FROM supplier), f AS (SELECT o, arg_min(name, k) AS now FROM c GROUP BY o)
SELECT CASE WHEN n_nationkey % 3 = 0 OR a.now IS NULL THEN 'old'||n_nationkey ELSE a.now END AS sub, coalesce(b.now, 'above') AS sup, 'accept' AS decision, '' AS reason, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE n_nationkey||'' END AS sub_wn, n_regionkey||'' AS sup_wn
FROM nation LEFT JOIN f AS a ON a.o = n_nationkey LEFT JOIN f AS b ON b.o = n_regionkey""")
def file_resolved_reviews(t: Tables) -> DataFrame:
    """Names are bound anew by the recorded offset, to the first concept that has it; rows are padded."""
    k = F.col("n_nationkey")
    reviews = t.nation.select(line(" old", k).alias("sub"), F.lit("above").alias("sup"), F.lit("accept ").alias("decision"), F.lit(None).cast("string").alias("reason"), F.when(k % 3 != 0, k.cast("string")).alias("sub_wn"), F.col("n_regionkey").cast("string").alias("sup_wn"))
    concepts = t.supplier.select(line("name", F.col("s_suppkey")).alias("name"), F.floor(F.col("s_suppkey") / 2).cast("string").alias("wordnet"), F.col("s_suppkey").alias("_ord"))
    return readers.resolved_reviews(reviews, concepts)


@query("SELECT vec_id||'' AS word, round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) / (sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) + 1e-9), 4) AS size FROM embeddings")
def file_vectors(t: Tables) -> DataFrame:
    """A text file of vectors, read as unit vectors."""
    path = lines(t, "vectors", t.embeddings.select(line(F.col("vec_id"), " ", F.array_join(F.transform("embedding", lambda x: x.cast("string")), " "))))
    size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return readers.vectors(t.spark, path, normalised=True).select("word", F.round(size, 4).alias("size"))


@query("""WITH s AS (SELECT p_partkey AS p FROM part), x AS (SELECT p, 0 AS ord FROM s WHERE p % 9 = 1 UNION ALL SELECT p, 1 FROM s WHERE p // 2 = 5 UNION ALL SELECT p, 2 FROM s WHERE p IN (7, 14, 15, 28, 29, 30, 31) OR (p BETWEEN 56 AND 63) OR (p BETWEEN 112 AND 127) OR (p BETWEEN 224 AND 255) OR (p BETWEEN 448 AND 511) OR (p BETWEEN 896 AND 1023)
OR (p BETWEEN 1792 AND 2047) OR (p BETWEEN 3584 AND 4095) OR (p BETWEEN 7168 AND 8191) OR (p BETWEEN 14336 AND 16383) UNION ALL SELECT p, 3 FROM s WHERE p = 11) SELECT p AS "offset", CAST(min(ord) AS INTEGER) AS ord FROM x GROUP BY p""")
def file_selected(t: Tables) -> DataFrame:
    """A pack's selection: a topic, the children of 5, the cone of 7 and the synset 11, each once, by the first that selects it."""
    from arbora.operators import graph

    p = F.col("p_partkey")
    pointer = F.when(p % 9 == 1, F.array(F.struct(F.lit(";c").alias("sym"), F.lit("0").alias("target")))).otherwise(F.array().cast("array<struct<sym:string,target:string>>"))
    synset = t.part.select(p.cast("string").alias("offset"), pointer.alias("pointers"))
    up = t.part.where("p_partkey > 1").select(p.cast("string").alias("sub"), F.floor(p / 2).cast("string").alias("sup"))
    spec = t.spark.createDataFrame([("topic", "0", 0), ("children", "5", 1), ("cone", "7", 2), ("synset", "11", 3), ("synset", "none", 4)], "kind string, offset string, ord int")
    return readers.selected(spec, synset, up, graph.closure(up)).select(F.col("offset").cast("long").alias("offset"), "ord")


@query("SELECT c_custkey AS item, 'Q'||c_nationkey AS kind FROM customer WHERE c_custkey IN (SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer WHERE c_nationkey < 5) WHERE k <= 3) UNION SELECT c_custkey, 'S'||c_mktsegment FROM customer WHERE c_custkey IN (SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer WHERE c_nationkey < 5) WHERE k <= 3)")
def pull_instances(t: Tables) -> DataFrame:
    """Of each wanted class its first items, with all classes of theirs."""
    links = t.customer.select(F.col("c_custkey").alias("item"), line("Q", F.col("c_nationkey")).alias("kind")).union(t.customer.select("c_custkey", line("S", F.col("c_mktsegment"))))
    return readers.instances_of(t.nation.where("n_nationkey < 5").select(line("Q", F.col("n_nationkey")).alias("kind")), links, 3)


@query("""WITH f AS (SELECT p_name, p_partkey, row_number() OVER (PARTITION BY p_name ORDER BY 'Q'||lpad(p_partkey||'', 9, '0')) AS k FROM part WHERE p_size % 6 != 1), w AS (SELECT DISTINCT p_name FROM part)
SELECT w.p_name AS label, coalesce(string_agg('Q'||lpad(p_partkey||'', 9, '0'), ' ' ORDER BY p_partkey), '') AS qids FROM w LEFT JOIN f ON f.p_name = w.p_name AND k <= 6 GROUP BY w.p_name""")
def pull_labels_looked_up(t: Tables) -> DataFrame:
    """Entities by label, six at most, without those of unwanted kinds."""
    qid = F.concat(F.lit("Q"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    entities = t.part.select(qid.alias("qid"), F.col("p_name").alias("label"))
    kinds = t.part.select(qid.alias("qid"), (F.col("p_size") % 6).cast("string").alias("kind"))
    return readers.looked_up(t.part.select(F.col("p_name").alias("label")), entities, kinds, ["1"]).select("label", F.array_join("qids", " ").alias("qids"))


@query("SELECT user_id||'' AS qid, coalesce(arg_max(event_type, event_id) FILTER (WHERE event_type != 'error'), user_id||'') AS label FROM events GROUP BY user_id")
def pull_first_labels(t: Tables) -> DataFrame:
    """The last label that a pull told, else the id."""
    return readers.first_labels(t.events.select(F.col("user_id").cast("string").alias("qid"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("label"), F.col("event_id").alias("ord")))


@query("SELECT lpad(p_partkey||'', 8, '0') AS id, p_name AS label FROM part")
def pull_by_prefix(t: Tables) -> DataFrame:
    """Answers of a source that is asked for ranges of ids, from a folder of recorded answers."""
    recorded = fresh(t, "answers")
    rows = t.part.select(F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("id"), F.col("p_name").alias("label"))
    rows.withColumn("p", F.concat(F.lit("p"), F.substring("id", 7, 1))).write.partitionBy("p").parquet(recorded)
    # The answers are recorded by prefix; asking is a lookup in them, by the workers.
    chunks = readers.by_prefix([f"p{i}" for i in range(10)], t.spark)
    return readers.pulled(chunks, recorded_by(recorded), "id string, label string")


def recorded_by(folder: str) -> Callable[[list[str]], list[tuple]]:
    """A source that answers a prefix with what is recorded of it."""

    def ask(values: list[str]) -> list[tuple]:
        system, path = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
        there = [f"{path}/p={v}" for v in values if system.get_file_info(f"{path}/p={v}").type == pafs.FileType.Directory]
        told = [pads.dataset(p, filesystem=system).to_table(columns=["id", "label"]) for p in there]
        return [row for x in told for row in zip(x["id"].to_pylist(), x["label"].to_pylist(), strict=True)]

    return ask


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS label FROM part")
def pull_in_chunks(t: Tables) -> DataFrame:
    """Labels of ids, asked for a hundred at a time."""
    chunks = readers.chunked(t.part.select(F.col("p_partkey").cast("string").alias("id")), "id", 100)
    asked = readers.pulled(chunks, lambda values: [(v,) for v in values], "id string")
    return asked.join(t.part.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("label")), "id")
