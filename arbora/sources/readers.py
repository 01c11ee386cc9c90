"""Readers of taxonomies, each into nodes (id, label) and edges (sub, sup), or the relation it names.

All of them are plans over Spark's own text, CSV, JSON and XML sources; only shell-quoted store lines need a UDF.
"""

from __future__ import annotations

import io
import re
import shlex
import time
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arbora.functions import text
from arbora.session import written

ORD = "_ord"
RDF, RDFS, OWL = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2000/01/rdf-schema#", "http://www.w3.org/2002/07/owl#"


def lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, value) of a text file in any encoding: the text source knows only UTF-8."""
    if encoding.upper() in ("UTF-8", "UTF8"):
        return spark.read.text(path).select(F.input_file_name().alias("file"), "value")
    return spark.read.schema("value string").csv(path, sep="\u0001", encoding=encoding, quote="", ignoreLeadingWhiteSpace=False).select(F.input_file_name().alias("file"), F.coalesce("value", F.lit("")).alias("value"))


# Stores: a name and its parents on each line, shell-quoted.


#: Without quotes shlex parts lines at these blanks, and does nothing else.
BLANKS, QUOTES = re.compile("[ \t\r\n]+"), re.compile("['\"\\\\]")


def _split_quoted(line: str) -> list[str]:
    if not QUOTES.search(line):
        return [f for f in BLANKS.split(line) if f]
    try:
        return shlex.split(line, comments=False)
    except ValueError:
        return line.split()


def _quoted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(_split_quoted)


def store(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A store file -> nodes (name), edges (sub, sup; top-level ones have `*`), meta (name, gloss, wn30).

    `#` lines are comments, but `#:meta name {json}` lines describe a name.
    """
    told = lines(spark, path).select("value").where(F.trim("value") != "")
    fields = F.pandas_udf(_quoted, "array<string>")
    entries = told.where(~F.col("value").startswith("#")).select(fields("value").alias("f"))
    nodes = entries.select(F.col("f")[0].alias("name")).distinct()
    edges = entries.select(F.col("f")[0].alias("sub"), F.explode(F.slice("f", F.lit(2), F.greatest(F.size("f") - 1, F.lit(0)))).alias("sup")).distinct()
    about = told.where(F.col("value").startswith("#:meta ")).select(fields(F.expr("substring(value, 8)")).alias("f"))
    meta = about.select(F.col("f")[0].alias("name"), F.from_json(F.col("f")[1], "gloss string, wn30 string").alias("m")).select("name", "m.gloss", "m.wn30")
    return nodes, edges, meta


# Tables with tabs, in two dialects.


def quoted_table(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> DataFrame:
    """Tab-separated with CSV quotes; comment lines may themselves be quoted by a spreadsheet."""
    kept = spark.read.text(path).where(~F.col("value").rlike('^"?#') & (F.trim("value") != ""))
    schema = ", ".join(f"`{c}` string" for c in columns)
    out = kept.select(F.from_csv("value", schema, {"sep": "\t", "escape": '"'}).alias("r")).select("r.*")
    return out.where(~F.col(columns[0]).eqNullSafe(F.lit(columns[0]))) if header else out


def raw_table(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> DataFrame:
    """Tab-separated without quotes, short rows padded with null, with _ord: a number that grows with the file's lines."""
    kept = spark.read.text(path).select("value", F.monotonically_increasing_id().alias(ORD)).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    parts = F.split("value", "\t")
    out = kept.select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)], ORD)
    return out.where(~F.col(columns[0]).eqNullSafe(F.lit(columns[0]))) if header else out


def resolved_reviews(reviews: DataFrame, concepts: DataFrame) -> DataFrame:
    """reviews (sub, sup, decision, reason, sub_wn, sup_wn; those at the end may be missing) with names bound anew by offset, to
    the first concept that has it: concepts (name, wordnet, _ord)."""
    first = concepts.where("wordnet is not null and wordnet != ''").groupBy("wordnet").agg(F.min_by("name", ORD).alias("now"))
    out = reviews
    for column in ("sub", "sup", "decision", "reason", "sub_wn", "sup_wn"):
        out = out.withColumn(column, F.trim(F.coalesce(F.col(column), F.lit(""))) if column in reviews.columns else F.lit(""))
    for end in ("sub", "sup"):
        out = out.join(first.select(F.col("wordnet").alias(f"{end}_wn"), F.col("now").alias(f"{end}_now")), f"{end}_wn", "left").withColumn(end, F.coalesce(f"{end}_now", end)).drop(f"{end}_now")
    return out.select(*reviews.columns, *[c for c in ("decision", "reason", "sub_wn", "sup_wn") if c not in reviews.columns])


def roots(spark: SparkSession, path: str) -> DataFrame:
    """One name a line, without comments -> (name)."""
    name = F.trim(F.substring_index("value", "#", 1))
    return spark.read.text(path).select(name.alias("name")).where("name != ''")


def roots_with_depth(spark: SparkSession, path: str) -> DataFrame:
    """Lines of an id and a depth -> (name, depth, _ord)."""
    return raw_table(spark, path, ["name", "depth"], header=False).select(F.trim("name").alias("name"), F.trim("depth").cast("int").alias("depth"), ORD)


def at_snapshot(spark: SparkSession, root: str, snapshot: str, name: str) -> DataFrame:
    """The lines (value) of a file as it was at a snapshot, a folder below root that is never changed."""
    return spark.read.text(f"{root.rstrip('/')}/{snapshot}/{name}")


# Lexical databases.


def synsets(spark: SparkSession, path: str) -> DataFrame:
    """data.noun -> (offset, field, lemmas, pointers: [(sym, target, pos)], gloss)."""
    told = lines(spark, path, "ISO-8859-1").where(~F.col("value").startswith("  ") & (F.trim("value") != ""))
    f = F.split(F.trim(F.substring_index("value", "|", 1)), r"\s+")
    words = F.conv(f[3], 16, 10).cast("int")
    told = told.select(f.alias("f"), words.alias("w"), F.trim(F.expr("substring(value, instr(value, '|') + 1)")).alias("gloss"))
    # Four fields for each pointer, after the words and the number of pointers.
    at = F.col("w") * 2 + 4
    n = F.get("f", at).cast("int")
    place = lambda i, k: F.get("f", at + 1 + i * 4 + k)
    pointers = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(place(i, 0).alias("sym"), place(i, 1).alias("target"), place(i, 2).alias("pos"))))
    lemmas = F.transform(F.sequence(F.lit(0), F.col("w") - 1), lambda i: F.get("f", i * 2 + 4))
    return told.select(F.col("f")[0].alias("offset"), text.lexfile_name(F.col("f")[1]).alias("field"), lemmas.alias("lemmas"), F.coalesce(pointers, F.array().cast("array<struct<sym:string,target:string,pos:string>>")).alias("pointers"), "gloss")


def links_of(found: DataFrame) -> DataFrame:
    """synsets() with what its pointers say: above (targets of @ and @i), instance, usage (;u) and topics (;c)."""
    targets = lambda *syms: F.transform(F.filter("pointers", lambda p: p["sym"].isin(*syms)), lambda p: p["target"])
    up = F.filter("pointers", lambda p: p["sym"].isin("@", "@i") & (p["pos"] == "n"))
    return found.select("*", F.transform(up, lambda p: p["target"]).alias("above"), F.exists(up, lambda p: p["sym"] == "@i").alias("instance"), targets(";u").alias("usage"), targets(";c").alias("topics"))


def audited(found: DataFrame, width: int | None = None) -> DataFrame:
    """(offset, field, words in lower case, above, gloss without examples, examples)."""
    parts = F.transform(F.split("gloss", "; "), lambda x: F.trim(x))
    examples = F.array_join(F.transform(F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x.startswith('"')), lambda x: F.trim(x, F.lit('"'))), " ")
    return links_of(found).select("offset", "field", F.transform("lemmas", lambda w: F.lower(w)).alias("words"), "above", text.gloss_head(F.col("gloss"), width).alias("gloss"), examples.alias("examples"))


def lemma_index(found: DataFrame) -> DataFrame:
    """(lemma in lower case, offsets in the order of the file, which is that of offsets)."""
    return found.select(F.explode("lemmas").alias("l"), "offset").groupBy(F.lower("l").alias("lemma")).agg(F.array_sort(F.collect_list("offset")).alias("offsets"))


def core_senses(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Lines `n [key] ...` and keys (sense_key, offset) -> (offset, _ord): the usual nouns, in the order of the file."""
    f = F.split(F.trim("value"), r"\s+")
    told = spark.read.text(path).select(f.alias("f"), F.monotonically_increasing_id().alias(ORD)).where((F.size("f") > 1) & (F.col("f")[0] == "n"))
    return told.select(F.regexp_replace(F.col("f")[1], r"[\[\]]", "").alias("sense_key"), ORD).join(keys.groupBy("sense_key").agg(F.min("offset").alias("offset")), "sense_key").select("offset", ORD)


def bridged(ids: DataFrame, bridge: DataFrame) -> DataFrame:
    """ids (qid, wordnet: `offset-n` of the newer release, ord), bridge (new, offset) -> (offset, qid): the first id that says an
    offset has it."""
    told = ids.where(F.col("wordnet").endswith("-n")).select("qid", "ord", F.regexp_replace("wordnet", "-n$", "").alias("new"))
    return told.join(bridge, "new").groupBy("offset").agg(F.min_by("qid", F.struct("ord", "new")).alias("qid"))


def hypernyms(found: DataFrame, instances: bool = False) -> DataFrame:
    """Edges of noun pointers `@`; instance links `@i` only if wanted."""
    syms = ["@", "@i"] if instances else ["@"]
    return found.select("offset", F.explode("pointers").alias("p")).where(F.col("p.sym").isin(*syms) & (F.col("p.pos") == "n")).select(F.col("offset").alias("sub"), F.col("p.target").alias("sup"))


def sense_index(spark: SparkSession, path: str) -> DataFrame:
    """index.noun -> (lemma, rank from 1, offset)."""
    f = F.split(F.trim("value"), r"\s+")
    told = lines(spark, path, "ISO-8859-1").where(~F.col("value").startswith("  ") & (F.trim("value") != "")).select(f.alias("f"))
    n, pointers = F.col("f")[2].cast("int"), F.col("f")[3].cast("int")
    return told.select(F.col("f")[0].alias("lemma"), F.posexplode(F.slice("f", pointers + 7, n)).alias("i", "offset")).select("lemma", (F.col("i") + 1).alias("rank"), "offset")


def sense_counts(spark: SparkSession, path: str) -> DataFrame:
    """index.sense -> (sense_key, lemma, pos, offset, count)."""
    f = F.split(F.trim("value"), r"\s+")
    told = lines(spark, path).where(F.trim("value") != "").select(f.alias("f"))
    sense = F.col("f")[0]
    return told.select(sense.alias("sense_key"), F.split_part(sense, F.lit("%"), F.lit(1)).alias("lemma"), F.substring(F.split_part(sense, F.lit("%"), F.lit(2)), 1, 1).alias("pos"), F.col("f")[1].alias("offset"), F.coalesce(F.get("f", F.lit(3)).cast("long"), F.lit(0)).alias("count"))


# Ontologies.


def kif(spark: SparkSession, path: str) -> DataFrame:
    """Edges of `(subclass A B)` at the start of a line, which may go on over lines."""
    whole = spark.read.text(path, wholetext=True)
    pair = r"(?m)^\(subclass\s+([A-Za-z0-9_-]+)\s+([A-Za-z0-9_-]+)\)"
    found = F.arrays_zip(F.regexp_extract_all("value", F.lit(pair), F.lit(1)).alias("a"), F.regexp_extract_all("value", F.lit(pair), F.lit(2)).alias("b"))
    return whole.select(F.explode(found).alias("x")).select(F.col("x.a").alias("sub"), F.col("x.b").alias("sup")).distinct()


def kif_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Synset lines with `&%Term=` -> (offset, term, rel); `;` lines are comments."""
    told = lines(spark, path, "ISO-8859-1").where(~F.col("value").startswith(";"))
    part = lambda i: F.regexp_extract("value", r"&%([A-Za-z0-9_-]+)([=+@:\[\]])", i)
    return told.select(F.substring_index("value", " ", 1).alias("offset"), part(1).alias("term"), part(2).alias("rel")).where("term != ''")


def ntriples(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """N-Triples, plain or gzipped -> nodes (id, label), edges of rdfs:subClassOf by local names."""
    pair = r"^<([^>]+)>\s+<http://www\.w3\.org/2000/01/rdf-schema#subClassOf>\s+<([^>]+)>"
    edges = spark.read.text(path).select(F.regexp_extract("value", pair, 1).alias("a"), F.regexp_extract("value", pair, 2).alias("b")).where("a != ''").select(text.local_name(F.col("a")).alias("sub"), text.local_name(F.col("b")).alias("sup")).distinct()
    nodes = edges.select(F.col("sub").alias("id")).union(edges.select("sup")).distinct().select("id", F.translate("id", "_", " ").alias("label"))
    return nodes, edges


def owl_classes(spark: SparkSession, path: str, row_tag: str = "owl:Class") -> tuple[DataFrame, DataFrame]:
    """RDF/XML classes -> nodes (id, label), edges to classes that are there; parents named, or in an intersection."""
    link = "STRUCT<`_rdf:resource`: STRING, `owl:Class`: STRUCT<`owl:intersectionOf`: STRUCT<`rdf:Description`: ARRAY<STRUCT<`_rdf:about`: STRING>>, `owl:Class`: ARRAY<STRUCT<`_rdf:about`: STRING>>>>>"
    schema = f"`_rdf:about` STRING, `rdfs:label` ARRAY<STRUCT<_VALUE: STRING, `_xml:lang`: STRING>>, `rdfs:subClassOf` ARRAY<{link}>, `owl:equivalentClass` ARRAY<{link}>"
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path).where("`_rdf:about` is not null")
    label = F.array_min(F.transform("`rdfs:label`", lambda x: F.struct(F.when(x["_xml:lang"] == "en", 0).when(x["_xml:lang"].isNull(), 1).otherwise(2).alias("o"), x["_VALUE"].alias("v"))))["v"]
    told = rows.select(text.local_name(F.col("`_rdf:about`")).alias("id"), label.alias("label"), F.flatten(F.array(*[F.coalesce(c, F.array()) for c in ("`rdfs:subClassOf`", "`owl:equivalentClass`")])).alias("up"))
    own = told.select("id", F.explode("up").alias("u"))
    listed = "u.`owl:Class`.`owl:intersectionOf`.`{}`"
    members = [own.select("id", F.explode(listed.format(kind)).alias("d")).select("id", F.col("d").getField("_rdf:about").alias("to")) for kind in ("rdf:Description", "owl:Class")]
    named = own.select("id", F.col("u").getField("_rdf:resource").alias("to")).union(members[0]).union(members[1]).where("to is not null and to != ''").select(F.col("id").alias("sub"), text.local_name(F.col("to")).alias("sup"))
    nodes = told.groupBy("id").agg(F.min("label").alias("label")).select("id", F.coalesce("label", "id").alias("label"))
    return nodes, named.join(nodes.select(F.col("id").alias("sup")), "sup", "left_semi").select("sub", "sup").distinct()


_TURTLE = re.compile(r'''"""(?:[^"\\]|\\.|"(?!""))*"""(?:@[\w-]+|\^\^\S+)?|"(?:[^"\\\n]|\\.)*"(?:@[\w-]+|\^\^\S+)?|<[^<>\s]*>|#[^\n]*|[\[\]();,]|\.(?=\s|$)|[^\s\[\]();,"<>#]+?(?=\.?(?:[\s\[\]();,"<>#]|$))''', re.S)


class _Turtle:
    """Statements of one Turtle document as triples; blank nodes and lists get names of their own."""

    def __init__(self, document: str):
        self.tokens = [t for t in _TURTLE.findall(document) if not t.startswith("#")]
        self.at, self.blanks, self.base = 0, 0, ""
        self.prefixes: dict[str, str] = {}
        self.triples: list[tuple[str, str, str]] = []

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1] if self.at <= len(self.tokens) else "."

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else "."

    def blank(self) -> str:
        self.blanks += 1
        return f"_:{self.blanks}"

    def full(self, token: str) -> str:
        if token.startswith("<"):
            iri = token[1:-1]
            return iri if ":" in iri else self.base + iri
        if token.startswith(('"', "_:")):
            return token
        if token == "a":
            return RDF + "type"
        prefix, colon, rest = token.partition(":")
        return self.prefixes.get(prefix, prefix + colon) + rest if colon else token

    def node(self) -> str:
        token = self.take()
        if token == "[":
            name = self.blank()
            self.about(name)
            self.take()
            return name
        if token == "(":
            items = []
            while self.peek() != ")" and self.at < len(self.tokens):
                items.append(self.node())
            self.take()
            name = self.blank()
            self.triples += [(name, "item", i) for i in items]
            return name
        return self.full(token)

    def about(self, subject: str) -> None:
        while self.peek() not in (".", "]"):
            predicate = self.full(self.take())
            while True:
                self.triples.append((subject, predicate, self.node()))
                if self.peek() != ",":
                    break
                self.take()
            while self.peek() == ";":
                self.take()

    def read(self) -> list[tuple[str, str, str]]:
        while self.at < len(self.tokens):
            word = self.peek().lower()
            if word in ("@prefix", "prefix"):
                self.take()
                prefix, iri = self.take(), self.take()
                self.prefixes[prefix.rstrip(":")] = iri[1:-1] if ":" in iri else self.base + iri[1:-1]
            elif word in ("@base", "base"):
                self.take()
                self.base = self.take()[1:-1]
            else:
                self.about(self.node())
            if self.peek() == ".":
                self.take()
        return self.triples


def _triples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for document in b["value"]:
            yield pd.DataFrame(_Turtle(document).read(), columns=["s", "p", "o"], dtype="object")


def turtle(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Turtle classes -> nodes (id, label), edges to classes that are there; parents named, or in an intersection.

    A document is read by one task (its blank nodes have no names elsewhere); several documents are read in parallel.
    """
    files = spark.read.text(path, wholetext=True).select("value")
    triples = files.mapInPandas(_triples, "s string, p string, o string")
    found = written(triples, "triples")
    of = lambda p: found.where(F.col("p") == p).select("s", "o")
    classes = of(RDF + "type").where((F.col("o") == OWL + "Class") & ~F.col("s").startswith("_:")).select("s").distinct()
    language = F.regexp_extract("o", r'"@([\w-]+)$', 1)
    labels = of(RDFS + "label").select("s", F.when(language == "en", 0).when(language == "", 1).otherwise(2).alias("rank"), F.regexp_extract("o", r'(?s)^"+(.*?)"+(?:@[\w-]+|\^\^\S+)?$', 1).alias("label"))
    nodes = classes.join(labels.groupBy("s").agg(F.min(F.struct("rank", "label")).getField("label").alias("label")), "s", "left")
    up = of(RDFS + "subClassOf").union(of(OWL + "equivalentClass"))
    inside = of(OWL + "intersectionOf").withColumnsRenamed({"s": "b", "o": "l"}).join(of("item").withColumnsRenamed({"s": "l", "o": "m"}), "l").select("b", "m")
    reached = up.union(up.join(inside, up["o"] == inside["b"]).select("s", F.col("m").alias("o")))
    edges = reached.join(classes, "s", "left_semi").join(classes.select(F.col("s").alias("o")), "o", "left_semi")
    local = lambda c: text.local_name(F.col(c))
    return nodes.select(local("s").alias("id"), F.coalesce("label", local("s")).alias("label")), edges.select(local("s").alias("sub"), local("o").alias("sup")).where("sub != sup").distinct()


def owl(spark: SparkSession, path: str, root: str) -> tuple[DataFrame, DataFrame]:
    """owl_classes() or turtle(), by how the file begins; a root that isn't there is an error."""
    head = spark.read.text(path).where("trim(value) != ''").first()
    nodes, edges = (turtle if head and head["value"].lstrip().lower().startswith(("@prefix", "@base", "prefix ")) else owl_classes)(spark, path)
    if nodes.where(F.col("id") == root).isEmpty():
        raise ValueError(f"{root} isn't among the classes of {path}")
    return nodes, edges


def json_ld(spark: SparkSession, path: str, prefix: str = "schema:") -> tuple[DataFrame, DataFrame]:
    """A JSON-LD graph of rdfs:Class -> nodes, edges.  A label or a parent may be a string, an object or a list."""
    whole = spark.read.text(path, wholetext=True)
    graph = whole.select(F.explode(F.from_json(F.get_json_object("value", "$['@graph']"), "array<string>")).alias("n"))
    at = lambda p: F.get_json_object("n", p)
    rows = graph.where(at("$['@type']").contains("rdfs:Class") & at("$['@id']").startswith(prefix))
    name = lambda c: F.regexp_replace(c, f"^{prefix}", "")
    label = F.coalesce(at("$['rdfs:label']['@value']"), at("$['rdfs:label']"))
    up = at("$['rdfs:subClassOf']")
    ids = F.regexp_extract_all(F.coalesce(up, F.lit("")), F.lit('"@id"\\s*:\\s*"([^"]+)"'), F.lit(1))
    ids = F.when(up.isNotNull() & ~up.startswith("{") & ~up.startswith("["), F.array(up)).otherwise(ids)
    nodes = rows.select(name(at("$['@id']")).alias("id"), label.alias("label"))
    edges = rows.select(name(at("$['@id']")).alias("sub"), F.explode(ids).alias("to")).select("sub", name(F.col("to")).alias("sup"))
    return nodes, edges.join(nodes.select(F.col("id").alias("sup")), "sup", "left_semi").select("sub", "sup").distinct()


def graph_pulls(spark: SparkSession, paths: list[str], top: str) -> tuple[DataFrame, DataFrame]:
    """JSON pulls {roots, labels, edges} together: later labels win, edges need both ends, roots without a parent hang
    below `top`."""
    labels = edges = roots = None
    for i, path in enumerate(paths):
        rows = spark.read.schema("roots array<string>, labels map<string,string>, edges array<array<string>>").json(path, multiLine=True)
        own = rows.select(F.explode("labels").alias("id", "label"), F.lit(i).alias("i"))
        ties = rows.select(F.explode("edges").alias("e")).select(F.col("e")[0].alias("sub"), F.col("e")[1].alias("sup"))
        tops = rows.select(F.explode("roots").alias("id"))
        labels, edges, roots = (own, ties, tops) if labels is None else (labels.union(own), edges.union(ties), roots.union(tops))
    nodes = labels.groupBy("id").agg(F.max_by("label", "i").alias("label"))
    for end in ("sub", "sup"):
        edges = edges.join(nodes.select(F.col("id").alias(end)), end, "left_semi")
    edges = edges.select("sub", "sup").distinct()
    orphans = roots.distinct().join(edges.select(F.col("sub").alias("id")), "id", "left_anti").select(F.col("id").alias("sub"), F.lit(top).alias("sup"))
    return nodes, edges.union(orphans)


# Product, code and registry lists.


def path_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Lines `1 - A > B > C` -> (id, path: array, label)."""
    told = lines(spark, path).select("value").where(~F.col("value").startswith("#") & F.col("value").contains(" - "))
    steps = F.split(F.trim(F.expr("substring(value, instr(value, ' - ') + 3)")), " > ")
    return told.select(F.trim(F.substring_index("value", " - ", 1)).alias("id"), steps.alias("path"), F.element_at(steps, -1).alias("label"))


def taxonomy(spark: SparkSession, path: str, root: str = "root") -> tuple[DataFrame, DataFrame]:
    """path_taxonomy() as nodes (id, label) and edges: a path hangs below the path without its last step.

    `A & B` (or `A and B`) whose halves share a head is that head; else it stays as a bin, and beside it its two kinds
    stand as idA and idB in small letters.  Other nodes of one label are one node, the first; links that close a loop by
    that go, the first ones first.
    """
    from arbora.operators import aggregates, graph

    told = written(path_taxonomy(spark, path).withColumn(ORD, F.monotonically_increasing_id()), "paths")
    up = told.select(F.col("path").alias("above"), F.col("id").alias("parent"))
    rows = told.withColumn("above", F.slice("path", F.lit(1), F.size("path") - 1)).join(up, "above", "left").withColumn("parent", F.coalesce("parent", F.lit(root)))
    spelt = F.replace(F.col("label"), F.lit(" and "), F.lit(" & "))
    is_bin = F.col("label").contains(" & ") | F.col("label").contains(" and ")
    rows = rows.select("id", "parent", ORD, spelt.alias("spelt"), is_bin.alias("bin"), F.when(is_bin, text.shared_head(spelt)).alias("head"), "label")
    name = F.when(F.col("bin"), F.coalesce("head", F.lower("spelt"))).otherwise(text.singular_label(F.col("label")))
    halves = F.when(F.col("bin") & F.col("head").isNull(), text.split_bin(F.col("label"))).otherwise(F.array().cast("array<string>"))
    entries = F.concat(F.array(F.struct(F.col("id"), name.alias("label"), F.lit(0).alias("k"))), F.transform(halves, lambda x, i: F.struct(F.concat("id", F.char(97 + i)).alias("id"), x.alias("label"), (i + 1).alias("k"))))
    nodes = written(rows.select("parent", ORD, F.explode(entries).alias("e")).select("e.id", "e.label", F.struct(ORD, "e.k").alias("ord"), F.array("parent").alias("parents")), "kinds")
    # A bin is a node by itself, whatever its label.
    unique = nodes.withColumn("label", F.when(F.col("label").contains(" & "), F.concat_ws("\u0000", "label", "id")).otherwise(F.col("label")))
    top = spark.createDataFrame([(root, "\u0000root")], "id string, label string").select("id", "label", F.struct(F.lit(-1).cast("long").alias(ORD), F.lit(0).alias("k")).alias("ord"), F.array().cast("array<string>").alias("parents"))
    merged = written(aggregates.merged_by_label(unique.union(top)), "merged")
    edges = merged.select(F.col("id").alias("sub"), F.explode("parents").alias("sup"))
    loops = edges.join(graph.closure(edges).select(F.col("sub").alias("sup"), F.col("sup").alias("sub")), ["sub", "sup"], "left_semi")
    cut = _unlooped([(r["sub"], r["sup"]) for r in loops.join(unique.select(F.col("id").alias("sub"), "ord"), "sub").orderBy("ord", "sup").collect()])
    if cut:
        edges = edges.join(spark.createDataFrame(cut, "sub string, sup string"), ["sub", "sup"], "left_anti")
    label = F.when(F.col("id") == root, root).otherwise(F.substring_index("label", "\u0000", 1))
    return merged.select("id", label.alias("label")), edges


def _unlooped(links: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Of links that lie on loops, in order, those that close one as the others stand: they go, one name after the other."""
    above: dict[str, list[str]] = {}
    for sub, sup in links:
        above.setdefault(sub, []).append(sup)
    gone = []
    for sub in list(above):
        closing = []
        for sup in above[sub]:
            seen, todo = set(), [sup]
            while todo:
                n = todo.pop()
                if n not in seen:
                    seen.add(n)
                    todo += above.get(n, ())
            if sub in seen:
                closing.append(sup)
        above[sub] = [p for p in above[sub] if p not in closing]
        gone += [(sub, p) for p in closing]
    return gone


def product_codes(spark: SparkSession, path: str, root: str = "root", services: str = "services", goods: str = "goods") -> tuple[DataFrame, DataFrame]:
    """code_list() as nodes (id, label) and edges: a code hangs below the code without its last digit, single digits below
    services (5 to 9) or goods, and so does division 53, below goods.

    A code of goods that has codes below it and a title of several kinds is a bin: each kind stands beside it, as the
    code with a letter.
    """
    from arbora.operators.selection import is_goods

    code = F.trim("code")
    told = code_list(spark, path).select(code.alias("id"), F.trim("title").alias("title"))
    parent = F.when(F.length("id") == 1, F.when(F.col("id").rlike("^[5-9]$"), services).otherwise(goods)).when(F.col("id") == "53", goods).otherwise(F.expr("substring(id, 1, length(id) - 1)"))
    rows = written(told.select("id", F.lower("title").alias("label"), parent.alias("parent")), "codes")
    having = rows.select(F.col("parent").alias("id")).distinct()
    bins = rows.join(having, "id", "left_semi").where(is_goods(F.col("id"))).withColumn("kinds", text.kinds(F.col("label"))).where(text.is_union(F.col("label"), F.col("kinds")))
    leaves = bins.select("id", "parent", F.posexplode("kinds").alias("i", "kind")).select(F.concat("id", F.char(F.col("i") + 97)).alias("id"), F.concat("kind", F.lit(" (from "), "id", F.lit(")")).alias("label"), "parent")
    whole = rows.unionByName(leaves)
    tops = spark.createDataFrame([(root, root), (services, services), (goods, goods)], "id string, label string")
    edges = whole.select(F.col("id").alias("sub"), F.col("parent").alias("sup")).union(spark.createDataFrame([(services, root), (goods, root)], "sub string, sup string"))
    return whole.select("id", "label").union(tops), edges


def code_list(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """A CSV of (code, title) with a header; codes stay strings."""
    return spark.read.csv(path, header=True, encoding=encoding, escape='"', schema="code string, title string").where("code is not null")


def level_list(spark: SparkSession, path: str, levels: list[tuple[str, str, int]], where: Column | None = None, encoding: str = "ISO-8859-1") -> DataFrame:
    """A wide CSV with a code and a title for each level, (code column, title column, digits), as (code, title): codes
    filled to their digits, the first title of each."""
    rows = spark.read.csv(path, header=True, encoding=encoding, escape='"').withColumn(ORD, F.monotonically_increasing_id())
    rows = rows.where(where) if where is not None else rows
    each = F.explode(F.array(*[F.struct(text.zero_filled(F.col(c), n).alias("code"), F.col(t).alias("title")) for c, t, n in levels]))
    return rows.select(ORD, each.alias("x")).where("x.code is not null").groupBy("x.code").agg(F.min_by("x.title", ORD).alias("title"))


def registry(spark: SparkSession, folder: str, tops: list[str]) -> DataFrame:
    """Registry CSVs (Name, Template), top.csv for each top type -> (media_type, top, dead).  The template is authoritative; rows
    without one, or with one that names no subtype, are placeholders.  Files that aren't there are left out."""
    rows = None
    for top in tops:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{top}.csv")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            continue
        own = spark.read.csv(path.toString(), header=True, escape='"').select(F.trim("Template").alias("media_type"), text.is_dead(F.col("Name")).alias("dead"))
        rows = own if rows is None else rows.union(own)
    if rows is None:
        return spark.createDataFrame([], "media_type string, top string, dead boolean")
    return rows.where(F.col("media_type").contains("/")).select("media_type", F.split_part("media_type", F.lit("/"), F.lit(1)).alias("top"), "dead")


# Selections and snapshots.


def selected(spec: DataFrame, synset: DataFrame, hypernym: DataFrame, closed: DataFrame) -> DataFrame:
    """spec (kind, offset, ord): topic, cone, synset or children -> (offset, ord), each once, of known synsets."""
    of = lambda kind: spec.where(F.col("kind") == kind).select(F.col("offset").alias("at"), "ord")
    topics = synset.select("offset", F.explode(F.filter("pointers", lambda p: p["sym"] == ";c")).alias("p")).select("offset", F.col("p.target").alias("at"))
    below = closed.select(F.col("sub").alias("offset"), F.col("sup").alias("at")).union(spec.where("kind = 'cone'").select("offset", F.col("offset").alias("at")))
    children = hypernym.select(F.col("sub").alias("offset"), F.col("sup").alias("at"))
    found = topics.join(of("topic"), "at").union(below.select("offset", "at").join(of("cone"), "at").select("at", "offset", "ord")).union(children.join(of("children"), "at").select("at", "offset", "ord"))
    found = found.select("offset", "ord").union(of("synset").select(F.col("at").alias("offset"), "ord"))
    return found.join(synset.select("offset"), "offset", "left_semi").groupBy("offset").agg(F.min("ord").alias("ord"))


def first_of_each(rows: DataFrame, group: str, order: str, most: int) -> DataFrame:
    """At most so many rows of each group, by order: a capped pull."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("_n") <= most).drop("_n")


def vectors(spark: SparkSession, path: str, normalised: bool = False) -> DataFrame:
    """Lines `word x y z` -> (word, vector), of length one if told so.  A zip archive's members are read by one task each."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        with io.TextIOWrapper(z.open(name), encoding="utf-8") as told:
                            while part := [line.rstrip("\n") for _, line in zip(range(4096), told, strict=False)]:
                                yield pd.DataFrame({"value": part})

    told = spark.read.format("binaryFile").load(path).select("content").mapInPandas(members, "value string") if path.endswith(".zip") else spark.read.text(path)
    f = F.split("value", " ")
    rows = told.select(f[0].alias("word"), F.transform(F.slice(f, F.lit(2), F.size(f) - 1), lambda x: x.cast("float")).alias("vector"))
    if not normalised:
        return rows
    size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double") * x))
    return rows.withColumn("_s", size).select("word", F.transform("vector", lambda x: (x / (F.col("_s") + 1e-9)).cast("float")).alias("vector"))


# Workbooks.


def _cells(data: bytes, sheet: int) -> Iterator[tuple[int, list[str | None]]]:
    """Rows of a sheet, numbered from 0: shared, inline and plain values as text."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        told = lambda e: "".join(t.text or "" for t in e.iter() if t.tag.endswith("}t"))
        shared = [told(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        with z.open(f"xl/worksheets/sheet{sheet}.xml") as body:
            for _, row in ElementTree.iterparse(body):
                if not row.tag.endswith("}row"):
                    continue
                cells: dict[int, str | None] = {}
                for c in (e for e in row if e.tag.endswith("}c")):
                    column = 0
                    for letter in re.match("[A-Z]*", c.get("r", ""))[0]:
                        column = 26 * column + ord(letter) - 64
                    value = next((e.text for e in c if e.tag.endswith("}v")), None)
                    kind = c.get("t")
                    cells[column or len(cells) + 1] = shared[int(value)] if kind == "s" and value is not None else told(c) if kind == "inlineStr" else value
                yield int(row.get("r", "1")) - 1, [cells.get(i) for i in range(1, max(cells, default=0) + 1)]
                row.clear()


def workbook(spark: SparkSession, path: str, sheet: int = 1) -> DataFrame:
    """A sheet of each workbook -> (file, row from 0, cells: array of text).  A workbook is read by one task."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"], strict=True):
                part = []
                for number, cells in _cells(content, sheet):
                    part.append((file, number, cells))
                    if len(part) == 4096:
                        yield pd.DataFrame(part, columns=["file", "row", "cells"])
                        part = []
                yield pd.DataFrame(part, columns=["file", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, "file string, row long, cells array<string>")


# Remote pulls.


def parts_of(n: int, size: int) -> int:
    """How many parts n ids are dealt to before they are cut to chunks."""
    return max(1, -(-n // max(1, 64 * size)))


def part_of(value: Column, parts: int) -> Column:
    """The part of an id, which Python tells as zlib.crc32(id.encode()) % parts."""
    return F.crc32(value.cast("string").cast("binary")) % parts


def chunked(ids: DataFrame, column: str, size: int) -> DataFrame:
    """ids in chunks of some `size`: (chunk, values: array).  Chunks are by hash, so no task numbers all rows; each is cut
    to size within, and is of one part."""
    parts = parts_of(ids.count(), size)
    held = ids.where(F.col(column).isNotNull()).select(F.col(column).alias("v")).distinct().groupBy(part_of(F.col("v"), parts).alias("p")).agg(F.array_sort(F.collect_list("v")).alias("all"))
    starts = F.sequence(F.lit(0), F.size("all") - 1, F.lit(size))
    return held.select("p", "all", F.explode(starts).alias("at")).select((F.col("p") * (1 << 20) + F.col("at") / size).cast("long").alias("chunk"), F.slice("all", F.col("at") + 1, F.lit(size)).alias("values"))


def pulled(chunks: DataFrame, ask: Callable[[list], list[tuple]], schema: str, tries: int = 4, pause: float = 1.0) -> DataFrame:
    """The rows that a remote source answers to each chunk: ask(values) -> rows.  Failures are tried again after pauses that
    double, then raised: the task is repeated elsewhere.  `ask` may read a folder of earlier answers instead."""
    names = [c.split()[0] for c in schema.split(",")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for values in b["values"]:
                for n in range(tries):
                    try:
                        found = ask(list(values))
                        break
                    except OSError:
                        if n == tries - 1:
                            raise
                        time.sleep(pause * 2**n)
                yield pd.DataFrame(found, columns=names)

    return chunks.select("values").mapInPandas(rows, schema)


def by_prefix(prefixes: list[str], spark: SparkSession) -> DataFrame:
    """Chunks (chunk, values) of one prefix each, for sources that answer ranges of ids."""
    return spark.createDataFrame([(i, [p]) for i, p in enumerate(prefixes)], "chunk long, values array<string>").repartition(max(1, len(prefixes)))


def first_labels(rows: DataFrame) -> DataFrame:
    """rows (qid, label, ord) of a pull -> (qid, label): the last label that was told, else the id."""
    return rows.groupBy("qid").agg(F.max_by("label", F.when(F.col("label").isNotNull(), F.col("ord"))).alias("label")).select("qid", F.coalesce("label", "qid").alias("label"))


def looked_up(wanted: DataFrame, entities: DataFrame, kinds: DataFrame, unwanted: list[str], shown: int = 6) -> DataFrame:
    """wanted (label), entities (qid, label: each of its names), kinds (qid, kind) -> (label, qids): the first `shown` entities of
    a label, by id, that are of none of the unwanted kinds; none is an empty array."""
    out = kinds.where(F.col("kind").isin(*unwanted)).select("qid").distinct()
    found = entities.select("qid", "label").distinct().join(out, "qid", "left_anti").join(wanted.select("label").distinct(), "label", "left_semi")
    w = Window.partitionBy("label").orderBy("qid")
    some = found.withColumn("k", F.row_number().over(w)).where(F.col("k") <= shown).groupBy("label").agg(F.array_sort(F.collect_list("qid")).alias("qids"))
    return wanted.select("label").distinct().join(some, "label", "left").select("label", F.coalesce("qids", F.array().cast("array<string>")).alias("qids"))


def instances_of(classes: DataFrame, links: DataFrame, most: int) -> DataFrame:
    """classes (kind), links (item, kind) -> (item, kind): of each class its first `most` items, by id, with all classes of theirs."""
    chosen = first_of_each(links.join(classes.select("kind"), "kind", "left_semi"), "kind", "item", most).select("item").distinct()
    return links.join(chosen, "item", "left_semi").select("item", "kind").distinct()
