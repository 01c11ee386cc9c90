"""Writers: stores, pair and queue tables, drawings and data for pages.  Each writes a folder, as Spark does."""

from __future__ import annotations

import shlex
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.operators.graph import reduction
from arbora.operators.rules import TOP, constrained, heads


def _line(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for names, parents in batches:
        yield pd.Series([" ".join(shlex.quote(x) for x in (n, *ps)) for n, ps in zip(names, parents, strict=True)], dtype=object)


def quoted_line(name: str, parents: str) -> Column:
    """name and its parents (an array), shell-quoted."""
    return F.pandas_udf(_line, "string")(name, parents)


def store_lines(edges: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(name, value): a line for each name, its parents reduced, sorted and quoted; names (name) without parents have a line
    of their own."""
    kept = reduction(edges).groupBy(F.col("sub").alias("name")).agg(F.array_sort(F.collect_set("sup")).alias("parents"))
    if names is not None:
        kept = kept.join(names.select("name").distinct(), "name", "full").withColumn("parents", F.coalesce("parents", F.array().cast("array<string>")))
    return kept.select("name", quoted_line("name", "parents").alias("value"))


def write_store(edges: DataFrame, path: str, mode: str = "errorifexists", names: DataFrame | None = None, header: str = "# store v1") -> None:
    """A header and lines in the order of names, over as many files as the data needs."""
    lines = store_lines(edges, names).select(F.lit(1).alias("section"), "name", "value").union(edges.sparkSession.createDataFrame([(0, "", header)], "section int, name string, value string"))
    lines.orderBy("section", "name").select("value").write.mode(mode).text(path)


def canonical_lines(edges: DataFrame, names: DataFrame, meta: DataFrame, prelude: DataFrame, marker: str = "#:canonical") -> DataFrame:
    """(section, name, value) of a canonical store: the marker with the number of names, the prelude (sub, sup) first, then every
    name with its reduced parents, `*` for none, what terms and parents need as stubs, and the glosses (name, gloss, wn30)."""
    told = edges.where(F.col("sup") != TOP)
    whole = reduction(told.union(prelude.select("sub", "sup").where("sup is not null")))
    first = prelude.select(F.col("sub").alias("name")).distinct().withColumn("prelude", F.lit(True))
    hung = told.select(F.explode(F.array_distinct(F.array(heads(F.col("sup")), constrained(F.col("sup"))))).alias("name"))
    every = names.select("name").union(edges.select("sub")).union(hung).union(first.select("name")).where(F.col("name") != TOP).distinct()
    parents = whole.groupBy(F.col("sub").alias("name")).agg(F.array_sort(F.collect_set("sup")).alias("parents"))
    rows = every.join(parents, "name", "left").join(first, "name", "left")
    rows = rows.select(F.when(F.col("prelude"), 1).otherwise(2).alias("section"), "name", F.coalesce("parents", F.array(F.lit(TOP))).alias("parents"))
    lines = rows.select("section", "name", quoted_line("name", "parents").alias("value"))
    about = meta.join(every, "name", "left_semi").select(F.lit(3).alias("section"), "name", F.array(F.to_json(F.struct("gloss", "wn30"))).alias("m")).select("section", "name", F.concat(F.lit("#:meta "), quoted_line("name", "m")).alias("value"))
    head = every.agg(F.lit(0).alias("section"), F.lit("").alias("name"), F.concat_ws(" ", F.lit(marker), F.count("*").cast("string")).alias("value"))
    return head.union(lines).union(about)


def write_canonical(edges: DataFrame, names: DataFrame, meta: DataFrame, prelude: DataFrame, path: str, mode: str = "errorifexists") -> None:
    canonical_lines(edges, names, meta, prelude).orderBy("section", "name").select("value").write.mode(mode).text(path)


def write_sections(sections: list[tuple[str, DataFrame]], path: str, comment: list[str] = (), mode: str = "errorifexists") -> None:
    """A tab-separated table of several sections, in their order, with the section's name first and its rows sorted; before it
    comment lines and the header.  Sections have the same columns; arrays are joined with spaces."""
    spark = sections[0][1].sparkSession
    columns = sections[0][1].columns
    rows = [(i, 0, f"# {c}") for i, c in enumerate(comment)] + [(len(comment), 0, "\t".join(["section", *columns]))]
    out = spark.createDataFrame(rows, "place int, k int, value string").select(F.col("place").cast("long").alias("place"), F.lit("").alias("key"), "value")
    for i, (name, df) in enumerate(sections):
        told = df.select(*[F.coalesce(F.array_join(c, " ") if kind.startswith("array") else F.col(c).cast("string"), F.lit("")).alias(c) for c, kind in df.dtypes])
        line = F.concat_ws("\t", *columns)
        out = out.union(told.select(F.lit(len(rows) + i).cast("long"), line, F.concat(F.lit(name + "\t"), line)))
    out.orderBy("place", "key").select("value").write.mode(mode).text(path)


def replaced_section(old: DataFrame, new: DataFrame, begin: str, end: str, ord_column: str = "_ord") -> DataFrame:
    """(part, ord, value): the lines of a shared file (value, _ord) with those between the markers replaced by new lines; without
    markers the section is put at the end.  In order of part and ord."""
    place = old.agg(F.min(F.when(F.col("value") == begin, F.col(ord_column))).alias("b"), F.max(F.when(F.col("value") == end, F.col(ord_column))).alias("e"))
    rows = old.join(F.broadcast(place)).where("b is null or e is null or not (_o between b and e)".replace("_o", f"`{ord_column}`"))
    kept = rows.select(F.when(F.col(ord_column) > F.coalesce("e", F.lit(1 << 62)), 2).otherwise(0).alias("part"), F.col(ord_column).cast("long").alias("ord"), "value")
    marks = old.sparkSession.createDataFrame([(1, -1, begin), (1, 1 << 62, end)], "part int, ord long, value string")
    return kept.union(new.select(F.lit(1).alias("part"), F.col(ord_column).cast("long").alias("ord"), "value")).union(marks)


def with_columns_of(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """A table rewritten with new columns: those that it has of an earlier run go, the others and all rows stay."""
    fresh = [c for c in new.columns if c != key]
    return old.drop(*fresh).join(new, key, "left").select(*[c for c in old.columns if c not in fresh], *fresh)


def report(rows: DataFrame, what: str, columns: list[str]) -> DataFrame:
    """(what, item, n): how often each value of each column stands, for a printed summary."""
    each = F.explode(F.array(*[F.struct(F.lit(f"{what} by {c}").alias("what"), F.coalesce(F.col(c).cast("string"), F.lit("-")).alias("item")) for c in columns]))
    return rows.select(each.alias("x")).groupBy("x.what", "x.item").agg(F.count("*").alias("n"))


def write_pairs(pairs: DataFrame, path: str, order: list[str] | None = None, mode: str = "errorifexists") -> None:
    """A tab-separated table, sorted; arrays are joined with spaces."""
    told = pairs.select(*[F.array_join(c, " ").alias(c) if kind.startswith("array") else F.col(c) for c, kind in pairs.dtypes])
    told.orderBy(*(order or pairs.columns)).write.mode(mode).csv(path, sep="\t", header=True, quote="", escape="")


def write_json(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).json(path)


def kept_below(old: DataFrame, marker: str, ord_column: str = "_ord") -> DataFrame:
    """The lines of a generated file (value, _ord) after the marker, which people wrote."""
    at = old.where(F.col("value") == marker).agg(F.min(ord_column).alias("at"))
    return old.join(F.broadcast(at), F.col(ord_column) > F.col("at")).drop("at")


def dot_lines(edges: DataFrame, colours: DataFrame | None = None) -> DataFrame:
    """(ord, value): a drawing of the graph; colours (name, colour) are optional."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('\\"')), F.lit('"'))
    spark = edges.sparkSession
    head = spark.createDataFrame([(0, "digraph {"), (3, "}")], "ord int, value string")
    body = edges.select(F.lit(2).alias("ord"), F.concat(F.lit("  "), quoted("sub"), F.lit(" -> "), quoted("sup"), F.lit(";")).alias("value"))
    if colours is not None:
        body = body.union(colours.select(F.lit(1), F.concat(F.lit("  "), quoted("name"), F.lit(" [color="), quoted("colour"), F.lit("];"))))
    return head.union(body).orderBy("ord", "value")


def atlas(edges: DataFrame, sizes: DataFrame) -> DataFrame:
    """(name, cone, data): what a page shows of each name, as JSON: parents, and children by cone."""
    up = edges.groupBy(F.col("sub").alias("name")).agg(F.array_sort(F.collect_set("sup")).alias("parents"))
    down = edges.join(sizes.select(F.col("name").alias("sub"), "cone"), "sub").groupBy(F.col("sup").alias("name")).agg(F.array_sort(F.collect_list(F.struct((-F.col("cone")).alias("o"), "sub"))).alias("c"))
    told = sizes.join(up, "name", "left").join(down, "name", "left")
    return told.select("name", "cone", F.to_json(F.struct(F.coalesce("parents", F.array().cast("array<string>")).alias("parents"), F.transform("c", lambda s: s["sub"]).alias("children"), F.col("cone").alias("n"))).alias("data"))


def synonyms(concepts: DataFrame, synsets: DataFrame) -> DataFrame:
    """(name, words): the other lemmas of each concept's synset, as words."""
    told = concepts.select("name", F.col("wordnet").alias("offset")).join(synsets.select("offset", "lemmas"), "offset")
    other = F.filter("lemmas", lambda w: F.translate(F.lower(w), "_", "-") != F.col("name"))
    return told.select("name", F.array_sort(F.array_distinct(F.transform(other, lambda w: F.translate(w, "_", " ")))).alias("words"))


def generated_words(concepts: DataFrame, synsets: DataFrame) -> DataFrame:
    """(name, words): what a generated finding aid has of each concept: the lemmas of its synset in small letters with dashes, in
    their order, without repeats and without the name itself; concepts that are left without any have no row."""
    told = concepts.select("name", F.col("wordnet").alias("offset")).join(synsets.select("offset", "lemmas"), "offset")
    words = F.array_distinct(F.transform("lemmas", lambda w: F.translate(F.lower(w), "_", "-")))
    return told.select("name", F.filter(words, lambda w: w != F.col("name")).alias("words")).where(F.size("words") > 0)
