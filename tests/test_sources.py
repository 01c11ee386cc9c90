"""Readers and writers on small files, and streams."""

import gzip
import json
import zipfile

import pytest

from arbora.operators import graph
from arbora.sources import readers, sinks
from arbora.streaming import verdicts


def pairs(df):
    return {(r["sub"], r["sup"]) for r in df.collect()}


def test_store_round_trip(spark, tmp_path):
    (tmp_path / "s.od").write_text("""# a store
#:meta cell '{"gloss": "a unit", "wn30": "1-n"}'
cell 'law'"'"'s-part' thing
'law'"'"'s-part' thing
thing '*'
""")
    nodes, edges, meta = readers.store(spark, str(tmp_path / "s.od"))
    assert nodes.count() == 3 and pairs(edges) == {("cell", "law's-part"), ("cell", "thing"), ("law's-part", "thing"), ("thing", "*")}
    assert tuple(meta.first()) == ("cell", "a unit", "1-n")
    sinks.write_store(edges, str(tmp_path / "out"))
    assert pairs(readers.store(spark, str(tmp_path / "out"))[1]) == pairs(graph.reduction(edges))
    assert sinks.dot_lines(edges).count() == 6
    assert json.loads(sinks.atlas(edges, graph.cone_sizes(edges)).where("name = 'thing'").first()["data"])["children"] == ["law's-part", "cell"]


def test_tables(spark, tmp_path):
    (tmp_path / "q.tsv").write_text('a\tb\n"# a note"\n"x ""y"""\tz\n')
    assert [tuple(r) for r in readers.quoted_table(spark, str(tmp_path / "q.tsv"), ["a", "b"]).collect()] == [('x "y"', "z")]
    (tmp_path / "r.tsv").write_text('# note\na\tb\tc\n"x\ty\n')
    assert [tuple(r)[:3] for r in readers.raw_table(spark, str(tmp_path / "r.tsv"), ["a", "b", "c"]).collect()] == [('"x', "y", None)]


def test_lexicon(spark, tmp_path):
    (tmp_path / "data.noun").write_bytes("  1 a licence\n00001740 03 n 02 entity 0 thing 1 001 ~ 00002000 n 0000 | that is; \"an example\"\n00002000 05 n 01 café 0 002 @ 00001740 n 0000 @i 00003000 n 0000 | below\n".encode("latin-1"))
    found = readers.synsets(spark, str(tmp_path / "data.noun"))
    rows = {r["offset"]: r for r in found.collect()}
    assert rows["00001740"]["lemmas"] == ["entity", "thing"] and rows["00002000"]["lemmas"] == ["café"] and rows["00002000"]["field"] == "animal"
    assert pairs(readers.hypernyms(found)) == {("00002000", "00001740")}
    (tmp_path / "index.noun").write_text("entity n 2 1 ~ 2 1 00001740 00002000  \n")
    assert [tuple(r) for r in readers.sense_index(spark, str(tmp_path / "index.noun")).collect()] == [("entity", 1, "00001740"), ("entity", 2, "00002000")]
    (tmp_path / "index.sense").write_text("entity%1:03:00:: 00001740 1 11\n")
    assert tuple(readers.sense_counts(spark, str(tmp_path / "index.sense")).first()) [1:] == ("entity", "1", "00001740", 11)


def test_ontologies(spark, tmp_path):
    (tmp_path / "a.kif").write_text("(subclass Dog\n   Animal)\n  (subclass No Way)\n(subclass Cat Animal)\n")
    assert pairs(readers.kif(spark, str(tmp_path / "a.kif"))) == {("Dog", "Animal"), ("Cat", "Animal")}
    (tmp_path / "m.txt").write_text(";; no\n00001 03 n &%Dog= | gloss\n")
    assert tuple(readers.kif_mapping(spark, str(tmp_path / "m.txt")).first()) == ("00001", "Dog", "=")
    with gzip.open(tmp_path / "y.nt.gz", "wt") as f:
        f.write("<http://x/Big_Dog> <http://www.w3.org/2000/01/rdf-schema#subClassOf> <http://x/Dog> .\n")
    nodes, edges = readers.ntriples(spark, str(tmp_path / "y.nt.gz"))
    assert pairs(edges) == {("Big_Dog", "Dog")} and {r["label"] for r in nodes.collect()} == {"Big Dog", "Dog"}
    (tmp_path / "o.owl").write_text('<rdf:RDF xmlns:rdf="r" xmlns:owl="o" xmlns:rdfs="s"><owl:Class rdf:about="http://x#A"><rdfs:label xml:lang="de">Ah</rdfs:label><rdfs:label xml:lang="en">Ay</rdfs:label></owl:Class><owl:Class rdf:about="http://x#B"><rdfs:subClassOf rdf:resource="http://x#A"/><rdfs:subClassOf rdf:resource="http://x#Gone"/></owl:Class></rdf:RDF>')
    nodes, edges = readers.owl_classes(spark, str(tmp_path / "o.owl"))
    assert pairs(edges) == {("B", "A")} and {tuple(r) for r in nodes.collect()} == {("A", "Ay"), ("B", "B")}
    (tmp_path / "s.json").write_text(json.dumps({"@graph": [{"@id": "schema:Thing", "@type": "rdfs:Class", "rdfs:label": {"@value": "Thing"}}, {"@id": "schema:Car", "@type": "rdfs:Class", "rdfs:label": "Car", "rdfs:subClassOf": [{"@id": "schema:Thing"}, {"@id": "schema:None"}]}, {"@id": "schema:p", "@type": "rdf:Property"}]}))
    nodes, edges = readers.json_ld(spark, str(tmp_path / "s.json"))
    assert pairs(edges) == {("Car", "Thing")} and {r["label"] for r in nodes.collect()} == {"Thing", "Car"}
    (tmp_path / "w.json").write_text(json.dumps({"roots": ["Q1"], "labels": {"Q1": "one", "Q2": "two"}, "edges": [["Q2", "Q1"], ["Q3", "Q1"]]}))
    assert pairs(readers.graph_pulls(spark, [str(tmp_path / "w.json")], "top")[1]) == {("Q2", "Q1"), ("Q1", "top")}


def test_lists(spark, tmp_path):
    (tmp_path / "t.txt").write_text("# v\n1 - Animals\n2 - Animals > Pets\n")
    assert [(r["id"], r["path"], r["label"]) for r in readers.path_taxonomy(spark, str(tmp_path / "t.txt")).collect()] == [("1", ["Animals"], "Animals"), ("2", ["Animals", "Pets"], "Pets")]
    (tmp_path / "l.csv").write_text("m,mt,u,ut\n1,one,1,unit\n1,again,12,two\n")
    assert {tuple(r) for r in readers.level_list(spark, str(tmp_path / "l.csv"), [("m", "mt", 1), ("u", "ut", 2)]).collect()} == {("1", "one"), ("01", "unit"), ("12", "two")}
    (tmp_path / "image.csv").write_text("Name,Template\npng,image/PNG\nold (OBSOLETE),image/old\nplaceholder,\n")
    assert {tuple(r) for r in readers.registry(spark, str(tmp_path), ["image", "audio"]).collect()} == {("image/PNG", "image", False), ("image/old", "image", True)}


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "a", "b", "accept", 1), ("s2", "a", "b", "reject", 2)], "source string, sub string, sup string, decision string, ord int")
    rows.write.parquet(str(tmp_path / "log"))
    stream = verdicts.log(spark, str(tmp_path / "log"), "source string, sub string, sup string, decision string, ord int")
    out = []
    verdicts.revote(stream, lambda: rows.select("source", "sub", "sup"), lambda df, epoch: out.extend(df.collect()), str(tmp_path / "c")).awaitTermination()
    assert [(r["sub"], r["for"]) for r in out] == [("a", ["s1", "s2"])]
    q = verdicts.latest(stream, ["sub", "sup"], "decision", "ord").writeStream.format("memory").queryName("verdicts").outputMode("complete").option("checkpointLocation", str(tmp_path / "d")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("verdicts").first()["decision"] == "reject"


def test_turtle_and_sniffing(spark, tmp_path):
    (tmp_path / "t.owl").write_text('''@prefix : <http://x.org/d#> .
@prefix owl: <http://www.w3.org/2002/07/owl#> .
@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .
# a note; with . marks
:Top a owl:Class ; rdfs:label "alto"@it , "top"@en .
:Mid rdf:type owl:Class .
:Mid a owl:Class ; rdfs:subClassOf :Top , [ a owl:Restriction ; owl:onProperty :p ; owl:someValuesFrom :Top ] ;
  rdfs:comment """two "quoted"
lines.""" .
<http://x.org/d#Low> a owl:Class ; rdfs:subClassOf :Gone ; owl:equivalentClass [ a owl:Class ; owl:intersectionOf ( :Mid [ a owl:Restriction ] :Top ) ] ; rdfs:label "low" .
''')
    nodes, edges = readers.owl(spark, str(tmp_path / "t.owl"), "Top")
    assert {tuple(r) for r in nodes.collect()} == {("Top", "top"), ("Mid", "Mid"), ("Low", "low")}
    assert pairs(edges) == {("Mid", "Top"), ("Low", "Mid"), ("Low", "Top")}
    (tmp_path / "x.owl").write_text('<rdf:RDF xmlns:rdf="r" xmlns:owl="o" xmlns:rdfs="s">\n<owl:Class rdf:about="h#A"/>\n<owl:Class rdf:about="h#B"><owl:equivalentClass><owl:Class><owl:intersectionOf><owl:Class rdf:about="h#A"/></owl:intersectionOf></owl:Class></owl:equivalentClass></owl:Class>\n</rdf:RDF>')
    assert pairs(readers.owl(spark, str(tmp_path / "x.owl"), "A")[1]) == {("B", "A")}
    with pytest.raises(ValueError, match="isn't among"):
        readers.owl(spark, str(tmp_path / "x.owl"), "Z")


def test_workbook(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>code</t></si><si><r><t>Engineer, </t></r><r><t>civil</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c></row><row r="2"><c r="A2"><v>2142</v></c><c r="C2" t="s"><v>1</v></c></row><row r="3"><c r="B3" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>')
    assert [(r["row"], r["cells"]) for r in readers.workbook(spark, str(tmp_path / "b.xlsx")).collect()] == [(0, ["code"]), (1, ["2142", None, "Engineer, civil"]), (2, [None, "x"])]


def test_pulls(spark, tmp_path):
    chunks = readers.chunked(spark.range(250).union(spark.range(5)), "id", 60)
    sizes = [len(r["values"]) for r in chunks.collect()]
    assert sum(sizes) == 250 and max(sizes) <= 60 and chunks.select("chunk").distinct().count() == len(sizes)
    flag = str(tmp_path / "failed")

    def ask(values):
        import os

        if not os.path.exists(flag):
            open(flag, "w").close()
            raise OSError("busy")
        return [(int(v), f"label {v}") for v in values]

    out = readers.pulled(chunks.coalesce(1), ask, "id long, label string", pause=0.01)
    assert out.distinct().count() == 250
    assert readers.chunked(spark.range(0), "id", 60).count() == 0
