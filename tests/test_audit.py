"""Audit rules on small cases."""

from arbora.operators import audit, ranking, votes


def test_flags(spark):
    schema = "name string, held string, ref string, everyday array<string>, ref_tags int, held_tags int, total_tags int, holder string, disjoint boolean, off boolean, leaf boolean, used boolean, senses int"
    rows = [
        ("a", None, "1", [], 0, 0, 0, None, False, False, False, False, 0), ("b", "2", "1", ["1"], 3, 0, 3, "x", False, True, False, False, 2), ("c", "1", "1", [], 3, 3, 3, "c", True, False, False, False, 1),
        ("d", "1", "1", [], 0, 0, 1, None, False, False, True, False, 1), ("e", "1", "1", ["1"], 0, 0, 1, None, False, False, True, False, 1), ("f", "2", "1", [], 1, 1, 2, None, False, False, False, False, 2),
    ]
    out = {r["name"]: (r["flags"], r["recommendation"]) for r in audit.audit_flags(spark.createDataFrame(rows, schema)).collect()}
    assert out == {"a": (["no-synset"], ""), "b": (["rare-sense", "held-by", "off-wordnet"], "rename"), "c": (["disjoint"], "split"), "d": (["shrink"], "drop"), "e": ([], ""), "f": ([], "")}


def test_names_in_turn():
    assert audit.named_in_turn([("1", ["chip"]), ("2", ["chip", "crisp"]), ("3", ["chip"]), ("4", ["chip"])], {"food"}, "gpt") == [("1", "chip"), ("2", "crisp"), ("3", "chip.gpt"), ("4", "chip.gpt.2")]


def test_routes_and_senses(spark):
    registered = spark.createDataFrame([("image/png",), ("text/vnd.a",), ("text/q",)], "media_type string")
    formats = spark.createDataFrame([("png-format", ["png-format", "png"]), ("a", ["a"]), ("a-file", ["a-file", "a"])], "name string, keys array<string>")
    assert {tuple(r) for r in audit.media_route(registered, formats).collect()} == {("image/png", "png-format", "picked"), ("text/vnd.a", None, "ambiguous"), ("text/q", None, "unmatched")}
    bags = spark.createDataFrame([("bank", "1", "river"), ("bank", "2", "money"), ("solo", "3", "money")], "lemma string, offset string, word string")
    words = spark.createDataFrame([("bank", "bank"), ("solo", "money")], "lemma string, key string")
    vectors = spark.createDataFrame([("river", [1.0, 0.0]), ("money", [0.0, 1.0]), ("bank", [0.2, 0.9])], "word string, vector array<double>")
    assert [(r["lemma"], r["offset"], r["place"]) for r in audit.first_senses(bags, words, vectors).orderBy("place").collect()] == [("bank", "2", 1), ("bank", "1", 2)]
    trial = spark.createDataFrame([(None, True, True, False), (False, True, True, True), (None, True, False, False)], "ruling boolean, standard boolean, alone boolean, sourced boolean")
    assert [r["accepted"] for r in audit.trial_acceptance(trial).collect()] == [True, False, False]


def test_naming():
    n = audit.Naming({"fixed": "9"})
    n.settled({"bank": "1", "shore": "1", "odd": None, "cut": "5"}, {"cut": "-", "service": "7"})
    assert n.names == {"fixed": "9", "bank": "1", "odd": None, "cut": None, "service": "7"}
    n.candidates([("2", ["bank", "depository"], "group"), ("3", ["bank"], "object"), ("4", ["bank"], "object"), ("7", ["service"], "act"), ("8", ["service", "depository", "rite"], "act"), ("10", ["x"], "act"), ("11", ["grinder"], "food"), ("12", ["mill"], "act")], {"12": "grinding-mill"}, {"10"})
    assert n.names == {"fixed": "9", "bank": "1", "odd": None, "cut": None, "service": "7", "depository": "2", "bank.object": "3", "bank.object.2": "4", "rite": "8", "grinder": "11", "grinding-mill": "12"}
    assert len(n.queue) == 7


def test_routes_of_occupations(spark):
    rows = spark.createDataFrame([("1", ""), ("2", "0110"), ("3", "21"), ("4", "22"), ("5", "23"), ("6", None)], "offset string, code string")
    owned = spark.createDataFrame([("3", "core", "c"), ("4", "law", "l"), ("1", "core", "x")], "offset string, owner string, name string")
    assert {r["offset"]: r["route"] for r in audit.occupation_route(rows, owned).collect()} == {"1": "spread", "2": "armed", "3": "core", "4": "held", "5": "new", "6": "spread"}


def test_ownership(spark):
    names = lambda *x: spark.createDataFrame([(v,) for v in x], "name string")
    concepts = spark.createDataFrame([("p", "mine", "p"), ("q", "theirs", "q"), ("q", "both", "q"), ("p", "both", "p"), ("q", "base", "q"), ("q", "plain", "")], "pack string, name string, origin string")
    external = votes.external_names(concepts, "p", names("base"))
    assert {r["name"] for r in external.collect()} == {"theirs"}
    accepted = spark.createDataFrame([("mine", "base"), ("theirs", "mine"), ("leaf", "nowhere"), ("base", "mine")], "sub string, sup string")
    own, edges = votes.owned_edges(accepted, names("mine", "theirs", "base", "leaf", "both"), names("mine", "both"), names("base"), external)
    assert {r["name"] for r in own.collect()} == {"mine", "theirs", "leaf", "both"}
    assert {tuple(r) for r in edges.collect()} == {("mine", "base"), ("theirs", "mine")}


def test_composites(spark):
    """Means of percentiles, ranked; rows without a similarity are left out, other nulls count as 0."""
    rows = spark.createDataFrame([("a", -1.0, 3.0, 5), ("b", -2.0, None, 7), ("c", -3.0, 2.0, 6), ("d", None, 1.0, 1)], "name string, low double, other double, rank int")
    assert {tuple(r) for r in ranking.misfit(rows, "name", "low", "other").select("name", "misfit").collect()} == {("a", 0.5), ("b", 0.0), ("c", 1.0)}
    assert {tuple(r) for r in ranking.trap(rows, "name", "low", "other", "rank").select("name", "trap").collect()} == {("a", 0.0), ("b", 0.5), ("c", 1.0)}
