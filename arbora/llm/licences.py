"""Licence scans: a positional rare-token index.

The index is data: key phrases' words, each with the templates it stands in and its position there.  One pass over all texts
counts in how many documents each of these words stands.  A template is posted under the two words of its phrase that are
rarest in the corpus (highest IDF); a file that holds a phrase holds all of its words, so these are also the file's
highest-IDF words of that phrase, and choosing them once for all files loses nothing.

A file's words are looked up in the postings of first words and in those of second words; each gives (template, start), the
word's position less its position in the template.  Where both agree the template may stand; there its key phrase is verified
word by word, and the rest of the template is compared at the same relative positions.  So every place where a key phrase
stands is found.  All of it is built-in functions over one constant (the index), so that the plan doesn't grow with the list of
licences; nothing is shuffled but the counts of the index's words.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.llm.common import text_of
from arbora.llm.licence_texts import BASE, NAMES, TEMPLATES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words, once A-Z are lower-cased.
EDGE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WHOLE, NAME, BASIC = 0, 1, 2
ENTRIES = "array<struct<label:string,words:array<string>,at:int,n:int,kind:int,first:int,second:int>>"
#: (template, start) as one number: starts are from -MOST on.
ROOM, MOST = 1 << 40, 1 << 20
PLACES = "array<struct<label:string,start:int,score:double,kind:int>>"


def runs(text: Column) -> Column:
    """The words of a text; before the first and after the last there may be an empty one."""
    return F.split(F.translate(text, UPPER, LOWER), EDGE)


def constant(value: object, kind: str) -> Column:
    """A value of any size as one literal."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """The number of documents, and in how many each word of the vocabulary stands: one row for each word comes back.

    Each task sums for the words it has seen before anything is sent.
    """
    present = F.array_intersect(runs(text_of(docs["text"])), constant(vocabulary, "array<string>"))
    found = docs.select(F.explode(F.array_append(present, F.lit(""))).alias("word")).groupBy("word").count().collect()
    seen = {r["word"]: r["count"] for r in found}
    return seen.pop("", 0), seen


class Catalogue:
    """Templates with the positions of their phrases' two rarest words, and the postings of these."""

    def __init__(self, docs: DataFrame, templates: tuple[tuple[str, str, str], ...], names: dict[str, str], base: dict[str, str]):
        self.entries: list[dict] = []
        for label, whole, phrase in templates:
            words, key = whole.split(), phrase.split()
            at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
            self.entries.append({"label": label, "words": words, "at": at, "n": len(key), "kind": WHOLE})
        for kind, phrases in ((NAME, names), (BASIC, base)):
            self.entries += [{"label": label, "words": phrase.split(), "at": 0, "n": len(phrase.split()), "kind": kind} for phrase, label in phrases.items()]
        key = lambda e: e["words"][e["at"] : e["at"] + e["n"]]
        vocabulary = sorted({w for e in self.entries for w in key(e)})
        total, seen = frequencies(docs, vocabulary)
        idf = {w: math.log((1 + total) / (1 + seen.get(w, 0))) for w in vocabulary}
        #: [first or second]: word -> the templates posted under it.
        self.postings: tuple[dict[str, list[int]], dict[str, list[int]]] = ({}, {})
        for number, e in enumerate(self.entries):
            where: dict[str, int] = {}
            for i, w in enumerate(key(e)):
                where.setdefault(w, i)
            rare = sorted(where.items(), key=lambda x: (-idf[x[0]], x[0]))[:2]
            e["first"], e["second"] = rare[0][1], rare[-1][1]
            for postings, (w, _) in zip(self.postings, (rare[0], rare[-1]), strict=True):
                postings.setdefault(w, []).append(number)
        self.literal = constant(self.entries, ENTRIES)

    def looked_up(self, words: str, which: int) -> Column:
        """(template, start) of each of a file's words that a posting has."""
        found = constant(self.postings[which], "map<string,array<int>>")
        hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: h["w"].isin(*self.postings[which]))
        position = lambda t: F.element_at(self.literal, t + 1)["second" if which else "first"]
        one = lambda h: F.transform(F.element_at(found, h["w"]), lambda t: t.cast("long") * ROOM + (h["i"] - position(t) + MOST))
        return F.flatten(F.transform(hits, one))

    def places(self, words: str) -> Column:
        """(label, start, score, kind) of each template whose key phrase stands in a file's words."""
        agree = F.array_intersect(self.looked_up(words, 0), self.looked_up(words, 1))
        told = F.transform(agree, lambda x: F.struct(F.element_at(self.literal, F.floor(x / ROOM).cast("int") + 1).alias("e"), (x % ROOM - MOST).cast("int").alias("s")))
        phrase = lambda p: F.slice(p["e"]["words"], p["e"]["at"] + 1, p["e"]["n"])
        verified = F.filter(told, lambda p: F.when(p["s"] >= 0, F.slice(words, F.greatest(p["s"], F.lit(0)) + 1, p["e"]["n"]) == phrase(p)).otherwise(False))

        def share(p: Column) -> Column:
            # get() is null beyond the end and before the beginning.
            same = F.zip_with(p["e"]["words"], F.sequence(p["s"] - p["e"]["at"], p["s"] - p["e"]["at"] + F.size(p["e"]["words"]) - 1), lambda w, i: F.coalesce((i >= 0) & (F.get(words, i) == w), F.lit(False)))
            return F.size(F.filter(same, lambda x: x)) / F.size(same)

        return F.transform(verified, lambda p: F.struct(p["e"]["label"].alias("label"), p["s"].alias("start"), share(p).cast("double").alias("score"), p["e"]["kind"].alias("kind")))


def scan(docs: DataFrame, templates: tuple[tuple[str, str, str], ...] = TEMPLATES, names: dict[str, str] = NAMES, base: dict[str, str] = BASE) -> DataFrame:
    """A row for each document (doc_id, text), with its own two columns (others are dropped) and:

    n_words; n_base, first_word, last_word (places of base phrases: how many, and the smallest and largest start, words
    from 0, else null); base_labels, labels (distinct, sorted, joined by commas, empty without any); score, from 0 to 1:
    the largest share of a template's words that stand in place where its key phrase does, 0 if no template's does (names and
    base phrases, which are nothing but themselves, don't count); places: (label, start, score) of each, in no order.  Long
    texts are read whole.  Null texts are empty: no words, score 0.  Repeated rows repeat; no rows give none.
    """
    catalogue = Catalogue(docs, templates, names, base)
    # A file without the rarest word of any template isn't looked at further.
    rarest = constant(sorted(catalogue.postings[0]), "array<string>")
    rows = docs.select(docs["doc_id"], docs["text"], runs(text_of(docs["text"])).alias("_s"))
    ends = (F.get("_s", F.lit(0)) == "").cast("long") + ((F.size("_s") > 1) & (F.element_at("_s", -1) == "")).cast("long")
    rows = rows.select("doc_id", "text", (F.size("_s") - ends).alias("n_words"), F.when(F.arrays_overlap("_s", rarest), F.filter("_s", lambda w: w != "")).alias("_w"))
    rows = rows.withColumn("places", F.when(F.col("_w").isNotNull(), catalogue.places("_w")))
    rows = rows.withColumn("places", F.coalesce("places", F.from_json(F.lit("[]"), PLACES))).drop("_w")
    own = F.filter("places", lambda p: p["kind"] == BASIC)
    named = lambda told: F.array_join(F.array_sort(F.array_distinct(F.transform(told, lambda p: p["label"]))), ",")
    return rows.select(
        "doc_id", "text", "n_words", F.size(own).cast("long").alias("n_base"),
        F.array_min(F.transform(own, lambda p: p["start"])).cast("long").alias("first_word"), F.array_max(F.transform(own, lambda p: p["start"])).cast("long").alias("last_word"),
        named(own).alias("base_labels"), named(F.col("places")).alias("labels"), F.coalesce(F.array_max(F.transform(F.filter("places", lambda p: p["kind"] == WHOLE), lambda p: p["score"])), F.lit(0.0)).alias("score"),
        F.transform("places", lambda p: F.struct(p["label"].alias("label"), p["start"].alias("start"), p["score"].alias("score"))).alias("places"),
    )
