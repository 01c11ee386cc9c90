"""Repair of conversations by weighted finite-state composition.

Three machines are composed: an acceptor of a conversation's rows, a transducer of edits (keep, rerole, delete, insert) and
an acceptor of well-formed role orders, `(s?(ua)+)?` by the roles' initials.  A state of the composition is (rows read,
state of the grammar); only states that some path reaches are built, row by row, which is a topological order once the
insertions before a row are taken together (no cheapest path inserts its way back to a state).  Weights are pairs (cost,
labels): the lesser cost wins, then the labels that come first.  Two cheapest paths between the same states read the same
rows, so neither's labels begin the other's; hence pairs may be compared at any cut, and the weights of a stretch of rows
are a small matrix from grammar state to grammar state.

Spark sorts rows by ranges of (conversation, turn), so that a conversation of any length is dealt to many tasks.  A task
cuts its rows into stretches of at most ROWS rows.  A conversation that lies within one stretch is finished there; of the
others, matrices are multiplied and stretches of text hashed in their order, one stretch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from arbora.llm.common import SALT, grouped, salt, trim, written

#: Costs of the edits, and of a row that ends in mid-sentence and stays.
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
FULL = {"u": "user", "a": "assistant"}
#: The grammar: (state, initial) -> state.
GRAMMAR = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
NONE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
ROWS, BYTES = 256, 1 << 20
SPACES = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

Weights = dict[int, tuple[int, str]]


def _better(weights: Weights, state: int, weight: tuple[int, str]) -> bool:
    if state in weights and weights[state] <= weight:
        return False
    weights[state] = weight
    return True


def inserted(weights: Weights) -> Weights:
    """Weights after any number of insertions."""
    out, new = dict(weights), dict(weights)
    while new:
        found: Weights = {}
        for state, (cost, labels) in new.items():
            for initial in FULL:
                after = GRAMMAR.get((state, initial))
                if after is not None and _better(out, after, (cost + INSERT, labels + "I")):
                    found[after] = out[after]
        new = found
    return out


@lru_cache(maxsize=4096)
def arcs(state: int, initial: str, fault: int) -> tuple[tuple[int, int, str], ...]:
    """(state after, cost, labels) of all ways from a state over one row: what is inserted before it, and its own edit."""
    out: Weights = {}
    for at, (cost, labels) in inserted({state: (0, "")}).items():
        _better(out, at, (cost + DELETE, labels + "D"))
        if fault in (BLANK, DUPLICATE):
            continue
        left = cost + (UNFINISHED if fault == TRUNCATED else 0)
        if (at, initial) in GRAMMAR:
            _better(out, GRAMMAR[at, initial], (left + KEEP, labels + "K"))
        for other in FULL:
            if (at, other) in GRAMMAR:
                _better(out, GRAMMAR[at, other], (left + REROLE, labels + "R"))
    return tuple((after, *weight) for after, weight in out.items())


def step(weights: Weights, initial: str, fault: int) -> Weights:
    """Weights after one more row."""
    out: Weights = {}
    for state, (cost, labels) in weights.items():
        for after, more, label in arcs(state, initial if initial in ("s", "u", "a") else "", fault):
            _better(out, after, (cost + more, labels + label))
    return out


def best(weights: Weights) -> tuple[int, str]:
    """The weight of the best path that may end."""
    return min(w for state, w in inserted(weights).items() if state in FINAL)


def repaired(labels: str, state: int, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of what the labels make of rows, from a state of the grammar."""
    for label in labels:
        if label == "I":
            role, text = FULL["a" if state == 2 else "u"], ""
        else:
            role, text = next(rows)
            if label == "D":
                continue
            if label == "R":
                role = FULL["a" if state == 2 else "u"]
        state = GRAMMAR[state, role[:1]]
        yield role, text


def run_through(labels: str, state: int, rows: Iterator[tuple[str, str]]) -> int:
    """The grammar's state after the labels."""
    for role, _ in repaired(labels, state, rows):
        state = GRAMMAR[state, role[:1]]
    return state


class Stretch:
    """Consecutive rows of one conversation: counts, ends and weights, and the rows themselves."""

    def __init__(self, conv_id: object, key: str, opens: bool):
        self.conv_id, self.key, self.opens = conv_id, key, opens  # opens: nothing of the conversation comes before it
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.bytes = 0
        self.first = self.last = self.low = self.high = None
        self.roles: list[str] = []
        self.texts: list[str] = []
        starts = (0,) if opens else (0, 1, 2, 3)
        self.weights: dict[int, Weights] = {s: {s: (0, "")} for s in starts}

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if self.roles:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == TRUNCATED
        self.weights = {s: step(w, initial, fault) for s, w in self.weights.items()}
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text) + 64


class Told:
    """What is known of a conversation's stretches read so far, in their order."""

    def __init__(self, conv_id: object):
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.last = self.low = self.high = None
        #: state of the grammar -> (cost, labels, length of the labels and state before each stretch)
        self.paths: dict[int, tuple[int, str, tuple]] = {0: (0, "", ())}

    def add(self, x: dict) -> None:
        if x["first"] is not None:
            if self.last is not None:
                self.illegal += self.last + x["first"] not in LEGAL
            self.last = x["last"]
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + x[name])
        if x["low"] is not None:
            self.turns -= self.high is not None and self.high == x["low"]
            self.low, self.high = x["low"] if self.low is None else self.low, x["high"]
        out: dict[int, tuple[int, str, tuple]] = {}
        for w in x["weights"]:
            if w["start"] in self.paths:
                cost, labels, cuts = self.paths[w["start"]]
                # Cuts are chained, so that paths share what they have in common.
                new = (cost + w["cost"], labels + w["labels"], (cuts, len(labels), w["start"]))
                if w["end"] not in out or new[:2] < out[w["end"]][:2]:
                    out[w["end"]] = new
        self.paths = out

    def solved(self) -> tuple[int, str, list[tuple[int, str]]]:
        """Cost, labels, and the state and labels of each stretch; the last one's hold what is inserted at the end."""
        cost, labels, end = min((*w, s) for s, w in ((s, w) for s, w in self._ends()))
        cuts, chain = [], self.paths[end][2]
        while chain:
            chain, at, state = chain
            cuts.append((at, state))
        cuts.reverse()
        ends = [*(at for at, _ in cuts[1:]), len(labels)][: len(cuts)]
        return cost, labels, [(state, labels[at:to]) for (at, state), to in zip(cuts, ends, strict=True)]

    def _ends(self) -> Iterator[tuple[int, tuple[int, str]]]:
        """For each state that the rows leave, the best weight from there to an end of the grammar."""
        for state, (cost, labels, _) in self.paths.items():
            yield state, best({state: (cost, labels)})

    def row(self, cost: int, labels: str, digest: str) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, labels, digest)


class Digest:
    """SHA-256 of rows `role:text` joined by newlines, row by row."""

    def __init__(self) -> None:
        self.sha, self.begun = hashlib.sha256(), False

    def add(self, rows: Iterator[tuple[str, str]]) -> None:
        for role, text in rows:
            if self.begun:
                self.sha.update(b"\n")
            self.begun = True
            self.sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
STATS = "first string, last string, low long, high long, turns long"
WEIGHTS = "array<struct<start int, end int, cost long, labels string>>"


def _stretches(schema: pa.Schema, most: int):
    """Rows sorted by conversation and turn -> finished conversations, and the stretches of those that may go on elsewhere."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, seen = TaskContext.get().partitionId(), 0, False
        now: Stretch | None = None
        out: list[dict] = []

        def close(s: Stretch, ended: bool) -> None:
            nonlocal number
            number += 1
            weights = [{"start": a, "end": b, "cost": c, "labels": labels} for a, w in s.weights.items() for b, (c, labels) in w.items()]
            row = {n: getattr(s, n) for n in ("conv_id", "key", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns")} | {"weights": weights, "part": part, "number": number}
            if s.opens and ended:
                told = Told(s.conv_id)
                told.add(row)
                cost, labels, _ = told.solved()
                digest = Digest()
                digest.add(repaired(labels, 0, iter(zip(s.roles, s.texts, strict=True))))
                names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
                out.append(dict(zip(names, told.row(cost, labels, digest.sha.hexdigest()), strict=True)) | {"key": None})
            else:
                out.append(row | {"roles": s.roles, "texts": s.texts})

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
            return made

        for batch in batches:
            for i in range(0, len(batch), 512):
                for x in batch.slice(i, 512).to_pylist():
                    if now is None or now.key != x["key"]:
                        # A task's first conversation may have begun in the task before, its last may go on in the next.
                        first = now is None
                        if not first:
                            close(now, True)
                        now = Stretch(None, x["key"], not first)
                    if x["n"] < 0:
                        seen = True
                        continue
                    now.conv_id = x["conv_id"]
                    for copy in range(x["n"]):
                        if len(now.roles) >= most or now.bytes >= BYTES:
                            close(now, False)
                            now = Stretch(x["conv_id"], x["key"], False)
                        now.add(x["turn"], x["role"], x["text"], BLANK if x["blank"] else DUPLICATE if copy or seen else TRUNCATED if x["unfinished"] else NONE)
                    seen = False
                if len(out) >= 256 or sum(len(r.get("texts") or ()) for r in out) > 4 * most:
                    yield flushed()
        if now is not None:
            close(now, False)
        if out:
            yield flushed()
        trim()

    return cut


def _joined(schema: pa.Schema):
    """For each conversation first its stretches without texts, then those with texts: one row."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = told = solved = digest = None
        at, out = 0, []

        def end() -> None:
            if told is not None:
                out.append(told.row(solved[0], solved[1], digest.sha.hexdigest()))

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)
            out.clear()
            return made

        for batch in batches:
            for i in range(0, len(batch), 16):
                for x in batch.slice(i, 16).to_pylist():
                    if key != x["key"]:
                        end()
                        key, told, solved, digest, at = x["key"], Told(x["conv_id"]), None, Digest(), 0
                    if x["texts"] is None:
                        told.add(x)
                        continue
                    solved = solved or told.solved()
                    state, labels = solved[2][at]
                    digest.add(repaired(labels, state, iter(zip(x["roles"], x["texts"], strict=True))))
                    at += 1
                if out:
                    yield flushed()
        end()
        if out:
            yield flushed()
        trim()

    return join


def _arrow(layout: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(layout))


def damaged(rows: DataFrame) -> DataFrame:
    """The damage by which the repair is tested, from crc32(`conv_id:turn`) mod 20: 0 drops a row (its conversation stays, as
    a row without turn, role and text), 1 empties its text, 2 removes `.!?` from it, 3 repeats it, 4 makes it the user's.

    (conv_id, turn, role, text, n: how often the row is there).  Nulls count as one space; a null turn stays null.
    """
    said = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    r = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"), r.alias("r"))
    gone = lambda c: F.when(F.col("r") != 0, c)
    text = F.when(F.col("r") == 1, "").when(F.col("r") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", gone(F.col("turn")).alias("turn"), gone(F.when(F.col("r") == 4, "user").otherwise(F.col("role"))).alias("role"), gone(text).alias("text"),
        F.when(F.col("r") == 0, 0).when(F.col("r") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def conversation_key(conv_id: Column) -> Column:
    """A text that tells conversations apart; those without an id are one conversation."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def repair(rows: DataFrame, most: int = ROWS) -> DataFrame:
    """Faults, cheapest repair and digest of each conversation of rows (conv_id, turn, role, text, and n or each row once).

    A row of n = 0 only says that there is such a conversation; role and text aren't null where n > 0.  Rows of a
    conversation are taken by turn, nulls first, those of one turn by role and then by the text's digest, so that equal rows
    stand together.  A row's fault is the first of: blank, duplicate (role and text earlier in the conversation), truncated.
    A role that begins with none of s, u and a, or is empty, can't be kept.  Rows without a conv_id are one conversation.
    Long texts are read whole.  No rows give no conversations; other columns are ignored.
    """
    spark = rows.sparkSession
    kind = dict(rows.dtypes)["conv_id"]
    n = F.col("n").cast("long") if "n" in rows.columns else F.lit(1).cast("long")
    # Equal rows become one with a count, so that any number of copies is a row.
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", n.alias("n")).groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    trimmed = F.rtrim("text", F.lit(SPACES))
    rows = rows.select(
        "conv_id", conversation_key(F.col("conv_id")).alias("key"), F.struct(F.col("turn").isNotNull().alias("has"), "turn").alias("at"), "role", F.unhex(F.sha2("text", 256)).alias("h"),
        "n", "text", (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("unfinished"),
    )
    # What was said before in the conversation: a row without text stands before each row that says it again.
    keys = ["key", "role", "h"]
    said = rows.where("n > 0").select(*keys, "at").withColumn(SALT, salt(spark, "at"))
    again = said.join(grouped(said, keys, [F.min("at").alias("at"), F.count("*").alias("m")], [F.min("at").alias("earliest"), F.sum("m").alias("m")], "m > 1"), [*keys, SALT]).where("at > earliest")
    marks = again.select(F.lit(None).cast(kind).alias("conv_id"), "key", "at", "role", "h", F.lit(-1).cast("long").alias("n"), *(F.lit(None).cast(t).alias(c) for c, t in (("text", "string"), ("blank", "boolean"), ("unfinished", "boolean"))))
    order = ["key", "at", "role", "h"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.union(marks).repartitionByRange(parts, *order).sortWithinPartitions(*order, "n")
    result = f"conv_id {kind}, {RESULT}"
    layout = f"{result}, key string, part int, number int, {STATS}, weights {WEIGHTS}, roles array<string>, texts array<string>"
    cut = written(sorted_rows.select("conv_id", "key", "at.turn", "role", "n", "text", "blank", "unfinished").mapInArrow(_stretches(_arrow(layout), most), layout), "stretches")
    names = ["conv_id", *(c.split()[0] for c in RESULT.split(", "))]
    parted = cut.where("key is not null")
    light = parted.withColumn("texts", F.lit(None).cast("array<string>")).withColumn("roles", F.lit(None).cast("array<string>"))
    heavy = parted.withColumn("weights", F.lit(None).cast(WEIGHTS))
    both = light.union(heavy).withColumn("heavy", F.col("texts").isNotNull()).repartition("key").sortWithinPartitions("key", "heavy", "part", "number").drop("heavy")
    whole = both.mapInArrow(_joined(_arrow(result)), result)
    return cut.where("key is null").select(*names).union(whole.select(*names))
