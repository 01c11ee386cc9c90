"""Lexical search and conversation repair against brute force, and on odd rows."""

import collections
import hashlib
import math
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arbora.llm import dialogue, lexical_search

DIR = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


# Search

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, top=10):
    """The contract, document by document."""
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        wanted = collections.Counter(terms(text))
        scored = []
        for i, c in held:
            m = 100 - 75 + 75 * sum(c.values()) * n // length
            score = sum(k * w[t] * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t, k in wanted.items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scored)[:top])]
    return out


def some(x):
    return sorted(x, key=lambda r: tuple((v is None, v or 0) for v in r))


ODD = [(1, "The cat's Ünder-tree 42"), (1, "The cat's Ünder-tree 42"), (2, None), (3, ""), (4, " --- \n"), (5, " ".join(f"w{i % 977}" for i in range(40_000)) + " cat"), (None, "cat tree"), (6, "tree cat"), (7, "cat\x00tree under Ünder"), (-8, "CAT")]


@pytest.mark.parametrize("most", [lexical_search.TERMS, 4])
def test_search_as_brute_force_on_odd_rows(spark, most):
    items = [(1, "cat tree tree"), (2, None), (3, ""), (None, "ünder UNDER w5"), (4, "w1 w1 w976"), (4, "cat"), (5, "nowhere")]
    d = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("n", "terms", "counts", "item", "score", "rank", "part")})
    q = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("item", "block", "doc_id")})
    assert some(rows(lexical_search.search(d, q, 3, most))) == some(ranked(ODD, items, 3))
    assert rows(lexical_search.search(d.limit(0), q, 3, most)) == [] == rows(lexical_search.search(d, q.limit(0), 3, most))


def test_search_on_the_tables(spark):
    d, q = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    want = ranked(rows(d.select("doc_id", "text")), rows(q.select("item_id", "text")))
    assert some(rows(lexical_search.search(d, q))) == some(want)


def test_blocks_of_documents_give_what_one_gives(spark, monkeypatch):
    import numpy as np

    items = lexical_search.Items(["a b b c", "c"])
    texts = [" ".join("abcd"[(i * k) % 4] for k in range(1 + i % 5)) for i in range(60)]
    entries = [items.of(lexical_search.Words(lexical_search.PARTS)(np.frombuffer(t.encode(), np.uint8))[0]) for t in texts]
    found = []
    for size in (60, 7, 1):
        p = lexical_search.Product(items, np.array([3, 5, 7]), 60, 180, 10)
        for i in range(0, 60, size):
            part = entries[i : i + size]
            p.add(np.arange(i, i + len(part)), np.array([len(t.split()) for t in texts[i : i + size]]), np.cumsum([len(t) for t, _ in part]), np.concatenate([t for t, _ in part]), np.concatenate([c for _, c in part]))
        found.append([(s.tolist(), d.tolist()) for s, d in p.kept])
    assert found[0] == found[1] == found[2]


# Conversations

NEXT = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}


def told(text):
    return text if text is not None else " "


def damaged(given):
    """{conv_id: rows after damage}, row by row."""
    out = {}
    for conv, turn, role, text in given:
        out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        r, role, text = zlib.crc32(key.encode()) % 20, told(role), told(text)
        if r:
            text = "" if r == 1 else re.sub("[.!?]", "", text) if r == 2 else text
            out[conv] += [(turn, "user" if r == 4 else role, text)] * (2 if r == 3 else 1)
    return out


def mended(given):
    """Counts, and the cheapest edits found by trying all of them, the cheapest first."""
    given = sorted(given, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, text in given:
        left = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not left else "d" if (role, text) in seen else "t" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in given if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[:1] for _, r, _ in given]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    import heapq

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, made = heapq.heappop(heap)
        if at == len(given) and last in ("", "a"):
            text = "\n".join(f"{r}:{t}" for r, t in made)
            return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()
        if (at, last) in done:
            continue
        done.add((at, last))
        new = []
        if at < len(given):
            _, role, text = given[at]
            new.append((4, "D", at + 1, last, made))
            if faults[at] not in ("b", "d"):
                left = 3 if faults[at] == "t" else 0
                if role[:1] and role[:1] in NEXT[last]:
                    new.append((left, "K", at + 1, role[:1], (*made, (role, text))))
                new += [(left + 3, "R", at + 1, full[0], (*made, (full, text))) for full in ("user", "assistant") if full[0] in NEXT[last]]
        new += [(3, "I", at, full[0], (*made, (full, ""))) for full in ("user", "assistant") if full[0] in NEXT[last]]
        for more, label, *rest in new:
            heapq.heappush(heap, (cost + more, audit + label, *rest))


def found(df, most=dialogue.ROWS):
    return {r[0]: r[1:] for r in rows(dialogue.repair(dialogue.damaged(df), most))}


@pytest.mark.parametrize("most", [dialogue.ROWS, 2])
def test_repair_as_brute_force_on_the_table(spark, most):
    df = spark.read.parquet(f"{DIR}/conversations.parquet")
    assert found(df, most) == {c: mended(x) for c, x in damaged(rows(df.select("conv_id", "turn", "role", "text"))).items()}


@pytest.mark.parametrize("most", [dialogue.ROWS, 3])
def test_repair_on_odd_rows(spark, most):
    given = [(None, None, None, None), (None, 3, "user", "Hm."), (1, None, "user", "a."), (1, None, "user", "a."), (1, 2, "", "b."), (1, 3, "tool", "c"), (1, 9, "assistant", "x" * 100_000 + "."), (2, 5, "system", " \x0b\r\n"), (2, 5, "system", "Be.\n"), (2, 6, "sudo", "u?")]
    given += [(3, t, ("user", "assistant", "system")[t * t % 3], "same." if t % 4 else f"t{t}!") for t in range(-20, 40)]
    given += [(4, 1, "user", "again.")] * 9 + [(5, t, "assistant", "é" * t) for t in range(8)]
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("key", "h", "r", "at", "blank", "seen", "cost", "_salt", "part")})
    assert found(df, most) == {c: mended(x) for c, x in damaged(given).items()}
    assert found(df.limit(0), most) == {}


def test_a_conversation_without_rows_left(spark):
    conv = next(i for i in range(1000) if all(zlib.crc32(f"{i}:{t}".encode()) % 20 == 0 for t in (1,)))
    df = spark.createDataFrame([(conv, 1, "user", "Gone.")], "conv_id long, turn long, role string, text string")
    assert found(df) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool"]), st.sampled_from(["a.", "b!", "c", " ", "d?"])), max_size=9), st.integers(1, 4))
def test_stretches_multiply_to_the_whole(said, size):
    """Any cut into stretches gives the cheapest edits, and the least of equal ones."""
    given = [(i, role, text) for i, (role, text) in enumerate(said)]
    seen, whole, parts = set(), {0: (0, "")}, dialogue.Told(1)
    for i in range(0, len(given), size):
        s = dialogue.Stretch(1, "=1", i == 0)
        for turn, role, text in given[i : i + size]:
            fault = dialogue.BLANK if text == " " else dialogue.DUPLICATE if (role, text) in seen else dialogue.TRUNCATED if text == "c" else dialogue.NONE
            seen.add((role, text))
            whole = dialogue.step(whole, role[:1], fault)
            s.add(turn, role, text, fault)
        stats = {n: getattr(s, n) for n in ("blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns")}
        parts.add(stats | {"weights": [{"start": a, "end": b, "cost": c, "labels": w} for a, ws in s.weights.items() for b, (c, w) in ws.items()]})
    cost, audit, cuts = parts.solved()
    assert (cost, audit) == dialogue.best(whole) == mended(given)[5:7]
    assert "".join(w for _, w in cuts) == audit
