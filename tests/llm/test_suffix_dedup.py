"""Removal of repeated strings against brute force, and induced sorting against plain sorting."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arbora.llm import suffix_dedup
from arbora.llm.induced_sorting import Scratch, Strings

DIR = "/root/testdata/sf0.001"


def brute(docs):
    """{doc_id: results} of (doc_id, text), windows one by one; equal ids in the order that is given."""
    seen, out = set(), []
    for i, t in sorted(docs, key=lambda x: (x[0] is None, x[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), sum(gone[k] and not (k and gone[k - 1]) for k in range(len(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def some(x):
    return sorted((tuple(r) for r in x), key=lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else v for v in r))


def test_as_brute_force_on_the_table(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    want = some(brute([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert some(suffix_dedup.dedup(docs).collect()) == want
    # Every group by way of the disk.
    assert some(suffix_dedup.dedup(docs, 3000, 1).collect()) == want


def test_odd_rows(spark):
    words = " ".join(f"w{i % 613}" for i in range(3000))
    line = "a line that many documents share, which is somewhat longer than a hundred bytes, so that it counts: one two three."
    docs = [(1, words), (1, words), (2, None), (3, ""), (4, "short"), (5, "x" * 99), (6, "x" * 100), (7, "x" * 1000), (8, "ab" * 300), (9, "é" * 120), (10, "é" * 49 + "ab"), (None, line), (None, words), (-5, line + line), (11, f"before {line} after"), (12, line[:99]), (13, "\x00" * 250 + line), (14, words[5:4000] + line), (15, "x" * 50 + "y" + "x" * 150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("h", "block", "data", "key", "place", "found", "n_bytes")})
    for args in ((), (1000, 2)):
        got = some(suffix_dedup.dedup(df, *args).collect())
        # Of rows of one id either may be first; rows without an id go by their text's hash.
        want = [some(brute(docs)), some(brute([*docs[:11], docs[12], docs[11], *docs[13:]]))]
        assert got in want
    assert suffix_dedup.dedup(df.limit(0)).collect() == []


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**6))
def test_pasted_texts(seed):
    """Stretches cover each window once, and equal windows have equal anchors at equal offsets."""
    rng = random.Random(seed)
    base = bytes(rng.choice(b"abc ") for _ in range(400))
    texts = [base[: rng.randint(0, 400)] + base[rng.randint(0, 300) :] for _ in range(4)] + [b"z" * rng.randint(0, 300)]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    cut = suffix_dedup.Cut(data, ends)
    raw, anchors, seen = data.tobytes(), {}, []
    for first, last, anchor in zip(cut.first.tolist(), cut.last.tolist(), cut.anchor.tolist()):
        for p in range(first, last + 1):
            seen.append(p)
            assert anchors.setdefault(raw[p : p + 100], anchor - p) == anchor - p
    starts = [0, *ends[:-1].tolist()]
    assert seen == [p for a, z in zip(starts, ends.tolist()) for p in range(a, z - 99)]
    halves = [(s, e) for start, core, end in cut.halves(np.arange(len(cut.first))) for s, c, e in zip(start.tolist(), core.tolist(), end.tolist()) if s <= c and c + 100 - suffix_dedup.REACH <= e]
    assert sorted(p for s, e in halves for p in range(s, e - 99)) == seen


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([0, 500, 1 << 26]), st.sampled_from([1, 3, 100]))
def test_induced_sorting(seed, memory, rows):
    """Orders and common prefixes are those of plain sorting, in memory and by way of the disk."""
    rng = random.Random(seed)
    n, width, letters = rng.randint(1, 25), rng.choice([1, 4, 7]), rng.choice([1, 2, 255])
    groups = np.sort([rng.randint(0, rng.choice([0, 2])) for _ in range(n)])
    left, right = (np.array([[rng.randint(0, letters) for _ in range(width)] for _ in range(n)], np.uint8) for _ in range(2))
    n_left, n_right = (np.array([rng.randint(0, width) for _ in range(n)]) for _ in range(2))
    strings = Strings(groups, left, n_left, right, n_right)

    def plain(at):
        told = sorted((int(groups[i]), bytes(left[i, :at][::-1]) + bytes(right[i, : n_right[i]])) for i in range(n) if n_left[i] >= at)
        common = [0] * len(told)
        for k in range(1, len(told)):
            (g, a), (h, b) = told[k - 1 : k + 1]
            common[k] = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) if g == h else 0
        return [s for _, s in told], common

    def check(at, order, common):
        assert ([bytes(left[i, :at][::-1]) + bytes(right[i, : n_right[i]]) for i in order], list(common)) == plain(at)

    for at, order, common in strings.orders():
        check(at, order, common)
    if groups[0] == groups[-1]:
        with Scratch(memory) as scratch:
            for at, chunks in strings.orders_on_disk(scratch, rows):
                held = list(chunks)
                check(at, [i for o, _ in held for i in o], [c for _, cs in held for c in cs])
