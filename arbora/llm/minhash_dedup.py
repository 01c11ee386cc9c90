"""Near-duplicate documents by BagMinHash signatures, bands, and exact multiset overlap.

A document is the multiset of its shingles of five words.  Each shingle owns Poisson processes over (time, weight), a
hierarchy in which level 0 covers the weights (0, 1] and level i the weights (2^(i-1), 2^i]; a point falls into one of the
signature's places, and counts if its weight is at most the shingle's count.  A place keeps its earliest point, so two
documents agree in it with the probability of their weighted Jaccard similarity: sum of smaller counts / sum of larger.
Points are drawn only up to the time at which all places are filled, for many documents at once.

Documents that agree on all places of a band share a bucket.  Each is compared with its bucket's first document, by exact
counts.  Buckets and groups of copies may hold a third of all rows, so every aggregate by bucket, by words or by first
document is salted (common.grouped), and nothing is joined by such a key alone.  What is then in other groups than the first is compared with all of the bucket: in large buckets by blocks, whose
tasks multiply matrices of counts and return a spanning forest of the links; in small ones pair by pair, but for pairs that
the triangle inequality (the Jaccard distance is a metric) rules out by their distances to the first.  So a link is lost
only if its ends share no bucket (at 0.8, 7 in 100,000), whatever a bucket's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.common import SALT, components, dropped, forest, grouped, met, salt, slices, text_of, trim, written
from arbora.llm.hashing import ODD, Words, lowered, mixed_bits

WIDTH = 5
#: Words are runs of ASCII letters and digits and all other characters beyond ASCII, in lower case.
_words = Words(np.array([b < 128 and not chr(b).isalnum() for b in range(256)]))


class Shingles:
    """The distinct shingles of many texts: document numbers (ascending), hashes and counts, and each text's own hash."""

    def __init__(self, texts: list[bytes], width: int = WIDTH):
        data = lowered(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8))
        h, start = _words(data)
        doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
        words = np.bincount(doc, minlength=len(texts))
        first = np.concatenate([[0], np.cumsum(words)])
        place = np.arange(len(h)) - first[doc]
        with np.errstate(over="ignore"):
            # A text's hash is of its words in their order; it tells equal documents.
            marks = [mixed_bits(h + (place.astype(np.uint64) + np.uint64(1)) * k) for k in (ODD, np.uint64(0xD6E8FEB86659FD93))]
            runs = [np.concatenate([np.zeros(1, np.uint64), m.cumsum(dtype=np.uint64)]) for m in marks]
            self.own = np.stack([mixed_bits(r[first[1:]] - r[first[:-1]] + words.astype(np.uint64)) for r in runs]).view(np.int64)
            # A text of fewer words is one shingle.
            begin = np.flatnonzero(place <= np.maximum(words[doc] - width, 0))
            x = np.zeros(len(begin), np.uint64)
            for i in range(width):
                there = begin + i < first[doc[begin] + 1] if len(begin) else np.zeros(0, bool)
                x = np.where(there, mixed_bits(x * ODD + np.append(h, np.uint64(0))[np.minimum(begin + i, len(h))] + np.uint64(1)), x)
        doc = doc[begin]
        order = np.lexsort((x, doc))
        x, doc = x[order], doc[order]
        new = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])])) if len(x) else np.zeros(0, int)
        self.doc, self.hash, self.count = doc[new], x[new], np.diff(np.append(new, len(x)))
        self.n = len(texts)


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two multisets (sorted hashes, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    all_ = int(a[1].sum() + b[1].sum()) - both
    return both / all_ if all_ else 0.0


def signatures(s: Shingles, places: int) -> np.ndarray:
    """[document, place] -> the time of its earliest point; infinite for documents without shingles."""
    top = max(1, int(s.count.max(initial=1)))
    levels = [np.flatnonzero(s.count > (0 if i == 0 else 1 << (i - 1))) for i in range((top - 1).bit_length() + 1)]
    of = np.concatenate(levels)
    level = np.repeat(np.arange(len(levels)), [len(x) for x in levels])
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    span = np.where(level == 0, 1.0, low)
    with np.errstate(over="ignore"):
        state = mixed_bits(s.hash[of] + (level.astype(np.uint64) + np.uint64(1)) * ODD)
    doc, weight = s.doc[of], s.count[of].astype(float)
    out = np.full(s.n * places, np.inf)
    total = np.bincount(s.doc, s.count, s.n)
    until = places * (np.log(places) + 3) / np.maximum(total, 1)
    unit = 2.0**-53

    def draw(state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            state = state + ODD
            return state, mixed_bits(state)

    def after(bits: np.ndarray, span: np.ndarray) -> np.ndarray:
        return -np.log(((bits >> np.uint64(11)).astype(float) + 0.5) * unit) / span

    state, bits = draw(state)
    time = after(bits, span)
    while len(doc):
        now = np.flatnonzero(time <= until[doc])
        if len(now):
            rest = np.flatnonzero(time > until[doc])
            waiting = [x[rest] for x in (doc, weight, low, span, state, time)]
            d, w, lo, sp, st, t = (x[now] for x in (doc, weight, low, span, state, time))
            later = [waiting]
            while len(d):
                st, bits = draw(st)
                where = (bits >> np.uint64(32)).astype(np.int64) * places >> 32
                st, bits2 = draw(st)
                y = lo + sp * ((bits2 >> np.uint64(11)).astype(float) + 0.5) * unit
                ok = np.ceil(y) <= w
                np.minimum.at(out, d[ok] * places + where[ok], t[ok])
                st, bits = draw(st)
                t = t + after(bits, sp)
                on = t <= until[d]
                later.append([x[~on] for x in (d, w, lo, sp, st, t)])
                d, w, lo, sp, st, t = (x[on] for x in (d, w, lo, sp, st, t))
            doc, weight, low, span, state, time = (np.concatenate(x) for x in zip(*later, strict=True))
        # Only documents with an empty place go on.
        lacking = np.isinf(out.reshape(s.n, places)).any(axis=1)
        on = lacking[doc]
        doc, weight, low, span, state, time = (x[on] for x in (doc, weight, low, span, state, time))
        until = until * 2
    return out.reshape(s.n, places)


def banded(sig: np.ndarray, rows: int) -> np.ndarray:
    """[document, band] -> a hash of the band's number and its places."""
    bits = sig.view(np.uint64).reshape(len(sig), -1, rows)
    with np.errstate(over="ignore"):
        x = np.broadcast_to(np.arange(1, bits.shape[1] + 1, dtype=np.uint64), bits.shape[:2])
        for i in range(rows):
            x = mixed_bits(x * ODD + bits[:, :, i])
    return x.view(np.int64)


def portions(texts: list[bytes], limit: int = 400_000) -> Iterator[tuple[int, int]]:
    """Runs (from, to) of texts of some `limit` bytes together; a longer text is a run by itself."""
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (n == 0 or n + len(texts[j]) <= limit):
            n += len(texts[j]) + 1
            j += 1
        yield i, j
        i = j


def encoded(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, h: a hash of the text as it is, key: two longs of the words, bands: array of longs, null without words)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = encoded(b.column(2).to_pylist())
            for i, j in portions(texts):
                s = Shingles(texts[i:j])
                has = np.bincount(s.doc, minlength=s.n) > 0
                told = banded(signatures(s, bands * rows), rows)
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], b.column(1)[i:j], pa.array(s.own[0]), pa.array(s.own[1]), pa.array([told[q] if has[q] else None for q in range(s.n)], pa.list_(pa.int64()))], ["doc_id", "h", "k1", "k2", "bands"])

    return marked(docs).select("doc_id", "h", "text").mapInArrow(task, "doc_id long, h long, k1 long, k2 long, bands array<long>")


def marked(docs: DataFrame) -> DataFrame:
    """(doc_id, text, h), which tells the rows of one id apart by their texts."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), F.xxhash64(text_of(docs["text"])).alias("h"))


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (a, b) with their exact similarity; texts (id, text) has a row for each id.

    A task reads the text of each a once, then those of its partners; an a of many partners is dealt to many tasks.
    """
    pairs = pairs.withColumn(SALT, salt(pairs.sparkSession, "b"))
    heads = met(pairs.select("a", SALT).distinct(), texts.select(F.col("id").alias("a"), "text"), "a").select("a", SALT, F.lit(0).alias("side"), F.col("a").alias("b"), "text")
    others = met(pairs, texts.select(F.col("id").alias("b"), "text"), "b").select("a", SALT, F.lit(1).alias("side"), "b", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in slices(batches, 128):
            a, side, b = (batch.column(i).to_pylist() for i in (0, 1, 2))
            texts = encoded(batch.column(3).to_pylist())
            out = []
            for i, j in portions(texts):
                s = Shingles(texts[i:j])
                at = np.searchsorted(s.doc, np.arange(s.n + 1))
                for r in range(i, j):
                    own = s.hash[at[r - i] : at[r - i + 1]], s.count[at[r - i] : at[r - i + 1]]
                    if side[r] == 0:
                        head = own
                    else:
                        out.append((a[r], b[r], jaccard(head, own)))
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["a", "b", "sim"])

    return heads.unionByName(others).repartition("a", SALT).sortWithinPartitions("a", SALT, "side").select("a", "side", "b", "text").mapInArrow(task, "a long, b long, sim double")


def overlaps(x: list[tuple], y: list[tuple]) -> np.ndarray:
    """[i, j] -> sum of smaller counts of multisets x[i] and y[j] (sorted hashes, counts).

    A count of c is c features, so that sums of smaller counts are products of matrices of zeros and ones.  Frequent
    features are columns of such matrices; of the others each pair of holders is added by itself.
    """

    def features(sets: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        h = [np.repeat(a, c) for a, c in sets]
        nth = [np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) for _, c in sets]
        with np.errstate(over="ignore"):
            return mixed_bits(np.concatenate(h) + np.concatenate(nth).astype(np.uint64) * ODD), np.repeat(np.arange(len(sets)), [len(a) for a in h])

    (fx, ix), (fy, iy) = features(x), features(y)
    both = np.intersect1d(fx, fy)
    out = np.zeros((len(x), len(y)), np.float32)

    def held(f: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.searchsorted(both, f)
        ok = both[np.minimum(at, len(both) - 1)] == f if len(both) else np.zeros(len(f), bool)
        order = np.argsort(at[ok], kind="stable")
        return at[ok][order], i[ok][order], np.searchsorted(at[ok][order], np.arange(len(both) + 1))

    cx, hx, sx = held(fx, ix)
    cy, hy, sy = held(fy, iy)
    nx, ny = np.diff(sx), np.diff(sy)
    frequent = np.flatnonzero(nx * ny > 64)
    for k in range(0, len(frequent), 1024):
        some = frequent[k : k + 1024]
        place = np.full(len(both), -1)
        place[some] = np.arange(len(some))
        a, b = np.zeros((len(x), len(some)), np.float32), np.zeros((len(y), len(some)), np.float32)
        a[hx[place[cx] >= 0], place[cx[place[cx] >= 0]]] = 1
        b[hy[place[cy] >= 0], place[cy[place[cy] >= 0]]] = 1
        out += a @ b.T
    rare = np.flatnonzero(nx * ny <= 64)
    for k in range(0, len(rare), 8192):
        some = rare[k : k + 8192]
        times = nx[some] * ny[some]
        which = np.repeat(some, times)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        np.add.at(out, (hx[sx[which] + nth // ny[which]], hy[sy[which] + nth % ny[which]]), 1)
    return out


def blocked(placed: DataFrame, others: DataFrame, salts: DataFrame, texts: DataFrame, threshold: float, block: int = 512, block_bytes: int = 2_000_000) -> DataFrame:
    """Links (a, b) that connect whatever is linked between `others` and all that is `placed` in the same bucket.

    salts (bucket, _salt) are those of the buckets.  Blocks have some `block` texts, fewer where these are long.
    """
    some = lambda rows, name: met(rows, texts.select("id", "bytes"), "id").groupBy("bucket").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("bytes") / block_bytes)).cast("int").alias(name))
    sizes = met(met(some(others, "nx"), some(placed, "ny"), "bucket"), salts, "bucket")
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    told = lambda rows: met(met(rows.select("bucket", SALT, "id"), sizes, ["bucket", SALT]), texts.select("id", "text"), "id")
    x = told(others).select("bucket", part("nx").alias("x"), F.explode(F.sequence(F.lit(0), F.col("ny") - 1)).alias("y"), F.lit(True).alias("asks"), "id", "text")
    y = told(placed).select("bucket", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)).alias("x"), part("ny").alias("y"), F.lit(False).alias("asks"), "id", "text")

    def task(group: pa.Table) -> pa.Table:
        asks = np.array(group["asks"].to_pylist(), bool)
        ids, own = group["id"].to_numpy(), encoded(group["text"].to_pylist())
        sets: list[tuple] = []
        for i, j in portions(own):
            s = Shingles(own[i:j])
            at = np.searchsorted(s.doc, np.arange(s.n + 1))
            sets += [(s.hash[p:q], s.count[p:q]) for p, q in zip(at, at[1:], strict=False)]
        total = np.array([c.sum() for _, c in sets])
        xs, ys = np.flatnonzero(asks), np.flatnonzero(~asks)
        a, b = np.zeros(0, int), np.zeros(0, int)
        if len(xs) and len(ys):
            both = overlaps([sets[i] for i in xs], [sets[i] for i in ys]).astype(float)
            i, j = np.nonzero(both >= threshold * (total[xs][:, None] + total[ys][None, :] - both) - 1e-9)
            exact = both[i, j] / (total[xs[i]] + total[ys[j]] - both[i, j]) >= threshold
            a, b = xs[i[exact]], ys[j[exact]]
        # The same document may ask and be asked: both are one node.
        nodes, inverse = np.unique(ids, return_inverse=True)
        root = forest(inverse[a], inverse[b], len(nodes))
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        trim()
        return pa.Table.from_arrays([pa.array(nodes[root[moved]]), pa.array(nodes[moved])], ["a", "b"])

    return x.unionByName(y).groupBy("bucket", "x", "y").applyInArrow(task, "a long, b long")


#: Nodes from here on stand for texts whose id stands for another text already.
SECOND = 1 << 62


def numbered(same: DataFrame) -> DataFrame:
    """same (k1, k2, rep, ...) with node: the rep; but where several texts have the same, only the one of the smallest key,
    and a hash of the key from SECOND on for the others."""
    rows = same.withColumn(SALT, salt(same.sparkSession, F.struct("k1", "k2")))
    key = F.struct("k1", "k2")
    firsts = grouped(rows, ["rep"], [F.min(key).alias("k"), F.count("*").alias("n")], [F.min("k").alias("k"), F.sum("n").alias("n")], "n > 1")
    if firsts.isEmpty():
        return same.withColumn("node", F.col("rep"))
    other = F.lit(SECOND) + F.xxhash64("k1", "k2").bitwiseAND(F.lit(SECOND - 1))
    return met(rows, firsts, ["rep", SALT], "left").withColumn("node", F.when(F.col("k").isNull() | (F.col("k") == key), F.col("rep")).otherwise(other)).drop("k", "n", SALT)


def answers(docs: DataFrame, threshold: float = 0.8, bands: int = 24, rows: int = 5, small: int = 32) -> DataFrame:
    """dedup() with h, a hash of the row's text."""
    spark = docs.sparkSession
    signs = written(signed(docs, bands, rows), "signatures")
    linked = F.col("bands").isNotNull() & F.col("doc_id").isNotNull()
    whole = signs.where(linked).withColumn(SALT, salt(spark, "doc_id"))
    every = written(whole.groupBy("k1", "k2", SALT).agg(F.min(F.struct("doc_id", "h", "bands")).alias("x")), "copies")
    same = every.groupBy("k1", "k2").agg(F.min("x").alias("x")).select("k1", "k2", F.col("x.doc_id").alias("rep"), "x.h", "x.bands")
    unnumbered = written(same, "distinct")
    same = written(numbered(unnumbered), "distinct")
    entries = same.select(F.col("node").alias("id"), F.explode("bands").alias("bucket")).withColumn(SALT, salt(spark, "id"))
    buckets = written(grouped(entries, ["bucket"], [F.min("id").alias("first"), F.count("*").alias("n")], [F.min("first").alias("first"), F.sum("n").alias("n")], "n > 1"), "buckets")
    salts = buckets.select("bucket", SALT)
    member = written(met(entries, buckets, ["bucket", SALT]), "members")
    pairs = written(member.where("id != first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = met(same.select("node", F.col("rep").alias("doc_id"), "h"), ids, "node")
    # Repeated rows of an id and text are one.
    texts = marked(docs).join(wanted.hint("merge"), ["doc_id", "h"]).groupBy(F.col("node").alias("id")).agg(F.min(text_of()).alias("text"))
    texts = written(texts.withColumn("bytes", F.octet_length("text").cast("long")), "texts")
    sims = written(compared(pairs, texts), "sims")
    near = sims.where(F.col("sim") >= threshold).select("a", "b")
    scratch = [every, unnumbered, same, buckets, member, pairs, texts, sims]
    comp = components(near)
    scratch.append(comp)

    def apart(comp: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Of buckets with more than one group: all members, and those that aren't in the first one's group."""
        heads = met(buckets, comp.select(F.col("id").alias("first"), F.col("component").alias("head")), "first", "left").select("bucket", SALT, "n", "first", F.coalesce("head", "first").alias("head"))
        groups = met(member.select("bucket", SALT, "id"), comp.select("id", F.col("component").alias("c")), "id", "left").select("bucket", SALT, "id", F.coalesce("c", "id").alias("c"))
        placed = written(met(groups, heads, ["bucket", SALT]), "placed")
        others = placed.where("c != head")
        mixed = met(salts, others.select("bucket").distinct(), "bucket")
        scratch.append(placed)
        return met(placed, mixed, ["bucket", SALT], "left_semi"), others

    found = near
    placed, others = apart(comp)
    large = F.col("n") > small
    if not others.where(large).isEmpty():
        found = written(found.union(blocked(placed.where(large), others.where(large), salts, texts, threshold)), "near")
        comp = components(found)
        scratch += [found, comp]
        placed, others = apart(comp)

    reach = 1 - threshold
    d = F.when(F.col("id") == F.col("first"), 0.0).otherwise(1 - F.col("sim"))
    far = lambda rows: met(rows.where(~large), sims.select(F.col("a").alias("first"), F.col("b").alias("id"), "sim"), ["first", "id"], "left").select("bucket", "id", "c", d.alias("d"), F.floor(d / reach + 1e-9).alias("step"))
    left = far(others).select("bucket", F.col("id").alias("a"), F.col("c").alias("ca"), F.col("d").alias("da"), F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1)).alias("step"))
    right = far(placed).select("bucket", F.col("id").alias("b"), F.col("c").alias("cb"), F.col("d").alias("db"), "step")
    more = met(left, right, ["bucket", "step"]).where((F.col("ca") != F.col("cb")) & (F.abs(F.col("da") - F.col("db")) <= reach + 1e-9)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = written(met(more, sims.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    scratch.append(more)
    if not more.isEmpty():
        also = written(compared(more, texts).where(F.col("sim") >= threshold).select("a", "b"), "sims")
        scratch.append(also)
        if not also.isEmpty():
            comp = components(found.union(also))
            scratch.append(comp)
    named = met(same, comp.withColumnRenamed("id", "node"), "node", "left").select("k1", "k2", "rep", F.coalesce("component", "node").alias("component_id"))
    # A group of second texts only has the smallest of their ids.
    second = named.where(F.col("component_id") >= SECOND).groupBy("component_id").agg(F.min("rep").alias("name"))
    if not second.isEmpty():
        named = met(named, second, "component_id", "left").withColumn("component_id", F.coalesce("name", "component_id"))
    named = met(every.select("k1", "k2", SALT), named.select("k1", "k2", "component_id"), ["k1", "k2"])
    out = met(whole, named, ["k1", "k2", SALT]).select("doc_id", "h", "component_id").unionByName(signs.where(~linked).select("doc_id", "h", F.col("doc_id").alias("component_id")))
    out = written(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "answers")
    dropped(signs, *scratch)
    return out


def dedup(docs: DataFrame, threshold: float = 0.8, bands: int = 24, rows: int = 5, small: int = 32) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, component_id, kept.  Other columns are ignored.

    component_id is the smallest id that links reach, and its document is kept.  A text of one to four words is one
    shingle, so it links with equal texts only.  Texts that are null, empty or without words link with nothing, nor do rows
    without an id, whose component_id is null; they are all kept.  Long texts are compared whole.  Repeated rows have the
    same answer.  Rows of one id that differ in text have answers of their own: one of these texts (that of the smallest
    hash of words) names a group by the id, the others only where all of a group are such.  No rows give no rows.
    """
    return answers(docs, threshold, bands, rows, small).select("doc_id", "component_id", "kept")
