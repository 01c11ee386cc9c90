"""Toxicity: nearest labelled examples by exact TF-IDF cosine, from a block-max inverted index.

The index holds a bounded sample of labelled rows, at most `sample` of them, taken in the order of a hash of their ids, and
every term of their texts.  Document frequencies are those of all documents.  A term's weight is (1 + log tf) * idf, stretched by
how much the term's frequency depends on the label (its log-likelihood ratio over what the best of so many unrelated terms
would reach, `floor` at least); vectors have length one, and equal ones are one entry.

Entries that are alike stand together (spherical k-means), and postings of a term are cut into blocks of entries, each with
its largest weight.  The sum of these bounds a whole block's cosines, so blocks are read from the highest bound down until no
bound reaches the k-th cosine found: the result is exactly that of reading all.  Votes are weighted by the square of the
cosine, that is by nearness, drawn towards the base rate, and calibrated by a logistic curve fitted on the sample, each
row judged without itself.  The nearest examples are the evidence.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Collection, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.common import dropped, remainder_of_five, slices, trim, written

WORD = re.compile(r"[^\W\d_]+")
#: More than rounding adds to a cosine.
SURE = 1e-6
EVIDENCE = "array<struct<doc_id:long,cosine:double,toxic:double>>"
Vector = tuple[np.ndarray, np.ndarray]


def terms(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def hashed(words: Iterable[str], n: int) -> np.ndarray:
    """64-bit hashes, by which tasks know terms: a vocabulary is eight bytes a term."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)


def known_in(vocabulary: np.ndarray, words: Collection[str]) -> tuple[np.ndarray, np.ndarray]:
    """The places of words in a sorted vocabulary of hashes, and whether they are in it."""
    h = hashed(words, len(words))
    at = np.searchsorted(vocabulary, h)
    return at, vocabulary[np.minimum(at, len(vocabulary) - 1)] == h if len(vocabulary) else np.zeros(len(h), bool)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all runs (starts[i], starts[i] + 1, ... sizes[i] of them), one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def alike(entries: list[Vector], cells: int, width: int = 256, rounds: int = 6, seed: int = 7) -> np.ndarray:
    """A cell for each entry, by spherical k-means on terms folded into `width` places."""
    rng = np.random.default_rng(seed)
    x = np.zeros((len(entries), width))
    sign = lambda t: np.where((t * 2654435761 >> 7) & 1, 1.0, -1.0)
    for i, (t, w) in enumerate(entries):
        np.add.at(x[i], t * 40503 % width, w * sign(t))
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    x = x / np.where(size > 0, size, 1)
    c = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    near = np.zeros(len(x), int)
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(size > 1e-9, total / np.where(size > 1e-9, size, 1), c)
    return near


class Index:
    """Entries (terms ascending, weights; with how many examples they stand for) in blocks, by postings of terms.

    Terms of more than one entry in `often` have a weight for each entry and a largest one for each block; postings of all
    others are lists, read whole.
    """

    def __init__(self, entries: list[Vector], examples: list[int], toxic: list[int], n_terms: int, width: int = 64, often: int = 16):
        # Place -> entry.  Alike ones stand together, which makes the blocks' bounds tight.
        cell = alike(entries, max(1, len(entries) // width)) if entries else np.zeros(0, int)
        self.order, self.width = np.argsort(cell, kind="stable"), width
        self.examples, self.toxic = (np.array(x, float)[self.order] if entries else np.zeros(0) for x in (examples, toxic))
        self.blocks = -(-len(entries) // width)
        sizes = np.array([len(entries[i][0]) for i in self.order], int)
        term = np.concatenate([np.zeros(0, np.int64), *(entries[i][0] for i in self.order)])
        weight = np.concatenate([np.zeros(0), *(entries[i][1] for i in self.order)]).astype(np.float32)
        place = np.repeat(np.arange(len(entries)), sizes).astype(np.int16 if len(entries) < 1 << 15 else np.int32)
        frequent = np.flatnonzero(np.bincount(term, minlength=n_terms) * often > len(entries))
        #: Row of a frequent term, -1 of others.
        self.row = np.full(n_terms, -1, np.int32)
        self.row[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), self.blocks, width), np.float32)
        some = self.row[term] >= 0
        self.dense[self.row[term[some]], place[some] // width, place[some] % width] = weight[some]
        self.most = self.dense.max(axis=2) if len(entries) else np.zeros((len(frequent), 0), np.float32)
        by_term = np.flatnonzero(~some)[np.argsort(term[~some], kind="stable")]
        self.place, self.weight = place[by_term], weight[by_term]
        self.first = np.searchsorted(term[by_term], np.arange(n_terms + 1)).astype(np.int32)

    def nearest(self, query: Vector, k: int, less: int = -1) -> list[tuple[float, int]]:
        """(cosine, place) of the nearest entries, best first, ties by place: as many as stand for k examples.

        less: a place whose entry counts for one example less.  Cosines are in single precision.
        """
        at, q = query
        if not len(at) or not self.blocks:
            return []
        row = self.row[at]
        listed, rare, light = row >= 0, at[row < 0], q[row < 0]
        row, heavy = row[listed], q[listed].astype(np.float32)
        sizes = self.first[rare + 1] - self.first[rare]
        posting = spread(self.first[rare], sizes)
        listed = np.bincount(self.place[posting], np.repeat(light, sizes) * self.weight[posting], self.blocks * self.width).reshape(self.blocks, self.width)
        bound = listed.max(axis=1) + heavy @ self.most[row]
        order = np.argsort(-bound, kind="stable")
        found, near = np.zeros(0, int), np.zeros(0)
        floor, done, some, dense = 0.0, 0, 16, self.dense.reshape(-1, self.width)
        while done < self.blocks and bound[order[done]] > SURE and bound[order[done]] >= floor - SURE:
            now = order[done : done + some]
            now = now[(bound[now] > SURE) & (bound[now] >= floor - SURE)]
            done, some = done + some, 2 * some
            cosine = (listed[now] + (heavy @ dense.take((row[:, None] * self.blocks + now).ravel(), axis=0).reshape(len(row), len(now) * self.width)).reshape(len(now), self.width)).ravel()
            hit = np.flatnonzero((cosine > SURE) & (cosine >= floor))
            found = np.concatenate([found, now[hit // self.width] * self.width + hit % self.width])
            near = np.concatenate([near, cosine[hit]])
            best = np.lexsort((found, -near))
            stand = np.cumsum(self.examples[found[best]] - (found[best] == less))
            upto = int(np.searchsorted(stand, k)) + 1
            if upto <= len(best):
                floor, best = near[best[upto - 1]], best[:upto]
            found, near = found[best], near[best]
        return list(zip(near.tolist(), found.tolist(), strict=True))


class Model:
    def __init__(self, vocabulary: np.ndarray, weight: np.ndarray, index: Index, ids: list[int], none: tuple[int, int], base: float, k: int):
        """weight: of each term, for a tf of one; ids: a labelled id for each place; none: how many of the sample have no
        term, and how many of these are toxic; base: the rate of toxic ones."""
        self.vocabulary, self.weight, self.index, self.ids, self.k, self.base = vocabulary, weight, index, ids, k, base
        #: Texts without a term: as the sample's such texts are.
        self.no_terms = (none[1] + 0.1) / (none[0] + 1)
        self.curve = (0.0, 1.0)

    def vector(self, text: str | None) -> Vector:
        counts = Counter(terms(text))
        at, known = known_in(self.vocabulary, counts)
        return self.of(at[known], np.fromiter(counts.values(), np.int64, len(counts))[known])

    def of(self, at: np.ndarray, n: np.ndarray) -> Vector:
        """Of terms and how often they stand."""
        order = np.argsort(at)
        at, n = at[order], n[order]
        w = (1 + np.log(n)) * self.weight[at]
        size = np.sqrt((w * w).sum())
        return at, w / size if len(at) else w

    def share(self, near: list[tuple[float, int]], less: int = -1, own: int = 0) -> float:
        """Of toxic among the nearest, in (0, 1), drawn towards the base rate."""
        of, all_ = self.base, 1.0
        for cosine, place in near:
            w = cosine * cosine
            of += w * (self.index.toxic[place] - own * (place == less))
            all_ += w * (self.index.examples[place] - (place == less))
        return min(1 - 1e-6, max(1e-6, of / all_))

    def judge(self, text: str | None, shown: int = 0) -> tuple[float, list[tuple[int, float, float]]]:
        """The score, and of the nearest `shown` labelled examples: id of one, cosine, share of toxic among its equals."""
        query = self.vector(text)
        if not len(query[0]):
            return self.no_terms, []
        near = self.index.nearest(query, self.k)
        return self.calibrated(self.share(near)), [(self.ids[p], min(1.0, c), float(self.index.toxic[p] / self.index.examples[p])) for c, p in near[:shown]]

    def calibrated(self, share: float) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, a + b * math.log(share / (1 - share))))))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Intercept and slope by Newton's method, with targets drawn in and a small ridge; the slope isn't negative."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    beta, design = np.array([0.0, 1.0]), np.stack([np.ones_like(x), x], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), design.T @ (target - p) - 1e-3 * (beta - [0.0, 1.0]))
        beta = beta + np.clip(step, -2, 2)
    return (float(beta[0]), float(beta[1])) if beta[1] > 0 else (0.0, 1.0)


def stretches(seen: np.ndarray, n: np.ndarray, floor: float) -> np.ndarray:
    """seen[label, term]: examples of the label with the term; n[label]: all examples -> a factor for each term."""
    rate = seen.sum(axis=0) / max(1.0, n.sum())
    ratio = np.zeros(seen.shape[1])
    for y in (0, 1):
        for count, of in ((seen[y], rate), (n[y] - seen[y], 1 - rate)):
            some = count > 0
            ratio[some] += 2 * count[some] * np.log(count[some] / (of[some] * n[y]))
    return np.maximum(ratio / (2 * math.log(max(2, len(ratio))) + 4), floor)


def examples_of(docs: DataFrame, labels: DataFrame, sample: int, held_out: int) -> pa.Table:
    """(_id, _toxic, terms, counts: how often each term stands) of the sampled labelled rows, in the order of ids, one for each:
    the smallest of its texts."""
    own = labels.where(remainder_of_five(labels["doc_id"]) != held_out).groupBy(labels["doc_id"].cast("long").alias("_id")).agg(F.max(labels["toxic"].cast("int")).alias("_toxic")).where("_toxic is not null")
    picked = own.join(docs.select(docs["doc_id"].cast("long").alias("_id")), "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(sample).collect()
    # The picked ids go along as a literal list: `sample` of them at most.
    told = docs.sparkSession.createDataFrame([(r["_id"], int(r["_toxic"] > 0)) for r in picked], "_id long, _toxic int")
    rows = docs.select(docs["doc_id"].cast("long").alias("_id"), F.coalesce(docs["text"], F.lit("")).alias("text")).join(F.broadcast(told), "_id")
    rows = written(rows.groupBy("_id").agg(F.min("text").alias("text"), F.max("_toxic").alias("_toxic")), "labelled")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            own = [Counter(terms(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([list(c) for c in own], pa.list_(pa.string())), pa.array([list(c.values()) for c in own], pa.list_(pa.int64()))], ["_id", "_toxic", "terms", "counts"])

    found = rows.mapInArrow(counted, "_id long, _toxic int, terms array<string>, counts array<long>").toArrow()
    dropped(rows)
    return found.sort_by("_id")


def frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of documents, and in how many each term of the vocabulary stands.  A task sends a row for each term."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(len(vocabulary), np.int64), 0
        for b in slices(batches):
            for text in b.column(0).to_pylist():
                at, known = known_in(vocabulary, set(terms(text)))
                seen[at[known]] += 1
                n += 1
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(seen[some], n))], ["term", "n"])

    told = docs.select(docs["text"]).mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out, total = np.zeros(len(vocabulary), np.int64), 0
    term, n = (told[c].to_numpy() for c in ("term", "n"))
    out[term[term >= 0]] = n[term >= 0]
    total = int(n[term < 0].sum())
    return total, out


def learn(docs: DataFrame, labels: DataFrame, sample: int = 4096, held_out: int = 0, k: int = 15, floor: float = 0.05) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic).

    Labels whose remainder is held_out, that are null, or whose id is null or isn't in docs teach nothing; of repeated labels the
    larger counts.  An id teaches once, however often it stands in docs: by the smallest of its texts, null ones being
    empty.  Long texts count whole.  Without labels, or from empty tables, every score is 0.1.  Other columns are ignored.
    """
    told = examples_of(docs, labels, sample, held_out)
    ids, toxic = (told[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("_id", "_toxic"))
    listed = told["terms"].combine_chunks()
    spelt = listed.flatten().dictionary_encode()
    hashes = hashed(spelt.dictionary.to_pylist(), len(spelt.dictionary))
    vocabulary, rank = np.unique(hashes, return_inverse=True)
    term, times = rank[spelt.indices.to_numpy()].astype(np.int64), told["counts"].combine_chunks().flatten().to_numpy()
    sizes = np.diff(listed.offsets.to_numpy()) if len(listed) else np.zeros(0, int)
    del told, listed, spelt, hashes, rank
    n = np.array([len(toxic) - toxic.sum(), toxic.sum()], float)
    base = (n[1] + 0.1) / (n.sum() + 1)
    if not len(vocabulary):
        return Model(vocabulary, np.zeros(0), Index([], [], [], 0), [], (int(n.sum()), int(n[1])), base, k)
    label = np.repeat(toxic, sizes)
    seen = np.stack([np.bincount(term[label == y], minlength=len(vocabulary)) for y in (0, 1)]).astype(float)
    total, df = frequencies(docs, vocabulary)
    weight = (np.log((1 + total) / (1 + df)) + 1) * stretches(seen, n, floor)
    model = Model(vocabulary, weight, Index([], [], [], 0), [], (0, 0), base, k)
    # Rows of the same counts are one entry.
    entries: dict[bytes, list[tuple[int, int]]] = {}
    vectors: list[Vector] = []
    none = [0, 0]
    for i, y, end, size in zip(ids.tolist(), toxic.tolist(), np.cumsum(sizes).tolist(), sizes.tolist(), strict=True):
        if not size:
            none = [none[0] + 1, none[1] + y]
            continue
        at, counts = term[end - size : end], times[end - size : end]
        order = np.argsort(at)
        key = hashlib.blake2b(np.stack([at[order], counts[order]]).tobytes(), digest_size=16).digest()
        if key not in entries:
            vectors.append(model.of(at, counts))
        entries.setdefault(key, []).append((i, y))
    own = list(entries.values())
    index = Index(vectors, [len(x) for x in own], [sum(y for _, y in x) for x in own], len(vocabulary))
    model = Model(vocabulary, weight, index, [own[i][0][0] for i in index.order], (none[0], none[1]), base, k)
    x, y = [], []
    for place, i in enumerate(index.order):
        near = index.nearest(vectors[i], k, place)
        for label in {label for _, label in own[i]}:
            share = model.share(near, place, label)
            times = sum(1 for _, other in own[i] if other == label)
            x += [math.log(share / (1 - share))] * times
            y += [label] * times
    if len(set(y)) == 2:
        model.curve = logistic(np.array(x), np.array(y, float))
    del entries, vectors, own
    trim()
    return model


def score(docs: DataFrame, model: Model, shown: int = 3) -> DataFrame:
    """docs with the columns toxicity (0 to 1) and evidence (the nearest `shown` labelled examples: doc_id, cosine, share of
    toxic among equal ones), from the text alone; columns of these names are replaced.

    Null and empty texts score as texts without a known term do, and have no evidence.  Long texts are read whole.  One pass
    without a shuffle; all other columns and repeated rows stay.
    """

    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("toxicity", pa.float64()), ("evidence", pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.float64())])))])
        for texts in batches:
            out = [model.judge(t, shown) for i in range(0, len(texts), 512) for t in texts.slice(i, 512).to_pylist()]
            yield pa.array([{"toxicity": s, "evidence": [dict(zip(("doc_id", "cosine", "toxic"), e, strict=True)) for e in es]} for s, es in out], kind)
        trim()

    told = F.arrow_udf(judged, f"struct<toxicity:double,evidence:{EVIDENCE}>")(docs["text"])
    own = [c for c in docs.columns if c not in ("toxicity", "evidence")]
    rows = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in own]).alias("_doc"), told.alias("_told"))
    return rows.select(*[F.col("_doc").getField(c).alias(c) for c in own], F.col("_told.toxicity").alias("toxicity"), F.col("_told.evidence").alias("evidence"))
