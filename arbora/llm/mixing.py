"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree over permuted blocks.

Each source is dealt into blocks by a keyed hash of its ids, which is a permutation.  Its target, in words, says how often
all of its blocks are drawn and how many more, to the word: one document may be taken in part.  The numbers of blocks,
one for each source, stand at the root of a binary tree over the output shards; each node splits its vector by a draw from
the multivariate hypergeometric distribution, so that each leaf holds exact quotas, and each shard takes the next blocks of
the permutation: no block goes twice to any copy.  Within a shard rows are ordered by a keyed hash.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arbora.llm.common import dropped, text_of, written

WORD = r"[^\x20\x09-\x0D]+"
#: Into so many parts the blocks are cut in which quotas end.
PARTS = 4096


def targets(sizes: list[int], weights: list[int], share: Fraction, most: int) -> list[Fraction]:
    """share of all sizes by weight; what exceeds most x a source's size is shared anew among the others."""
    out: list[Fraction] = [Fraction(0)] * len(sizes)
    open_, left = set(range(len(sizes))), share * sum(sizes)
    while open_:
        each = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if each * weights[i] > most * sizes[i]}
        for i in full or open_:
            out[i] = Fraction(most * sizes[i]) if full else each * weights[i]
        left -= sum((out[i] for i in full), Fraction(0))
        open_ = open_ - full if full else set()
    return out


def split(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """quotas[source] -> [shard, source]: exact sums, each node's left part a multivariate hypergeometric draw."""
    if shards == 1:
        return quotas[None, :]
    low = shards // 2
    take = int(quotas.sum() * low // shards)
    left = rng.multivariate_hypergeometric(quotas, take, method="marginals") if take else np.zeros_like(quotas)
    return np.concatenate([split(left, low, rng), split(quotas - left, shards - low, rng)])


class Plan:
    """What plan() has found: sized (the rows with size, hash and block), by source what is drawn of it, and all words drawn."""

    def __init__(self, sized: DataFrame, by_source: DataFrame, words: int):
        self.sized, self.by_source, self.words = sized, by_source, words


def keyed(docs: DataFrame, seed: int, blocks: int) -> list:
    """The hash that permutes a source's documents, and its leading bits: the block."""
    h = F.xxhash64(F.lit(seed), docs["doc_id"].cast("string"))
    return [h.alias("_h"), F.shiftrightunsigned(h, 64 - (blocks.bit_length() - 1)).cast("int").alias("_block") if blocks > 1 else F.lit(0).alias("_block")]


def plan(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: Fraction = Fraction(3, 2), most: int = 2, seed: int = 7, shards: int = 64, blocks: int = 4096, max_sources: int = 100_000, near: float = 0.0) -> Plan:
    """Targets and draws for docs (doc_id, source, text).

    Sources by code point, null last, take `weights` in turn.  The catalogue of sources (not documents) comes to the
    driver; more than max_sources of them is an error.  A source's blocks are summed in their order in one task, which
    is `blocks` rows at most.  The block in which a source's quota ends is cut into PARTS by the hash's next bits, and only
    the part in which it ends is sorted by document.  That last document is taken in part, to the word; but whole, or not
    at all, where this misses the target by no more than the share `near`.
    """
    if blocks & (blocks - 1):
        raise ValueError("blocks is a power of two")
    spark = docs.sparkSession
    size = F.regexp_count(text_of(docs["text"]), F.lit(WORD)).cast("long")
    sized = written(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), size.alias("size"), *keyed(docs, seed, blocks)), "sized")
    summed = written(sized.groupBy("source", "_block").agg(F.sum("size").alias("words")), "blocks")
    sources = summed.groupBy("source").agg(F.sum("words").alias("words")).limit(max_sources + 1).collect()
    if len(sources) > max_sources:
        raise ValueError(f"there are more than {max_sources} sources")
    sources.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["words"] for r in sources]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, most)
    words = [round(g) for g in goal]
    whole = [w // s if s else 0 for w, s in zip(words, sizes, strict=True)]
    extra = [w - k * s for w, k, s in zip(words, whole, sizes, strict=True)]
    rows = [(r["source"], s, float(g), k, e) for r, s, g, k, e in zip(sources, sizes, goal, whole, extra, strict=True)]
    told = spark.createDataFrame(rows, "source string, source_size long, target double, copies int, extra long")

    def ends(sums: DataFrame, rest: DataFrame, by: str) -> DataFrame:
        """sums (source, by, words), rest (s, extra) -> (s, by, rest): where a source's words reach extra, and what is lacking before."""
        upto = F.sum("words").over(Window.partitionBy("source").orderBy(by))
        rows = sums.withColumn("upto", upto).join(F.broadcast(rest), F.col("source").eqNullSafe(F.col("s")))
        return rows.where("upto >= extra and upto - words < extra").select("s", by, (F.col("extra") - F.col("upto") + F.col("words")).alias("rest"))

    # A row for each source at most, of which there are max_sources.
    in_block = ends(summed, told.where("extra > 0").select(F.col("source").alias("s"), "extra"), "_block")
    part = F.shiftrightunsigned("_h", 64 - (blocks.bit_length() - 1) - (PARTS.bit_length() - 1)).bitwiseAND(PARTS - 1).cast("int")
    inside = written(sized.join(F.broadcast(in_block), sized["source"].eqNullSafe(F.col("s")) & (sized["_block"] == in_block["_block"])).select("source", sized["_block"], "_h", "size", "rest", part.alias("_part")), "inside")
    by_part = inside.groupBy("source", "_part").agg(F.sum("size").alias("words"))
    in_part = ends(by_part, inside.groupBy(F.col("source").alias("s")).agg(F.first("rest").alias("extra")), "_part").withColumnRenamed("_part", "p")
    rows_ = inside.drop("rest").join(F.broadcast(in_part), F.col("source").eqNullSafe(F.col("s")) & (F.col("_part") == F.col("p")))
    w = Window.partitionBy("source").orderBy("_h")
    by_hash = rows_.groupBy("source", "_block", "_h").agg(F.sum("size").alias("size"), F.count("*").alias("rows"), F.first("rest").alias("rest")).withColumn("upto", F.sum("size").over(w))
    last = {r["source"]: r for r in by_hash.where("upto >= rest and upto - size < rest").collect()}
    dropped(inside)

    units = np.array([k * blocks + (last[r[0]]["_block"] + 1 if r[0] in last else 0) for r, k in zip(rows, whole, strict=True)], np.int64)
    quotas = split(units, shards, np.random.default_rng(seed)) if len(units) else np.zeros((shards, 0), np.int64)
    firsts = np.concatenate([np.zeros((1, len(units)), np.int64), quotas.cumsum(axis=0)])
    found = []
    for i, (source, s, g, k, _) in enumerate(rows):
        at = last.get(source)
        lacking = at["rest"] - at["upto"] + at["size"] if at else 0
        part = lacking // at["rows"] if at else 0
        if at and min(lacking, at["size"] - lacking) <= near * g:
            part = at["size"] if 2 * lacking >= at["size"] else 0
        found.append((source, s, g, k, at["_block"] if at else -1, at["_h"] if at else 0, part, firsts[:, i].tolist()))
    dropped(summed)
    return Plan(sized, spark.createDataFrame(found, "_source string, source_size long, target double, copies int, end_block int, end_h long, part long, firsts array<long>"), sum(words))


def _drawn(rows: DataFrame, by_source: DataFrame, blocks: int) -> DataFrame:
    """rows (source, size, _h, _block) with draws: for each time that a shard draws the row's block, copy, words and shard.

    Blocks are counted over all copies of a source; each shard draws from its first to the next shard's.  The last block
    drawn may be in part, in which case only its rows up to the end have words.  What is broadcast has a row for each
    source, of which plan() bounds the number.
    """
    unit = lambda copy: copy.cast("long") * blocks + F.col("_block")
    shard = lambda copy: F.size(F.filter("firsts", lambda x: x <= unit(copy))) - 1
    # By unsigned value, as blocks and their parts are.
    unsigned = lambda c: F.col(c).bitwiseXOR(F.lit(-(1 << 63)))
    last = F.when(unsigned("_h") < unsigned("end_h"), F.col("size")).when(F.col("_h") == F.col("end_h"), F.least("part", "size")).otherwise(F.lit(0))
    words = lambda copy: F.when((copy == F.col("copies")) & (F.col("_block") == F.col("end_block")), last).otherwise(F.col("size"))
    draws = F.transform(F.sequence(F.lit(0), F.col("copies")), lambda c: F.struct(c.alias("copy"), words(c).cast("long").alias("words"), shard(c).cast("int").alias("shard")))
    # firsts ends with the number of all blocks drawn: what is beyond no shard draws.
    draws = F.filter(draws, lambda d: (d["shard"] < F.size("firsts") - 1) & ((d["copy"] < F.col("copies")) | (d["words"] > 0)))
    return rows.join(F.broadcast(by_source), rows["source"].eqNullSafe(by_source["_source"])).withColumn("draws", draws).drop("_source")


def taken(docs: DataFrame, seed: int = 7, blocks: int = 4096, **how: object) -> DataFrame:
    """A row for each document: doc_id, source, size, source_size, target, taken (words, repeats counted), shards.

    taken is the sum of what the shards draw, and shards tells which, one for each copy.  Each source's taken words are
    its target, rounded; no document is taken more than `most` times over.  Null and empty texts have size 0; null
    sources are one source, the last; null ids share a hash, so that they are taken alike; repeated rows of an id are too
    (the last one's words are divided among them, rounded down).
    """
    p = plan(docs, seed=seed, blocks=blocks, **how)
    words = F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"])
    return _drawn(p.sized, p.by_source, blocks).select("doc_id", "source", "size", "source_size", "target", words.alias("taken"), F.transform("draws", lambda d: d["shard"]).alias("shards"))


def mixed(docs: DataFrame, seed: int = 7, blocks: int = 4096, **how: object) -> DataFrame:
    """The mix itself: doc (a struct of the columns of docs, whatever their names) once for each copy taken, with copy (from
    0), words, shard and place.

    The document in which a source's quota ends may have its first words only (`words` of them, see plan()); all others are
    whole.  Documents of no words are in every copy of their source that is whole: null texts stay null, empty ones
    empty.  Null sources are one source, null ids are taken alike, repeated rows are too.  No rows give no rows.  dealt()
    puts it in the order of shards and places, in which it is shuffled within shards.
    """
    return _mixed(docs, plan(docs, seed=seed, blocks=blocks, **how), seed, blocks)


def _mixed(docs: DataFrame, p: Plan, seed: int, blocks: int) -> DataFrame:
    rows = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("doc"), docs["source"].cast("string").alias("source"), F.regexp_count(text_of(docs["text"]), F.lit(WORD)).cast("long").alias("size"), *keyed(docs, seed, blocks))
    drawn = _drawn(rows, p.by_source, blocks).withColumn("draw", F.explode("draws"))
    words = F.col("draw.words")
    cut = F.expr(r"array_join(slice(regexp_extract_all(doc.text, '[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*', 0), 1, cast(draw.words as int)), '')")
    whole = F.col("doc").withField("text", F.when(words >= F.col("size"), F.col("doc.text")).otherwise(cut))
    return drawn.select(whole.alias("doc"), F.col("draw.copy").alias("copy"), words.alias("words"), F.col("draw.shard").alias("shard"), F.xxhash64(F.lit(seed), F.col("_h"), F.col("draw.copy"), F.col("doc.text")).alias("place"))


def dealt(docs: DataFrame, seed: int = 7, blocks: int = 4096, shards: int = 64, task_words: int = 2_000_000, most_ranges: int = 32_768, **how: object) -> DataFrame:
    """What mixed() returns, by shard and in the order of places within: a range for each shard at least, and for every
    `task_words` of the mix, so that no task holds a whole shard that is large; beyond `most_ranges` ranges these grow instead
    (a range is sorted with spill).  A place is a hash of id, copy and text, so that rows of one id, or of none, are dealt to
    all ranges.  Nulls, empty and long texts, ties and repeated rows are as in mixed(); no rows give none."""
    p = plan(docs, seed=seed, blocks=blocks, shards=shards, **how)
    parts = max(shards, min(most_ranges, -(-p.words // task_words)))
    return _mixed(docs, p, seed, blocks).repartitionByRange(parts, "shard", "place").sortWithinPartitions("shard", "place")
