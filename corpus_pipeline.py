"""A training corpus from documents: toxic ones go, one of each group of near-duplicates stays, personal data becomes
pseudonyms, sources are mixed to their weights, and the mix is packed.

Each stage takes (spark, docs, sf_dir).  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.llm import minhash_dedup, mixing, packing, pii, toxicity
from arbora.llm.common import table, text_of, written
from arbora.llm.queries import PII_KEY, TOKENIZER


def carried(docs: DataFrame) -> DataFrame:
    """(doc: a struct of all columns, whatever their names, text), so that no operator's column meets one of docs."""
    return docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("doc"), docs["text"].alias("text"))


def unpacked(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of docs from the struct doc, with a new text and its n_chars (null of a null text)."""
    new = {"text": F.col(text), "n_chars": F.when(F.col(text).isNotNull(), F.length(text).cast(dict(docs.dtypes).get("n_chars", "long")))}
    return rows.select(*[(new[c] if c in new else F.col("doc").getField(c)).alias(c) for c in docs.columns])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half, learned from the table labels.

    Null and empty texts score as the sample's texts without a term; long texts are read whole; repeated rows are judged
    alike and all kept or none; null ids are judged by their text.  No documents give none; all columns stay as they are.
    """
    model = toxicity.learn(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.score(carried(docs), model, shown=0).where("toxicity < 0.5").select("doc.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id.

    Repeated rows of one id and text stay as one; rows of one id that differ in text are documents of their own.  Null,
    empty and wordless texts are no copies of anything, and rows without an id stay, all of them.  Long texts are
    compared whole.  No documents give none; all columns stay as they are.
    """
    found = minhash_dedup.answers(docs.select("doc_id", "text"))
    answers = written(found.where("doc_id is not null").groupBy("doc_id", "h").agg(F.max("kept").alias("kept"), F.count("*").alias("n")).where("kept"), "kept")
    rows = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("doc"), docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text_of(docs["text"])).alias("h"))
    key = ["doc_id", "h"]
    kept = rows.join(answers.where("n = 1").select(*key).hint("merge"), key, "left_semi").select("doc")
    repeated = answers.where("n > 1").select(*key)
    if not repeated.isEmpty():
        kept = kept.union(rows.join(repeated, key, "left_semi").dropDuplicates(key).select("doc"))
    return kept.union(rows.where("doc_id is null").select("doc")).select("doc.*")


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms, and n_chars as it is then.

    Null texts stay null, empty ones empty; long texts are read whole; repeated rows change alike.  No documents give none;
    all other columns stay as they are.
    """
    return unpacked(pii.pseudonymised(carried(docs), PII_KEY), docs, "text")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the shares of their weights: documents as often as they are drawn, by shard and shuffled within.

    The last document of a source is whole, or not there, where that misses the source's target by 0.5 % at most; else it
    has its first words.  Null sources are one source; null ids are drawn alike, repeated rows are too; null and empty texts
    have no words and come with each whole copy of their source.  No documents give none; all columns stay.
    """
    return unpacked(mixing.dealt(docs, near=0.005).withColumn("_text", F.col("doc.text")), docs, "_text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens.

    Null and empty texts are the end's id alone; long texts are cut; repeated rows are packed each by itself; null ids stay
    null.  No documents give no pieces; other columns are ignored.
    """
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [("toxicity", without_toxic), ("near_duplicates", without_copies), ("pii", pseudonymised), ("mixing", mixed), ("packing", packed)]

#: SQL can express neither the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
