"""From raw documents to token ids: toxicity, quality, near-duplicates, source mix, BPE.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before kept. Rows are
numbered once, in a copy in the shared folder, where a stage joins them later. Stages 1 to 4 return the columns of their
input. Columns of any name may ride along; columns doc_id, text, source and n_chars are used.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import bpe, mixing, quality, simhash, toxicity
from martkit.llm.common import blank_words, numbered, read, shared_dir
from martkit.llm.queries import VOCABULARY

SHINGLE, RADIUS = 4, 4  #: words of a shingle, bits in which linked fingerprints may differ: those of op2_simhash
ORACLE_SQL = None  # trained weights, fingerprints and merges are tested against brute force


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score accepts; the machine is fitted on the labelled ones among them."""
    machine = spark.sparkContext.broadcast(toxicity.train(docs, read(spark, sf_dir, "labels")))
    return docs.where(toxicity.score(F.col("text"), machine) < 0.5)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows = docs.select(F.struct("*").alias("doc"), "text")
    return quality.judge(rows).where("kept").select("doc.*")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id.

    Documents are linked if their 64-bit SimHash fingerprints of 4-word shingles differ in at most 4 bits; a group is all
    that can be reached over links. Documents without words are one group.
    """
    rows = numbered(docs.select(F.struct("*").alias("doc")), "row")
    groups = simhash.near_groups(rows.select("row", "doc.doc_id", "doc.text"), RADIUS, SHINGLE)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"]
    kept = groups.groupBy("component").agg(first.alias("row")).select("row")
    return rows.join(kept, "row", "left_semi").select("doc.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed 5 : 2 : 1 to 150% of all words, in the order of the schedule's slots.

    A document comes once per turn that takes it, at the first slot that does. A turn that takes part of a document, one per
    source, has its first words, joined by spaces.
    """
    rows = numbered(docs.select(F.struct("*").alias("doc")), "row")
    words = blank_words(F.col("doc.text"))
    sizes = rows.select("row", "doc.doc_id", "doc.source", F.size(words).cast("long").alias("size"))
    _, pieces = mixing.chosen(sizes)
    turns = pieces.groupBy("row", "turn").agg(F.sum("words").alias("part"), F.min("slot").alias("slot"))
    each = rows.join(turns, "row").repartitionByRange("slot", "row", "turn").sortWithinPartitions("slot", "row", "turn")
    part = F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), " ")
    text = F.when(F.col("part") == F.size(words), F.col("doc.text")).otherwise(part)
    made = {"text": text, "n_chars": F.length(text).cast("long")}
    return each.select(*[made.get(c.lower(), F.col("doc").getField(c)).alias(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    vocab = bpe.vocabulary(spark, VOCABULARY)
    ids = docs.select("doc_id", "source", bpe.encode(F.col("text"), vocab).alias("ids"))
    return ids.withColumn("decoded", bpe.decode(F.col("ids"), vocab)).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("toxicity", clean), ("quality", good), ("near_duplicates", distinct), ("mix", mixed), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each result is written to the shared folder and read again."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"

    def step(docs: DataFrame, stage: tuple) -> DataFrame:
        name, function = stage
        function(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return reduce(step, STAGES, read(spark, sf_dir, "documents"))
