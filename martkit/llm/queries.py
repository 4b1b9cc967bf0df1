"""The registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, bpe, licenses, mixing, oracles, packing, parsing, quality, resampling, sharding, simhash, toxicity,
               urls, warc)
from .common import n_blank_words, read, shared_dir

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text."""
    vocab = bpe.vocabulary(spark, VOCABULARY)
    ids = read(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text"), vocab).alias("ids"))
    both = ids.withColumn("decoded", bpe.decode(F.col("ids"), vocab))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


SHARDS = 8


def op1_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight equal shards, by doc_id."""
    text = F.coalesce("text", F.lit(""))
    rows = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"), sharding.rendezvous(F.col("doc_id"), [1.0] * SHARDS).alias("shard"),
        sharding.rendezvous(F.col("doc_id"), [1.0] * (SHARDS + 1)).alias("grown_shard"))
    return sharding.slots(rows, "shard", ["doc_id", "size", "text_crc32"])


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 64-bit fingerprints of 4-word shingles differ in at most 4 bits."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = simhash.near_groups(docs, radius=4, width=4)
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "component").select("doc_id", "fingerprint", "component_id")


URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url; a labelled url is one whose number in the path is a labelled document."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    labels = read(spark, sf_dir, "labels")
    marks = labels.select(F.col("doc_id").alias("_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    number = F.regexp_extract(urls.parts(F.col("url"))[1], r"/([0-9]{1,18})(?:/|\.|$)", 1)
    known = pages.withColumn("_id", F.when(number != "", number).cast("long")).join(marks, "_id")
    rows = urls.judge(pages, known.select("url", "blocked"), URL_RULES)
    return rows.select("page_id", "host", "path", "rule", "verdict", "confidence")


def op4_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edits."""
    return parsing.compare_with_next(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = toxicity.judge(docs, read(spark, sf_dir, "labels"))
    return rows.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every whole text."""
    return quality.judge(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every whole text."""
    return licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives in the shared folder, and read back."""
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(read(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).drop("url")


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed 5 : 2 : 1 to 150% of their words."""
    rows = read(spark, sf_dir, "documents").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", n_blank_words(F.col("text")).alias("size"))
    return mixing.mix(rows).drop("row", "source")


VOCABULARIES = alignment.Vocabularies(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                      public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of tokens of two vocabularies of every whole text, and how its links agree with the corpus."""
    return alignment.agreement(read(spark, sf_dir, "documents"), VOCABULARIES)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all documents, drawn by their likeness to the benchmark texts."""
    return resampling.draw(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("n_words")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids in sequences of 2048."""
    return packing.pack(packing.pieces(read(spark, sf_dir, "documents"), VOCABULARY, with_ids=False))


QUERIES = {f.__name__: f for f in (
    op1_rendezvous, op2_simhash, op3_urls, op4_parsing, op5_toxicity, op6_quality, op7_licenses, op8_warc, op9_mix, op10_bpe,
    op11_alignment, op12_resampling, op13_packing)}
ORACLES = {"op1_rendezvous": oracles.OP1, "op3_urls": oracles.op3(URL_RULES), "op6_quality": oracles.OP6,
           "op7_licenses": oracles.op7(), "op8_warc": oracles.OP8, "op9_mix": oracles.OP9, "op12_resampling": oracles.OP12}
