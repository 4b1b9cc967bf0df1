"""The corpus pipeline on driver rows and on planted cases."""

import os
import random

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def article(seed, words=300):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.randrange(40)}a"
                    for _ in range(words)) + "."


@pytest.fixture
def table(spark, tmp_path):
    def make(texts, extra=False):
        rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            for name in ("score", "kept", "component", "ids", "taken", "n_words", "size", "_row", "_size", "_part", "row",
                         "doc", "slot", "turn", "_taken", "Component2", "_HASH", "_base", "_words"):
                df = df.withColumn(name, F.lit("mine"))
        path = str(tmp_path / f"docs{len(texts)}{extra}")
        df.write.parquet(path)
        return spark.read.parquet(path)
    return make


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")
def test_run_and_stage_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == COLUMNS
        if name != "mix":
            assert 0 < docs.count() < whole
            whole = docs.count()
    rows = pipeline.run(spark, SF).collect()
    assert len(rows) == docs.count() and all(r.n_tokens == len(r.ids) for r in rows)


def plain_print(text):
    """SimHash of 4-word shingles with Python integers."""
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    runs = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_keepers(texts):
    """The first document of each component, over all pairs."""
    prints, up = [plain_print(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = up[i], up[j]
                up = [min(a, b) if x in (a, b) else x for x in up]
    return {i for i, x in enumerate(up) if i == x}


def test_near_copies_go_and_clean_documents_stay(spark, table):
    texts = [article(i) for i in range(40)]
    near = texts[3].split(" ")
    near[50] = "changed"
    texts += [texts[1], texts[2] + " ", " ".join(near), None, "", article(3, 60) + " " + article(99, 240)]
    docs = table(texts, extra=True)
    kept = {r.doc_id: r for r in pipeline.distinct(spark, docs, SF).collect()}
    assert set(kept) == plain_keepers(texts) == {*range(40), 43, 45} and kept[0].component == "mine"
    assert pipeline.distinct(spark, docs.limit(0), SF).count() == 0


def test_groups_are_those_of_all_pairs(spark, table):
    rng, texts = random.Random(7), []
    for k in range(30):  # copies of one to eight changed words, and copies of these
        words = article(k, 200).split(" ")
        texts.append(" ".join(words))
        for n in (1, 2, 4, 8):
            for at in rng.sample(range(len(words)), n):
                words[at] = f"new{n}"
            texts.append(" ".join(words))
    texts += ["one two", "One TWO", "three", "", None, " \n", article(1, 3000)]
    keepers = plain_keepers(texts)
    assert 40 < len(keepers) < 150
    assert {r.doc_id for r in pipeline.distinct(spark, table(texts), SF).collect()} == keepers


def test_texts_that_share_a_passage_stay(spark, table):
    passage = article(500, 60)
    texts = [article(i, 200) + " " + passage for i in range(20)]
    assert {r.doc_id for r in pipeline.distinct(spark, table(texts), SF).collect()} == set(range(20))


def moving(spark, docs):
    """The same rows, dealt otherwise each time they are read."""
    @F.pandas_udf("int")
    def place(i: pd.Series) -> pd.Series:
        return pd.Series(np.random.default_rng().integers(0, 8, len(i)), dtype="int32")

    return docs.repartition(8, place.asNondeterministic()("doc_id"))


def test_rows_keep_their_numbers_when_read_otherwise(spark, table):
    texts = [article(i, 100) for i in range(30)]
    docs = moving(spark, table(texts + texts))
    kept = sorted(r.text for r in pipeline.distinct(spark, docs, SF).collect())
    assert kept == sorted(texts)
    sizes = [article(i, 60 + i) for i in range(30)]
    mixed = pipeline.mixed(spark, moving(spark, table(sizes)), SF).collect()
    assert abs(sum(len(r.text.split()) for r in mixed) - 1.5 * sum(len(t.split()) for t in sizes)) <= 2


def test_quality_keeps_prose_and_extra_columns(spark, table):
    docs = table([article(1), "short", "### " * 200, article(2)], extra=True)
    out = pipeline.good(spark, docs, SF).collect()
    assert {r.doc_id for r in out} == {0, 3} and out[0].n_words == "mine"


def test_mix_repeats_and_cuts_documents(spark, table):
    texts = [article(i, 100) for i in range(20)] + [None, ""]
    out = pipeline.mixed(spark, table(texts, extra=True), SF).collect()
    whole = {i: t for i, t in enumerate(texts)}
    full = [r for r in out if r.text == whole[r.doc_id]]
    assert len(out) - len(full) <= 2 and all(r.n_chars == len(r.text) for r in out)
    assert abs(sum(len(r.text.split()) for r in out) - 3000) <= 2 and out[0].taken == "mine"


def test_the_mix_is_written_in_the_order_of_the_schedule(spark, table, tmp_path):
    """Every stretch of the output holds the sources' shares: three files of 600 documents, each near the whole's mix."""
    docs = table([article(i, 60) for i in range(1800)])
    pipeline.mixed(spark, docs.withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3)), SF).write.parquet(str(tmp_path / "mix"))
    files = sorted((tmp_path / "mix").glob("part-*.parquet"))
    rows = pd.concat([pd.read_parquet(f) for f in files], ignore_index=True)
    whole = rows.groupby("source").size() / len(rows)
    for k in range(0, len(rows) - 400, 200):  # 400 documents are about a dozen blocks
        share = rows[k:k + 400].groupby("source").size() / 400
        assert (share.reindex(whole.index, fill_value=0) - whole).abs().max() < 0.15


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")
def test_stages_on_empty_tables(spark, table):
    docs = table([article(1)]).limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
