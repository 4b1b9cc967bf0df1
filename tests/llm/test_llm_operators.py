"""Operators on small hand-made rows: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martkit.llm import bpe, licenses, mixing, parsing, quality, sharding, simhash, toxicity, urls, warc, words
from martkit.llm.queries import URL_RULES, VOCABULARY

ODD = [None, "", " \n\t", "a", "é" * 50, "word " * 3000, "x" * 20_000, "same text here", "same text here"]


def documents(spark, texts=ODD, start=0):
    rows = [(start + i, t, "en", f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


# sharding

def test_weighted_shards_get_their_share_and_move_little(spark):
    rows = spark.range(20_000)
    weights = [1.0, 2.0, 5.0]
    a = rows.select("id", sharding.rendezvous(F.col("id"), weights).alias("a"),
                    sharding.rendezvous(F.col("id"), [*weights, 2.0]).alias("b")).toPandas()
    share = a.groupby("a").size() / len(a)
    assert np.allclose(share, [0.125, 0.25, 0.625], atol=0.02)
    moved = a[a.a != a.b]
    assert set(moved.b) == {3} and abs(len(moved) / len(a) - 0.2) < 0.02


def test_slots_are_gapless_with_repeated_and_null_rows(spark):
    rows = [(None, 1), (None, 1), (5, 1), (5, 1), (5, 2)] * 40 + [(i, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, v long").withColumn("shard", sharding.rendezvous(F.col("k"), [1.0] * 3))
    out = sharding.slots(df.withColumn("slot", F.lit("old")), "shard", ["k", "v"]).toPandas()
    assert len(out) == len(rows)
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert sharding.slots(df.limit(0), "shard", ["k", "v"]).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("k"), [1.0, 0.0])


# simhash

def test_links_find_every_near_pair():
    rng = np.random.default_rng(1)
    for lanes in (1, 2):
        base = rng.integers(0, 1 << 63, (40, lanes), dtype=np.uint64)
        flips = [np.uint64(1) << rng.integers(0, 64, dtype=np.uint64) for _ in range(400)]
        rows = np.array([base[i % 40] ^ np.where(np.arange(lanes) == i % lanes, f, np.uint64(0)) for i, f in enumerate(flips)])
        rows = np.unique(np.concatenate([rows, base]), axis=0)
        for split in (None, len(rows) // 2):
            left, right = (rows, None) if split is None else (rows[:split], rows[split:])
            root = simhash.links(left, right, 4)
            up = list(range(len(rows)))

            def find(x, up=up):
                while up[x] != x:
                    x = up[x]
                return x

            for i in range(len(rows)):
                for j in range(i + 1, len(rows)):
                    if split is not None and (i < split) == (j < split):
                        continue
                    if np.bitwise_count(rows[i] ^ rows[j]).sum() <= 4:
                        up[max(find(i), find(j))] = min(find(i), find(j))
            assert [find(i) for i in range(len(rows))] == root.tolist()


def test_components_of_a_long_path(spark):
    names = [f"{i:016x}" for i in range(300)]
    random.Random(3).shuffle(names)
    edges = spark.createDataFrame(list(zip(names, names[1:], strict=False)), "a string, b string")
    out = simhash.components(edges).collect()
    assert len(out) == 299 and {r.root for r in out} == {min(names)}
    assert simhash.components(edges.limit(0)).count() == 0


def test_near_groups_on_odd_texts(spark):
    df = documents(spark).withColumn("root", F.lit(1)).withColumn("fingerprint", F.lit("old"))
    rows = {r.doc_id: r for r in simhash.near_groups(df, radius=4, width=5).collect()}
    assert len(rows) == len(ODD)
    assert {rows[i].component for i in (0, 1, 2)} == {"0" * 16}
    assert rows[7].component == rows[8].component != rows[3].component
    assert simhash.near_groups(df.limit(0), radius=4, width=5).count() == 0


def test_blocks_of_any_size_give_the_same_components(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = sorted({f"{b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)):016x}" for b in base for _ in range(8)})
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint string")
    found = [sorted(map(tuple, simhash.components(simhash.linked(df, 4, block)).collect())) for block in (7, 10_000)]
    assert found[0] == found[1] != []


def test_components_name_the_smallest_fingerprint(spark):
    # the upper bit is set in half of them: longs must keep the order of the hex texts
    texts = ["a b c d e", "a b c d e", "f g h i", "", *(f"w{i} x y z" for i in range(40))]
    rows = simhash.near_groups(documents(spark, texts), radius=24, width=4).collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    for r in rows:
        group = [prints[o.doc_id] for o in rows if o.component == r.component]
        assert int(r.component, 16) == min(group)
    assert len({r.component for r in rows}) < len(set(prints.values()))


# urls

def test_written_rules_and_urls_without_host(spark):
    rows = [(1, "http://A.net/x"), (2, "http://example.net/en/1"), (3, "http://b.example.com/de/x?q"), (4, "http://o.org/fr/"),
            (5, None), (6, "no scheme/"), (7, "ftp://a.net"), (8, "x://notexample.com/de/"), (9, "s://h?p/q://net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("confidence", F.lit("old"))
    none = pages.select("url", F.lit(None).cast("boolean").alias("blocked"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, none, URL_RULES).collect()}
    assert got == {1: ("a.net", "/x", "net/", "block"), 2: ("example.net", "/en/1", "example.net/en/", "allow"),
                   3: ("b.example.com", "/de/x", "example.com/de/", "block"), 4: ("o.org", "/fr/", "org/fr/", "allow"),
                   5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("a.net", "", None, "allow"),
                   8: ("notexample.com", "/de/", None, "allow"), 9: ("h", "", None, "allow")}
    assert urls.judge(pages.limit(0), none.limit(0), URL_RULES).count() == 0


def test_mined_pairs_block_and_single_tokens_do_not(spark):
    good = [f"http://shop.io/{w}/{i}" for w in ("cheap", "pills") for i in range(30)]
    bad = [f"http://shop.io/cheap/pills/{i}" for i in range(20)]
    known = spark.createDataFrame([(u, False) for u in good] + [(u, True) for u in bad], "url string, blocked boolean")
    pages = spark.createDataFrame([(1, "http://other.io/pills/cheap/x"), (2, "http://other.io/cheap"), (1, "http://q.io/")],
                                  "page_id long, url string")
    got = sorted((r.page_id, r.verdict) for r in urls.judge(pages, known, ()).collect())
    assert got == [(1, "allow"), (1, "block"), (2, "allow")]


# parsing

def test_parsing_is_locally_consistent():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    a, b, c, d = parsing.sketches([text, "zzz" + text, text[100:], "".join(rng.choice("ijklmnop ") for _ in range(4000))])
    assert parsing.likeness(a, b) > 0.85 and parsing.likeness(a, c) > 0.8 and parsing.likeness(a, d) == 0


def test_parsing_shrinks_and_ends():
    for text in ("", "a", "ab", "a" * 5000, "ab" * 5000, "abc" * 999 + "x"):
        assert len(parsing.sketches([text])[0]) == parsing.BINS
    names = parsing._mixed(np.frombuffer(random.Random(1).randbytes(20_000), np.uint8).astype(np.uint64))
    doc = np.zeros(len(names), int)
    again, _ = parsing._level(names, doc)
    assert len(names) / 4 < len(again) <= len(names) / 2 + 1
    assert np.diff(np.flatnonzero(parsing._begins(names, doc))).max() <= 12


def test_compare_with_next_on_odd_rows(spark):
    df = documents(spark).unionAll(documents(spark, ["tie one", "tie two"], 4)).withColumn("part", F.lit(1))
    out = parsing.compare_with_next(df).collect()
    assert len(out) == len(ODD) + 2 and len({r.fingerprint for r in out if r.n_chars == 0}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    single = parsing.compare_with_next(documents(spark, ["only one text"])).collect()
    assert len(single) == 1 and single[0].near_next == 1.0
    assert parsing.compare_with_next(df.limit(0)).count() == 0


# toxicity

def test_pairs_of_harmless_terms_are_learnt():
    rng = random.Random(4)
    texts, label = [], []
    for _ in range(3000):
        words = [f"w{rng.randrange(40)}" for _ in range(6)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join(words + ["louse"] * insult + ["folk"] * group))
        label.append(float(insult and group))
    ids, size = toxicity._slots(pa.array(texts), toxicity.Terms())
    label = np.array(label)
    machine = toxicity.fit(ids, size, label, epochs=20)
    predicted = machine.score(ids, size) >= 0.5
    assert (predicted == (label > 0)).mean() > 0.98


@pytest.mark.parametrize("share, rule", [(0.8, lambda a, b: a and b), (0.5, lambda a, b: a != b)])
def test_pairs_of_terms_near_the_base_rate_are_learnt(share, rule):
    rng = random.Random(4)
    texts, label = [], []
    for _ in range(3000):
        words = [f"w{rng.randrange(40)}" for _ in range(6)]
        insult, group = rng.random() < 0.5, rng.random() < share
        texts.append(" ".join(words + ["louse"] * insult + ["folk"] * group))
        label.append(float(rule(insult, group)))
    ids, size = toxicity._slots(pa.array(texts), toxicity.Terms())
    label = np.array(label)
    assert (label[2000:] == (toxicity.fit(ids[:size[:2000].sum()], size[:2000], label[:2000], epochs=20)
                             .score(ids[size[:2000].sum():], size[2000:]) >= 0.5)).mean() > 0.98


def test_held_out_accuracy_and_odd_texts(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(30)) + (" nasty brute" if i % 5 == 0 else "") for i in range(600)]
    docs = documents(spark, texts).withColumn("score", F.lit("old"))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    rows = toxicity.judge(docs.unionByName(documents(spark, ODD, 1000).withColumn("score", F.lit(""))), labels).collect()
    assert len(rows) == 600 + len(ODD) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == int(r.doc_id % 5 == 0) for r in held]) > 0.97
    assert toxicity.judge(docs.limit(0), labels.limit(0)).count() == 0
    assert {r.predicted for r in toxicity.judge(docs, labels.limit(0)).collect()} == {0}


def fitted_on(monkeypatch, docs, labels, sample):
    """Labels and term lists of the rows that the machine is fitted on."""
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda ids, size, label: seen.append((size, label)))
    toxicity.train(docs, labels, sample)
    return seen[0]


def explicit(machine, rows):
    """Log-odds by a double loop over the pairs of terms."""
    out = []
    for ids in rows:
        terms = [i for i in ids if machine.value[i]]
        norm = math.sqrt(sum(machine.value[i] ** 2 for i in terms))
        x = {i: machine.value[i] / max(1.0, norm / toxicity.LENGTH) for i in terms}
        total = machine.bias + sum(machine.weight[i] * x[i] for i in terms)
        for k, i in enumerate(terms):
            for j in terms[k + 1:]:
                total += sum(float(a) * float(b) for a, b in zip(machine.factor[i], machine.factor[j])) * x[i] * x[j]
        out.append(total)
    return out


def terms_of(rows):
    return np.array([i for r in rows for i in r], np.int64), np.array([len(r) for r in rows], np.int64)


def test_scores_equal_a_double_loop_over_term_pairs():
    rng = np.random.default_rng(4)
    value = np.where(rng.random(toxicity.SLOTS) < 0.7, rng.random(toxicity.SLOTS) * 3, 0.0)
    machine = toxicity.Machine(-0.3, value, rng.normal(0, 0.3, toxicity.SLOTS), rng.normal(0, 0.2, (toxicity.SLOTS, toxicity.FACTORS)))
    rows = [sorted(rng.choice(500, int(n), replace=False)) for n in (0, 1, 2, 7, 40, 200, 0)]
    wanted = [1 / (1 + math.exp(-max(-30.0, min(30.0, t)))) for t in explicit(machine, rows)]
    assert np.allclose(machine.score(*terms_of(rows)), wanted, rtol=0, atol=1e-9)


def test_one_step_follows_the_gradient_by_finite_differences():
    """All rows in one batch: each parameter moves by the numerical slope of the loss, scaled as the adaptive step says."""
    rng = np.random.default_rng(5)
    rows = [sorted(rng.choice(12, 5, replace=False)) for _ in range(40)]
    label = np.array([float(3 in r and 7 in r) for r in rows])
    rate, decay = 0.1, 1e-4
    value = toxicity.values(*terms_of(rows), label)
    weight, factor = np.zeros(toxicity.SLOTS), np.random.default_rng(7).normal(0, 0.01, (toxicity.SLOTS, toxicity.FACTORS))
    bias = math.log(label.mean() / (1 - label.mean()))

    def loss(b):
        odds = np.array(explicit(toxicity.Machine(b, value, weight, factor), rows))
        return float(np.sum(np.logaddexp(0, odds) - label * odds))

    def slope(table, at, h=1e-5):
        own = table[at]
        table[at] = own + h
        above = loss(bias)
        table[at] = own - h
        below = loss(bias)
        table[at] = own
        return (above - below) / (2 * h) + decay * own

    made = toxicity.fit(*terms_of(rows), label, epochs=1, rate=rate, decay=decay, batch=len(rows))
    g = (loss(bias + 1e-5) - loss(bias - 1e-5)) / 2e-5
    assert abs(made.bias - (bias - rate * g / math.sqrt(1 + g * g))) < 1e-6
    for i in np.flatnonzero(value[:12]):
        g = slope(weight, i)
        assert abs(made.weight[i] - (weight[i] - rate * g / math.sqrt(1 + g * g))) < 1e-6
        for f in range(toxicity.FACTORS):
            g = slope(factor, (i, f))
            assert abs(made.factor[i, f] - (factor[i, f] - rate * g / math.sqrt(1 + g * g))) < 1e-6


def test_sample_keeps_the_ratio_of_the_classes(spark, monkeypatch):
    docs = documents(spark, [f"word{i} and more" for i in range(2000)])
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(2000)], "doc_id long, toxic int")
    for sample in (toxicity.Sample(6000, 14000), toxicity.Sample(100, 400), toxicity.Sample(40, 1400)):
        size, label = fitted_on(monkeypatch, docs, labels, sample)
        assert abs(label.mean() - 0.1) < 0.015 and label.sum() <= sample.toxic and (1 - label).sum() <= sample.clean
        assert len(label) > 350


def test_rows_of_one_id_are_one_row_of_the_sample(spark, monkeypatch):
    docs = documents(spark, [f"word{i} and more" for i in range(50)])
    many = spark.range(400).select(F.lit(7).cast("long").alias("doc_id"), F.concat_ws(" ", F.lit("copy"), "id").alias("text"))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(50)] + [(7, 0)] * 9, "doc_id long, toxic int")
    size, _ = fitted_on(monkeypatch, docs.select("doc_id", "text").unionByName(many), labels, toxicity.Sample())
    assert len(size) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(50))


# quality

def test_measures_by_hand(spark):
    texts = [*ODD, "a b c a b c d", "l\nl\n\nl \n m", "#a $b"]
    rows = {r.doc_id: r for r in quality.measured(documents(spark, texts).withColumn("n_words", F.lit("old"))).collect()}
    n = len(ODD)
    assert (rows[0].n_words, rows[1].n_words, rows[2].n_words) == (0, 0, 0)
    assert (rows[5].n_words, rows[5].n_repeat_words, rows[5].word_chars) == (3000, 3000, 12_000)
    assert (rows[n].n_repeat_words, rows[n].n_words) == (6, 7)
    assert rows[n + 1].n_dup_lines == 1 and rows[n + 2].n_symbols == 2


def test_cascade_order_changes_nothing(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["word", "other", "#", "LOUD", "thing."]) + str(rng.randrange(99)) for _ in range(80))
             for _ in range(40)] + ["LOUD " * 3 + " ".join(f"CAPS{i}" for i in range(60))]
    rows = quality.measured(documents(spark, texts))
    rules = quality.rules()
    a, b = (sorted(r[0] for r in rows.where(quality.cascade(chain)).select("doc_id").collect())
            for chain in (rules, rules[::-1]))
    assert a == b and len(a) < len(texts)
    assert {r.name for r in quality.ordered(rows, rules)} == {r.name for r in rules}
    assert quality.judge(documents(spark).limit(0)).count() == 0
    assert not any(r.kept for r in quality.judge(documents(spark)).collect())


def test_cheap_rules_that_reject_come_first(spark):
    """A costly rule that rejects nothing is last, although it is given first; a rule that only repeats another's rejections too."""
    rows = quality.measured(documents(spark, [f"{'word ' * 400}{i}" for i in range(60)]))
    text = F.col("text")
    for _ in range(40):
        text = F.regexp_replace(text, "(w|o)+r", "wor")
    half = F.col("doc_id") % 2 == 0
    rules = [quality.Rule("costly", F.length(text) < 0), quality.Rule("half", half), quality.Rule("third", F.col("doc_id") % 3 == 0)]
    assert [r.name for r in quality.ordered(rows, rules)] == ["half", "third", "costly"]
    verdicts = [{"a": i < 6, "b": i < 5, "c": i >= 8} for i in range(10)]
    named = [quality.Rule(n, half) for n in "bca"]
    assert [r.name for r in quality.placed(named, dict.fromkeys("abc", 1.0), verdicts)] == ["a", "c", "b"]
    assert [r.name for r in quality.placed(named, {"a": 4.0, "b": 1.0, "c": 1.0}, verdicts)] == ["b", "c", "a"]


def test_the_sample_of_rules_is_bounded_and_spread(spark):
    rows = spark.range(0, 20_000, 1, 40)
    for _ in range(2):
        ids = [r.id for r in quality.sampled(rows, 400).collect()]
        assert 250 < len(ids) <= 400 and len({i // 500 for i in ids}) > 25
    assert quality.sampled(rows.limit(10), 400).count() == 10 and quality.sampled(rows.limit(0), 400).count() == 0


# licences

def test_licences_by_place(spark):
    texts = [*ODD, "MIT license mit License", "by the Apache license; general public license", "the \u212a mit-license",
             "Licensed under CC BY-NC 4.0. x Released under the MIT License.", "license mit nc by cc", "cc by nc"]
    rows = {r.doc_id: r for r in licenses.scan(documents(spark, texts).withColumn("labels", F.lit(1))).collect()}
    n = len(ODD)
    assert all(rows[i].labels == "" and rows[i].score == 0 for i in range(n))
    assert (rows[n].n_base, rows[n].first_word, rows[n].last_word, rows[n].base_labels) == (2, 0, 2, "mit")
    assert rows[n + 1].base_labels == "apache,gpl" and rows[n + 2].first_word == 2
    assert rows[n + 3].labels == "cc-by-nc,mit" and rows[n + 3].score == 1.0
    assert rows[n + 4].labels == ""
    assert rows[n + 5].labels == "cc-by-nc" and 0 < rows[n + 5].score < 1
    assert licenses.scan(documents(spark).limit(0)).count() == 0


# warc

PAGES = [(1, "u\n1", "aa"), (1, "u", "aa"), (2, None, None), (None, "n", "aa"), (None, "m", "zz"), (None, "m2", "zz"),
         (5, "x", "\u00e9\r\n\r\nWARC/1.1\r\n"), (9, "y", ""), (7, "long", "z" * 200_000)]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("kind", F.lit(1))
    folders = [str(tmp_path / name) for name in ("a", "b")]
    for folder, roll in zip(folders, (150, 150), strict=True):
        listed = warc.write(pages, folder, roll_bytes=roll).collect()
        assert sum(r.records for r in listed) == len(PAGES) and len(listed) > 3
    files = [{r.file: r.sha256 for r in spark.read.parquet(f"{f}/manifest").collect()} for f in folders]
    assert files[0] == files[1]  # the same bytes again
    rows = warc.read(spark, folders[0]).collect()
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in rows) == sorted([
        ("1", "response", "None", 2), ("1", "revisit", "1", 2), ("2", "response", "None", 0), ("9", "revisit", "2", 0),
        ("None", "revisit", "1", 2), ("None", "response", "None", 2), ("None", "revisit", "None", 2),
        ("5", "response", "None", 16), ("7", "response", "None", 200_000)])


def test_warc_ignores_files_outside_the_manifest(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write(spark.createDataFrame(PAGES, "page_id long, url string, html string"), folder)
    (tmp_path / "w" / "part-000099-00000.warc.gz").write_bytes(b"broken")
    assert warc.read(spark, folder).count() == len(PAGES)
    empty = str(tmp_path / "e")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), empty)
    assert warc.read(spark, empty).count() == 0


# mixing

def test_targets_are_reshared(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 500), ("c", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes, (5, 2, 1), 1.5, 2).collect()}
    # a, b, c, NULL weigh 5, 2, 1, 5; all is 2265; a is full at 20, c at 0, NULL at 1000
    assert got == {"a": 20.0, "b": 1245.0, "c": 0.0, None: 1000.0}


def test_mix_takes_targets_from_whole_documents(spark):
    rng = random.Random(9)
    rows = [(i, None if i % 50 == 0 else i // 2, rng.choice(["x", "y", None, "z"]), rng.randrange(60)) for i in range(400)]
    df = spark.createDataFrame(rows, "row long, doc_id long, source string, size long").withColumn("taken", F.lit("old"))
    out = mixing.mix(df, block=64).toPandas()
    again = mixing.mix(df.repartition(5), block=64).toPandas()
    assert sorted(out.taken) == sorted(again.taken) and len(out) == 400
    assert (out.taken <= 2 * out["size"]).all()
    for _, part in out.groupby("source", dropna=False):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 1
    assert mixing.mix(df.limit(0)).count() == 0


def test_schedule_is_even(spark):
    sources = spark.createDataFrame([(0, 50), (1, 30), (2, 0), (3, 20)], "source_no int, need long")
    slots = mixing.schedule(sources).toPandas().sort_values("slot").reset_index(drop=True)
    assert slots.groupby("source_no").size().to_dict() == {0: 50, 1: 30, 3: 20}
    for _, part in slots.groupby("source_no"):
        assert sorted(part.block) == list(range(len(part))) and part.block.is_monotonic_increasing
    half = slots.iloc[:50].groupby("source_no").size().to_dict()
    assert abs(half[0] - 25) <= 4 and abs(half[1] - 15) <= 4 and abs(half[3] - 10) <= 4


# bpe

def test_segment_trees_merge_as_the_library_does():
    library, encoder = Tokenizer.from_file(VOCABULARY), bpe.Encoder(bpe.Vocabulary(open(VOCABULARY).read()))
    rng, letters = random.Random(1), "ab cde\u00e9'\u00dfst!?123\n\U0001f600\u00f1\u03a3\u0130\u65e5<|>\u0301\x1c\x85\u2028"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 150))) for _ in range(800)]
    texts += ["<|startoftext|>a<|endoftext|>", "a" * 3000, "!" * 500 + "th" * 400, "", None, "IT'S ''S \u0391\u03a3"]
    flat, count = encoder.encode(pa.array(texts))
    at = 0
    for text, n in zip(texts, count, strict=True):
        assert flat[at:at + n].tolist() == library.encode(text or "", add_special_tokens=False).ids
        at += n


def test_every_code_point_is_cut_as_the_library_does():
    library, encoder = Tokenizer.from_file(VOCABULARY), bpe.Encoder(bpe.Vocabulary(open(VOCABULARY).read()))
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b C{c} x" for c in points[:0x600]] + ["".join(points[i:i + 200]) for i in range(0, len(points), 200)]
    flat, count = encoder.encode(pa.array(texts))
    ends = np.cumsum(count)
    for e, n, ids in zip(ends, count, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert flat[e - n:e].tolist() == ids.ids


def test_full_stores_lose_nothing_and_keep_what_is_used():
    encoder, library = bpe.Encoder(bpe.Vocabulary(open(VOCABULARY).read())), Tokenizer.from_file(VOCABULARY)
    encoder.words.room = encoder.chunks.room = 3
    for text in ("one two three four five", "five six seven one", "two <|endoftext|> two", "one"):
        assert encoder.encode(pa.array([text]))[0].tolist() == library.encode(text, add_special_tokens=False).ids
    asked = []
    store = words.Store(lambda names: asked.append(names) or [n.encode() for n in names], room=2)
    for i in range(6):
        assert store.get(["often", f"rare{i}"]) == [b"often", f"rare{i}".encode()]
    assert sum("often" in names for names in asked) == 1


def test_encode_and_decode_columns(spark):
    vocab = bpe.vocabulary(spark, VOCABULARY)
    df = documents(spark).withColumn("ids", bpe.encode(F.col("text"), vocab)).withColumn("back", bpe.decode(F.col("ids"), vocab))
    rows = {r.doc_id: r for r in df.collect()}
    library = Tokenizer.from_file(VOCABULARY)
    for i, text in enumerate(ODD):
        assert rows[i].ids == library.encode(text or "", add_special_tokens=False).ids
        assert rows[i].back == library.decode(rows[i].ids, skip_special_tokens=False)
    odd = spark.createDataFrame([([320, -1, 99_999_999, 320],), (None,), ([],)], "ids array<int>")
    assert [r[0] for r in odd.select(bpe.decode(F.col("ids"), vocab)).collect()] == ["a</w> a</w>", "", ""]
    assert df.limit(0).count() == 0
