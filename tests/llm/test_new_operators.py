"""Alignment, resampling and packing on small hand-made rows, against plain computations."""

import math
import random
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martkit.llm import alignment, bpe, packing, resampling, urls
from martkit.llm.common import ordered
from martkit.llm.queries import VOCABULARIES, VOCABULARY

ODD = [None, "", " \n\t", "a", "é" * 50, "word " * 3000, "x" * 20_000, "same text here", "same text here", "▁x", "日本語 👍🏽",
       "<|endoftext|> <s> </s> <0x41>", "a\x00b\x1cc", "two\nlines\n\nhere"]


def documents(spark, texts=ODD):
    """Rows with columns whose names the operators use themselves; the last id comes twice and once as NULL."""
    rows = [(i, t, i, "b", "c") for i, t in enumerate(texts)]
    rows += [(len(texts), "again and again", 0, "b", "c")] * 2 + [(None, "no id", 0, "b", "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, row long, _row string, Length string")


# numbering

def test_ordered_numbers_all_rows_in_order(spark):
    rows = [(random.Random(i).randint(0, 9), i, "x") for i in range(500)] + [(3, i, "x") for i in range(500, 900)]
    df = spark.createDataFrame(rows, "k long, at long, part string")
    got = [tuple(r) for r in ordered(df, [F.col("k") * -1, F.col("at")], "place").select("place", "k", "at", "part").collect()]
    want = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert sorted(got) == [(i, *r) for i, r in enumerate(want)]
    assert ordered(df.limit(0), [F.col("k")], "place").count() == 0


# alignment

@pytest.fixture(scope="module")
def aligner():
    paths = VOCABULARIES
    return alignment.Aligner(alignment.Bytewise(open(paths.bytewise).read(), open(paths.ranks, "rb").read(), paths.pattern),
                             alignment.Piecewise(open(paths.piecewise, "rb").read()))


def test_galloping_finds_the_first_place_not_below():
    rng = np.random.default_rng(5)
    for _ in range(200):
        values = np.unique(rng.integers(0, 400, rng.integers(0, 80)))
        keys = np.unique(rng.integers(0, 420, rng.integers(0, 80)))
        start = np.zeros(len(keys), np.int64)
        assert alignment.gallop(keys, values, start).tolist() == np.searchsorted(values, keys).tolist()
        assert alignment.ranks(keys, values, start).tolist() == np.searchsorted(values, keys).tolist()


def test_fast_vocabulary_equals_the_files_own(aligner):
    rng, letters = random.Random(3), "ab cdEé'ßst!?123\n \t\rñ’—<|>\x1c\x85\xa0_ŉǅİ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(1500)]
    texts += [f"a{chr(c)}b {chr(c)}1{chr(c)}" for c in [*range(0x250), *range(0x2010, 0x2028)]]
    assert all(alignment.SETTLED.fullmatch(t) for t in texts)
    slow = [e.ids for e in aligner.a.slow.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert aligner.a.encode(texts) == slow


def plain(aligner, text):
    """Groups and links by walking over all pairs of tokens."""
    (a,), (b,) = aligner.whole([text])

    def spans(ids, pieces):
        ends = np.cumsum([len(pieces[i]) for i in ids]).tolist()
        return list(zip([0, *ends[:-1]], ends, strict=True)) if ids else []

    left, right = spans(a, aligner.a.pieces), spans(b, aligner.b.pieces)
    common = sorted({e for _, e in left} & {e for _, e in right})
    groups = [(sum(e <= c for _, e in left), sum(e <= c for _, e in right)) for c in common]
    links = [(a[i], b[j]) for i, x in enumerate(left) for j, y in enumerate(right) if x[0] < y[1] and y[0] < x[1]]
    return a, b, groups, links


def test_alignment_of_odd_texts(spark, aligner):
    texts = [t for t in ODD if len(t or "") < 200] + ["Thé  quick brown 12345 foxes...jumped\n\n\tover"]
    docs = documents(spark, texts)
    every = [(r.doc_id, r.text) for r in docs.collect()]
    plains = {t: plain(aligner, t) for _, t in every}
    counts = {}
    for _, t in every:
        for x in plains[t][3]:
            counts[x] = counts.get(x, 0) + 1
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    for heads in (1, 50, alignment.HEADS):  # with few and with many broadcast pairs
        got = sorted(alignment.agreement(docs, VOCABULARIES, heads).collect(), key=str)
        want = []
        for key, t in every:
            a, b, groups, links = plains[t]
            parts, at = [], (0, 0)
            for g in groups:
                parts.append(",".join(map(str, a[at[0]:g[0]])) + "|" + ",".join(map(str, b[at[1]:g[1]])))
                at = g
            digest = sha256(";".join(parts).encode()).hexdigest() if parts else ""
            want.append((key, len(a), len(b), len(groups), len(links), digest, sum(counts[x] == most[x[1]] for x in links),
                         sum(counts[x] for x in links)))
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    spans = {r.doc_id: r for r in alignment.groups(docs, VOCABULARIES).collect()}
    for key, t in every:
        a, b, groups, _ = plains[t]
        assert (spans[key].a, spans[key].b, [tuple(e) for e in spans[key].ends]) == (a, b, groups)


def test_alignment_of_long_and_no_texts(spark):
    out = {r.doc_id: r for r in alignment.agreement(documents(spark), VOCABULARIES).collect()}
    assert out[5].n_groups > 2000 and out[6].n_a > 500 and out[0].n_a == out[1].n_a == out[9].n_links == 0
    assert out[0].groups_sha256 == "" and out[9].count_sum == 0
    assert alignment.agreement(documents(spark).limit(0), VOCABULARIES).count() == 0


# resampling

def plain_words(text):
    return (text or "").encode().translate(resampling.WORD_BYTES).split()


def plain_draw(docs, target, features, percent, least, seed):
    def runs(text):
        w = plain_words(text)
        return [zlib.crc32(b" ".join(w[i:i + n])) % features.buckets
                for n in range(1, features.longest + 1) for i in range(len(w) - n + 1)]

    s, t = [0] * features.buckets, [0] * features.buckets
    for _, text in docs:
        for b in runs(text):
            s[b] += 1
    for text in target:
        for b in runs(text):
            t[b] += 1
    gain = [math.floor(1000 * math.log(((y + 1.0) * (sum(s) + features.buckets)) / ((x + 1.0) * (sum(t) + features.buckets))))
            for x, y in zip(s, t, strict=True)]
    rows = []
    for key, text in docs:
        own = [gain[b] for b in runs(text)]
        h = int(sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(own) // len(own) if own else 0
        rows.append((key, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text))))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[:len(able) * percent // 100]
    return rows, drawn


@pytest.mark.parametrize("longest", [1, 3])
def test_draw_matches_plain_counting(spark, longest):
    rng, vocabulary = random.Random(longest), [f"Word{i}" for i in range(60)] + ["naïve", "Z", "9"]
    lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9))) for _ in range(40)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9))) for _ in range(150)] + ODD
    target = [rng.choice(lines) + "\n" + rng.choice(lines) for _ in range(10)] + [None, ""]
    docs = documents(spark, texts)
    features = resampling.Features(longest, 500)
    every = [(r.doc_id, r.text) for r in docs.collect()]
    rows, drawn = plain_draw(every, target, features, 30, 3, 7)
    goal = spark.createDataFrame([(x, 1) for x in target], "text string, n long")
    out = resampling.draw(docs, goal, 30, 3, 7, features).collect()
    assert sorted(str((r.doc_id, r.n_features, r.weight, r.score, r.n_words)) for r in out) == sorted(str(r) for r in rows)
    ranked = sorted((r for r in out if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.score, r.doc_id) for r in ranked] == [(r[3], r[0]) for r in drawn]


def test_draw_of_few_or_no_rows(spark):
    goal = spark.createDataFrame([("a b",)], "text string")
    docs = documents(spark)
    assert resampling.draw(docs.limit(0), goal).count() == 0
    assert {r["rank"] for r in resampling.draw(docs.where("doc_id < 3"), goal).collect()} == {None}
    assert resampling.draw(docs, goal.limit(0)).count() == docs.count()
    same = spark.createDataFrame([(1, "one two three")] * 40, "doc_id long, text string")
    ranks = sorted(r["rank"] for r in resampling.draw(same, goal, 50, 1).collect() if r["rank"])
    assert ranks == list(range(1, 21))


# packing

def padding(made, size):
    cost = packing._costs(size)
    return sum((cost[sum(p)] - sum(p)) * n for p, n in made)


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_once(seed):
    rng, size = random.Random(seed), 64
    histogram = {rng.randint(1, size): rng.randint(1, 3000 if seed % 2 else 3) for _ in range(rng.randint(1, 40))}
    made, seen = packing.plan(histogram, size), {}
    for lengths, n in made:
        assert sum(lengths) <= size and n > 0
        for length in lengths:
            seen[length] = seen.get(length, 0) + n
    assert seen == histogram


def test_plan_is_near_the_bound():
    histogram = {7: 900, 9: 400, 13: 650, 20: 300, 31: 1000, 33: 20, 50: 10}
    lengths = np.array(sorted(histogram))
    columns, uses, bound = packing.patterns(lengths, np.array([histogram[v] for v in lengths.tolist()], float), 64)
    assert np.allclose(columns @ uses, [histogram[v] for v in lengths.tolist()]) and (columns.T @ lengths <= 64).all()
    spent = sum(packing._costs(64)[sum(p)] * n for p, n in packing.plan(histogram, 64))
    assert bound <= spent <= bound * 1.01 + 3 * 64
    assert padding(packing.plan({32: 5, 16: 3}, 64), 64) == 0  # powers of two stand alone without padding
    assert packing.plan({}, 64) == [] and packing.plan({64: 3}, 64) == [([64], 3)]


def test_packed_sequences_give_the_ids_back(spark):
    docs = documents(spark)
    parts = packing.pieces(docs, VOCABULARY, 256).withColumn("offset", F.lit("old"))
    packed = packing.pack(parts, 256).cache()
    library = Tokenizer.from_file(VOCABULARY)
    want = sorted([*library.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs.collect())
    by_doc = {}
    for r in packed.collect():
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    flat = [i for own in by_doc.values() for _, ids in sorted(own) for i in ids]
    assert len(flat) == sum(map(len, want)) and sorted(flat) == sorted(i for w in want for i in w)
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert sorted(whole) == list(range(len(whole))) and max(map(len, whole.values())) <= 256
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == r.ids
    assert packing.pack(parts.limit(0), 256).count() == 0


def test_hot_length_is_dealt_whole(spark):
    parts = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 40).otherwise(F.col("id") % 100 + 1).alias("length"))
    out = packing.pack(parts, 100).toPandas()
    assert len(out) == 5000
    for _, own in out.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() <= 100


def test_stores_take_sliced_texts():
    store = bpe._encoder(open(VOCABULARY).read()).chunks
    texts = pa.array(["skip me", None, "keep this  text", ""]).slice(1)
    ids, counts = packing.words.encode(texts, store)
    library = Tokenizer.from_file(VOCABULARY)
    assert ids.tolist() == library.encode("keep this text", add_special_tokens=False).ids and counts.tolist() == [0, len(ids), 0]
    assert [len(s) for s in packing.words.slices(pa.array(["aa", None, "bbb", "c"]), 3)] == [2, 1, 1]


# url filters

def plain_rules(rows, mining):
    """Minimal confident sets of tokens among all subsets of all urls."""
    seen = {}
    for tokens, blocked in rows:
        for m in range(1, 1 << len(tokens)):
            key = frozenset(t for i, t in enumerate(tokens) if m >> i & 1)
            n, bad = seen.get(key, (0, 0))
            seen[key] = n + 1, bad + blocked
    sure = {k: bad / n for k, (n, bad) in seen.items() if bad >= mining.least and bad >= mining.confidence * n}
    return {k: c for k, c in sure.items() if not any(o < k for o in sure)}


@pytest.mark.parametrize("clean", [1, 100])
def test_mined_rules_equal_all_subsets(spark, clean):
    rng, rows = random.Random(clean), []
    for i in range(300):
        names = [n for n in ("ads", "win", "cash", "free", "blog", "news") if rng.random() < 0.5]
        rows.append(("/".join(names), {"ads", "win", "cash", "free"} <= set(names) or (rng.random() < 0.1)))
    rows += [("blog/news/shop", False)] * 30 * clean + [("ads/ads2/spam/spam2", True)] * 7
    df = spark.createDataFrame([(f"http://h.org/{p}", b) for p, b in rows], "url string, blocked boolean")
    mining = urls.Mining(least=5, confidence=0.7)
    want = plain_rules([(["host:h", "host:org", *sorted({f"path:{x}" for x in p.split("/") if x})], b) for p, b in rows], mining)
    paths = sorted({p for p, _ in rows}) + ["ads/win/cash/free/other", "ads/win/cash", "unseen", "spam", "spam2/blog"]
    pages = spark.createDataFrame([(i, f"http://h.org/{p}", "x", "y") for i, p in enumerate(paths)],
                                  "page_id long, url string, _says string, Tokens string")
    got = {r.page_id: r for r in urls.judge(pages, df, (), mining).collect()}
    assert len(got) == len(paths) and any(len(k) == 4 for k in want)
    for i, p in enumerate(paths):
        own = {"host:h", "host:org", *(f"path:{x}" for x in p.split("/") if x)}
        fits = [c for k, c in want.items() if k <= own]
        assert (got[i].verdict, got[i].confidence) == (("block", max(fits)) if fits else ("allow", None)), p
        assert (got[i]._says, got[i].Tokens) == ("x", "y")
