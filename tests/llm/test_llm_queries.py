"""Registered operator queries against their DuckDB SQL, or a plain computation where SQL has no words for them."""

import base64
import hashlib
import itertools
import math
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from martkit.llm import bpe, parsing, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet").collect()


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for file in os.listdir(SF):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    df = queries.QUERIES[name](spark, SF)
    result = db.execute(queries.ORACLES[name])
    names, cols = [c[0] for c in result.description], sorted(df.columns)
    assert cols == sorted(names)
    mine = sorted(tuple(canonical(r[c]) for c in cols) for r in df.collect())
    theirs = sorted(tuple(canonical(r[names.index(c)]) for c in cols) for r in result.fetchall())
    assert mine and mine == theirs


def test_simhash_components_match_all_pairs(spark):
    got = {r.doc_id: r for r in queries.op2_simhash(spark, SF).collect()}
    prints = {}
    for r in table(spark, "documents"):
        words = (r.text or "").encode().lower().split()
        shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[r.doc_id] = sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))
    ids = sorted(prints)
    up = dict(zip(ids, ids, strict=True))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    assert {i: (got[i].fingerprint, got[i].component_id) for i in ids} == {
        i: (f"{prints[i]:016x}", root(i)) for i in ids}


def test_parsing_matches_document_by_document(spark):
    got = {r.doc_id: r for r in queries.op4_parsing(spark, SF).collect()}
    docs = sorted(((r.doc_id, r.text or "") for r in table(spark, "documents")), reverse=True)
    assert len(got) == len(docs)
    for i, (key, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        n = len(text) // 3
        edit = text[:len(text) - n] + following[:n]
        a, e, f = parsing.sketches([text, edit, following])
        r = got[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert (r.fingerprint, r.near_edited, r.near_next) == (
            a.astype(">u2").tobytes().hex(), parsing.likeness(a, e), parsing.likeness(a, f))
    assert np.mean([r.near_edited for r in got.values()]) > 5 * np.mean([r.near_next for r in got.values()])


MASK = (1 << 64) - 1


def mixed(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> shift)) * factor & MASK
    return x ^ (x >> 31)


def phrases(names):
    """One level of parsing, symbol by symbol: runs, then stretches cut at local maxima of tossed labels."""
    out, stretch = [], []

    def cut_stretch():
        labels = list(stretch)
        for _ in range(parsing.ROUNDS):
            tossed = [labels[0] & 1]
            for left, own in zip(labels, labels[1:]):
                place = next((b for b in range(64) if (left ^ own) >> b & 1), None)
                tossed.append(own & 1 if place is None else 2 * place + (own >> place & 1))
            labels = tossed
        phrase = []
        for i, name in enumerate(stretch):
            if 2 <= i < len(stretch) - 1 and labels[i] > labels[i - 1] and labels[i] >= labels[i + 1]:
                out.append(phrase)
                phrase = []
            phrase.append(name)
        out.append(phrase)
        stretch.clear()

    for _, run in itertools.groupby(names):
        run = list(run)
        if len(run) == 1:
            stretch += run
            continue
        if stretch:
            cut_stretch()
        out.append(run)
    if stretch:
        cut_stretch()
    return out


def sketch(text):
    """The bins of one text, level by level."""
    names, level, least = [mixed(ord(c) + 1) for c in text], 0, {}
    while names:
        if level >= parsing.FIRST:
            for name in names:
                h = mixed((name + level) & MASK)
                least[h >> 58] = min(least.get(h >> 58, MASK), (h << 6) & MASK)
            if len(names) == 1:
                break
        names = [mixed((sum(mixed((n + 0x9E3779B97F4A7C15 * (i + 1)) & MASK) for i, n in enumerate(p)) + len(p)) & MASK)
                 for p in phrases(names)]
        level += 1
    return [(least[b] >> 48) % 65535 + 1 if b in least else 0 for b in range(parsing.BINS)]


def alike(a, b):
    used = [(x, y) for x, y in zip(a, b) if x or y]
    return sum(x == y for x, y in used) / len(used) if used else 1.0


def test_parsing_matches_a_parser_that_goes_symbol_by_symbol(spark):
    got = {r.doc_id: r for r in queries.op4_parsing(spark, SF).collect()}
    docs = sorted(((r.doc_id, r.text or "") for r in table(spark, "documents")), reverse=True)[:60]
    prints = [sketch(text) for _, text in docs]
    for i, (key, text) in enumerate(docs[:-1]):
        n = len(text) // 3
        edit = sketch(text[:len(text) - n] + docs[i + 1][1][:n])
        r = got[key]
        assert r.fingerprint == "".join(f"{v:04x}" for v in prints[i])
        assert r.edited_fingerprint == "".join(f"{v:04x}" for v in edit)
        assert (r.near_edited, r.near_next) == (alike(prints[i], edit), alike(prints[i], prints[i + 1]))
    odd = ["", "a", "aa", "ab", "aab", "abab" * 9, "a" * 50, "xyz" * 40 + "aaaa" + "zyx" * 3, "\U0001f600é\n\t" * 7]
    assert [list(map(int, s)) for s in parsing.sketches(odd)] == [sketch(t) for t in odd]


def test_bpe_matches_the_library(spark):
    got = {r.doc_id: r for r in queries.op10_bpe(spark, SF).collect()}
    library = Tokenizer.from_file(queries.VOCABULARY)
    for r in table(spark, "documents"):
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def test_alignment_matches_token_by_token(spark):
    got = {r.doc_id: r for r in queries.op11_alignment(spark, SF).collect()}
    a = Tokenizer.from_file(queries.VOCABULARIES.bytewise)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=queries.VOCABULARIES.piecewise)
    letters = {c: i for i, c in enumerate(bpe.byte_letters())}
    held, counts = {}, Counter()
    for r in table(spark, "documents"):
        text = r.text or ""
        left = a.encode(" " + text, add_special_tokens=False) if text else None
        ids_a = left.ids if left else []
        raw_a = [bytes(letters[c] for c in t) for t in left.tokens] if left else []
        ids_b = b.encode(text) if text else []
        names = [b.id_to_piece(i) for i in ids_b]
        raw_b = [bytes([int(n[3:5], 16)]) if b.is_byte(i) else n.replace("\u2581", " ").encode() for i, n in zip(ids_b, names)]
        if b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            ids_a, ids_b, raw_a, raw_b = [], [], [], []
        groups, links, i, j, at, own = [], [], 0, 0, [0, 0], ([], [])
        while i < len(ids_a) or j < len(ids_b):
            links.append((ids_a[i], ids_b[j]))
            ends = at[0] + len(raw_a[i]), at[1] + len(raw_b[j])
            if ends[0] <= ends[1]:
                own[0].append(str(ids_a[i]))
                i, at[0] = i + 1, ends[0]
            if ends[1] <= ends[0]:
                own[1].append(str(ids_b[j]))
                j, at[1] = j + 1, ends[1]
            if ends[0] == ends[1]:
                groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
                own = ([], [])
        held[r.doc_id] = (len(ids_a), len(ids_b), groups, links)
        counts.update(links)
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    for key, (n_a, n_b, groups, links) in held.items():
        r = got[key]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, len(groups), len(links))
        assert r.groups_sha256 == (hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        assert r.n_best == sum(counts[x] == most[x[1]] for x in links) and r.count_sum == sum(counts[x] for x in links)
    assert len(got) == len(held)


def test_packing_holds_every_id_once(spark):
    rows = queries.op13_packing(spark, SF).collect()
    library = Tokenizer.from_file(queries.VOCABULARY)
    docs = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 1] for r in table(spark, "documents")}
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = docs[r.doc_id]
        assert r.doc_tokens == len(ids) and 1 <= r.length <= 2048
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
        parts[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, ids in docs.items():
        own = sorted(parts[key])
        assert [s for s, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(n for _, n in own) == len(ids)
    padding = 0
    for own in sequences.values():
        own.sort()
        total = sum(n for _, n in own)
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and total <= 2048
        padding += 0 if total & (total - 1) == 0 else 2048 - total
    assert sorted(sequences) == list(range(len(sequences)))
    assert padding <= 0.01 * sum(map(len, docs.values())) + 2048


def test_toxicity_scores_every_document(spark):
    rows = queries.op5_toxicity(spark, SF).collect()
    assert len(rows) == len(table(spark, "documents"))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_warc_payload_digests(spark):
    got = {r.page_id: r.payload_digest for r in queries.op8_warc(spark, SF).collect()}
    for r in table(spark, "pages"):
        assert got[r.page_id] == base64.b32encode(hashlib.sha1((r.html or "").encode()).digest()).decode()
