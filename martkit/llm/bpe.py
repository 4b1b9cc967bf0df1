"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of a word's tree hold (merge rank, position) of each adjacent pair, every inner node the smaller of its
children, so the root is the leftmost pair of lowest rank. A merge changes three leaves; their paths to the root are
recomputed. The trees of many words lie in one array and advance together; a long word has a tree of its own.

A batch's distinct chunks between white space, and their distinct words, are encoded once and remembered in two
generations (`words`). Chunks beyond Latin are cut by the tokenizer file's own normaliser and pattern, so they
follow its Unicode tables. Defined results: NULL and empty texts have no tokens and decode to "".
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import words
from .common import ship

SHIFT, END = 32, np.int64(1) << 62
PAIR = 32  #: bits of an id in a pair
LONG = 64  #: words of more symbols get a tree of their own
LATIN = range(0x180)  #: code points whose classes do not differ between Unicode tables, none of them combining
CAPITAL_I_DOT = "\u0130"  #: the one of them whose small form has two letters


def _class(*kinds: str) -> str:
    """A pattern's set of the Latin code points of some general categories."""
    return "".join(f"\\u{c:04x}" for c in LATIN if unicodedata.category(chr(c))[0] in kinds)


def _pattern() -> tuple[re.Pattern, re.Pattern]:
    """The tokenizer's pattern, a fixed value, for Latin texts; and the test whether a text is one."""
    letters, digits, blanks = _class("L"), _class("N"), r"\x09-\x0D\x20\x85\xA0"
    plain = rf"'(?:s|t|re|ve|m|ll|d)|[{letters}]+|[{digits}]|[^{blanks}{letters}{digits}]+"
    return re.compile(plain), re.compile(rf"[\x00-{chr(LATIN[-1])}]*")


PLAIN, IS_LATIN = _pattern()


def byte_letters() -> list[str]:
    """The visible letter of each byte in byte-level vocabularies."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(visible)]
    letters = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """A word-end BPE vocabulary: symbols of bytes, merges by pair, special tokens."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model, ids = spec["model"], spec["model"]["vocab"]
        suffix, letters = model["end_of_word_suffix"], byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.last = np.array([ids[c + suffix] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = {c: b for b, c in enumerate(letters)}
        tokenizer = Tokenizer.from_str(text)
        self.normal, self.cutter = tokenizer.normalizer, tokenizer.pre_tokenizer
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([(ids[a] << PAIR) | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks, self.made = pairs[order], order.astype(np.int64), made
        self.rank_of = dict(zip(pairs.tolist(), range(len(pairs)), strict=True))
        names = {v: k for k, v in ids.items()} | {v: k for k, v in self.special.items()}
        self.names = pa.array([names.get(i) for i in range(max(names) + 1)], pa.string())
        self.stop = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")

    def pieces(self, text: str) -> list[bytes]:
        """Words of a text without special tokens."""
        if IS_LATIN.fullmatch(text) and CAPITAL_I_DOT not in text:
            return [w.encode() for w in PLAIN.findall(text.lower())]
        cut_up = self.cutter.pre_tokenize_str(self.normal.normalize_str(text))
        return [bytes(map(self.bytes.__getitem__, w)) for w, _ in cut_up]

    def keys(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaf values of pairs: rank and position, or END where the pair does not merge."""
        pair = (left << PAIR) | right
        i = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[i] == pair, (self.ranks[i] << SHIFT) | at, END)

    def grow(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of words that have 2 to LONG bytes, all in one array of trees with room for the longest."""
        room = 1 << (max(map(len, words)) - 1).bit_length()
        n, size = len(words), np.fromiter(map(len, words), np.int64, len(words))
        sym = np.zeros((n, room + 1), np.int64)
        live = np.arange(room + 1) < size[:, None]
        data = np.frombuffer(b"".join(words), np.uint8)
        sym[live] = self.inner[data]
        sym[np.arange(n), size - 1] = self.last[data[np.cumsum(size) - 1]]
        nxt, prv = np.tile(np.arange(1, room + 2), (n, 1)), np.tile(np.arange(-1, room), (n, 1))
        tree = np.full((n, 2 * room), END)
        tree[:, room:] = np.where(live[:, 1:], self.keys(sym[:, :-1], sym[:, 1:], np.arange(room)), END)
        half = room >> 1
        while half:
            tree[:, half: 2 * half] = np.minimum(tree[:, 2 * half: 4 * half: 2], tree[:, 2 * half + 1: 4 * half: 2])
            half >>= 1
        rows = np.flatnonzero(tree[:, 1] < END)
        while len(rows):
            top = tree[rows, 1]
            at, new = top & 0xFFFFFFFF, self.made[top >> SHIFT]
            right = nxt[rows, at]
            after, before = nxt[rows, right], prv[rows, at]
            sym[rows, at], nxt[rows, at], live[rows, right] = new, after, False
            inside = after < size[rows]
            tree[rows, room + at], tree[rows, room + np.minimum(right, room - 1)] = END, END
            r, a, b = rows[inside], at[inside], after[inside]
            prv[r, b] = a
            tree[r, room + a] = self.keys(sym[r, a], sym[r, b], a)
            has = before >= 0
            q, p = rows[has], before[has]
            tree[q, room + p] = self.keys(sym[q, p], new[has], p)
            line, node = np.concatenate([rows, rows, q]), np.concatenate([at, np.minimum(right, room - 1), p]) + room
            while room > 1 and node[0] > 1:
                node >>= 1
                tree[line, node] = np.minimum(tree[line, 2 * node], tree[line, 2 * node + 1])
            rows = rows[tree[rows, 1] < END]
        flat, ends = sym[live].tolist(), np.cumsum(live.sum(1)).tolist()
        return [tuple(flat[i:j]) for i, j in zip([0, *ends], ends, strict=False)]

    def grow_long(self, word: bytes) -> list[int]:
        """The same for one long word, in memory proportional to it."""
        n, room, end = len(word), 1 << (len(word) - 1).bit_length(), int(END)
        sym = [*self.inner[np.frombuffer(word[:-1], np.uint8)].tolist(), int(self.last[word[-1]])]
        nxt, prv, rank_of, made = list(range(1, n + 1)), list(range(-1, n - 1)), self.rank_of, self.made.tolist()

        def key(i: int, j: int) -> int:
            rank = rank_of.get((sym[i] << PAIR) | sym[j])
            return end if rank is None else (rank << SHIFT) | i

        tree = [end] * (2 * room)
        for i in range(n - 1):
            tree[room + i] = key(i, i + 1)
        for i in range(room - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, value: int) -> None:
            i += room
            tree[i] = value
            while i > 1:
                i >>= 1
                tree[i] = min(tree[2 * i], tree[2 * i + 1])

        while (top := tree[1]) < end:
            i = top & 0xFFFFFFFF
            j = nxt[i]
            k = nxt[j]
            sym[i], sym[j], nxt[i] = made[top >> SHIFT], -1, k
            put(j, end)
            if k < n:
                prv[k] = i
            put(i, key(i, k) if k < n else end)
            if prv[i] >= 0:
                put(prv[i], key(prv[i], i))
        return [s for s in sym if s >= 0]


class Encoder:
    """Encodes texts by the vocabulary; remembers chunks and words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.words, self.chunks = words.Store(self._trees), words.Store(self._cut)
        self.special = {t: np.int32(i).tobytes() for t, i in vocabulary.special.items()}

    def _trees(self, names: list[bytes]) -> list[bytes]:
        """Ids of distinct words, those of like lengths in one array of trees."""
        found: list[bytes] = [b""] * len(names)
        by_room: dict[int, list[int]] = {}
        for i, w in enumerate(names):
            by_room.setdefault((len(w) - 1).bit_length(), []).append(i)
        for bits, group in by_room.items():
            step = max(1, (1 << 18) >> bits)
            for at in range(0, len(group), step):
                part = group[at:at + step]
                raw = [names[i] for i in part]
                if not bits:
                    ids = [[int(self.vocabulary.last[w[0]])] for w in raw]
                elif 1 << bits > LONG:
                    ids = map(self.vocabulary.grow_long, raw)
                else:
                    ids = self.vocabulary.grow(raw)
                for i, own in zip(part, ids, strict=True):
                    found[i] = np.array(own, np.int32).tobytes()
        return found

    def _cut(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks; special tokens in them are found first."""
        stop, pieces, parts = self.vocabulary.stop, self.vocabulary.pieces, []
        for chunk in chunks:
            own, at = [], 0
            for m in stop.finditer(chunk):
                own += [*pieces(chunk[at:m.start()]), m[0]]
                at = m.end()
            parts.append(own + pieces(chunk[at:] if at else chunk))
        names = list({w for own in parts for w in own if isinstance(w, bytes)})
        known = dict(zip(names, self.words.get(names), strict=True)) | self.special
        return [b"".join(map(known.__getitem__, own)) for own in parts]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one after another, and the number of each text's."""
        return words.encode(texts, self.chunks)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Vocabulary(spec))
    return _ENCODERS[key]


def vocabulary(spark: SparkSession, path: str):
    """The vocabulary file, read once and sent to the executors; its size is that of the file, whatever the input."""
    ship(spark)
    return spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def encode(text: Column, vocab) -> Column:
    """Token ids of a text column as array<int>."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        encoder, values, counts = _encoder(vocab.value), [], []
        gc.disable()  # many small tuples and no cycles
        try:
            for part in words.slices(texts):
                v, c = encoder.encode(part)
                values.append(v)
                counts.append(c)
        finally:
            gc.enable()
        ends = np.concatenate([[0], np.cumsum(np.concatenate([*counts, np.zeros(0, np.int64)]))])
        flat = np.concatenate([*values, np.zeros(0, np.int32)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return ids(text)


def decode(ids: Column, vocab, slice_rows: int = 500) -> Column:
    """The tokens' strings joined by a space, special tokens included; ids without a token are skipped."""

    @F.arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        names, out = _encoder(vocab.value).vocabulary.names, []
        lists = pc.coalesce(lists, pa.scalar([], lists.type))
        for i in range(0, len(lists), slice_rows):
            part = lists.slice(i, slice_rows)
            flat = part.flatten()
            known = pc.and_kleene(pc.greater_equal(flat, 0), pc.less(flat, len(names)))
            token = names.take(pc.if_else(known, flat, None))
            before = np.concatenate([[0], np.cumsum(np.asarray(pc.is_valid(token)))])
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(part).to_numpy(zero_copy_only=False))])
            split = pa.ListArray.from_arrays(pa.array(before[ends], pa.int32()), token.drop_null())
            out.append(pc.binary_join(split, " "))
        return pa.concat_arrays(out) if out else pa.array([], pa.string())

    return text(ids)
