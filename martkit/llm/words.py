"""Token ids of texts by way of their distinct chunks between ASCII white space.

Word tokenizers never join letters across white space, so a text's ids are those of its chunks one after another. A batch
of texts is cut into chunks and dictionary-coded by Arrow; only chunks that a worker does not know yet go to the
tokenizer, and the ids are gathered by numpy. What a worker knows is kept in two generations: when the young one is full
it becomes the old one, and a chunk found in the old one moves back, so frequent chunks stay. The size bounds memory and
never a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ROOM = 200_000  #: chunks of a generation
SLICE = 4 << 20  #: bytes of text that are worked on at a time


class Store:
    """Ids of chunks, as bytes of 32-bit numbers."""

    def __init__(self, learn: Callable[[list[str]], list[bytes]], room: int = ROOM) -> None:
        self.learn, self.room, self.young, self.old = learn, room, {}, {}

    def get(self, chunks: list[str]) -> list[bytes]:
        """Ids of each of the distinct chunks."""
        young, old = self.young, self.old
        found = [young.get(c) for c in chunks]
        away = [i for i, ids in enumerate(found) if ids is None]
        unknown = []
        for i in away:
            ids = old.get(chunks[i])
            if ids is None:
                unknown.append(i)
            else:
                found[i] = young[chunks[i]] = ids
        if unknown:
            names = [chunks[i] for i in unknown]
            for i, name, ids in zip(unknown, names, self.learn(names), strict=True):
                found[i] = young[name] = ids
        if len(young) > self.room:
            self.young, self.old = {}, young
        return found


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[pa.Array]:
    """The texts in runs of about `limit` bytes, at least one text each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = size[start - 1] if start else 0
        end = max(int(np.searchsorted(size, before + limit, "right")), start + 1)
        yield texts.slice(start, end - start)
        start = end


def encode(texts: pa.Array, store: Store) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts one after another, and the number of each text's; NULL is empty."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    parts = store.get(coded.dictionary.to_pylist())
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    flat, start, codes = np.frombuffer(b"".join(parts), np.int32), np.cumsum(size) - size, coded.indices.to_numpy()
    n = size[codes]
    ends = np.concatenate([[0], np.cumsum(n)])
    ids = flat[np.repeat(start[codes] - ends[:-1], n) + np.arange(ends[-1])]
    last = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
    return ids, np.diff(ends[np.concatenate([[0], last])])
