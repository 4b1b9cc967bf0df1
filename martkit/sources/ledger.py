"""Loads in chunks that can stop and go on, with a ledger of their states.

The rows of every chunk are staged beside the table and noted. Only when all
chunks of a batch are done is their window of the table replaced, so a failed
chunk fails the batch and leaves the window as it was. The next call with the
same chunks goes on with those that are not done.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .claims import WHOLE, Folder, Load
from .load import reload_range

LOADED = "_LOADED"
STATE = "batch string, account_id string, start_date date, end_date date, state string, n_rows long, error string"


class Chunk(NamedTuple):
    """Days of one account, both ends included."""

    account: str
    start: date
    end: date

    @property
    def name(self) -> str:
        return f"{self.start}_{self.end}_{hashlib.sha256(self.account.encode()).hexdigest()[:16]}"


class ChunksFailed(RuntimeError):
    """Chunks of a batch that could not be extracted, with their errors."""

    def __init__(self, errors: dict[Chunk, str]) -> None:
        super().__init__("; ".join(f"{c.account} {c.start}..{c.end}: {e}" for c, e in sorted(errors.items())))
        self.errors = errors


def chunks_of(ranges: DataFrame, account: str = "account_id") -> list[Chunk]:
    """The chunks of :func:`load.date_chunks`; one per load job, so they fit the driver."""
    return sorted(Chunk(*r) for r in ranges.select(account, "chunk_start", "chunk_end").collect())


def batch_name(chunks: Iterable[Chunk]) -> str:
    """A name that the same chunks always have."""
    return hashlib.sha256(json.dumps(sorted(c.name for c in set(chunks))).encode()).hexdigest()[:16]


def windows(chunks: Iterable[Chunk]) -> dict[tuple[date, date], list[str]]:
    """The accounts of every window; an account's chunks must follow each other without a gap or an overlap."""
    spans: dict[str, tuple[date, date]] = {}
    for c in sorted(set(chunks)):
        start, end = spans.get(c.account, (c.start, c.start - timedelta(days=1)))
        if c.start != end + timedelta(days=1) or c.end < c.start:
            raise ValueError(f"chunk {c.start}..{c.end} of {c.account} does not follow {end}")
        spans[c.account] = (start, c.end)
    out: dict[tuple[date, date], list[str]] = {}
    for account, span in spans.items():
        out.setdefault(span, []).append(account)
    return out


def _stage(extract: Callable[[Chunk], DataFrame], chunk: Chunk, folder: str, day: str, account: str) -> int:
    """Write the rows of a chunk and count them in the same pass; rows of other days or accounts are refused."""
    seen = Observation()
    inside = (F.col(account) == chunk.account) & F.col(day).between(F.lit(chunk.start), F.lit(chunk.end))
    rows = extract(chunk).observe(seen, F.count(F.lit(1)).alias("n"),
                                  F.count_if(~F.coalesce(inside, F.lit(False))).alias("outside"))
    rows.write.mode("overwrite").parquet(folder)
    if seen.get["outside"]:
        raise ValueError(f"{seen.get['outside']} rows outside the chunk")
    return seen.get["n"]


def load_chunks(spark: SparkSession, path: str, chunks: Iterable[Chunk], extract: Callable[[Chunk], DataFrame],
                workers: int = 1, day: str = "date", account: str = "account_id", wait: float = 0.0, **kwargs) -> bool:
    """Extract every chunk, then replace the accounts' windows of the table at ``path``.

    A chunk that raises does not stop the others, but the table then stays as
    it was and ``ChunksFailed`` follows. What is done is not extracted again
    until the batch is loaded; after that, the same chunks begin anew. False if
    no chunk has any row, which changes nothing. ``workers`` chunks run at a time;
    while another call works on the batch this one waits up to ``wait`` seconds,
    then raises ``Busy``.
    """
    chunks = sorted(set(chunks))
    spans, batch = windows(chunks), batch_name(chunks)
    root = f"{path.rstrip('/')}__chunks/{batch}"
    notes = Folder(spark, f"{root}/state")
    with Load(spark, root, wait) as hold:
        hold.claim([WHOLE])
        if notes.exists(LOADED):
            Folder(spark, root).delete()

        def run(chunk: Chunk) -> str | None:
            old = json.loads(notes.read(chunk.name)) if notes.exists(chunk.name) else None
            if old and old["state"] == "done":
                return None
            note = {"batch": batch, "account_id": chunk.account, "start_date": f"{chunk.start}", "end_date": f"{chunk.end}"}
            try:
                note |= {"state": "done", "n_rows": _stage(extract, chunk, f"{root}/rows/{chunk.name}", day, account)}
            except Exception as e:  # noted, and raised with the others' at the end
                note |= {"state": "failed", "error": f"{type(e).__name__}: {e}".splitlines()[0]}
            notes.delete(chunk.name)
            notes.write(chunk.name, json.dumps(note))
            return note.get("error")

        with ThreadPoolExecutor(workers) as pool:
            errors = {c: e for c, e in zip(chunks, pool.map(run, chunks), strict=True) if e is not None}
        if errors:
            raise ChunksFailed(errors)
        changed = False
        for (start, end), accounts in spans.items():
            rows = spark.read.parquet(*[f"{root}/rows/{c.name}" for c in chunks if c.account in accounts])
            changed |= reload_range(rows, path, start, end, accounts, day=day, account=account, wait=wait, **kwargs)
        notes.write(LOADED, "")
        Folder(spark, root).delete("rows")
        return changed


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per chunk that was tried: ``done`` or ``failed``, of each batch's newest run."""
    root = Folder(spark, f"{path.rstrip('/')}__chunks")
    states = [f"{root.at()}/{n}/state" for n in root.names() if Folder(spark, f"{root.at()}/{n}/state").exists()]
    return spark.read.schema(STATE).json(states) if states else spark.createDataFrame([], STATE)
