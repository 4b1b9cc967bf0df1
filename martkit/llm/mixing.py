"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by a hash and laid end to end; the stream, repeated up to `most` times, is cut into
blocks of equal size. The schedule has one slot per block: van der Corput points (bit-reversed slot numbers) go through
the cumulative block counts of the sources, so every source gets exactly its share and every stretch of the schedule has
nearly the same mix. Slots are ranked per source, and the slot of rank k takes the source's k-th block.

Defined results: sources are ordered by code point, NULL last, and weigh weights[0], weights[1], ... repeating; a source
without words has target 0; a document without words is never taken; equal rows are separate documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, running_start

CELL = 4096  #: ranks of the schedule per join cell


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Target per source: share * all sizes by weight, none above most * its size, the excess reshared by weight.

    `sizes` has one row per source (source, source_size). Sources are filled in the order of cap per weight: those that
    fill below the common level keep their cap, the rest share what is left. The windows have one row per source.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = (sizes.withColumn("source_no", number).withColumn("_w", weight)
            .withColumn("_cap", F.col("source_size") * float(most)))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "source_no")
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    used = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("_all", F.sum("source_size").over(whole) * float(share))
    rows = rows.withColumn("_level", (F.col("_all") - used) / left)
    rows = rows.withColumn("_full", F.col("_cap") <= F.col("_level") * F.col("_w"))
    common = F.max(F.when(~F.col("_full"), F.col("_level"))).over(whole)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(common * F.col("_w"))
    return rows.withColumn("_common", common).select("source", "source_no", "source_size", target.alias("target"))


def _reversed(value: Column, bits: int) -> Column:
    """The lowest `bits` bits of a value in reverse order."""
    x = value
    for step, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F),
                       (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)):
        x = F.shiftleft(x.bitwiseAND(mask), step).bitwiseOR(F.shiftright(x, step).bitwiseAND(mask))
    x = F.shiftleft(x, 32).bitwiseOR(F.shiftrightunsigned(x, 32))
    return F.shiftrightunsigned(x, 64 - bits)


def schedule(sources: DataFrame) -> DataFrame:
    """Slots (slot, source_no, block) of a mix; `sources` has source_no and need, the number of its slots."""
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    spans = (sources.where("need > 0").withColumn("_lo", F.coalesce(F.sum("need").over(before), F.lit(0)))
             .select("source_no", "_lo", (F.col("_lo") + F.col("need")).alias("_hi")))
    total = sources.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0]  # one number
    bits = max(1, (total - 1).bit_length())
    points = sources.sparkSession.range(1 << bits if total else 0).withColumnRenamed("id", "slot")
    points = points.withColumn("_at", _reversed(F.col("slot"), bits)).where(F.col("_at") < total)
    cells = spans.withColumn("_cell", F.explode(F.sequence(F.expr(f"_lo div {CELL}"), F.expr(f"(_hi - 1) div {CELL}"))))
    hit = points.withColumn("_cell", F.expr(f"_at div {CELL}")).join(cells, "_cell")
    hit = hit.where((F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi"))).select(
        "slot", "source_no", F.shiftright("slot", max(0, bits - 12)).alias("_part"), F.lit(1).alias("_one"))
    return running_start(hit, ["source_no"], "_part", [F.col("slot")], "_one", "block").drop("_part", "_one")


def chosen(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: int = 2,
           block: int = 2048) -> tuple[DataFrame, DataFrame]:
    """Rows with their source's target, and the pieces that the schedule takes (row, turn, block, slot, words).

    `row` is a unique number. Blocks are laid over the sources' streams, and a slot of the schedule takes all pieces of its
    block; a source's last block ends at its target, rounded to whole words.
    """
    docs = cut(docs.select("row", "doc_id", "source", "size"))
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = targets(sizes, weights, share, most).withColumn("wanted", F.floor(F.col("target") + 0.5))
    sources = cut(sources.withColumn("need", F.ceil(F.col("wanted") / float(block))))
    order = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), "size"))
    named = docs.join(sources.drop("need"), docs["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    named = named.withColumn("_h", order).withColumn("_cell", F.substring("_h", 1, 3))
    laid = running_start(named, ["source_no"], "_cell", [F.col("_h"), F.col("doc_id"), F.col("size"), F.col("row")],
                         "size", "_start").drop("_h", "_cell")
    turns = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    runs = laid.withColumn("turn", turns).withColumn("_lo", F.col("_start") + F.col("turn") * F.col("source_size"))
    runs = runs.withColumn("_hi", F.least(F.col("_lo") + F.col("size"), F.col("wanted"))).where("_lo < _hi")
    blocks = F.explode(F.sequence(F.expr(f"_lo div {block}"), F.expr(f"(_hi - 1) div {block}")))
    pieces = runs.select("row", "turn", "source_no", "_lo", "_hi", blocks.alias("block"))
    words = F.least("_hi", (F.col("block") + 1) * block) - F.greatest("_lo", F.col("block") * block)
    taken = pieces.join(schedule(sources), ["source_no", "block"]).select("row", "turn", "block", "slot", words.alias("words"))
    return laid, taken


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: int = 2,
        block: int = 2048) -> DataFrame:
    """Words taken from each row of `docs` (row, doc_id, source, size): adds source_size, target, taken, first_slot."""
    laid, pieces = chosen(docs, weights, share, most, block)
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    out = laid.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return out.select("row", "doc_id", "source", "size", "source_size", "target", "taken", "first_slot")
