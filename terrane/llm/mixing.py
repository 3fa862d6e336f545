"""Mixing sources to target weights by systematic sampling.

Each document of a source has the same expected number of copies, its source's
target over its source's size. Documents are laid end to end in a fixed order,
each as long as its expected copies; the line starts at a random offset, and a
document is emitted once for every integer boundary that its stretch crosses.

The order is by size, so neighbours are alike and the words taken come close to
the target; within a size the order is that of a keyed hash. The running sum
over a source is split: documents fall into many small cells, the sum runs
within each cell, and only the cells' totals (a bounded number per source) are
summed in one window. No task holds a source.

Defined results
    null text or source   size 0; the null source is a source of its own, last in order
    size 0                takes part with its expected copies, takes no words
    repeated rows         rows of their own
    empty table           no rows
    extra columns         ignored by ``mix_counts``, kept by ``mix``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import fresh, n_words, stage

MAX_COPIES = 2


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = MAX_COPIES) -> DataFrame:
    """``_source, source_size, target`` from the sources' sizes.

    In the order of their keys the sources weigh ``weights`` in turn, and they share ``share`` of all sizes. A target stops at
    ``cap`` times its source's size; what is over goes to the others by weight until none is above. A source is at
    its cap if and only if its cap per weight is small enough, so sorting by that ratio settles all of them at once:
    with the capped ones a prefix of that order, a source stays uncapped from the first place where the level that
    would be left for it and its successors is below its own ratio.
    """
    by_name = Window.orderBy("_source")
    table = F.array(*(F.lit(float(w)) for w in weights))
    ranked = sizes.withColumn("w", F.get(table, (F.row_number().over(by_name) - 1) % len(weights)))
    ranked = ranked.withColumn("cap", F.col("source_size") * float(cap)).withColumn("ratio", F.col("cap") / F.col("w"))
    line = Window.orderBy("ratio", "_source")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    after = line.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * float(share)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    marked = ranked.withColumn("at", F.row_number().over(line)).withColumn("level", level)
    final = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("at", "level"))).over(Window.partitionBy())["level"]
    return marked.select("_source", "source_size", F.least(F.col("cap"), F.coalesce(final * F.col("w"), F.col("cap"))).alias("target"))


def mix_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    seed: int = 7,
    cell_rows: int = 4_000,
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``copies``, ``taken``; and ``_row``, a row number.

    The row number is ``row_col``, or a new one; it settles the order of rows that are equal in size and id.
    """
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    # A key without nulls that sorts as the sources do, null last.
    source = F.concat(F.when(F.col(source_col).isNull(), "1").otherwise("0"), F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    # What is numbered is written, so the numbers cannot change.
    sized = docs.select(row.alias("_row"), F.col(id_col).alias("_id"), source.alias("_source"), n_words(F.col(text_col)).alias("size"))
    sized = stage(sized.withColumn("_h", F.xxhash64(F.lit(seed), "_id", "size")), "sizes")
    totals = sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
    # Sources are few next to documents, but not bounded: nothing of them is broadcast by force.
    offset = (F.pmod(F.xxhash64(F.lit(seed), "_source"), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    plan = source_targets(totals, weights, share).withColumn("u", offset)

    # A cell is a size class (about 9 % wide) and a share of its hashes, as many as keep cells small.
    salts = max(1, sized.count() // cell_rows)
    cells = sized.withColumn("_c", F.floor(8 * F.log2(F.col("size") + 1.0)).cast("int")).withColumn("_k", F.pmod("_h", F.lit(salts)).cast("int"))
    per_cell = cells.groupBy("_source", "_c", "_k").agg(F.count(F.lit(1)).alias("_n"))
    # Totals of the salts first, of the classes next: each window holds one source's classes, or one class's salts.
    per_class = per_cell.groupBy("_source", "_c").agg(F.sum("_n").alias("_cn"))
    class_start = F.sum("_cn").over(Window.partitionBy("_source").orderBy("_c")) - F.col("_cn")
    per_class = per_class.select("_source", "_c", class_start.alias("_first"))
    salt_start = F.sum("_n").over(Window.partitionBy("_source", "_c").orderBy("_k")) - F.col("_n")
    starts = per_cell.withColumn("_in", salt_start).join(per_class, ["_source", "_c"]).join(plan, "_source")
    starts = starts.select("_source", "_c", "_k", (F.col("_first") + F.col("_in")).alias("_start"), "source_size", "target", "u")

    line = Window.partitionBy("_source", "_c", "_k").orderBy("size", "_h", "_id", "_row")
    placed = cells.withColumn("_at", F.row_number().over(line) - 1).join(starts, ["_source", "_c", "_k"])
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(MAX_COPIES)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    at = F.col("_start") + F.col("_at")
    crossed = F.floor((at + 1) * rate + F.col("u")) - F.floor(at * rate + F.col("u"))
    copies = F.least(F.lit(MAX_COPIES), F.greatest(F.lit(0), crossed)).cast("int")
    return placed.select(
        "_row",
        F.col("_id").alias(id_col),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed documents: each as often as it is taken. Columns are those of ``docs``."""
    row, copies, copy = (fresh(docs, c) for c in ("_mix_row", "_mix_copies", "_mix_copy"))
    kept = stage(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    counts = mix_counts(kept, id_col, text_col, source_col, row_col=row, **options)
    chosen = counts.where("copies > 0").select(F.col("_row").alias(row), F.col("copies").alias(copies))
    repeated = kept.join(chosen, row).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return repeated.select(*docs.columns)
