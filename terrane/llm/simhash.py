"""SimHash near-duplicates by segment popcounts.

A 64-bit fingerprint is cut into 16 segments of 4 bits; the bit counts of the
segments place it on a grid. Two fingerprints that differ in d bits are at most
d apart there (Manhattan distance), so the range join with radius 2 on the grid
misses no pair within 2 bits, and its candidates are verified on the bits.

The range join is an equi-join: two grid points at most 2 apart always have a
grid point at most 1 from both, so each fingerprint is entered in its own cell
and the cells one step away (33 at most). Only distinct fingerprints take part,
so a group of equal fingerprints, however large, is one row here.

Cells with more than ``crowd`` fingerprints are not paired. Their members are
entered under their own value and the 64 values one bit away instead; two of
them within 2 bits always share such a value, and each value has 65 possible
holders, so these groups are bounded and exact whatever the crowd.

Defined results
    null or blank text    no shingles: fingerprint zero, linked like any other
    fewer than 3 words    one shingle, the whole sequence
    repeated rows         each row gets its fingerprint and the same component
    null id               kept; takes part in no minimum
    empty table           no rows
    extra columns         ignored by ``simhash_components``, kept by ``keep_one``
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from terrane.llm.common import stage
from terrane.llm.components import components

SEGMENTS, SEGMENT_BITS = 16, 4
RADIUS = 2


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """A bit is set if it is set in over half of the shingles' XXH64 values."""
    w = (text or "").encode().lower().split()  # bytes: folds and splits ASCII only
    if not w:
        return 0
    hash_of = xxhash.xxh64_intdigest
    if len(w) < words:
        shingles = [hash_of(b" ".join(w), seed)]
    else:
        shingles = [hash_of(b" ".join(x), seed) for x in zip(*(w[i:] for i in range(words)), strict=False)]
    h = np.array(shingles, dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):  # a very long text needs no more memory than a block
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


@F.pandas_udf(LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series(np.array([fingerprint(t) for t in batch], dtype=np.uint64).view(np.int64))


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _cells(fp: Column) -> Column:
    """The grid point of a fingerprint, 4 bits a coordinate, and the points one step away."""
    # Bit counts of all segments at once: the four bits of each are added in its own place.
    ones = [F.shiftrightunsigned(fp, i).bitwiseAND(F.lit(0x1111111111111111)) for i in range(SEGMENT_BITS)]
    point = ones[0] + ones[1] + ones[2] + ones[3]
    near = [F.lit(0).cast("long")]
    for s in range(SEGMENTS):
        unit = F.shiftleft(F.lit(1).cast("long"), SEGMENT_BITS * s)
        count = F.shiftrightunsigned(point, SEGMENT_BITS * s).bitwiseAND(F.lit(15))
        near += [F.when(count < SEGMENT_BITS, unit), F.when(count > 0, -unit)]
    return F.transform(F.array_compact(F.array(*near)), lambda step: point + step)


def close_pairs(fps: DataFrame, crowd: int = 32) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``fp``) that connect all that are within 2 bits.

    Members of a crowded cell are linked to the least holder of each shared value, not to each other.
    """
    near = fps.select("fp", F.explode(_cells(F.col("fp"))).alias("cell"))
    # Written first: a join of two plain shuffles can be split where one cell holds very many fingerprints.
    sizes = stage(near.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "cell-sizes")
    shared = stage(near.join(sizes, "cell"), "cells")
    calm = shared.where(F.col("n") <= crowd).select("cell", "fp")
    other = calm.select("cell", F.col("fp").alias("fp2"))
    verified = calm.join(other, (calm.cell == other.cell) & (F.col("fp") < F.col("fp2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= RADIUS))
    pairs = verified.select(F.col("fp").alias("a"), F.col("fp2").alias("b"))

    # What is within 2 bits of a member of a crowded cell shares its crowd there or a calm cell elsewhere;
    # both are covered only if all members of the crowded cells are entered here.
    flips = F.array(*(F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)))
    crowded = shared.where(F.col("n") > crowd).select("fp").distinct()
    values = crowded.select("fp", F.explode(F.concat(F.array("fp"), F.transform(flips, lambda bit: F.col("fp").bitwiseXOR(bit)))).alias("value"))
    stars = values.groupBy("value").agg(F.collect_set("fp").alias("held")).where(F.size("held") > 1)
    links = stars.select(F.array_min("held").alias("a"), F.explode("held").alias("b")).where("a <> b")
    return pairs.union(links).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = 32) -> DataFrame:
    """One row per document: id, ``fp`` (the fingerprint as a long) and ``component_id``, the smallest id reachable."""
    marked = stage(docs.select(F.col(id_col).alias("_id"), _fingerprints(F.col(text_col)).alias("fp")), "fingerprints")
    fps = stage(marked.groupBy("fp").agg(F.min("_id").alias("least")), "distinct-fingerprints")
    linked = components(close_pairs(fps, crowd), "a", "b")
    joined = stage(linked.join(fps, linked.node == fps.fp).select("component", "fp", "least"), "linked")
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(least, "component").select("fp", "component_id")
    every = fps.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    every = stage(every, "named-fingerprints")  # and so can this one, where one fingerprint has very many documents
    return marked.join(every, "fp").select(F.col("_id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay: of each component the one with the smallest id, and one row of it.

    Null ids cannot be told apart and stay. Columns are those of ``docs``.
    """
    found = simhash_components(docs, id_col, text_col)
    first = found.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("_keep")).distinct()
    with_id = docs.join(first, F.col(id_col) == F.col("_keep"), "left_semi")
    return with_id.dropDuplicates([id_col]).unionByName(docs.where(F.col(id_col).isNull()))
