"""Benchmark decontamination with suffix arrays over the training text.

Each Arrow batch of documents is a shard. Its words become ids of the test
vocabulary (0 for any other word, which no test suffix can match), a suffix
array is built over the positions where a match could start, and every test
suffix is looked up in it by binary search. A hit gives the places where its
window occurs in the shard and how far each match goes on.

The test set is small next to the corpus, but nothing here relies on that: it is
measured first and looked up in blocks of at most ``block_bytes``. One block goes
to the tasks in one pass over the corpus, without a shuffle. Of several blocks
each has a pass of its own, whose hits are written before the next block is
collected, so the driver and each worker hold one block at a time; the hits are
merged by row. The work is the corpus's words, and for each Arrow batch the test
windows times the logarithm of its places.

A window is 13 consecutive words of an item; an item of fewer words, but not
none, is one window. A document word inside any occurrence of a window is hit.

Defined results
    null text            no words: nothing hit, not contaminated; a null item is skipped
    empty item           no window
    repeated rows        each row is searched; equal items are all listed
    null item id         listed as the empty string
    ties                 items that occur in one place are all listed, in the order of their ids as strings
    very long texts      a batch's memory is in proportion to its words
    empty tables         no rows, or nothing hit
    extra columns        kept; the operator's own column must be a new name
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import fresh, stage

WINDOW = 13
#: A-Z to a-z; ASCII characters other than letters and digits to a space; other bytes stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
MATCH = "n_words long, starts array<int>, ends array<int>, items array<string>, longest int"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


class TestSuffixes:
    """All suffixes of a block of test items that start a window, as rows of word ids."""

    __test__ = False  # not a test case

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        same: dict[tuple[bytes, ...], list[str]] = {}
        for item, text in items:
            if w := words(text):
                same.setdefault(tuple(w), []).append(item)
        self.names = list(same.values())
        self.ids: dict[bytes, int] = {}
        texts = [np.array([self.ids.setdefault(x, len(self.ids) + 1) for x in w], np.int32) for w in same]
        self.depth = max(map(len, texts), default=0)
        #: All texts end to end, each followed by a 0; ``depth`` more zeros let any suffix be read to full depth.
        self.flat = np.concatenate([np.append(t, 0) for t in texts] + [np.zeros(self.depth + window, np.int32)]).astype(np.int32)
        base = np.cumsum([0, *(len(t) + 1 for t in texts)])
        at = [(i, base[i] + j, min(window, len(t))) for i, t in enumerate(texts) for j in range(max(1, len(t) - window + 1))]
        self.text, self.start, self.length = (np.array(x, np.int64) for x in (zip(*at, strict=True) if at else ([], [], [])))
        self.width = int(self.length.max(initial=1))
        #: The least window length that starts with each word; words that start none get one that nothing reaches.
        self.need = np.full(len(self.ids) + 1, np.iinfo(np.int32).max, np.int64)
        np.minimum.at(self.need, self.flat[self.start], self.length)


def suffix_array(ids: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """``positions`` in the order of the suffixes that start there, compared over ``depth`` words, by prefix doubling."""
    rank, k = ids.astype(np.int64), 1
    while k < depth:
        after = np.zeros_like(rank)
        after[:-k] = rank[k:] if k < len(rank) else 0
        rank = np.unique(rank * (rank.max(initial=0) + 1) + after, return_inverse=True)[1]
        k *= 2
    return positions[np.argsort(rank[positions], kind="stable")]


def _bound(ids: np.ndarray, sa: np.ndarray, tests: TestSuffixes, upper: bool) -> np.ndarray:
    """For each test window, how many suffixes are below it (or, ``upper``, not above it), by binary search."""
    span = np.arange(tests.width)
    want = tests.flat[tests.start[:, None] + span]
    inside = span < tests.length[:, None]
    lo, hi = np.zeros(len(tests.start), np.int64), np.full(len(tests.start), len(sa), np.int64)
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        have = ids[sa[np.minimum(mid, len(sa) - 1)][:, None] + span]
        differs = (have != want) & inside
        first = differs.argmax(axis=1)
        row = np.arange(len(first))
        below = np.where(differs.any(axis=1), have[row, first] < want[row, first], upper)
        lo, hi = np.where(open_ & below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
    return lo


def search_shard(texts: list[str | None], tests: TestSuffixes) -> list[tuple]:
    """``n_words, starts, ends, items, longest`` of each text of a shard; spans in words, merged."""
    get = tests.ids.get
    lengths = np.zeros(len(texts), np.int64)
    parts = []
    for i, t in enumerate(texts):
        w = words(t)
        lengths[i] = len(w)
        parts.append(np.fromiter((get(x, 0) for x in w), np.int32, len(w)))
        parts.append(np.zeros(1, np.int32))
    none: tuple = ([], [], [], 0)
    out = [(int(n), *none) for n in lengths]
    pad = np.zeros(max(tests.depth, tests.width) + 1, np.int32)
    ids = np.concatenate([*parts, pad])
    if not len(tests.start) or not len(texts):
        return out
    zero = np.flatnonzero(ids == 0)
    run = zero[np.searchsorted(zero, np.arange(len(ids)))] - np.arange(len(ids))
    could = run >= tests.need[ids]
    if not could.any():
        return out
    # Only runs of test words with a place where a match could start are kept, a 0 between them.
    run_of = np.cumsum(ids == 0)
    live = np.zeros(run_of[-1] + 1, bool)
    live[run_of[could]] = True
    keep = np.flatnonzero(live[run_of] | (np.append(live[run_of][1:], False) & (ids == 0)))
    small = np.concatenate([ids[keep], pad])
    sa = suffix_array(small, np.flatnonzero(could[keep]), tests.depth)
    lo, hi = _bound(small, sa, tests, False), _bound(small, sa, tests, True)
    n = hi - lo
    if not n.sum():
        return out
    test = np.repeat(np.arange(len(n)), n)
    place = sa[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
    # How far each match goes on: one word more for all that still agree.
    size = tests.length[test].copy()
    going = np.arange(len(test))
    while len(going):
        a, b = small[place[going] + size[going]], tests.flat[tests.start[test[going]] + size[going]]
        going = going[(a == b) & (a > 0)]
        size[going] += 1
    begin = np.cumsum(lengths + 1) - lengths - 1
    where = keep[place]
    doc = np.searchsorted(begin, where, side="right") - 1
    edge = np.zeros(len(ids) + 1, np.int32)
    np.add.at(edge, where, 1)
    np.add.at(edge, where + tests.length[test], -1)
    hit = np.cumsum(edge)[:-1] > 0
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, doc, size)
    pairs = np.unique(doc * len(tests.names) + tests.text[test])
    found: dict[int, list[str]] = {}
    for d, t in zip(pairs // len(tests.names), pairs % len(tests.names), strict=True):
        found.setdefault(int(d), []).extend(tests.names[t])
    for d, items in found.items():
        h = np.concatenate([[0], hit[begin[d] : begin[d] + lengths[d]].astype(np.int8), [0]])
        step = np.diff(h)
        out[d] = (int(lengths[d]), np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), sorted(items), int(longest[d]))
    return out


def _matcher(items: list[tuple[str, str]], window: int):
    @F.pandas_udf(MATCH)
    def match(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tests = TestSuffixes(items, window)
        for batch in texts:
            yield pd.DataFrame(search_shard(list(batch), tests), columns=["n_words", "starts", "ends", "items", "longest"])

    return match


def _covered(starts: Column, ends: Column) -> Column:
    """Words in the union of spans."""
    spans = F.array_sort(F.arrays_zip(starts.alias("s"), ends.alias("e")))
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(F.greatest(a["to"], x["e"]).alias("to"), (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["to"], x["s"]))).alias("n")),
        lambda a: a["n"],
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = 16 << 20,
    out_col: str = "_match",
) -> DataFrame:
    """``docs`` with ``out_col``, which must be a new name: n_words, n_hit, starts, ends, items (ids as sorted strings), longest."""
    if fresh(docs, out_col) != out_col:
        raise ValueError(f"there is a column {out_col} already")
    tests = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    # The whole test set is searched; a block is bounded, and the number of blocks follows the set's size.
    total = tests.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("id")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))

    def matcher(b: int):
        part = tests if blocks == 1 else tests.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        return _matcher([(r["id"], r["text"]) for r in part.collect()], window)(F.col(text_col))

    def whole(m: Column, items: Column) -> Column:
        fields = {"n_words": m["n_words"], "n_hit": _covered(m["starts"], m["ends"]), "starts": m["starts"], "ends": m["ends"], "items": items, "longest": m["longest"]}
        return F.struct(*(c.alias(k) for k, c in fields.items()))

    if blocks == 1:
        found = docs.withColumn(out_col, matcher(0))
        return found.withColumn(out_col, whole(F.col(out_col), F.array_sort(F.array_distinct(F.col(out_col)["items"]))))
    row = fresh(docs, "_row")
    kept = stage(docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate-documents")
    hits = []
    for b in range(blocks):
        one = kept.select(F.col(row).alias("_r"), matcher(b).alias("m"))
        hits.append(stage(one.where(F.lit(b == 0) | (F.size("m.items") > 0)), "benchmark-hits"))  # the first has every row, for its words
    # A row's hits of all blocks: as many as there are blocks.
    every = reduce(DataFrame.unionByName, hits).groupBy("_r").agg(F.collect_list("m").alias("ms"))
    joined = lambda field: F.flatten(F.transform("ms", lambda m: m[field]))
    one = F.struct(F.col("ms")[0]["n_words"].alias("n_words"), joined("starts").alias("starts"), joined("ends").alias("ends"), F.array_max(F.transform("ms", lambda m: m["longest"])).alias("longest"))
    merged = every.select("_r", one.alias("m"), F.array_sort(F.array_distinct(joined("items"))).alias("items")).select("_r", whole(F.col("m"), F.col("items")).alias("_m"))
    both = kept.join(merged.select(F.col("_r").alias(row), F.col("_m").alias(out_col)), row, "left")
    return both.select(*docs.columns, out_col)


def contaminated(match: str = "_match") -> Column:
    return (F.col(match)["n_hit"] > 0) & (20 * F.col(match)["n_hit"] >= F.col(match)["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated. Columns are those of ``docs``."""
    mark = fresh(docs, "_match")
    return find_contamination(docs, benchmark, out_col=mark, **options).where(~contaminated(mark)).select(*docs.columns)
