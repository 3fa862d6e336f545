"""Phrases whose words come together more often than their parts would.

Counting. Each task walks its texts once with a trie of word ids. Below the root
are hash containers for groups of 256 first words; a container over ``burst``
entries bursts into one for each first word, and such a one into one for each
second word. When the tries of a task hold over ``entries`` counts, whole subtrees
are spilled, those first that were met least for the counts they hold, each run
sorted by words, until half is left. Runs are dealt by prefix: language and first
word, and a slice of the rest, so that a frequent word is not one task's. They are
merged there by addition. The counts are exact.

Words and pairs are counted first. A phrase of three words that is frequent has
two frequent pairs, so the second walk counts only such phrases. It knows the
frequent pairs by a Bloom filter of fixed size, ``filter_bits``, which takes some
others for frequent but never misses one: counts stay exact, and a full filter
only costs time.

Word ids are a task's own and end with it; runs carry the words.

Scoring. ``score = floor(1000000 a a / (l r))`` of the cut that scores lowest, in
decimals of 38 digits and whole division. Parts of a phrase that is found a times
are found a times at least, so the parts of candidates are among the frequent
phrases, and only those are joined.

Defined results
    null text or one without words    nothing is counted
    null language                     ``und``
    very long text                    walked in slices of about a megabyte that overlap by words; a word is never cut
    ties                              by count, then by the phrase's bytes
    repeated rows                     counted each
    empty table                       no rows
    extra columns                     ignored
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrane.llm.common import stage

#: Three ids of so many bits fill a signed machine word.
BITS = 21
SLICE = 1 << 20
RUN_ROWS = 100_000
#: Of Spark's xxhash64, and how far a pair's second hash is turned.
SEED, TURN = 42, 23
#: Ends a piece. It is one of the fixed delimiters ``.,;:!?`` and LF to CR, so no word holds it.
STOP = b"."
_BYTES = bytes(STOP[0] if chr(b) in ".,;:!?\n\v\f\r" else b + 32 if 65 <= b <= 90 else 32 if b == 9 else b for b in range(256))
_RUN = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


class WordIds(dict):
    """Ids from 1 in the order of first sight; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({STOP: 0})
        self.held = 0
        self.hashes = np.zeros(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self.held += len(word)
        new = self[word] = len(self)
        return new

    def hashed(self) -> np.ndarray:
        """XXH64 of each word by its id."""
        if len(self.hashes) < len(self):
            new = [xxhash.xxh64_intdigest(w, SEED) for w in islice(self, len(self.hashes), None)]
            self.hashes = np.concatenate([self.hashes, np.array(new, np.uint64)])
        return self.hashes


class PhraseTrie:
    """Counts of phrases of up to three word ids in one language; a phrase is ``id << 42 | id << 21 | id``, zero where it has no word."""

    #: What is left of a phrase at each level: the group of its first word, its first word, its first two.
    LEVELS = (2 * BITS + 8, 2 * BITS, BITS)

    def __init__(self, burst: int):
        self.burst = burst
        self.root: dict[int, Counter | dict] = {}
        self.sizes: Counter = Counter()
        self.met: Counter = Counter()

    def add(self, phrases: np.ndarray) -> None:
        """Count phrases given in ascending order."""
        each = phrases.tolist()
        for group, i, j in _runs(phrases >> self.LEVELS[0]):
            self.sizes[group] += self._add(self.root, group, 0, phrases[i:j], each[i:j])
            self.met[group] += j - i

    def _add(self, node: dict, key: int, level: int, phrases: np.ndarray, each: list[int]) -> int:
        """Count below ``node[key]``; how many counts are new."""
        child = node.get(key)
        if child is None:
            child = node[key] = Counter()
        if isinstance(child, Counter):
            was = len(child)
            child.update(each)
            if len(child) > self.burst and level + 1 < len(self.LEVELS):
                node[key] = self._burst(child, self.LEVELS[level + 1])
            return len(child) - was
        return sum(self._add(child, k, level + 1, phrases[i:j], each[i:j]) for k, i, j in _runs(phrases >> self.LEVELS[level + 1]))

    @staticmethod
    def _burst(container: Counter, shift: int) -> dict[int, Counter]:
        """A node in a container's place, with a container for each of its words."""
        out: dict[int, Counter] = {}
        for phrase, n in container.items():
            out.setdefault(phrase >> shift, Counter())[phrase] = n
        return out

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Phrases and counts of whole subtrees until at most ``keep`` counts are left."""
        left = self.sizes.total()
        phrases, counts, held = [], [], 0
        for group in sorted(self.sizes, key=lambda g: self.met[g] / self.sizes[g]):
            if left <= keep:
                break
            left -= self.sizes.pop(group)
            del self.met[group]
            for container in _containers(self.root.pop(group)):
                phrases.append(np.fromiter(container, np.int64, len(container)))
                counts.append(np.fromiter(container.values(), np.int64, len(container)))
                held += len(container)
            if held >= RUN_ROWS:
                yield np.concatenate(phrases), np.concatenate(counts)
                phrases, counts, held = [], [], 0
        if held:
            yield np.concatenate(phrases), np.concatenate(counts)


def _containers(node: Counter | dict) -> Iterator[Counter]:
    if isinstance(node, Counter):
        yield node
    else:
        for child in node.values():
            yield from _containers(child)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each run of equal values: the value and where the run begins and ends."""
    if len(values):
        begins = np.concatenate([[0], np.flatnonzero(np.diff(values)) + 1])
        ends = begins.tolist()
        yield from zip(values[begins].tolist(), ends, [*ends[1:], len(values)], strict=True)


def _slices(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        cut = data.find(b" ", at + SLICE)
        cut = len(data) if cut < 0 else cut
        yield data[at:cut]
        at = cut


def _phrases(ids: np.ndarray, seen: int, lengths: tuple[int, ...], usual: np.ndarray | None = None) -> np.ndarray:
    """The phrases of these lengths that end after the first ``seen`` ids, in ascending order; of ``usual`` neighbours only."""
    found = []
    for words in lengths:
        ends = np.arange(max(seen, words - 1), len(ids))
        parts = [ids[ends - k] for k in range(words - 1, -1, -1)]
        inside = np.logical_and.reduce([p > 0 for p in parts])
        if usual is not None:
            inside &= np.logical_and.reduce([usual[ends - k] for k in range(words - 2, -1, -1)])
        found.append(sum(p[inside] << BITS * (2 - k) for k, p in enumerate(parts)))
    out = np.concatenate(found)
    out.sort()
    return out


def _run(lang: str, words: list[bytes], phrases: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A sorted run as rows. Words are ranked once, so that phrases are sorted as numbers."""
    mask = (1 << BITS) - 1
    ids, at = np.unique(np.concatenate([phrases >> 2 * BITS, phrases >> BITS & mask, phrases & mask]), return_inverse=True)
    spelled = pa.array([words[i] if i else None for i in ids.tolist()], pa.binary())
    rank = np.empty(len(ids), np.int64)
    rank[pc.array_sort_indices(spelled, null_placement="at_start").to_numpy()] = np.arange(len(ids))
    parts = at.reshape(3, -1)
    order = np.argsort(rank[parts[0]] << 2 * BITS | rank[parts[1]] << BITS | rank[parts[2]])
    spelled = spelled.cast(pa.string())
    for i in range(0, len(order), RUN_ROWS):
        some = order[i : i + RUN_ROWS]
        spell = [spelled.take(pa.array(p[some])) for p in parts]
        phrase = pc.binary_join_element_wise(*spell, " ", null_handling="skip")
        yield pa.record_batch([pa.array([lang] * len(some), pa.string()), phrase, pa.array(counts[some])], schema=_RUN)


def count_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    lengths: tuple[int, ...] = (1, 2, 3),
    burst: int = 1 << 14,
    entries: int = 1_000_000,
    pairs: PairFilter | None = None,
) -> DataFrame:
    """``lang, phrase, n``: how often each phrase of these numbers of words (at most 3) is found within pieces.

    The empty phrase has the number of words. With ``pairs``, phrases with a pair that the filter does not have are left out.
    """
    if not lengths or not set(lengths) <= {1, 2, 3}:
        raise ValueError("lengths must be of 1 to 3: that many ids fill a machine word")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    overlap = max(lengths) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tries, totals = WordIds(), {}, Counter()

        def spilled(keep: int) -> Iterator[pa.RecordBatch]:
            words = list(ids)
            for lang, trie in tries.items():
                for phrases, counts in trie.spill(keep):
                    yield from _run(lang, words, phrases, counts)

        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.large_binary()).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                trie = tries.setdefault(lang, PhraseTrie(burst))
                data = STOP.join(texts).translate(_BYTES).replace(STOP, b" . ")
                before = np.zeros(0, np.int64)
                for part in _slices(data):
                    own = np.array(list(map(ids.__getitem__, part.split())), np.int64)
                    joined = np.concatenate([before, own])
                    usual = None if pairs is None else pairs.neighbours(lang, ids.hashed()[joined])
                    trie.add(_phrases(joined, len(before), lengths, usual))
                    totals[lang] += int(np.count_nonzero(own))
                    before = joined[max(0, len(joined) - overlap) :] if overlap else joined[:0]
                    if sum(t.sizes.total() for t in tries.values()) > entries:
                        yield from spilled(entries // 2 // len(tries))
                    if len(ids) > 1 << BITS - 1 or ids.held > 64 << 20:  # a slice brings 2^19 new words at most
                        yield from spilled(0)
                        words, ids = list(ids), WordIds()
                        before = np.array([ids[words[i]] for i in before.tolist()], np.int64)
        yield from spilled(0)
        if totals:
            yield pa.record_batch([pa.array(list(totals)), pa.array([""] * len(totals)), pa.array(list(totals.values()), pa.int64())], schema=_RUN)

    runs = rows.mapInArrow(run, "lang string, phrase string, n long")
    prefix = [F.col("lang"), F.substring_index("phrase", " ", 1).alias("_first"), F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("_slice")]
    return runs.repartition(*prefix).groupBy(*prefix, "phrase").agg(F.sum("n").alias("n")).select("lang", "phrase", "n")


class PairFilter:
    """A Bloom filter of pairs of words by language, made in the tasks as words of 64 bits and gathered as those: its size does not follow the input."""

    def __init__(self, pairs: DataFrame, bits: int):
        if not 6 <= bits <= 32:
            raise ValueError("a filter has 2^6 to 2^32 bits")
        self.mask = (1 << bits) - 1
        word = F.split("phrase", " ")
        turned = F.xxhash64(word[1])
        turned = F.shiftleft(turned, TURN).bitwiseOR(F.shiftrightunsigned(turned, 64 - TURN))
        h = F.xxhash64("lang").bitwiseXOR(F.xxhash64(word[0])).bitwiseXOR(turned)
        places = F.explode(F.array(h.bitwiseAND(F.lit(self.mask)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(self.mask))))
        held = pairs.select(places.alias("_p")).groupBy(F.shiftright("_p", 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_p").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
        table = held.toArrow()
        array = np.zeros((self.mask + 1) // 64, np.int64)
        array[table["at"].to_numpy()] = table["bits"].to_numpy()
        self.held = pairs.sparkSession.sparkContext.broadcast(array.view(np.uint64))

    def neighbours(self, lang: str, words: np.ndarray) -> np.ndarray:
        """Whether the filter has the pair of each word and the one before it; given the words' hashes."""
        turned = words << np.uint64(TURN) | words >> np.uint64(64 - TURN)
        h = np.uint64(xxhash.xxh64_intdigest(lang.encode(), SEED)) ^ words[:-1] ^ turned[1:]
        out = np.ones(len(words), bool)
        for place in (h & np.uint64(self.mask), h >> np.uint64(32) & np.uint64(self.mask)):
            out[1:] &= (self.held.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def score(a: F.Column, left: F.Column, right: F.Column) -> F.Column:
    """``floor(1000000 a a / (l r))``, exact: products of 38 digits and whole division."""
    wide = [c.cast("decimal(19,0)") for c in (a, left, right)]
    top = (wide[0] * wide[0]).cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (wide[1] * wide[2]).cast("decimal(38,0)"))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = 3,
    least: int = 10,
    covered: int = 50,
    top: int = 2000,
    burst: int = 1 << 14,
    entries: int = 1_000_000,
    filter_bits: int = 26,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of 2 to ``longest`` (2 or 3) words of each language.

    Phrases are found ``least`` times or more. One that lies in a longer one which is found ``covered`` percent as often or more is left out.
    """
    if longest not in (2, 3):
        raise ValueError("longest must be 2 or 3")
    counts = count_phrases(docs, text_col, lang_col, (1, 2), burst, entries)
    frequent = stage(counts.where((F.col("n") >= least) | (F.col("phrase") == "")), "frequent-phrases")
    if longest == 3:
        pairs = PairFilter(frequent.where(F.col("phrase").contains(" ")), filter_bits)
        more = count_phrases(docs, text_col, lang_col, (3,), burst, entries, pairs).where((F.col("n") >= least) & (F.col("phrase") != ""))
        frequent = frequent.union(stage(more, "frequent-triples"))
    spaces = F.length(F.translate("phrase", " ", "")) * -1 + F.length("phrase")
    candidates = frequent.where(F.col("phrase") != "").select("lang", "phrase", F.col("n").alias("a"), spaces.alias("m")).where("m > 0")
    word = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("m")),
        lambda k: F.struct(k.alias("k"), F.array_join(F.slice(word, 1, k), " ").alias("first"), F.array_join(F.slice(word, k + 1, F.col("m") + 1 - k), " ").alias("rest")),
    )
    cut = candidates.select("lang", "phrase", "a", F.inline(cuts))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("c"))
    # What lies in a longer candidate, with the count of the most frequent one.
    at = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("m")), lambda w: F.transform(F.sequence(F.lit(1), F.col("m") + 2 - w), lambda i: F.array_join(F.slice(word, i, w), " ")))))
    longer = candidates.where("m > 1").select("lang", at.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("_longer") < covered * F.col("a"), F.lit(True)))
    rows = kept.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    # First the best of each slice of a language, so that no task gets all of it.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slice_ = F.pmod(F.xxhash64("phrase"), F.lit(32))
    some = rows.withColumn("_slice", slice_).withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_slice").orderBy(*order))).where(F.col("_r") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    words = frequent.where("phrase = ''").select("lang", F.col("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
