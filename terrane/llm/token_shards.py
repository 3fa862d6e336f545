"""Token ids in training order, in shards of a fixed stride.

Texts are encoded with a public byte-level BPE vocabulary, closed by an
end-of-text id and cut into sequences. The sequences are numbered 0 to N-1 in the
order of a hash of id, text and chunk, whatever the partitions of the input: they
are dealt to tasks by ranges of the hash, sorted there, and the ranges' counts
give each its first number. A keyed Feistel network with cycle-walking permutes
the numbers; that is a sequence's slot. So the slots follow from the rows and the
key alone. Slots are dealt out by range, ``stride`` to a shard, and every sequence
is padded to the same bytes, so slot k is row ``k % stride`` of shard
``k // stride`` and a reader can go on from any slot.

Decoding the sequences of a document in chunk order gives its text again.

Defined results
    null or empty text    one sequence with the end-of-text id alone; reads back as the empty text
    very long text        encoded in blocks that end where the encoding cannot depend on what follows
    repeated rows         sequences of their own; rows that are equal in id and text are told apart by nothing,
                          so it does not matter which of them has which of their slots
    ties                  of the hash: by id, chunk and tokens
    null id               kept
    empty table           no rows
    extra columns         ignored
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm.common import stage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_TEXT = 50256
#: Fixed value: how the vocabulary's makers cut text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: An encoded chunk is remembered by its text, up to so many chunks a worker.
REMEMBERED = 300_000
ID_TYPE = np.dtype("<u2")  # 50,257 ids fit in two bytes

_encoders: dict[str, object] = {}


def encoder(vocabulary: str):
    if vocabulary not in _encoders:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[vocabulary] = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    return _encoders[vocabulary]


#: A place where a text can be cut: before a space that stands alone between two characters that are not white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space that does not stand alone, or not between other characters.
_UNEVEN = re.compile(r"\s\s|\A\s|\s\Z")


class Pieces(dict):
    """The ids of what follows a space that stands alone, with that space; encoded on first sight and remembered if short."""

    def __init__(self, enc):
        super().__init__()
        self.enc = enc

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.enc.encode_ordinary(f" {piece}"), ID_TYPE).tobytes()
        if len(piece) < 40:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


_pieces: dict[str, Pieces] = {}


def pieces(vocabulary: str) -> Pieces:
    """What this worker has encoded so far: it is kept from one task to the next."""
    if vocabulary not in _pieces:
        _pieces[vocabulary] = Pieces(encoder(vocabulary))
    return _pieces[vocabulary]


def encode(text: str, known: Pieces) -> bytes:
    """The ids of a text. A space that stands alone starts a piece, so the text between two such spaces is encoded by itself."""
    if not text:
        return b""
    first, *rest = _CUT.split(text) if _UNEVEN.search(text) else text.split(" ")
    return np.array(known.enc.encode_ordinary(first), ID_TYPE).tobytes() + b"".join(map(known.__getitem__, rest))


def token_sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 512, vocabulary: str = VOCABULARY) -> DataFrame:
    """``_id, doc, chunk, n_tokens, tokens``: sequences of at most ``length`` ids, two bytes each, little-endian; ``doc`` is a hash of id and text."""
    source = docs.select(F.col(id_col).alias("_id"), F.xxhash64(id_col, text_col).alias("_doc"), F.col(text_col).alias("_text"))
    kind = dict(source.dtypes)["_id"]
    end = np.array([END_OF_TEXT], ID_TYPE).tobytes()
    step = length * ID_TYPE.itemsize

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = pieces(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for key, doc, text in zip(batch["_id"], batch["_doc"], batch["_text"], strict=True):
                ids = encode(text or "", known) + end
                key = None if pd.isna(key) else key
                rows += [(key, doc, k, min(step, len(ids) - i) // ID_TYPE.itemsize, ids[i : i + step]) for k, i in enumerate(range(0, len(ids), step))]
                held += len(ids)
                if held > 8 << 20:
                    yield _frame(rows)
                    rows, held = [], 0
            yield _frame(rows)

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["_id", "doc", "chunk", "n_tokens", "tokens"])
        return frame.astype({"_id": "Int64"}) if kind in ("int", "bigint") else frame

    return source.mapInPandas(run, f"_id {kind}, doc long, chunk int, n_tokens int, tokens binary")


def feistel(index: np.ndarray, n: int, key: int, rounds: int = 4) -> np.ndarray:
    """A permutation of 0..n-1: the network permutes the next power of four, and walks on from results of n or more."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for r in range(rounds):
            z = right + np.uint64((key + r * 0x9E3779B97F4A7C15) % (1 << 64))
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((z ^ (z >> np.uint64(31))) & mask)
        return (left << half) | right

    with np.errstate(over="ignore"):
        out = once(index.astype(np.uint64))
        while (over := out >= np.uint64(n)).any():
            out[over] = once(out[over])
    return out.astype(np.int64)


def _slot(index: Column, n: int, key: int) -> Column:
    @F.pandas_udf("long")
    def permute(batch: pd.Series) -> pd.Series:
        return pd.Series(feistel(batch.to_numpy(np.int64), n, key))

    return permute(index)


def training_order(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 512,
    stride: int = 2048,
    key: int = 20_240_229,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """All sequences by slot: ``slot, shard, id, doc, chunk, n_tokens, tokens``; tokens padded to ``length`` ids with the end-of-text id.

    Rows are dealt to tasks by range of the slot and sorted there, so files hold consecutive slots.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = token_sequences(docs, id_col, text_col, length, vocabulary).withColumn("_h", F.xxhash64("doc", "chunk"))
    # Ranges of equal width of the upper 31 bits, in the order of the hash as a signed number. How many there are
    # decides which one a row is in, but not its place in the whole.
    upper = F.shiftrightunsigned(F.col("_h").bitwiseXOR(F.lit(-(1 << 63))), 33)
    dealt = hashed.withColumn("_range", F.floor(upper * tasks / (1 << 31)).cast("int"))
    sorted_ = dealt.repartitionById(tasks, F.col("_range")).sortWithinPartitions("_range", "_h", "_id", "chunk", "tokens")
    # The number is the row's in its task; it is written with the row and stays as it is.
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stage(sorted_.withColumn("_at", in_task).drop("_h"), "sequences")
    # One row for each range: as many as the shuffle has partitions, whatever the input's rows.
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("least")).orderBy("_range").collect()
    n = sum(r["n"] for r in counts)
    starts, total = [], 0
    for r in counts:
        starts.append((r["_range"], total - r["least"]))
        total += r["n"]
    offsets = spark.createDataFrame(starts, "_range int, _start long")
    index = F.col("_start") + F.col("_at")
    slots = rows.join(F.broadcast(offsets), "_range").withColumn("slot", _slot(index, n, key))
    # Slots are dense and known to be even, so their ranges need no sample of the data.
    shards = max(1, -(-n // stride))
    parts = max(1, min(shards, tasks * 4))
    shard = F.floor(F.col("slot") / stride).cast("long")
    ordered = slots.withColumn("shard", shard).withColumn("_part", F.floor(F.col("shard") * parts / shards).cast("int"))
    ordered = ordered.repartitionById(parts, F.col("_part")).sortWithinPartitions("slot")
    pad = np.full(length, END_OF_TEXT, ID_TYPE).tobytes()
    padded = F.concat("tokens", F.substring(F.lit(pad), F.lit(1), F.lit(len(pad)) - F.octet_length("tokens")))
    return ordered.select("slot", "shard", F.col("_id").alias(id_col), "doc", "chunk", "n_tokens", padded.alias("tokens"))


def write_shards(ordered: DataFrame, path: str, per_folder: int = 1024) -> None:
    """Rows of a fixed number of bytes in slot order, ``per_folder`` shards to a folder.

    A task has consecutive slots, so its files do too, and a reader skips files and row groups by their least and largest slot.
    """
    folders = ordered.withColumn("folder", F.floor(F.col("shard") / per_folder).cast("long"))
    folders.sortWithinPartitions("folder", "slot").write.partitionBy("folder").parquet(path)


def read_from(spark: SparkSession, path: str, slot: int, stride: int, per_folder: int = 1024) -> DataFrame:
    """Go on reading at ``slot``: earlier folders are not opened, earlier shards are skipped."""
    rows = spark.read.parquet(path).where((F.col("folder") >= slot // stride // per_folder) & (F.col("slot") >= slot))
    return rows.drop("folder").orderBy("slot")


def decode(sequences: DataFrame, id_col: str = "doc_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """``id, text`` again: a document's sequences joined in chunk order, without padding and end-of-text id; a row for each copy of it."""

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        enc = encoder(vocabulary)
        return ids.map(lambda b: enc.decode(np.frombuffer(b, ID_TYPE)[:-1].tolist()))

    own = F.substring(F.col("tokens"), F.lit(1), F.col("n_tokens") * ID_TYPE.itemsize)
    # Copies of a row fall together before its chunks are gathered.
    once = sequences.groupBy(id_col, "doc", "chunk").agg(F.min(own).alias("b"), F.count(F.lit(1)).alias("copies"))
    parts = once.groupBy(id_col, "doc").agg(F.array_sort(F.collect_list(F.struct("chunk", "b"))).alias("p"), F.min("copies").alias("copies"))
    joined = F.concat_ws("", F.transform("p", lambda x: F.hex(x["b"])))
    read = parts.select(id_col, "copies", text(F.unhex(joined)).alias("text"))
    return read.select(id_col, "text", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy")).drop("_copy")
