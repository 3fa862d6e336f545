"""Byte-level BPE by a sentencepiece model that is made from the ranks alone.

A rank file gives each token's bytes and its rank. Every byte stands for one
character (byte b for U+0100 + b: letters, none of them white space), so a token
is a string, and the strings with the negative rank as score are a sentencepiece
BPE model: it joins the two neighbours whose union has the best score, the first
of several, which is the merge of least rank. Normalisation is the identity, and
no space is added, dropped or replaced. The model's ids are the ranks; one unknown
piece follows them, of a character that no byte stands for.

A text is cut into pre-tokens by the vocabulary's pattern, with the letters, numbers
and blanks that the tiktoken library knows (other modules may know a later Unicode). A pre-token that is a token as a whole is that token; any other goes
through the model. Decoding looks up each id's bytes.

Model and pattern are made on the driver and sent to the tasks with the function
(about a megabyte: the vocabulary's size, whatever the input's), so executors read
no file.

Defined results
    null or empty text    no ids; decodes to no bytes
    very long text        encoded whole; the ids of a row are held at once, those of a batch are not
    repeated rows         each gets its row
    null id               kept
    empty table           no rows
    extra columns         kept; a column named as the result is replaced, others that clash are not touched
"""

from __future__ import annotations

import base64
import re
import struct
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from terrane.llm.common import fresh

#: Pre-tokens that a worker remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 300_000, 40
#: Characters that are encoded together; a longer text is encoded in parts.
BLOCK = 1 << 20
BYTE_CHARS = {b: chr(0x100 + b) for b in range(256)}
UNKNOWN = "unknown"  # letters below U+0100: no token is spelled with them


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> list[bytes]:
    """The tokens by rank; ranks must run from 0 without a gap."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or not {bytes([b]) for b in range(256)} <= ranks.keys():
        raise ValueError(f"{path}: ranks must run from 0 without a gap and cover every byte")
    return tokens


@cache
def pre_token_pattern(below: int = 0x110000) -> str:
    """The public pattern with each character class spelled out as what tiktoken takes for it, whatever Unicode version other modules know.

    The pattern is right for characters under ``below``: sets of those up to U+FFFF are looked up much faster than others.
    """
    import public_tokenizers
    import tiktoken

    text = "".join(chr(c) for c in range(below) if not 0xD800 <= c < 0xE000)
    ranges = {}
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        probe = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        codes = np.frombuffer(bytes(probe.encode_ordinary(text)).decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1)
        ranges[kind] = "".join(rf"\U{r[0]:08x}-\U{r[-1]:08x}" for r in runs)
    # Within a set a class is its ranges; elsewhere it is a set of them.
    by_set = re.split(r"(\[.*?\])", public_tokenizers.PATTERN)
    for i, part in enumerate(by_set):
        for kind, r in ranges.items():
            part = part.replace(kind, r if i % 2 else f"[{r}]")
        by_set[i] = part.replace(r"\S", f"[^{ranges[r'\s']}]")
    return "".join(by_set)


def as_chars(data: bytes) -> str:
    return data.decode("latin-1").translate(BYTE_CHARS)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One field of a protocol buffer: a whole number, a 32-bit float, or bytes with their length."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(tokens: Iterable[bytes]) -> bytes:
    """The serialised model: pieces (1), trainer (2) and normaliser (3) of sentencepiece's public message."""
    tokens = list(tokens)
    pieces = [_field(1, as_chars(t).encode()) + _field(2, -float(rank)) for rank, t in enumerate(tokens)]
    pieces.append(_field(1, UNKNOWN.encode()) + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens))
    normaliser = _field(1, b"identity") + b"".join(_field(k, 0) for k in (3, 4, 5))
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


#: Where a text can be cut whatever stands around: before a space that stands alone between characters that are not white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def segments(text: str, size: int) -> Iterator[str]:
    """A long text in parts that are encoded by themselves."""
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Codec:
    """Encodes texts by the block: pre-tokens that are new in a block are encoded in one call, and remembered if they are short."""

    def __init__(self, model: bytes, basic: str, full: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.processor.get_piece_size() - 1
        chars = {c: b for b, c in BYTE_CHARS.items()}
        self.tokens = [bytes(map(chars.__getitem__, p)) for p in self.processor.id_to_piece(list(range(n)))]
        self.whole = {t: i for i, t in enumerate(self.tokens)}
        self.basic, self.full = re.compile(basic).findall, re.compile(full).findall
        self.known: dict[str, bytes] = {}

    def pre_tokens(self, text: str) -> list[str]:
        return (self.basic if len(text.encode("utf-16-le")) == 2 * len(text) else self.full)(text)

    def _learn(self, new: set[str]) -> None:
        rest = []
        for piece in new:
            data = piece.encode()
            whole = self.whole.get(data)
            if whole is None:
                rest.append((piece, as_chars(data)))
            else:
                self.known[piece] = array("i", [whole]).tobytes()
        if rest:
            for (piece, _), ids in zip(rest, self.processor.encode([chars for _, chars in rest], num_threads=1), strict=True):
                self.known[piece] = array("i", ids).tobytes()

    def _block(self, texts: list[str]) -> list[bytes]:
        found = [self.pre_tokens(t) for t in texts]
        known = self.known
        new = {p for pieces in found for p in pieces if p not in known}
        self._learn(new)
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in found]
        for long in [p for p in new if len(p) > LONGEST]:
            del known[long]
        if len(known) > REMEMBERED:
            known.clear()
        return out

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        block: list[str] = []
        held = 0
        for text in texts:
            if len(text) > BLOCK:
                yield from self._ids(block)
                block, held = [], 0
                parts = [ids for part in segments(text, BLOCK) for ids in self._block([part])]
                yield np.frombuffer(b"".join(parts), np.int32)
                continue
            block.append(text)
            held += len(text)
            if held > BLOCK:
                yield from self._ids(block)
                block, held = [], 0
        yield from self._ids(block)

    def _ids(self, block: list[str]) -> Iterator[np.ndarray]:
        for ids in self._block(block):
            yield np.frombuffer(ids, np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_codecs: dict[tuple[bytes, str, str], Codec] = {}


def codec(*parts) -> Codec:
    """A worker's codec of this model: it is kept from one batch and task to the next."""
    if parts not in _codecs:
        _codecs[parts] = Codec(*parts)
    return _codecs[parts]


def _parts(vocabulary: str | None) -> tuple[bytes, str, str]:
    return sentencepiece_model(read_ranks(vocabulary or default_vocabulary())), pre_token_pattern(0x10000), pre_token_pattern()


def _with_column(df: DataFrame, source: str, result: str, kind: DataType, convert: Callable[[pa.Array], Iterator[pa.Array]]) -> DataFrame:
    """``df`` with a column made of another. ``convert`` gives it for the first rows of a batch, then for the next, as many as it likes."""
    kept = df.drop(result)
    given = fresh(df, "_given")
    schema = StructType([*kept.schema.fields, StructField(result, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest, at = batch.drop_columns([given]), 0
            for made in convert(batch[given]):
                part = rest.slice(at, len(made))
                at += len(made)
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, result])

    return df.select(*(F.col(f"`{c}`") for c in kept.columns), F.col(source).alias(given)).mapInArrow(run, schema)


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text, as an array."""
    parts = _parts(vocabulary)

    def convert(texts: pa.Array) -> Iterator[pa.Array]:
        some: list[np.ndarray] = []
        held = 0
        for ids in codec(*parts).encode(t or "" for t in texts.to_pylist()):
            some.append(ids)
            held += len(ids)
            if held > BLOCK // 4:
                yield _lists(some)
                some, held = [], 0
        yield _lists(some)

    return _with_column(docs, text_col, ids_col, ArrayType(IntegerType()), convert)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int32), pa.int32()))


def decode(encoded: DataFrame, ids_col: str = "ids", bytes_col: str = "bytes", vocabulary: str | None = None) -> DataFrame:
    """``encoded`` with the bytes that the ids stand for; null for null. An id outside the vocabulary is an error."""
    parts = _parts(vocabulary)

    def convert(lists: pa.Array) -> Iterator[pa.Array]:
        known = codec(*parts)
        for i in range(0, len(lists), 1000):
            yield pa.array([known.decode(ids.values.to_numpy()) if ids.is_valid else None for ids in lists[i : i + 1000]], pa.binary())

    return _with_column(encoded, ids_col, bytes_col, BinaryType(), convert)
