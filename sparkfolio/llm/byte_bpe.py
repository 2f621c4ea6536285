"""Byte-level BPE encoding and decoding with a sentencepiece model made from a rank file.

The rank file is serialised as a sentencepiece BPE model directly, without training: each token's bytes are mapped
to printable characters, one for one; a piece's score is its negative rank, so that sentencepiece merges the pair of the
lowest rank first, the leftmost of equals; normalisation is the identity. Each match of the splitting pattern is
encoded on its own, and ids map back to bytes by the inverse of the character mapping.
"""

from __future__ import annotations

import base64
import gc
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.spark_env import prepare, trim

#: Splits whose ids a task keeps at hand.
CACHE = 200_000


def byte_characters() -> list[str]:
    """A character for each byte: the byte's own Latin-1 character if it is printable, else one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto whose ids are the ranks; the unknown piece comes last. Ranks are 0, 1, 2, ..."""
    letters = byte_characters()
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    pieces = [_field(1, _field(1, "".join(letters[b] for b in t).encode()) + _field(2, float(-i))) for i, t in enumerate(by_rank)]
    unknown = _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(by_rank) + 1) + _field(40, len(by_rank)) + b"".join(
        _varint(n << 3) + b"\xff" * 9 + b"\x01" for n in (41, 42, 43))       # -1: no other special pieces
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + unknown + _field(2, trainer) + _field(3, normalizer)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """Encoder and decoder of one rank file; a task makes it once for each worker process."""

    _made: dict[tuple[str, str], Codec] = {}

    def __init__(self, path: str, pattern: str):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(read_ranks(path)))
        self.split = regex.compile(pattern)
        letters = byte_characters()
        self.letters = {b: c for b, c in enumerate(letters)}
        back = {c: b for b, c in enumerate(letters)}
        self.bytes = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(self.model.get_piece_size() - 1)]
        self.known: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> Codec:
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit integers; what is new in all of them goes to the model in one call."""
        parts = [self.split.findall(t) for t in texts]
        if len(self.known) > CACHE:
            self.known.clear()
        if new := list(set(chain.from_iterable(parts)).difference(self.known)):
            mapped = [p.encode().decode("latin-1").translate(self.letters) for p in new]
            self.known.update([(p, np.array(ids, np.int32).tobytes())
                               for p, ids in zip(new, self.model.encode(mapped, num_threads=1), strict=True)])
        get = self.known.__getitem__
        return [b"".join(map(get, x)) for x in parts]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def _encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    codec = Codec.of(path, pattern)
    gc.set_threshold(1_000_000)                              # millions of short-lived lists, no cycles
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = codec.encode(part.column("text").fill_null("").to_pylist())
            ends = np.append(0, np.cumsum([len(x) // 4 for x in ids])).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(ends, flat)], ["doc_id", "ids"])
    codec.known.clear()
    trim()


def _decoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    codec = Codec.of(path, pattern)
    for batch in batches:
        decoded = [codec.decode(x.as_py() or []) for x in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"])


def _texts(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text string; other columns are ignored): doc_id, ids (array of int).

    Null and empty texts have no ids; rows that repeat get the same ids; an empty table gives no rows. ``path``, the rank file,
    has to be readable on all executors."""
    return _texts(docs).mapInArrow(lambda it: _encoded(it, path, pattern), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with a column ``decoded`` (binary): the bytes of the text; null ids count as none."""
    prepare(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(lambda it: _decoded(it, path, pattern), "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decode(encode(docs))`` in one pass over the texts, so that a task needs one Python worker, not two."""
    return _texts(docs).mapInArrow(lambda it: _decoded(_encoded(it, path, pattern), path, pattern),
                                   "doc_id long, ids array<int>, decoded binary")
