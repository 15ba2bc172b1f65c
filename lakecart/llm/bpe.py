"""Byte-level BPE run by a sentencepiece model serialised from the vocabulary (dealt operator 9)."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecart.llm.textbatch import slices

# Distinct pre-tokens remembered per task, and the longest of them; beyond that they are encoded again.
CACHE_ENTRIES, CACHE_LENGTH = 150_000, 48


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def byte_letters() -> list[str]:
    """A printable, space-free character for each byte: itself where it is one, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n & (1 << 64) - 1)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece i is token i with each byte as its letter, scored -i.

    Merging the best-scored pair first is then merging the lowest rank first.  The unknown piece comes last (all
    bytes are pieces, so it is never used); no other special piece, identity normalisation, no added or changed
    spaces.  Field numbers are those of the public sentencepiece model format.
    """
    letters = byte_letters()
    pieces = b"".join(
        _bytes(1, _bytes(1, "".join(letters[b] for b in t).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(i)))
        for i, t in enumerate(tokens))
    unknown = _bytes(1, _bytes(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2))
    trainer = (_number(3, 2) + _number(4, len(tokens) + 1) + _number(40, len(tokens))
               + b"".join(_number(f, -1) for f in (41, 42, 43)))
    normaliser = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return pieces + unknown + _bytes(2, trainer) + _bytes(3, normaliser)


class Codec:
    """Encodes and decodes whole texts; one per task."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        import regex
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_proto=model)
        self.tokens, self.split = tokens, regex.compile(pattern).findall
        self.letters = byte_letters()
        self.cache: dict[str, bytes] = {}

    def _encoded(self, pretokens: list[str]) -> list[bytes]:
        letters = [t.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters) for t in pretokens]
        return [np.array(ids, np.uint32).tobytes() for ids in self.pieces.encode(letters, num_threads=1)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; each pre-token separately."""
        cache = self.cache
        pretokens = self.split(text)
        missing = [t for t in dict.fromkeys(pretokens) if t not in cache]
        if len(cache) + len(missing) > CACHE_ENTRIES:
            cache.clear()
            missing = list(dict.fromkeys(pretokens))
        cache.update(zip(missing, self._encoded(missing), strict=True))
        ids = b"".join(map(cache.__getitem__, pretokens))
        for t in missing:
            if len(t) > CACHE_LENGTH:
                del cache[t]
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        return ids

    def decode(self, ids: bytes) -> bytes:
        """Inverse mapping: the bytes of each id's token."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), decoded (binary) per document.

    Pre-tokens are the matches of `pattern`; each is encoded on its own by a sentencepiece model serialised from the
    rank file on the driver (about a megabyte, broadcast), then the ids are decoded by the inverse mapping.
    Null text is empty; empty text has no ids; repeated rows repeat; an empty table gives no rows; only doc_id and
    text are read.  No shuffle.
    """
    return _mapped(docs, vocabulary_path, pattern, "ids binary, decoded binary", lambda ids, back: (
        pa.array(ids, pa.binary()), pa.array(back, pa.binary())))


def token_digests(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """As `encode_documents`, with digests in place of ids and bytes: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _mapped(docs, vocabulary_path, pattern, "n_tokens long, ids_sha256 string, decoded_sha256 string", lambda ids, back: (
        pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([sha256(i).hexdigest() for i in ids], pa.string()),
        pa.array([sha256(b).hexdigest() for b in back], pa.string())))


def _mapped(docs: DataFrame, vocabulary_path: str, pattern: str, columns: str, made) -> DataFrame:
    tokens = read_ranks(vocabulary_path)
    shared = docs.sparkSession.sparkContext.broadcast((serialise_model(tokens), tokens, pattern))
    names = ["doc_id", *(c.split()[0] for c in columns.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for part in slices(batches):
            ids = [codec.encode(t or "") for t in part.column("text").to_pylist()]
            back = [codec.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *made(ids, back)], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, f"doc_id {kind}, {columns}")
