"""SentencePiece BPE encoding by vectorised merge rounds, and decoding (dealt operator 13).

Words (spaces and what follows them) are flat NumPy symbol arrays.  A round looks up the rank of every adjacent pair,
takes each word's best and leftmost pair, merges all of them at once and compacts the arrays, until no pair is left.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecart.llm.textbatch import slices

# The space symbol, and the piece types of the public model format.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

# A word of more symbols merges all pairs that are best within a piece's length, not only its best pair; when a round
# merges less than one pair in FEW (runs of equal pairs merge one by one) what is left is merged from a queue.
LONG_WORD, FEW = 64, 100
# Distinct words remembered per task, and the longest of them.
CACHE_WORDS, CACHE_LENGTH = 150_000, 48
# Texts whose unknown words are merged together: enough to make a round worth its calls, small beside the cache.
CHUNK_CHARS = 1 << 20
NONE = np.iinfo(np.int64).max

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """The vocabulary of a BPE model as arrays; picklable, a few megabytes."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        model = model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if (model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or not norm.add_dummy_prefix
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or not model.trainer_spec.byte_fallback or model.trainer_spec.treat_whitespace_as_suffix
                or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("only BPE models with byte fallback, identity normalisation and a dummy prefix are read")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece joins a word with the space after it")
        self.size = len(model.pieces)
        self.end_id = next(i for i, p in enumerate(model.pieces) if p.type == CONTROL and p.piece == "</s>")
        self.span = max(map(len, normal))
        order = {s: r for r, s in enumerate(sorted({-model.pieces[i].score for i in normal.values()}))}
        rank = {p: order[-model.pieces[i].score] for p, i in normal.items()}
        merges = sorted((normal[p[:k]] * self.size + normal[p[k:]], rank[p], i) for p, i in normal.items()
                        for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal)
        self.pair_key, self.pair_rank, self.pair_piece = (np.array(c, np.int64) for c in zip(*merges, strict=True))
        self.pairs: dict[int, tuple[int, int]] | None = None
        # symbols of single characters, and the pairs of characters that stand side by side in some piece
        letters = sorted(p for p in normal if len(p) == 1)
        self.letter_code = np.array([ord(c) for c in letters], np.int64)
        self.letter_piece = np.array([normal[c] for c in letters], np.int64)
        inner = {ord(a) << 32 | ord(b) for p in normal for a, b in zip(p, p[1:], strict=False)}
        self.inner = np.array(sorted(inner), np.int64)
        # ASCII marks that in no piece follow anything but a mark or space: a word may end before them
        marks = {c for c in range(128) if not chr(c).isalnum() and c != 0x20}
        while True:
            tied = {k & 0xFFFFFFFF for k in inner if k >> 32 not in marks and chr(k >> 32) != SPACE}
            if not marks & tied:
                break
            marks -= tied
        self.marks = "".join(map(chr, sorted(marks)))
        self.byte_piece = np.zeros(256, np.int64)
        shown: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_piece[int(p.piece[3:5], 16)] = i
            shown.append(bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" if p.type == CONTROL
                         else model.trainer_spec.unk_surface.encode() if p.type == UNKNOWN
                         else p.piece.replace(SPACE, " ").encode())
        self.shown = shown
        self.control = np.array([p.type == CONTROL for p in model.pieces])

    def table(self) -> dict[int, tuple[int, int]]:
        """The pairs as a dictionary, made when first needed."""
        if self.pairs is None:
            values = zip(self.pair_rank.tolist(), self.pair_piece.tolist(), strict=True)
            self.pairs = dict(zip(self.pair_key.tolist(), values, strict=True))
        return self.pairs

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE if no piece) and merged piece of each pair of symbols; negative symbols never merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        known = (self.pair_key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.pair_rank[at], NONE), self.pair_piece[at]


def _lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys, at


def _window_least(key: np.ndarray, reach: int) -> np.ndarray:
    """The least key within `reach` places on both sides."""
    width, full = 1, 2 * reach + 1
    out = np.concatenate((np.full(reach, NONE), key, np.full(reach, NONE)))
    while 2 * width <= full:
        out = np.minimum(out[: len(out) - width], out[width:])
        width *= 2
    return np.minimum(out[: len(key)], out[full - width : full - width + len(key)])


def merge_rounds(pieces: Pieces, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merged symbols and the words' new starts.  `starts` are the words' first places; no word is empty.

    Merging a word's best pair, the leftmost of equal ones, is what the library does one pair at a time.  In a long
    word every pair that comes first among those within a piece's greatest length merges as well: whatever merges
    before it lies outside, and a symbol that reached in from there would be longer than any piece.
    """
    words = len(starts)
    lengths = np.diff(np.append(starts, len(symbols)))
    done_symbols, done_words = [], []
    long_words = lengths > LONG_WORD
    for chosen, window in ((~long_words, 0), (long_words, pieces.span)):
        owner = np.repeat(np.arange(words), lengths)
        take = chosen[owner]
        sym, owner = symbols[take], owner[take]
        if not len(sym):
            continue
        rank, result = np.full(len(sym), NONE), np.zeros(len(sym), np.int64)
        fresh = np.arange(len(sym) - 1)
        while True:
            # look the changed pairs up; a word's last symbol has no pair
            fresh = fresh[owner[fresh] == owner[fresh + 1]]
            rank[fresh], result[fresh] = pieces.find(sym[fresh], sym[fresh + 1])
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            place = np.arange(len(sym))
            key = np.where(rank == NONE, NONE, rank << 32 | place)
            least = np.minimum.reduceat(key, first)
            open_words = np.repeat(least != NONE, np.diff(np.append(first, len(sym))))
            if not open_words.all():  # compaction: finished words leave
                done_symbols.append(sym[~open_words])
                done_words.append(owner[~open_words])
                sym, owner, rank, result, key = (a[open_words] for a in (sym, owner, rank, result, key))
                if not len(sym):
                    break
                least = least[least != NONE]
                key = np.where(rank == NONE, NONE, rank << 32 | np.arange(len(sym)))
                first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                least = np.minimum.reduceat(key, first)
            if window:
                at = np.flatnonzero((key == _window_least(key, window)) & (key != NONE))
                if len(at) * FEW < np.count_nonzero(key != NONE):
                    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(sym)], strict=True):
                        rest = merge_queue(pieces, sym[a:b].tolist())
                        done_symbols.append(np.array(rest, np.int64))
                        done_words.append(np.full(len(rest), owner[a]))
                    break
            else:
                at = least & 0xFFFFFFFF
            sym[at] = result[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            rank[at] = NONE  # also where the merged symbol is now its word's last
            sym, owner, rank, result = (a[keep] for a in (sym, owner, rank, result))
            at = moved[at]
            rank[np.maximum(at - 1, 0)[owner[np.maximum(at - 1, 0)] == owner[at]]] = NONE
            fresh = np.concatenate((at, np.maximum(at - 1, 0)))
            fresh = fresh[fresh < len(sym) - 1]
    owner = np.concatenate(done_words)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(done_symbols)[order], np.searchsorted(owner[order], np.arange(words))


def merge_queue(pieces: Pieces, symbols: list[int]) -> list[int]:
    """One word merged pair by pair from a queue ordered by rank, then place."""
    n = len(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    table = pieces.table()
    queue: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and symbols[i] >= 0 and symbols[j] >= 0:
            found = table.get(symbols[i] * pieces.size + symbols[j])
            if found:
                heapq.heappush(queue, (found[0], i, symbols[i], symbols[j]))

    for i in range(n):
        offer(i)
    gone = [False] * n
    while queue:
        _, i, a, b = heapq.heappop(queue)
        j = after[i]
        if gone[i] or symbols[i] != a or j < 0 or symbols[j] != b:
            continue
        symbols[i] = table[a * pieces.size + b][1]
        gone[j], after[i] = True, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [s for s, g in zip(symbols, gone, strict=True) if not g]


class PieceCodec:
    """Encodes and decodes whole texts; one per task."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        marks = f"[{re.escape(pieces.marks)}]" if pieces.marks else "(?!)"
        other = f"[^ {re.escape(pieces.marks)}]"
        self.words = re.compile(f" *{marks}*{other}+| *{marks}+| +").findall
        self.decimal = [f" {i}" for i in range(pieces.size)]
        self.cache: dict[str, tuple[bytes, bytes]] = {}
        self.ends = np.array([pieces.end_id], np.int32).tobytes()

    def encode_words(self, words: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """(ids, ids as decimal text with a space before each) of each word; no word is empty."""
        p = self.pieces
        joined = "".join(words).replace(" ", SPACE)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.array([len(w) for w in words])
        begins = np.cumsum(lengths) - lengths
        is_letter, at = _lookup(p.letter_code, code)
        # characters without a piece are themselves, negative, until they become bytes
        symbols = np.where(is_letter, p.letter_piece[at], -code - 1)
        # a word falls apart where no piece holds both neighbours
        apart = np.ones(len(code), bool)
        apart[1:] = ~_lookup(p.inner, code[:-1] << 32 | code[1:])[0]
        apart[begins] = True
        starts = np.flatnonzero(apart)
        merged, new_starts = merge_rounds(p, symbols, starts)
        ids, places = self._with_bytes(merged)
        edges = [*places[new_starts[np.searchsorted(starts, begins)]].tolist(), len(ids)]
        raw, decimal = ids.astype(np.int32).tobytes(), list(map(self.decimal.__getitem__, ids.tolist()))
        for a, b in zip(edges, edges[1:], strict=False):
            yield raw[4 * a : 4 * b], "".join(decimal[a:b]).encode()

    def _with_bytes(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, characters without a piece as their UTF-8 bytes, and each symbol's first place among them."""
        code = -symbols - 1
        width = np.where(symbols >= 0, 1, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        places = np.cumsum(width) - width
        ids = np.repeat(symbols, width)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
        for n in (1, 2, 3, 4):
            at = np.flatnonzero((symbols < 0) & (width == n))
            for j in range(n):
                low = code[at] >> 6 * (n - 1 - j)
                ids[places[at] + j] = self.pieces.byte_piece[lead[n] | low if j == 0 else 0x80 | low & 0x3F]
        return ids, places

    def _looked_up(self, texts: list[str]) -> Iterator[list[tuple[bytes, bytes]]]:
        """Per text, (ids, ids as decimal text with a space before each) of its words.

        The words that are not remembered are encoded together, in runs of texts of about CHUNK_CHARS.
        """
        cache, at = self.cache, 0
        while at < len(texts):
            run, size = [], 0
            while at < len(texts) and (not run or size < CHUNK_CHARS):
                run.append(self.words((" " + texts[at]).replace(SPACE, " ")) if texts[at] else [])
                size += len(texts[at])
                at += 1
            if len(cache) > CACHE_WORDS:
                cache.clear()
            missing = list(set().union(*run).difference(cache))
            if missing:
                cache.update(zip(missing, self.encode_words(missing), strict=True))
            yield from (list(map(cache.__getitem__, words)) for words in run)
            for w in missing:
                if len(w) > CACHE_LENGTH:
                    del cache[w]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, the end id last."""
        for found in self._looked_up(texts):
            yield np.frombuffer(b"".join([w[0] for w in found]) + self.ends, np.int32)

    def encode_digests(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids of each text with the end id, and the sha256 of the decimal ids joined by one space."""
        for found in self._looked_up(texts):
            decimal = b"".join([w[1] for w in found]) + f" {self.pieces.end_id}".encode()
            yield np.frombuffer(b"".join([w[0] for w in found]) + self.ends, np.int32), sha256(decimal[1:]).hexdigest()

    def decode(self, ids: np.ndarray) -> bytes:
        """The pieces' text as UTF-8; the first space of the text is the dummy prefix, bytes of no character are U+FFFD."""
        shown = list(map(self.pieces.shown.__getitem__, ids.tolist()))
        space = self.pieces.byte_piece[0x20]
        first = next((i for i, s in enumerate(shown) if s), None)
        if first is not None and shown[first][:1] == b" " and ids[first] != space and shown[first] != self.pieces.shown[0]:
            shown[first] = shown[first][1:]
        # bytes on both sides of a control piece are no one character
        cuts = [0, *np.flatnonzero(self.pieces.control[ids]).tolist(), len(shown)]
        return b"".join([_utf8(b"".join(shown[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)])


def _utf8(data: bytes) -> bytes:
    try:
        data.decode()
    except UnicodeDecodeError:
        return data.decode("utf-8", "each_byte").encode()
    return data


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array of int, the end id last) and decoded (string) per document.

    Exactly the ids of the library's model with an end id, no begin id and no sampling.  The model's vocabulary
    (fixed size) is broadcast as arrays; texts never move.  Null text is empty, empty text has the end id only;
    repeated rows repeat; an empty table gives no rows; only doc_id and text are read.
    """
    def made(codec: PieceCodec, texts: list[str]) -> tuple:
        ids = list(codec.encode(texts))
        return pa.array(ids, pa.list_(pa.int32())), pa.array([codec.decode(i).decode() for i in ids], pa.string())

    return _mapped(docs, model_path, "ids array<int>, decoded string", made)


def token_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """As `encode_documents` with digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    def made(codec: PieceCodec, texts: list[str]) -> tuple:
        rows = [(len(ids), digest, sha256(codec.decode(ids)).hexdigest()) for ids, digest in codec.encode_digests(texts)]
        return tuple(pa.array(list(c), k) for c, k in zip(
            zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True))

    return _mapped(docs, model_path, "n_tokens long, ids_sha256 string, decoded_sha256 string", made)


def _mapped(docs: DataFrame, model_path: str, columns: str, made) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model_path))
    names = ["doc_id", *(c.split()[0] for c in columns.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(shared.value)
        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *made(codec, texts)], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, f"doc_id {kind}, {columns}")
