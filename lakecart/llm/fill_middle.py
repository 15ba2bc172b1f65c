"""Fill-in-middle transformation by secondary sort (dealt operator 12).

Every document becomes pieces of whole units, keyed by document and output position.  One repartitioning by document
and a sort within each partition (`repartitionAndSortWithinPartitions` on DataFrames) bring a document's pieces next
to each other in output order, so they stream into an incremental digest.  A second sort within the same partitions,
by original position and without another shuffle, streams them back into the restored text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import blake2b, sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.llm.textbatch import slices


class Rule(NamedTuple):
    """How texts are cut and arranged; h1 to h4 are `draws` of the document id."""

    fim_percent: int = 100  # h3 % 100 below this: transformed
    spm_percent: int = 50  # h4 % 100 below this: suffix first
    seed: int = 7
    piece_bytes: int = 1 << 16  # pieces are closed at the first unit end beyond this; longer units are cut


# The sentinels of prefix, suffix and middle, and the order of sections in each form's output.
SENTINELS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
OUTPUT_ORDER = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
TEXT_ORDER = ("prefix", "middle", "suffix")
HAS_SENTINEL = re.compile(b"|".join(SENTINELS.values())).search

# Rows held while a batch of pieces is built, and its size.
BATCH_PIECES, BATCH_BYTES = 4096, 1 << 23

KEY = "key binary"
FACTS = "form string, n long, prefix_chars long, middle_chars long"


def draws(seed: int, doc_id) -> list[int]:
    """The first four 8-digit groups of the hex sha256 of `seed:doc_id`; a null id is the empty text."""
    h = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i : i + 8], 16) for i in range(0, 32, 8)]


def unit_ends(text: bytes) -> list[int]:
    """End offsets of the lines of a text; a line end belongs to its line."""
    ends = [m.end() for m in re.finditer(b"\n", text)]
    if text and not text.endswith(b"\n"):
        ends.append(len(text))
    return ends


def chars(data: bytes) -> int:
    return len(data.decode("utf-8", "replace"))


def cut(text: bytes, doc_id, rule: Rule) -> tuple[str, int, dict[str, bytes] | None]:
    """(form, units, sections of the text or None if it stays plain)."""
    ends = unit_ends(text)
    h1, h2, h3, h4 = draws(rule.seed, doc_id)
    if not text or h3 % 100 >= rule.fim_percent or HAS_SENTINEL(text):
        return "plain", len(ends), None
    a, b = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    starts = [0, *ends]
    sections = {"prefix": text[: starts[a]], "middle": text[starts[a] : starts[b]], "suffix": text[starts[b] :]}
    return ("spm" if h4 % 100 < rule.spm_percent else "psm"), len(ends), sections


def pieces(data: bytes, size: int) -> Iterator[bytes]:
    """Data in chunks of whole units of about `size` bytes; a longer unit is cut; one empty chunk of no data."""
    at = 0
    while len(data) - at > size:
        end = data.find(b"\n", at + size - 1, at + 2 * size) + 1 or at + size
        yield data[at:end]
        at = end
    yield data[at:]


def output_pieces(form: str, text: bytes, sections: dict[str, bytes] | None, size: int) -> Iterator[bytes]:
    """The output in order; each section opens a piece with its sentinel."""
    if sections is None:
        yield from pieces(text, size)
        return
    for name in OUTPUT_ORDER[form]:
        mark = SENTINELS[name]
        for piece in pieces(sections[name], size):
            yield mark + piece
            mark = b""


class _Rows:
    """Collects rows into Arrow batches of bounded size."""

    def __init__(self, columns: str, kinds: dict[str, pa.DataType] | None = None):
        plain = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
        self.fields = [(n, (kinds or {}).get(n) or plain[t]) for n, t in (c.split() for c in columns.split(", "))]
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple, size: int = 0) -> bool:
        """True if the batch is full."""
        self.rows.append(row)
        self.size += size
        return len(self.rows) >= BATCH_PIECES or self.size >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[] for _ in self.fields]
        out = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, self.fields, strict=True)],
                                         names=[n for n, _ in self.fields])
        self.rows, self.size = [], 0
        return out


def document_pieces(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(key, pos, piece, doc_id, form, n, prefix_chars, middle_chars, copies): each document's output in pieces.

    All but key, pos and piece stand at position 0 only.  The key is a digest of id and text with the number of the
    scan partition, so repeated rows are one sequence per partition (counted in `copies`) and never meet in one task.
    """
    columns = f"{KEY}, pos long, piece binary, doc_id {{}}, {FACTS}, copies long"
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for part in slices(batches):
            if out is None:
                out = _Rows(columns.format("long"), {"doc_id": part.schema.field("doc_id").type})
            seen: dict[bytes, list] = {}
            for doc_id, text, pid in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "pid")), strict=True):
                text = text or b""
                key = blake2b(f"{doc_id!r}|".encode() + text, digest_size=16).digest() + pid.to_bytes(4, "big")
                seen.setdefault(key, [doc_id, text, 0])[2] += 1
            for key, (doc_id, text, copies) in seen.items():
                form, n, sections = cut(text, doc_id, rule)
                sizes = (chars(sections["prefix"]), chars(sections["middle"])) if sections else (None, None)
                facts = (doc_id, form, n, *sizes, copies)
                for pos, piece in enumerate(output_pieces(form, text, sections, rule.piece_bytes)):
                    if out.add((key, pos, piece, *(facts if pos == 0 else (None,) * 6)), len(piece)):
                        yield out.batch()
            if out.rows:
                yield out.batch()

    src = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"),
                      F.spark_partition_id().alias("pid"))
    return src.mapInArrow(run, columns.format(kind))


def _in_order(df: DataFrame, *order: str) -> DataFrame:
    """Each document in one partition, its rows in order."""
    return df.repartition("key").sortWithinPartitions("key", *order)


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for part in slices(batches):
        yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def _digested(sorted_pieces: DataFrame) -> DataFrame:
    """(key, back, data, output_sha256, doc facts): the output digested, its pieces at their places in the text.

    `back` is null for the row that ends a document, which carries its facts and digest; null sorts first.
    """
    kind = sorted_pieces.schema["doc_id"].dataType.simpleString()
    columns = f"{KEY}, back long, data binary, doc_id {{}}, {FACTS}, copies long, output_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = state = None
        names = ("key", "pos", "piece", "doc_id", "form", "n", "prefix_chars", "middle_chars", "copies")

        def ended():
            return (state["key"], None, None, *state["facts"], state["copies"], state["digest"].hexdigest())

        kinds = {}
        batches = _noting(batches, kinds, "doc_id")
        for key, pos, piece, *facts in _rows(batches, *names):
            out = out or _Rows(columns.format("long"), kinds)
            if state is None or state["key"] != key:
                if state is not None and out.add(ended()):
                    yield out.batch()
                state = {"key": key, "at": -1, "facts": facts[:5], "copies": 0, "digest": sha256(), "open": 0}
            state["copies"] += facts[5] or 0
            if pos == state["at"]:  # the same piece of a repeated row
                continue
            state["at"] = pos
            state["digest"].update(piece)
            form, rank = state["facts"][1], 0
            if form != "plain":
                opened = len(OUTPUT_ORDER[form]) > state["open"] and OUTPUT_ORDER[form][state["open"]]
                if opened and piece.startswith(SENTINELS[opened]):
                    piece = piece[len(SENTINELS[opened]) :]
                    state["open"] += 1
                rank = TEXT_ORDER.index(OUTPUT_ORDER[form][state["open"] - 1])
            if out.add((key, rank << 56 | pos, piece, *(None,) * 7), len(piece)):
                yield out.batch()
        if state is not None:
            out.add(ended())
            yield out.batch()

    return sorted_pieces.mapInArrow(run, columns.format(kind))


def _noting(batches: Iterator[pa.RecordBatch], kinds: dict, name: str) -> Iterator[pa.RecordBatch]:
    """The batches, the Arrow type of one column noted on the way."""
    for part in batches:
        kinds.setdefault(name, part.schema.field(name).type)
        yield part


def _restored(digested: DataFrame) -> DataFrame:
    """One row per document and copy, the pieces in the order of the text digested again."""
    kind = digested.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {{}}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = facts = digest = None
        names = ("key", "back", "data", "doc_id", "form", "n", "prefix_chars", "middle_chars", "copies", "output_sha256")
        kinds = {}

        def ended():
            doc_id, form, n, prefix, middle, copies, output = facts
            return [(doc_id, n, form, prefix, middle, output, digest.hexdigest())] * copies

        for _, back, data, *row in _rows(_noting(batches, kinds, "doc_id"), *names):
            out = out or _Rows(columns.format("long"), kinds)
            if back is None:
                for r in ended() if facts else []:
                    if out.add(r):
                        yield out.batch()
                facts, digest = row, sha256()
            else:
                digest.update(data)
        if facts:
            for r in ended():
                out.add(r)
            yield out.batch()

    return digested.mapInArrow(run, columns.format(kind))


def fim_digests(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 per row of `docs`.

    The texts move once, as pieces; both digests are incremental, so a text of any length needs the memory of a few
    pieces beyond the scan.  Null text is empty; a null id draws as the empty text; repeated rows repeat; different
    texts under one id are separate documents; an empty table gives no rows; other columns are not read.
    """
    return _restored(_digested(_in_order(document_pieces(docs, rule), "pos")).sortWithinPartitions("key", "back"))


def _assembled(df: DataFrame, *order: str) -> DataFrame:
    """(doc_id, form, n, prefix_chars, middle_chars, text): sorted pieces joined, one row per document and copy."""
    kind = df.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {{}}, {FACTS}, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = last = None
        held: list[bytes] = []
        facts, copies, kinds = (), 0, {}

        def ended():
            return [(*facts, b"".join(held).decode("utf-8", "replace"))] * copies

        names = ("key", "pos", "piece", "doc_id", "form", "n", "prefix_chars", "middle_chars", "copies")
        for key, pos, piece, *row in _rows(_noting(batches, kinds, "doc_id"), *names):
            out = out or _Rows(columns.format("long"), kinds)
            if last is None or last[0] != key:
                for r in ended() if last else []:
                    if out.add(r, len(r[-1])):
                        yield out.batch()
                held, facts, copies, last = [], tuple(row[:5]), 0, None
            copies += row[5] or 0
            if last != (key, pos):
                held.append(piece)
            last = (key, pos)
        if last:
            for r in ended():
                out.add(r)
            yield out.batch()

    return _in_order(df, *order).mapInArrow(run, columns.format(kind))


def fim_documents(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, form, n, prefix_chars, middle_chars, text: the transformed texts themselves.  Rows as `fim_digests`."""
    return _assembled(document_pieces(docs, rule), "pos")


def restore_documents(transformed: DataFrame, text: str | Column = "text") -> DataFrame:
    """doc_id, text: the original texts, from the columns doc_id and form and the output text alone.

    Sections are found by their sentinels (no text that holds one is transformed), put back in order and joined.
    A null form or text gives a null text; plain texts are themselves.
    """
    c = F.col(text) if isinstance(text, str) else text

    def between(a: str, b: str | None) -> Column:
        tail = F.substring_index(c, a, -1)
        return F.substring_index(tail, b, 1) if b else tail

    psm = F.concat(between("<P>", "<S>"), between("<M>", None), between("<S>", "<M>"))
    spm = F.concat(between("<P>", "<M>"), between("<M>", None), between("<S>", "<P>"))
    return transformed.select("doc_id", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm)
                              .when(F.col("form") == "plain", c).alias("text"))
