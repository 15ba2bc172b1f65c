"""Substring dedup by hashing lines and parts of lines (dealt operator 2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecart.llm.store import written
from lakecart.llm.textbatch import IS_SPACE, chunks, mix, slices, word_hashes

# A text is cut before each word whose hash is the smallest of the REACH words on both sides: cuts depend on the words
# alone, so a passage is cut alike wherever it stands and however its lines are broken.  Units are PARTS parts in a row,
# and whole lines of LINE_WORDS words or more.
REACH, PARTS, LINE_WORDS = 3, 3, 8
# Repeated units that touch or overlap are one passage, from this many words on; whole lines are one at any length.
PASSAGE_WORDS = 25

_R = np.uint64(0xD1342543DE82EF95)
_R_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 2**64))


def _run_hashes(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run x[first:last], from prefix sums of a polynomial modulo 2**64."""
    powers = np.cumprod(np.full(len(x), _R, np.uint64), dtype=np.uint64)
    back = np.cumprod(np.full(len(x), _R_INVERSE, np.uint64), dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * powers, dtype=np.uint64)))
    return mix((sums[last] - sums[first]) * back[first] + (last - first).astype(np.uint64))


def part_starts(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether a part starts at each word: at a text's first word, and where the hash is smallest within REACH."""
    smallest = np.ones(len(hashes), bool)
    for j in range(1, REACH + 1):
        same = text[j:] == text[:-j]
        smallest[j:] &= ~same | (hashes[j:] < hashes[:-j])
        smallest[:-j] &= ~same | (hashes[:-j] <= hashes[j:])
    smallest[0] = True
    smallest[1:] |= text[1:] != text[:-1]
    return smallest


def text_units(texts: list[str | None]) -> Iterator[tuple[np.ndarray, ...]]:
    """Units of the A-Z lower-cased texts, in blocks of arrays: text index, start and length in code points, first word
    in the text and number of words (negative for a whole line or paragraph), and a 64-bit and a 32-bit digest of the
    words.  Spacing does not matter to a digest.  (Lengths, not ends: small numbers keep the shuffled rows small.)"""
    for first_text, parts in chunks(texts, lower=True):
        hashes, at = word_hashes(parts)
        if not len(hashes):
            continue
        data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        edge = np.diff(np.concatenate(([0], (~IS_SPACE[data]).view(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        text = np.searchsorted(at, np.arange(len(hashes)), "right") - 1
        begin = np.cumsum([0] + [len(b) + 1 for b in parts])[text]
        line = np.cumsum(data == 10)[starts] + text

        cut = np.append(np.flatnonzero(part_starts(hashes, text)), len(hashes))
        a, b = cut[: -PARTS], cut[PARTS:]
        inside = text[a] == text[b - 1]
        row = np.flatnonzero(np.diff(line, prepend=-1))
        block = row[(text[row] != text[row - 1]) | (line[row] > line[row - 1] + 1)]  # after a line without words
        block = np.union1d(block, row[:1])
        row, block = np.append(row, len(hashes)), np.append(block, len(hashes))
        several = np.searchsorted(row, block[1:]) - np.searchsorted(row, block[:-1]) > 1
        whole_a, whole_b = np.concatenate((row[:-1], block[:-1][several])), np.concatenate((row[1:], block[1:][several]))
        long = whole_b - whole_a >= LINE_WORDS
        sign = np.repeat([1, -1], [int(inside.sum()), int(long.sum())])
        a, b = np.concatenate((a[inside], whole_a[long])), np.concatenate((b[inside], whole_b[long]))
        yield (text[a] + first_text, points[starts[a]] - points[begin[a]], points[ends[b - 1]] - points[starts[a]],
               a - at[text[a]], (b - a) * sign, _run_hashes(hashes, a, b),
               _run_hashes(mix(hashes), a, b) >> np.uint64(32))


def units(docs: DataFrame) -> DataFrame:
    """(doc_id, start, chars, w0, words, d1, d2): every unit of every whole text, words negative for lines, paragraphs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for t, start, chars, w0, words, d1, d2 in text_units(batch.column("text").to_pylist()):
                columns = [pa.array(ids[t]), *(pa.array(c.astype(np.int32)) for c in (start, chars, w0, words)),
                           pa.array(d1.view(np.int64)), pa.array(d2.astype(np.uint32).view(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "chars", "w0", "words", "d1", "d2"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.where("doc_id is not null and text is not null").mapInArrow(
        run, "doc_id long, start int, chars int, w0 int, words int, d1 long, d2 int")


def repeated_passages(docs: DataFrame, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """(doc_id, start, end, n_words, n_units, kept_doc_id): every passage to remove, one row each.

    Units are grouped by digest over all documents; the occurrence of smallest (doc_id, start) stays, the others are
    repeats.  Repeats of a document that touch or overlap, with `passage_words` words or more together, are one
    passage, with its offsets in the original text; kept_doc_id is the smallest document that keeps one of its units.
    With fewer words, a run that holds whole lines or paragraphs is a passage from the first to the end of the last of
    them, and a run of parts alone is none.
    A passage may lose the part at an end that is no end of a text or whole line (7 words on average).
    Groups are counted before the shuffle, and the join back can be split by adaptive execution, so a very common
    line meets in no single task.

    Null doc_id or text, empty and short texts: no passages.  A repeated row is the same document.  An empty table
    gives no rows; other columns are not read.
    """
    every = written(units(docs), "repeat-units", "zstd")
    first = every.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "start")).alias("kept"), F.count("*").alias("n"))
    first = first.where("n > 1").select("d1", "d2", F.col("kept.doc_id").alias("kept_doc"), F.col("kept.start").alias("kept_start"))
    again = every.join(first, ["d1", "d2"]).where("doc_id <> kept_doc or start <> kept_start").select(
        "doc_id", "start", (F.col("start") + F.col("chars")).alias("end"), "w0",
        (F.col("w0") + F.abs("words")).alias("w1"), "kept_doc", (F.col("words") < 0).alias("whole"))
    again = again.groupBy("doc_id", "start", "end", "w0", "w1", "kept_doc").agg(F.max("whole").alias("whole"))
    order = Window.partitionBy("doc_id").orderBy("w0", "w1", "kept_doc")
    reached = F.max("w1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = again.withColumn("apart", F.when(F.col("w0") <= reached, 0).otherwise(1))
    runs = apart.withColumn("run", F.sum("apart").over(order)).groupBy("doc_id", "run")
    long = F.max("w1") - F.min("w0") >= passage_words
    def of(fn, col):  # over the run, or over its whole lines if it is short
        return F.when(long, fn(col)).otherwise(fn(F.when(F.col("whole"), F.col(col))))

    passages = runs.agg(
        of(F.min, "start").alias("start"), of(F.max, "end").alias("end"),
        (of(F.max, "w1") - of(F.min, "w0")).cast("int").alias("n_words"),
        F.when(long, F.count("*")).otherwise(F.count_if("whole")).alias("n_units"), of(F.min, "kept_doc").alias("kept_doc_id"))
    return passages.where("n_units > 0").drop("run")


def remove_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """`docs` with the passages cut out, and `removed`: their (start, end) in the original text (null without any).

    A column of the documents named `removed` gives way to it.
    """
    docs = docs.drop("removed")
    spans = passages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"))
    joined = docs.join(spans, "doc_id", "left").select(*docs.columns, "removed")
    n = F.size("removed")
    bounds = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(
        F.when(i == 0, 0).otherwise(F.get("removed", i - 1)["end"]).alias("a"),
        F.when(i == n, F.length("text")).otherwise(F.get("removed", i)["start"]).alias("b")))
    rest = F.array_join(F.transform(bounds, lambda s: F.substring("text", s["a"] + 1, s["b"] - s["a"])), "")
    return joined.withColumn("text", F.when(n > 0, rest).otherwise(F.col("text")))
