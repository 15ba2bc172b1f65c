"""Quality rules: plain text counts, then tokeniser fertility bands (dealt operator 10)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecart.llm.store import written
from lakecart.llm.textbatch import IS_SPACE, chunks, mix, slices, windows, word_hashes

# The contract's base rules.
MIN_WORDS, MAX_REPEAT_PERCENT, SYMBOLS = 50, 50, b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_SPACES = " \t\n\x0b\x0c\r"
CACHE_ENTRIES, CACHE_LENGTH = 150_000, 64


@dataclass(frozen=True)
class Band:
    """What a script's clean text stays within."""

    low_chars: float  # characters per token
    high_chars: float
    max_fallback: float  # share of tokens that are single-byte fallbacks
    min_entropy: float  # bits per token
    max_entropy: float


# Bands come from the corpus itself, per script and language (see `fitted_bands`).  These are for scripts of which it has
# fewer than GROUP_ROWS documents: wide, and without a vote for text that the vocabulary reads as bytes or digits.
BANDS = {
    "latin": Band(1.25, 9.0, 0.20, 3.0, 20.0),
    "greek_cyrillic": Band(0.9, 8.0, 0.30, 3.0, 20.0),
    "cjk": Band(0.3, 4.0, 0.80, 3.0, 20.0),
    "other": Band(0.85, 8.0, 0.50, 3.0, 20.0),
    "none": Band(0.25, 20.0, 0.50, 4.0, 20.0),
}
# A band reaches from the median TAIL_REACH times as far as the quantiles TAIL and 1 - TAIL do, and at least the
# slacks: relative for characters per token, absolute for byte share and bits.
TAIL, TAIL_REACH, GROUP_ROWS = 0.02, 2.0, 200
CHARS_SLACK, FALLBACK_SLACK, ENTROPY_SLACK = 0.06, 0.10, 0.6
# Languages with bands of their own, by documents.
LANGUAGES = 64
# First code points of Unicode script areas, with the script each starts.
_SCRIPT_FROM = [(0x0, "latin"), (0x370, "greek_cyrillic"), (0x530, "other"), (0x1E00, "latin"), (0x1F00, "greek_cyrillic"),
                (0x2000, "other"), (0x2C00, "other"), (0x2E80, "cjk"), (0xA000, "other"), (0xAC00, "cjk"), (0xD7B0, "other"),
                (0xF900, "cjk"), (0xFB00, "other"), (0xFF66, "cjk"), (0xFFDD, "other"), (0x20000, "cjk"), (0x32000, "other")]
SCRIPTS = ("latin", "greek_cyrillic", "cjk", "other")


def script_of(text: str) -> str:
    """The script of most of the text's letters, `none` without letters (ties to the first of SCRIPTS)."""
    letters = [c for c in set(text) if c.isalpha()]
    if not letters:
        return "none"
    if all(c < "Ͱ" for c in letters):
        return "latin"
    codes = np.array([c for c in map(ord, text) if chr(c).isalpha()])
    area = np.searchsorted([f for f, _ in _SCRIPT_FROM], codes, "right") - 1
    names = np.array([SCRIPTS.index(n) for _, n in _SCRIPT_FROM])[area]
    return SCRIPTS[int(np.bincount(names, minlength=len(SCRIPTS)).argmax())]


def base_counts(texts: list[str | None]) -> np.ndarray:
    """(texts × 5): words, code points in words, symbols, duplicate lines, words in repeated 3-word windows."""
    out = np.zeros((len(texts), 5), np.int64)
    for first, parts in chunks(texts):
        words, at = word_hashes(parts)
        n = np.diff(at)
        data = np.frombuffer(b"".join(parts) or b" ", np.uint8)
        ends = np.cumsum([len(p) for p in parts])
        begins = ends - [len(p) for p in parts]

        def per_text(mask, ends=ends, begins=begins):
            total = np.concatenate(([0], np.cumsum(mask)))
            return total[ends] - total[begins]

        rows = slice(first, first + len(parts))
        out[rows, 0] = n
        out[rows, 1] = per_text(~IS_SPACE[data] & ((data & 0xC0) != 0x80))
        out[rows, 2] = per_text(_SYMBOL[data])
        out[rows, 4] = _repeated(words, at)
        for i, t in enumerate(texts[rows]):
            if t and "\n" in t:
                lines = [x for x in t.split("\n") if x.strip(_SPACES)]
                out[first + i, 3] = len(lines) - len(set(lines))
    return out


def _repeated(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per text the words that lie in a 3-word window found twice or more in it."""
    n = np.diff(at)
    owner = np.repeat(np.arange(len(n)), n)
    covered = np.zeros(len(words) + 1, np.int64)
    if len(words) >= 3:
        runs = windows(words, 3)
        here = np.flatnonzero(owner[:-2] == owner[2:])
        keys = mix(runs[here] + owner[here].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        same = np.diff(keys[order]) == 0
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        hit = here[twice]
        mark = np.zeros(len(words) + 3, bool)
        for j in range(3):
            mark[hit + j] = True
        covered[1:] = np.cumsum(mark[: len(words)])
    return covered[at[1:]] - covered[at[:-1]]


class Fertility:
    """Token counts of whole texts, word by word, under one public vocabulary; one per task."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_proto=model)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.cache: dict[str, bytes] = {}

    def measure(self, text: str, word_chars: int) -> tuple[float, float, float]:
        """Characters per token, share of byte-fallback tokens, bits of entropy per token (zeros without words)."""
        words = text.translate(_TO_SPACE).split(" ") if text else []
        words = [w for w in words if w]
        if not words:
            return 0.0, 0.0, 0.0
        cache = self.cache
        missing = [w for w in dict.fromkeys(words) if w not in cache]
        if len(cache) + len(missing) > CACHE_ENTRIES:
            cache.clear()
            missing = list(dict.fromkeys(words))
        for w, ids in zip(missing, self.pieces.encode(missing, num_threads=1), strict=True):
            cache[w] = np.array(ids, np.uint16 if len(self.is_byte) < 65536 else np.uint32).tobytes()
        flat = np.frombuffer(b"".join(map(cache.__getitem__, words)), np.uint16 if len(self.is_byte) < 65536 else np.uint32)
        for w in missing:
            if len(w) > CACHE_LENGTH:
                del cache[w]
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        if not len(flat):  # words that the vocabulary's normaliser leaves nothing of
            return 0.0, 0.0, 0.0
        seen = np.unique(flat, return_counts=True)[1] / len(flat)
        return word_chars / len(flat), float(self.is_byte[flat].mean()), float(-(seen * np.log2(seen)).sum())


_TO_SPACE = str.maketrans(dict.fromkeys(_SPACES, " "))


def verdict(script: str, chars: float, fallback: float, entropy: float) -> bool:
    """The band of a script of which the corpus holds too little."""
    b = BANDS[script]
    return b.low_chars <= chars <= b.high_chars and fallback <= b.max_fallback and b.min_entropy <= entropy <= b.max_entropy


_MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
             "script string, chars_per_token double, byte_share double, token_entropy double")


def fitted_bands(measured: DataFrame) -> DataFrame:
    """(script, lang, band): the bands of a table with script, lang and the measures, a null lang being the whole script.

    Quantiles of all documents that pass the base rules, grouped by script and by script and language; groups under
    GROUP_ROWS documents have no band.  At most LANGUAGES languages, so the result is bounded.
    """
    rows = measured.where(~F.col("base_failed"))
    often = rows.where("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    named = [r["lang"] for r in often.collect()]
    lang = F.when(F.col("lang").isin(named), F.col("lang")) if named else F.lit(None).cast("string")
    cut = F.array(F.lit(TAIL), F.lit(0.5), F.lit(1 - TAIL))
    at = {c: F.percentile_approx(c, cut, 10_000).alias(c) for c in ("chars_per_token", "byte_share", "token_entropy")}
    group = rows.select("script", F.explode(F.array_distinct(F.array(lang, F.lit(None)))).alias("lang"), *at)
    found = group.groupBy("script", "lang").agg(F.count(F.lit(1)).alias("rows"), *at.values()).where(F.col("rows") >= GROUP_ROWS)

    def reach(name: str, side: int, slack: Column) -> Column:
        q = F.col(name)
        far = F.abs(q[0 if side < 0 else 2] - q[1]) * TAIL_REACH
        return q[1] + side * F.greatest(far, slack)

    chars = F.col("chars_per_token")[1] * CHARS_SLACK
    bits = F.lit(ENTROPY_SLACK)
    return found.select("script", "lang", F.struct(
        reach("chars_per_token", -1, chars).alias("low_chars"), reach("chars_per_token", 1, chars).alias("high_chars"),
        reach("byte_share", 1, F.lit(FALLBACK_SLACK)).alias("max_fallback"),
        reach("token_entropy", -1, bits).alias("min_entropy"), reach("token_entropy", 1, bits).alias("max_entropy")).alias("band"))


def _within_bands(script: Column, lang: Column, chars: Column, fallback: Column, entropy: Column, bands: list) -> Column:
    """True if the measures lie in the band of script and language.

    A null language may be any that has a band in this script (without one: the whole script's).  A language without a
    band goes by the script's fixed one, since other languages say little about it.
    """
    fixed = {k: [tuple(getattr(b, f) for f in Band.__dataclass_fields__)] for k, b in BANDS.items()}
    whole = {r["script"]: [tuple(r["band"])] for r in bands if r["lang"] is None}
    own: dict[str, list] = {}
    for r in bands:
        if r["lang"] is not None:
            own.setdefault(r["script"], []).append(tuple(r["band"]))
    table = {f"{k}|": v for k, v in (fixed | whole | own).items()} | fixed
    table |= {f"{r['script']}|={r['lang']}": [tuple(r["band"])] for r in bands if r["lang"] is not None}
    lists = F.create_map(*[x for key, v in table.items() for x in (
        F.lit(key), F.array(*[F.array(*[F.lit(float(n)) for n in band]) for band in v]))])
    key = F.concat(script, F.lit("|"), F.coalesce(F.concat(F.lit("="), lang), F.lit("")))
    mine = F.coalesce(F.try_element_at(lists, key), F.try_element_at(lists, script))
    return F.exists(mine, lambda b: chars.between(b[0], b[1]) & (fallback <= b[2]) & entropy.between(b[3], b[4]))


def quality(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, and the fertility measures.

    base_failed: under MIN_WORDS words, or over MAX_REPEAT_PERCENT percent of the words in 3-word windows found
    twice.  Otherwise the text is tokenised word by word with a public vocabulary and kept if characters per token,
    byte-fallback share and token entropy lie within the band of its script and language (`lang`, where that column
    exists), which is fitted to all documents.  Null text: no words, so base_failed.  Null lang: see `_within_bands`.
    Repeated rows repeat; an empty table gives no rows; only doc_id, text and lang are read.  Whole texts; texts are not
    moved; the driver holds at most 5 * (LANGUAGES + 1) bands.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"), _lang(docs))
    names = ["doc_id", "lang", *(c.split()[0] for c in _MEASURES.split(", "))]
    measures = _measurer(docs, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, arrays in measures(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *arrays], names=names)

    rows = written(src.mapInArrow(run, f"doc_id {kind}, lang string, {_MEASURES}"), "quality-measures")
    kept = ~F.col("base_failed") & _within_bands(*map(F.col, ("script", "lang", "chars_per_token", "byte_share", "token_entropy")),
                                                 fitted_bands(rows).collect())
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return rows.select("doc_id", *base, kept.alias("kept"), "script", "chars_per_token", "byte_share", "token_entropy")


def keep_quality(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """`docs` without the rows that `quality` does not keep, all columns as they are.

    The rows are written once with their measures, so texts are tokenised once and no text moves between tasks.
    """
    text_at, measures = docs.columns.index("text"), _measurer(docs, vocabulary_path)
    own = "_quality"
    while own in docs.columns:
        own += "_"
    names = [c.split()[0] for c in _MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, arrays in measures(batches, text_at):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.StructArray.from_arrays(arrays, names=names)],
                                             names=[*batch.schema.names, own])

    made = ", ".join(":".join(c.split()) for c in _MEASURES.split(", "))
    fields = T.StructType([*docs.schema.fields, T.StructField(own, T._parse_datatype_string(f"struct<{made}>"))])
    rows = written(docs.mapInArrow(run, fields), "quality-rows")
    flat = rows.select(_lang(docs), f"{own}.*")
    at = lambda c: F.col(f"{own}.{c}")
    within = _within_bands(at("script"), _lang(docs), at("chars_per_token"), at("byte_share"), at("token_entropy"),
                           fitted_bands(flat).collect())
    return rows.where(~at("base_failed") & within).select(*[F.col(f"`{c}`") for c in docs.columns])


def _lang(docs: DataFrame) -> Column:
    return (F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")).alias("lang")


def _measurer(docs: DataFrame, vocabulary_path: str):
    with open(vocabulary_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def measured(batches, text_at):
        fertility = Fertility(model.value)
        for batch in slices(batches):
            texts = batch.column(text_at).to_pylist()
            base = base_counts(texts)
            failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])
            extra = []
            for t, counts in zip(texts, base.tolist(), strict=True):
                extra.append((script_of(t or ""), *fertility.measure(t or "", counts[1])))
            yield batch, [*(pa.array(base[:, i]) for i in range(5)), pa.array(failed), pa.array([e[0] for e in extra], pa.string()),
                          *(pa.array([e[i] for e in extra], pa.float64()) for i in (1, 2, 3))]

    return measured
