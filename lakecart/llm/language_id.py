"""Language identification by cross-parsing entropy over suffix automata (dealt operator 6)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecart.llm.textbatch import slices

# Bounded sample the automata are built from: documents and normalised characters per language, the latter shared
# among languages so that all tables together stay under TABLE_CELLS.
TRAIN_DOCS, TRAIN_CHARS, TABLE_CELLS = 96, 32_768, 24_000_000
# Symbols: 0 is the gap between words, then DIGITS hexadecimal digits, the rest frequent letters.  Every other letter is
# spelled by the four digits of each of its UTF-16 units, so no two letters are the same.
ALPHABET = 64
GAP, DIGITS = 0, 16
# Long texts are parsed in blocks of this many symbols, many blocks at a time.
BLOCK = 512
_BREAK = np.int32(-(2**31))
_GROUP_CHARS = 1 << 20


def normalise(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the lower-cased texts as code points, everything else as single gaps (0); text number of each."""
    lowered = [(t or "").lower() for t in texts]
    flat = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])[: len(flat)]
    flat = np.where(_letters(flat), flat, np.uint32(GAP))
    keep = np.ones(len(flat), bool)
    keep[1:] = (flat[1:] != GAP) | (flat[:-1] != GAP) | (owner[1:] != owner[:-1])
    keep[np.cumsum([len(t) + 1 for t in lowered], dtype=np.int64)[:-1] - 1] = False  # the marks between texts
    return flat[keep], owner[keep]


def _letters(codes: np.ndarray) -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _LETTER[codes]


_LETTER: np.ndarray | None = None


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a symbol sequence (state 0 is the root): every path spells a factor."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return following


@dataclass(frozen=True)
class Model:
    """Suffix automata of one text per language, over a shared alphabet. Bounded by TRAIN_CHARS and TABLE_CELLS."""

    langs: list[str]
    letters: list[int]  # code points of the symbols after the digits
    sizes: list[int]  # training symbols per language
    edges: list[tuple[int, np.ndarray]]  # states, and (state, symbol, next) rows

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Next state by state * ALPHABET + symbol for all automata, and each root.

        Where the factor ends, the cell holds the root's next state with the sign bit set: a phrase ended.
        """
        out, roots, first = [], [], 0
        for states, rows in self.edges:
            t = np.zeros((states, ALPHABET), np.int32) - 1
            t[rows[:, 0], rows[:, 1]] = rows[:, 2]
            fresh = np.where(t[0] >= 0, t[0], 0) + first
            out.append(np.where(t >= 0, t + first, fresh | _BREAK).ravel().astype(np.int32))
            roots.append(first)
            first += states
        return np.concatenate([np.zeros(0, np.int32), *out]), np.array(roots, np.int32)


def build_model(samples: dict[str, list[str]], chars: int = TRAIN_CHARS) -> Model:
    """Automata from labelled texts: whole texts in the given order up to `chars` symbols, none over an eighth."""
    langs = sorted(samples)
    chars = min(chars, TABLE_CELLS // (2 * ALPHABET * max(1, len(langs))))
    texts = {}
    for lang in langs:
        parts, room = [], chars
        for t in samples[lang]:
            codes = normalise([t])[0][: min(room, max(1, chars // 8))]
            parts.append(codes)
            room -= len(codes)
        texts[lang] = parts
    share: dict[int, float] = {}  # of each letter in the language that has most of it
    for parts in texts.values():
        codes = np.concatenate([np.zeros(0, np.uint32), *parts])
        for c, n in zip(*(x.tolist() for x in np.unique(codes, return_counts=True)), strict=True):
            share[c] = max(share.get(c, 0.0), n / len(codes))
    letters = [c for c in sorted(share, key=lambda c: (-share[c], c)) if c != GAP][: ALPHABET - 1 - DIGITS]
    table = symbol_table(letters)
    spelled = {lang: np.concatenate([np.zeros(0, np.int32), *[spell(codes, table)[0][: max(1, chars // 8)] for codes in parts]])[:chars]
               for lang, parts in texts.items()}
    model = Model(langs, letters, [max(2, len(spelled[lang])) for lang in langs], [])
    for lang in langs:
        following = suffix_automaton(spelled[lang].tolist())
        rows = np.array([(s, c, n) for s, out in enumerate(following) for c, n in out.items()], np.int32).reshape(-1, 3)
        model.edges.append((len(following), rows))
    return model


def symbol_table(letters: list[int]) -> np.ndarray:
    """Symbol of each code point, -1 if it is spelled."""
    table = np.full(0x110000, -1, np.int32)
    table[GAP] = GAP
    table[np.array(letters, np.int64)] = np.arange(1 + DIGITS, len(letters) + 1 + DIGITS)
    return table


def spell(codes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the code points, and how many each one takes."""
    symbols = table[codes]
    wide = np.flatnonzero(symbols < 0)
    size = np.ones(len(codes), np.int64)
    if not len(wide):
        return symbols, size
    c = codes[wide].astype(np.int64)
    far = c >= 0x10000
    size[wide] = np.where(far, 8, 4)
    out = np.repeat(symbols, size)
    at = (np.cumsum(size) - size)[wide]
    first = np.where(far, 0xD800 + ((c - 0x10000) >> 10), c)
    second = 0xDC00 + (c & 0x3FF)
    for j in range(4):
        out[at + j] = 1 + ((first >> (12 - 4 * j)) & 15)
        out[at[far] + 4 + j] = 1 + ((second[far] >> (12 - 4 * j)) & 15)
    return out, size


class Parser:
    """Cross-parses texts against every automaton at once."""

    def __init__(self, model: Model):
        self.model, self.symbols = model, symbol_table(model.letters)
        self.table, self.roots = model.tables()

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts × languages) phrase counts of the greedy longest-match parse, and whether a text has a letter."""
        codes, owner = normalise(texts)
        counts = np.zeros((len(texts), len(self.model.langs)), np.int64)
        has = np.zeros(len(texts), bool)
        has[owner[codes != GAP]] = True
        if not self.model.langs:
            return counts, has
        symbols, size = spell(codes, self.symbols)
        owner = np.repeat(owner, size)
        first = np.searchsorted(owner, np.arange(len(texts) + 1))
        lanes = np.concatenate([np.zeros(0, np.int64), *[np.arange(a, b, BLOCK) for a, b in zip(first[:-1], first[1:], strict=True)]])
        if not len(lanes):
            return counts, has
        ends = np.minimum(lanes + BLOCK, first[owner[lanes] + 1])
        by = np.argsort(lanes - ends, kind="stable")  # longest blocks first: the active ones are a prefix
        lanes, lens = lanes[by], (ends - lanes)[by]
        state = np.repeat(self.roots[:, None], len(lanes), axis=1)
        found = np.ones(state.shape, np.int32)
        active = np.searchsorted(-lens, -np.arange(int(lens[0])), "left")
        for step in range(int(lens[0])):
            n = active[step]
            now = self.table[state[:, :n] * ALPHABET + symbols[lanes[:n] + step]]
            found[:, :n] += now < 0
            state[:, :n] = now & 0x7FFFFFFF
        np.add.at(counts, owner[lanes], found.T)
        return counts, has

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        langs = self.model.langs
        weight = np.log2(np.array(self.model.sizes, float)) if langs else np.zeros(0)
        for part in _groups(texts):
            counts, has = self.phrases(part)
            cost = counts * weight  # bits of the phrases' pointers into each language's text
            for row, letter in zip(cost, has.tolist(), strict=True):
                if not letter or not langs:
                    yield "und", 0.0
                    continue
                best = int(row.argmin())
                rest = np.delete(row, best).min(initial=np.inf)
                yield langs[best], float(1 - row[best] / rest) if rest > 0 else 0.0


def _groups(texts: list[str | None]) -> Iterator[list[str | None]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "")
        if size > _GROUP_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def training_sample(labelled: DataFrame) -> dict[str, list[str]]:
    """Per language the texts of its TRAIN_DOCS rows of smallest hash: a bounded sample, taken in two passes.

    labelled: (doc_id, text, lang).  The first pass ranks ids only, with a partial top-k before its shuffle.
    """
    ranked = labelled.where("lang is not null and text rlike '\\\\p{L}'").select(
        "doc_id", "lang", F.xxhash64("doc_id").alias("h"), F.crc32(F.col("text").cast("binary")).alias("t"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "t"))
    chosen = ranked.withColumn("r", rank).where(F.col("r") <= TRAIN_DOCS).select("doc_id", "lang", "t").distinct()
    rows = labelled.withColumn("t", F.crc32(F.col("text").cast("binary"))).join(
        F.broadcast(chosen), ["doc_id", "lang", "t"]).select(  # at most TRAIN_DOCS narrow rows per language
        "lang", "doc_id", F.substring("text", 1, TRAIN_CHARS).alias("text"), F.xxhash64("doc_id").alias("h")).distinct()
    samples: dict[str, list] = {}
    for r in rows.collect():
        samples.setdefault(r["lang"], []).append((r["h"], r["doc_id"], r["text"]))
    return {lang: [t for _, _, t in sorted(got, key=lambda x: (x[0], x[1] if x[1] is not None else -1, x[2]))[:TRAIN_DOCS]]
            for lang, got in samples.items()}


def fit(labelled: DataFrame) -> Model:
    return build_model(training_sample(labelled))


def predict_language(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text.

    The text is cut greedily into the longest factors each language's automaton knows; phrases times the bits of a
    pointer into that language's text is the cross-parsing code length, and the shortest wins (ties to the first by
    name).  score: 1 - best / second best.  `und`, score 0: null, empty or letterless text, or nothing learned.
    Only doc_id and text are read; repeated rows repeat; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(shared.value)
        for batch in slices(batches):
            got = list(parser.predict(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double")
