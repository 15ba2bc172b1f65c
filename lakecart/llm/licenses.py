"""License scans with a positional index of rare licence words (dealt operator 5, DataFrame functions only)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.llm.store import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A notice: label, its words in order, and the key phrase within it that must stand word by word."""

    label: str
    notice: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.notice.split()

    @property
    def key_at(self) -> int:
        """Where the key phrase starts in the notice."""
        words, key = self.words, self.key.split()
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


# The contract's phrases and labels (keys of the base templates), then public licence notices.
TEMPLATES = (
    Template("gpl", "licensed under the gnu general public license", "gnu general public license", True),
    Template("apache", "licensed under the apache license", "apache license", True),
    Template("cc-by", "licensed under cc by", "cc by", True),
    Template("mit", "released under the mit license", "mit license", True),
    Template("gpl-2", "gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license version", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license version", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "hereby granted free"),
    Template("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted",
             "binary forms"),
    Template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    Template("unlicense", "free and unencumbered software released into the public domain", "unencumbered software"),
)
# Words too common in prose to be worth a posting; no key phrase uses them.
COMMON = frozenset("a and any are in into is of or the this to use".split())


def rare_words(template: Template) -> list[tuple[int, str]]:
    """(offset, word) of the notice's indexed words."""
    return [(i, w) for i, w in enumerate(template.words) if w not in COMMON]


def vocabulary(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for _, w in rare_words(t)})


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def postings(docs: DataFrame, words: list[str]) -> DataFrame:
    """(doc_id, n_words, hits): per document its word count and the (position, word) of every indexed word."""
    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    doc = docs.select("doc_id", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(words), F.struct(i.alias("p"), w.alias("w")))),
                    lambda h: h.isNotNull())
    return doc.select("doc_id", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))


def inverse_document_frequency(index: DataFrame, words: list[str]) -> dict[str, float]:
    """Per indexed word log((documents + 1) / (documents with it + 1)), over all documents; one entry per word."""
    seen = index.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w"))
    counts = {r["w"]: r["n"] for r in seen.groupBy("w").agg(F.count("*").alias("n")).collect()}
    total = index.count()
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in words}


def _has(hits: Column, word: str) -> Column:
    return F.exists(hits, lambda h: h["w"] == word)


def _starts(hits: Column, word: str, offset: int) -> Column:
    """Notice starts that the word's postings imply."""
    return F.transform(F.filter(hits, lambda h: h["w"] == word), lambda h: h["p"] - offset)


def _most_votes(starts: Column, votes: Column) -> Column:
    """The most votes that one of the starts has.

    Starts (even) and votes (odd) are sorted together, so each start stands before its votes and one pass counts them:
    a text with thousands of places costs no more per place than one with a few.
    """
    marks = F.sort_array(F.concat(F.transform(starts, lambda s: s * 2), F.transform(votes, lambda v: v * 2 + 1)))
    zero = F.struct(F.lit(None).cast("int").alias("start"), F.lit(0).alias("count"), F.lit(0).alias("best"))

    def step(a, m):
        count = F.when(m == a["start"] + 1, a["count"] + 1).otherwise(0)
        return F.struct(F.when(F.pmod(m, F.lit(2)) == 0, m).otherwise(a["start"]).alias("start"), count.alias("count"),
                        F.greatest(a["best"], count).alias("best"))

    return F.aggregate(marks, zero, step, lambda a: a["best"])


def license_matches(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, and matches: array of (label, base, starts, coverage) per document.

    Each document's rare licence words are indexed with their positions.  A template is looked up by the highest-IDF
    word of its key phrase, the other key words' postings are intersected by relative position in order of falling
    IDF, and what is left are the places where the key phrase stands whole (starts, in words, from 0).  coverage is
    the best share of the notice's indexed words that stand at their relative positions around such a place.

    A document without a template's look-up word cannot hold its key phrase, so nothing is lost.  Row by row after
    one pass for the document frequencies (bounded by the vocabulary): no shuffle of texts or postings.  Null or
    empty text: no words, no matches.  Repeated rows repeat; an empty table gives none; other columns are not read.
    """
    words = vocabulary(templates)
    index = written(postings(docs, words), "license-postings")
    idf = inverse_document_frequency(index, words)
    none = F.lit(None).cast("struct<label:string,base:boolean,starts:array<int>,coverage:double>")
    found = []
    for t in templates:
        key = sorted(((t.key_at + j, w) for j, w in enumerate(t.key.split())), key=lambda x: (-idf[x[1]], x[0]))
        anchor = key[0][1]
        places = _starts(F.col("hits"), anchor, key[0][0])
        for offset, w in key[1:]:
            places = F.array_intersect(places, _starts(F.col("hits"), w, offset))
        found.append((t, F.when(_has(F.col("hits"), anchor), places)))
    located = index.select("doc_id", "n_words", "hits", *[c.alias(f"s{i}") for i, (_, c) in enumerate(found)])

    def described(i: int, t: Template) -> Column:
        rare = rare_words(t)
        at = F.col(f"s{i}")
        # Votes of all indexed words of the notice, by the start that they imply.
        votes = F.flatten(F.array(*[_starts(F.col("hits"), w, o) for o, w in rare]))
        share = _most_votes(at, votes) / F.lit(float(len(rare)))
        return F.when(F.size(at) > 0, F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
            F.transform(at, lambda s: (s + t.key_at).cast("int")).alias("starts"), share.alias("coverage"))).otherwise(none)

    matches = F.array_compact(F.array(*[described(i, t) for i, (t, _) in enumerate(found)]))
    return located.select("doc_id", "n_words", matches.alias("matches"))


def license_digest(found: DataFrame) -> DataFrame:
    """`license_matches` rows as counts, places and label lists; score: the best coverage (0 without a match)."""
    base = F.filter("matches", lambda m: m["base"])
    starts = F.flatten(F.transform(base, lambda m: m["starts"]))
    labels = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["coverage"])), F.lit(0.0)).alias("score"))
