"""Plain, slow versions of the dealt operators, written from their contracts for comparison."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def topk(queries, vectors, k=20):
    out = {}
    for q, qv in queries:
        scores = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in vectors if i != q)
        out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, percent=85):
    """{doc_id: (set size, component)} from (doc_id, text) rows."""
    sets = {d: shingles(t) for d, t in rows}
    held = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            held[g].append(d)
    both = Counter(p for ids in held.values() for p in combinations(sorted(ids), 2))
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def base_secrets(text):
    """(kind, start, end) of the three contract kinds."""
    text, out = text or "", []
    letters = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password")
    names = "|".join("".join(f"[{c}{c.upper()}]" for c in n) for n in ("password", "passwd", "secret", "token"))
    key = "[aA][pP][iI]_?[kK][eE][yY]"
    assert letters in names
    for m in re.finditer(rf"""({names}|{key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if m.end() - m.start() >= 20:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if m.end() - m.start() >= 24:
            out.append((m.start(), 2, "hex", m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans):
    return hashlib.sha256(joined(spans).encode()).hexdigest()


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base_licenses(text):
    """(words, places, labels) of the contract phrases."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        got = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += got
        labels |= {label} if got else set()
    return len(words), places, sorted(labels)


def quality_counts(text):
    """(words, word chars, symbols, duplicate lines, words in repeated 3-word windows)."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


def crc(text):
    return zlib.crc32((text or "").encode())
