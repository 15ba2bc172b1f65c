"""Secret scans through a trigram inverted index (dealt operator 4)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _parser as regex_ast  # the standard library's own syntax tree of a pattern

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecart.llm.textbatch import ASCII_LOWER, slices

# A trigram query: all clauses must hold; a clause holds if all trigrams of one of its alternatives are there.
Query = list[list[frozenset[bytes]]]
_MAX_STRINGS = 64
_CHUNK_BYTES = 1 << 21


@dataclass(frozen=True)
class Rule:
    """A named pattern; a match fails if its group is shorter than `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The three contract kinds.  A run of 24 or more is the same as a run, then its length tested.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# A PEM key: on to its END line, over whatever stands between; without one, over its header fields and base64, which is
# a run of 16 or more (its line breaks may be spaces or escapes by now) or a line of its own.
_PEM_GAP = r"(?:\s|\\[nr])*"
_PEM_KEY = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-(?!----)[^-]*)*-----END [A-Z ]*PRIVATE KEY-----"
            rf"|(?:{_PEM_GAP}(?:Proc-Type|DEK-Info):[^\n\\]*)*"
            rf"(?:{_PEM_GAP}[A-Za-z0-9+/]{{16,}}={{0,2}}(?:{_PEM_GAP}[A-Za-z0-9+/]{{1,15}}={{1,2}})?"
            r"|[\t\x20\r]*(?:\n|\\n)\s*[A-Za-z0-9+/]+={0,2}(?=[\t\x20\r]*(?:\n|\\[nr]|[\"']|\Z)))*)")
# Public formats of well-known credentials.
MORE_RULES = (
    Rule("private_key", _PEM_KEY),
    Rule("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_api", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    # the first part starts where its run of letters does, or behind a percent escape, so a run is read once
    Rule("web_token", r"(?:(?<![A-Za-z0-9_-])|(?<=%[0-9A-Fa-f][0-9A-Fa-f]))eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[A-Za-z0-9_.-]+:[^\s/@]{6,}@"),
)
RULES = BASE_RULES + MORE_RULES


def _absorbed(alternatives: set[frozenset[bytes]]) -> list[frozenset[bytes]]:
    """Without alternatives that ask for more than another does."""
    return sorted((a for a in alternatives if not any(b < a for b in alternatives)), key=sorted)


def _strings(node) -> set[str] | None:
    """All strings a syntax tree can match, if they are few."""
    found = {""}
    for op, arg in node:
        name = str(op)
        if name == "LITERAL":
            more = {chr(arg)}
        elif name == "IN":
            more = set()
            for kind, value in arg:
                if str(kind) == "LITERAL":
                    more.add(chr(value))
                elif str(kind) == "RANGE" and value[1] - value[0] < _MAX_STRINGS:
                    more |= set(map(chr, range(value[0], value[1] + 1)))
                else:
                    return None
        elif name == "SUBPATTERN":
            more = _strings(arg[3])
        elif name == "BRANCH":
            parts = [_strings(x) for x in arg[1]]
            more = None if None in parts else set().union(*parts)
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] in (0, 1):
            more = _strings(arg[2])
            more = more if more is None or arg[0] else more | {""}
        elif name == "AT":
            more = {""}
        else:
            return None
        if more is None or len(found) * len(more) > _MAX_STRINGS:
            return None
        found = {a + b for a in found for b in more}
    return found


def _clause(strings: set[str]) -> list[frozenset[bytes]]:
    grams = set()
    for s in strings:
        b = s.encode().translate(ASCII_LOWER)
        grams.add(frozenset(b[i : i + 3] for i in range(len(b) - 2)))
    return [] if frozenset() in grams else _absorbed(grams)


def _derive(node) -> Query:
    """Clauses every match of the syntax tree satisfies (lower-cased ASCII)."""
    query: Query = []
    run: set[str] = {""}

    def close() -> None:
        nonlocal run
        if clause := _clause(run):
            query.append(clause)
        run = {""}

    for item in node:
        more = _strings([item])
        if more is not None and len(run) * len(more) <= _MAX_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        close()
        if more is not None:
            run = more
            continue
        op, arg = str(item[0]), item[1]
        if op == "SUBPATTERN":
            query += _derive(arg[3])
        elif op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
            query += _derive(arg[2])
        elif op == "BRANCH":
            parts = [_derive(x) for x in arg[1]]
            if all(parts):  # any one clause of each branch is mandatory for that branch
                query.append(_absorbed(set().union(*(min(p, key=len) for p in parts))))
    close()
    return query


def trigram_query(rule: Rule) -> Query:
    """The Boolean trigram query of a rule's pattern; empty if no trigram is mandatory (the rule scans fully)."""
    return _derive(regex_ast.parse(rule.pattern))


class Segment:
    """Inverted index of one run of texts: trigram → sorted numbers of the texts that hold it (case folded).

    Only trigrams some rule asks for get a posting list.
    """

    def __init__(self, parts: list[bytes], grams: list[bytes], slots: np.ndarray):
        data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        ends = np.cumsum([len(p) + 1 for p in parts])
        self.postings: dict[bytes, np.ndarray] = {}
        if len(data) < 3:
            return
        wide = data.astype(np.uint32)
        slot = slots[(wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]]
        hits = np.flatnonzero(slot)
        text = np.searchsorted(ends, hits, "right")
        inside = hits + 3 < ends[text]
        pairs = np.unique(slot[hits[inside]].astype(np.int64) * len(parts) + text[inside])
        number, text = np.divmod(pairs, len(parts))
        cuts = np.searchsorted(number, np.arange(1, len(grams) + 2))
        self.postings = {g: text[cuts[i] : cuts[i + 1]] for i, g in enumerate(grams)}

    def candidates(self, query: Query) -> np.ndarray:
        """Numbers of the texts that satisfy the query."""
        none = np.zeros(0, np.int64)
        found = None
        for clause in query:
            either = []
            for grams in clause:
                lists = sorted((self.postings.get(g, none) for g in grams), key=len)
                both = lists[0]
                for other in lists[1:]:
                    both = np.intersect1d(both, other, assume_unique=True)
                either.append(both)
            union = np.unique(np.concatenate(either))
            found = union if found is None else np.intersect1d(found, union, assume_unique=True)
        return none if found is None else found


class Scanner:
    """Rules with their trigram queries, ready to scan runs of texts."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, r.compiled(), trigram_query(r)) for r in rules]
        self.grams = sorted({g for _, _, q in self.rules for clause in q for a in clause for g in a})
        self.slots = np.zeros(1 << 24, np.uint16)
        for i, g in enumerate(self.grams):
            self.slots[int.from_bytes(g, "big")] = i + 1

    def scan(self, texts: list[str | None]) -> Iterator[list[tuple[int, int, int]]]:
        """Per text: (start, rule number, end) in code points, sorted."""
        texts = [t or "" for t in texts]
        first, held, size = 0, [], 0
        for i, t in enumerate(texts):
            held.append(t.encode("utf-8", "surrogatepass").translate(ASCII_LOWER))
            size += len(held[-1])
            if size > _CHUNK_BYTES or i + 1 == len(texts):
                yield from self._chunk(texts[first : i + 1], held)
                first, held, size = i + 1, [], 0

    def _chunk(self, texts: list[str], parts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        segment = Segment(parts, self.grams, self.slots)
        for n, (rule, pattern, query) in enumerate(self.rules):
            for i in segment.candidates(query).tolist() if query else range(len(texts)):
                for m in pattern.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[i].append((m.start(), n, m.end()))
        for spans in found:
            spans.sort()
        return found


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans: array of (kind, start, end) of every secret in the whole text, code points, end exclusive.

    Each run of texts in a task gets a trigram inverted index; a rule's trigram query intersects and unites its
    postings, and only the remaining texts meet the pattern.  A rule without mandatory trigrams scans every text.
    Matches are leftmost and do not overlap within a kind; kinds may overlap.  No shuffle: rows stay where they are.

    Null and empty texts have no spans; repeated rows repeat; an empty table gives none; other columns are not read.
    """

    kinds = [r.kind for r in rules]
    made = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in slices(batches):
            spans = [[{"kind": kinds[n], "start": a, "end": b} for a, n, b in found]
                     for found in scanner.scan(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, made)], names=["doc_id", "spans"])

    src = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:int,end:int>>")


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with each secret's characters replaced by ``[kind]`` and n_chars (if there) set to the new length.

    Overlapping spans are replaced once, named after the first.  Other columns and texts without secrets stay.
    """
    text_at = docs.columns.index("text")
    count_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in slices(batches):
            texts = batch.column(text_at).to_pylist()
            changed = {}
            for i, found in enumerate(scanner.scan(texts)):
                if found:
                    out, at = [], 0
                    for a, n, b in found:
                        if a >= at:
                            out += [texts[i][at:a], f"[{rules[n].kind}]"]
                        at = max(at, b)
                    changed[i] = "".join(out) + texts[i][at:]
            if changed:
                columns = list(batch.columns)
                columns[text_at] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], columns[text_at].type)
                if count_at is not None:
                    counts = columns[count_at].to_pylist()
                    columns[count_at] = pa.array(
                        [len(changed[i]) if i in changed else c for i, c in enumerate(counts)], columns[count_at].type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(run, docs.schema)


def secret_digest(found: DataFrame) -> DataFrame:
    """`find_secrets` rows as counts and digests per document (base kinds by name, all spans as text)."""
    base = [r.kind for r in BASE_RULES]

    def texts(spans, keep):
        return F.array_join(F.transform(F.filter(spans, keep), lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    is_base = lambda s: s["kind"].isin(base)
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, base), F.sha2(texts("spans", is_base), 256).alias("base_sha256"),
                        texts("spans", lambda s: F.lit(True)).alias("spans"))
