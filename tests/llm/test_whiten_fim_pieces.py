"""Whitening, fill-in-middle and sentencepiece encoding against plain versions and the library."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakecart.llm import fill_middle, pieces, whitening
from tests.llm.test_operators import ROWS, SCHEMA

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    extra = [(900, "a <P> b\nc", *ROWS[0][2:]), (901, "\n\n\n", *ROWS[0][2:]), (902, "no end\nof line", *ROWS[0][2:]),
             (903, "x" * 300_000 + "\n" + "yz\n" * 90_000, *ROWS[0][2:]), (904, "<P\n>S><\nM>\n<", *ROWS[0][2:]),
             (5, "another text of id five\nsecond line\nthird", *ROWS[0][2:])]
    return spark.createDataFrame(ROWS + extra, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- fill-in-middle ------------------------------------------------------------

def _plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        form, out, sizes = "plain", text, (None, None)
    else:
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        form, sizes = ("spm" if h4 % 100 < 50 else "psm"), (len(p), len(m))
        out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), form, *sizes, out, text


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("piece_bytes", [1 << 16, 5, 1])
def test_fim_digests_equal_a_plain_version(docs, none, piece_bytes):
    df = docs if piece_bytes > 1 else docs.where("doc_id > 0 and doc_id <> 903 and length(text) < 2000")
    rule = fill_middle.Rule(piece_bytes=piece_bytes)
    got = sorted((tuple(r) for r in fill_middle.fim_digests(df, rule).collect()), key=_key)
    want = [_plain_fim(r["doc_id"], r["text"]) for r in df.collect()]
    assert got == sorted(((*w[:5], _sha(w[5]), _sha(w[6])) for w in want), key=_key)
    assert all(_sha(r["text"] or "") in {g[6] for g in got} for r in df.collect())
    assert fill_middle.fim_digests(none).count() == 0


def test_fim_texts_are_whole_and_come_back(docs):
    rule = fill_middle.Rule(fim_percent=70, spm_percent=30, seed=11, piece_bytes=64)
    out = fill_middle.fim_documents(docs, rule)
    back = fill_middle.restore_documents(out).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in back) == sorted(
        (r["doc_id"] or -1, r["text"] or "") for r in docs.collect())
    forms = {r["form"] for r in out.collect()}
    assert forms == {"plain", "psm", "spm"}


def test_repeated_rows_of_fim_stay_apart_by_partition(spark):
    df = spark.range(3000).select(F.lit(7).alias("doc_id"), F.lit("one\ntwo\nthree").alias("text")).repartition(5)
    made = fill_middle.document_pieces(df)
    assert made.select("key").distinct().count() > 1
    rows = fill_middle.fim_digests(df).collect()
    assert len(rows) == 3000 and len(set(rows)) == 1


def test_fim_moves_texts_once(docs):
    plan = fill_middle.fim_digests(docs.coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("MapInArrow") == 3


# ---- sentencepiece -------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec(pieces.Pieces(MODEL))


def _same(library, codec, texts):
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        want = library.encode(text, add_eos=True)
        assert ids.tolist() == want, text[:80]
        assert codec.decode(ids) == library.decode(want).encode()


def test_pieces_equal_the_library_on_hard_texts(library, codec):
    rnd = random.Random(4)
    alphabets = ["ab ", "abcdefghij", "aeiou tnsrl\n", " \n\t.,;()=ABCabc012", "가나다漢字éüßпривет𝒳😀\0▁<>", "0123456789abcdef"]
    texts = ["", " ", "▁", "<s></s><unk><0x41>", "  a ", "a" * 999, " " * 300 + "x" + " " * 45, "﻿x", "\r\n\r\n"]
    texts += ["".join(rnd.choices(a, k=n)) for a in alphabets for n in (2, 7, 60, 500, 3000) for _ in range(12)]
    words = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32_000)]
    texts += ["".join(rnd.choices(words, k=n)) for n in (3, 40, 300) for _ in range(60)]
    _same(library, codec, texts)
    _same(library, codec, [r[1] or "" for r in ROWS])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_pieces_equal_the_library_on_any_text(library, codec, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    _same(library, codec, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 262)), min_size=1, max_size=12))
def test_decode_equals_the_library_on_any_ids(library, codec, ids):
    assert codec.decode(np.array(ids)) == library.decode(ids).encode()


def test_every_piece_is_its_own_word(library, codec):
    _same(library, codec, [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32_000, 3)])


def test_rounds_and_queue_agree(codec):
    rnd = random.Random(8)
    p = codec.pieces
    code_of = dict(zip(p.letter_code.tolist(), p.letter_piece.tolist(), strict=True))
    for alphabet in ("ab", "etaoin", "abcdefghijklmnopqrstuvwxyz"):
        for n in (3, 64, 65, 400):
            word = [code_of[ord(c)] for c in rnd.choices(alphabet, k=n)]
            merged, starts = pieces.merge_rounds(p, np.array(word * 2), np.array([0, n]))
            want = pieces.merge_queue(p, list(word))
            assert merged.tolist() == want * 2 and starts.tolist() == [0, len(want)]


def test_long_runs_take_seconds(library, codec):
    import time

    for text in ("a" * 400_000, " " * 400_000, "".join(random.Random(1).choices("abcdefgh", k=400_000))):
        began = time.monotonic()
        ids = next(codec.encode([text]))
        assert time.monotonic() - began < 15
        assert ids.tolist() == library.encode(text, add_eos=True)


def test_piece_documents(docs, none, library):
    got = pieces.encode_documents(docs, MODEL).collect()
    want = [(r["doc_id"], library.encode(r["text"] or "", add_eos=True)) for r in docs.collect()]
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=_key) == sorted(want, key=_key)
    digests = sorted((tuple(r) for r in pieces.token_digests(docs, MODEL).collect()), key=_key)
    assert digests == sorted(((d, len(i), _sha(" ".join(map(str, i))), _sha(library.decode(i))) for d, i in want), key=_key)
    assert pieces.encode_documents(none, MODEL).count() == 0


# ---- whitening -----------------------------------------------------------------

def _whitened(df):
    return whitening.whiten(df).collect()


def test_whitening_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    monkeypatch.setattr(whitening, "TASK_BLOCKS", 2)
    rnd = np.random.default_rng(2)
    x = rnd.integers(-900, 900, (1500, 12)) * np.arange(1, 13) + 100_000
    x[700:1200] = x[0]  # a third of all rows are one
    ids = [None, 3, 3, *range(3, 1500)]
    df = spark.createDataFrame([(i, v.tolist(), 1, 2) for i, v in zip(ids, x, strict=True)],
                               "id long, x array<long>, index long, centred long").repartition(6)
    rows = _whitened(df)
    n, s = len(x), x.sum(0).astype(object)
    exact = n * x.astype(object) - s
    b = exact.astype(float) / n
    values, vectors = np.linalg.eigh(b.T @ b / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    y = b @ vectors[:, :8] / np.sqrt(values[:8])
    assert len(rows) == 8 * n
    assert {r["n"] for r in rows} == {n} and max(r["identity_error"] for r in rows) < 1e-9
    for c in range(8):
        mine = [r for r in rows if r["component"] == c + 1]
        assert abs(mine[0]["explained"] - values[c] / values.sum()) < 1e-12
        assert sorted((r["id"] is None, r["id"] or 0, r["deviation"]) for r in mine) == sorted(
            (i is None, i or 0, int(d)) for i, d in zip(ids, (exact**2).sum(1), strict=True))
        got = np.sort([r["whitened"] for r in mine])
        assert min(np.abs(got - np.sort(y[:, c])).max(), np.abs(got - np.sort(-y[:, c])).max()) < 1e-9
        by_id = {r["id"]: r["whitened"] for r in mine if r["id"] != 3}
        want = {i: v for i, v in zip(ids, y[:, c], strict=True) if i != 3}
        sign = np.sign(sum(by_id[i] * want[i] for i in want))
        assert max(abs(sign * by_id[i] - want[i]) for i in want) < 1e-9


def test_whitening_of_few_rows(spark):
    make = lambda *rows: spark.createDataFrame([(i, list(v)) for i, v in enumerate(rows)], "id long, x array<long>")
    assert _whitened(make()) == []
    assert _whitened(make((5, 6))) == []
    assert _whitened(make((5, 6), (5, 6), (5, 6))) == []
    two = _whitened(make((0, 0), (3, 4)))  # rank one: one component
    assert sorted((r["id"], r["component"], round(abs(r["whitened"]), 12), r["deviation"]) for r in two) == [
        (0, 1, 1.0, 25), (1, 1, 1.0, 25)]
    with pytest.raises(ValueError):
        whitening.whiten(make((1, 2), (1, 2, 3)))
    bad = spark.createDataFrame([(1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
                                 (6, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [r[0] for r in bad.where(whitening.finite_vector(F.col("embedding"))).select("vec_id").collect()] == [6]
    assert bad.where("vec_id = 6").select(whitening.scaled(F.col("embedding"))).first()[0] == [101_024, 102_048]


def test_whitening_numbers_rows_without_gaps(spark):
    df = spark.range(1000).select("id", F.array("id").alias("x")).repartition(7).where("id % 3 <> 1")
    rows, n = whitening._indexed(df, 1)
    assert sorted(r["index"] for r in rows.collect()) == list(range(n))
