"""Fertility bands: planted gibberish goes, real texts stay, and the measures equal a plain version."""

from __future__ import annotations

import math
import os
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from lakecart.llm import quality

PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "/root/testdata/sf0.01/documents.parquet"
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, script string"
ALPHABETS = {
    "letters": "abcdefghijklmnopqrstuvwxyz", "consonants": "bcdfghjklmnpqrstvwxz", "digits": "0123456789",
    "arabic": "".join(map(chr, range(0x621, 0x64B))), "ethiopic": "".join(map(chr, range(0x1200, 0x1258))),
}


def _gibberish(alphabet, words, rnd):
    return " ".join("".join(rnd.choices(alphabet, k=rnd.randint(2, 9))) for _ in range(words))


@pytest.mark.skipif(not os.path.isdir(DOCS) and not os.path.isfile(DOCS), reason="driver tables not present")
def test_gibberish_goes_and_real_texts_stay(spark):
    rnd = random.Random(6)
    real = spark.read.parquet(DOCS).select("doc_id", "text", "lang", "source", F.lit(1).cast("long").alias("n_words"),
                                           F.lit("s").alias("script"))
    rows, name = [], {}
    for alphabet, chars in ALPHABETS.items():
        for i, words in enumerate((60, 150, 300, 900)):
            for lang in ("en", None):
                doc = 10_000_000 + len(rows)
                rows.append((doc, _gibberish(chars, words, rnd), lang, "x", 1, "s"))
                name[doc] = (alphabet, words, lang)
    both = real.union(spark.createDataFrame(rows, SCHEMA)).repartition(4)
    got = quality.quality(both, PIECES).collect()
    planted = [r for r in got if r["doc_id"] in name]
    assert not [name[r["doc_id"]] for r in planted if r["kept"]]
    passed = [r for r in got if r["doc_id"] not in name and not r["base_failed"]]
    assert sum(r["kept"] for r in passed) >= 0.98 * len(passed) > 500
    stay = quality.keep_quality(both, PIECES)
    assert stay.columns == both.columns
    assert sorted(r[0] for r in stay.select("doc_id").collect()) == sorted(r["doc_id"] for r in got if r["kept"])


def test_measures_equal_a_plain_version(spark):
    rnd = random.Random(2)
    texts = ["one two three " * 20, "привет мир " * 30, _gibberish(ALPHABETS["letters"], 200, rnd), "漢字 仮名 " * 30 + "x",
             "", None, " \n ", "a▁b c" * 30, "\x00 \x01 é" * 40]
    rows = [(i, t, None, None, None, None) for i, t in enumerate(texts)]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in quality.quality(spark.createDataFrame(rows, SCHEMA), PIECES).collect():
        words = re.findall(r"[^\x20\x09-\x0d]+", texts[r["doc_id"]] or "")
        ids = [i for w in words for i in library.encode(w)]
        if not ids:
            assert (r["chars_per_token"], r["byte_share"], r["token_entropy"]) == (0.0, 0.0, 0.0)
            continue
        shares = [n / len(ids) for n in Counter(ids).values()]
        want = (sum(map(len, words)) / len(ids), sum(library.is_byte(i) for i in ids) / len(ids),
                -sum(p * math.log2(p) for p in shares))
        assert (r["chars_per_token"], r["byte_share"], r["token_entropy"]) == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_bands_are_grouped_quantiles(spark, monkeypatch):
    monkeypatch.setattr(quality, "GROUP_ROWS", 20)
    monkeypatch.setattr(quality, "LANGUAGES", 1)
    rows = [("latin", "en", False, 2.0 + i / 100, 0.0, 6.0) for i in range(101)]
    rows += [("latin", "fr", False, 1.0, 0.0, 5.0)] * 19 + [("latin", None, False, 3.0, 0.0, 5.0)] * 30
    rows += [("latin", "en", True, 50.0, 1.0, 0.0)] * 90 + [("cjk", "zh", False, 1.0, 0.1, 6.0)] * 5
    df = spark.createDataFrame(rows, "script string, lang string, base_failed boolean, chars_per_token double, byte_share double, token_entropy double")
    got = {(r["script"], r["lang"]): r["band"] for r in quality.fitted_bands(df).collect()}
    assert set(got) == {("latin", "en"), ("latin", None)}
    en = got[("latin", "en")]
    assert (round(en.low_chars, 2), round(en.high_chars, 2)) == (1.54, 3.46)
    assert (en.max_fallback, en.min_entropy, en.max_entropy) == (0.1, 5.4, 6.6)
    none = df.limit(0)
    assert quality.fitted_bands(none).collect() == []
