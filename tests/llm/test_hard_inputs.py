"""Inputs that once cost quadratic time or lost documents."""

from __future__ import annotations

import time

import numpy as np
from pyspark.sql import functions as F

from lakecart.llm import licenses, mixing, near_dups, secrets

DOCS = "doc_id long, text string"


def _timed(df):
    began = time.monotonic()
    rows = df.collect()
    return rows, time.monotonic() - began


def test_a_text_of_licence_repeats_is_linear(spark):
    n = 60_000
    texts = [("mit license " * n), ("apache license, version 2.0 " * (n // 3))]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    rows, seconds = _timed(licenses.license_digest(licenses.license_matches(df)).orderBy("doc_id"))
    assert [(r["n_base"], r["first_word"], r["base_labels"]) for r in rows] == [(n, 0, "mit"), (n // 3, 0, "apache")]
    assert rows[0]["last_word"] == 2 * (n - 1) and seconds < 20


def test_coverage_is_the_best_share_of_votes(spark):
    t = next(t for t in licenses.TEMPLATES if len(licenses.rare_words(t)) > len(t.key.split()) + 2)
    whole = " ".join(t.words)
    df = spark.createDataFrame([(0, f"{t.key} x {whole} y {t.key}"), (1, t.key)], DOCS)
    rows = {r["doc_id"]: {m["label"]: m["coverage"] for m in r["matches"]} for r in licenses.license_matches(df).collect()}
    rare = licenses.rare_words(t)
    keys = sum(t.key_at <= i < t.key_at + len(t.key.split()) for i, _ in rare)
    assert rows[0][t.label] == 1.0 and rows[1][t.label] == keys / len(rare)


def test_web_tokens_are_found_in_linear_time(spark):
    token = "eyJabcdefgh.eyJabcdefgh.abcdefgh"
    hard = ".eyJ " + "eyJ" * 340_000
    rows, seconds = _timed(secrets.find_secrets(spark.createDataFrame(
        [(0, hard), (1, f"auth%3D{token} x={token},"), (2, f"Bearer%20{token}")], DOCS)))
    assert seconds < 15
    found = {r["doc_id"]: secrets_of(r) for r in rows}
    assert found[0] == 0 and found[1] == 2 and found[2] == 1


def secrets_of(row):
    spans = row["spans"]
    return sum("web_token" in (str(s["kind"]) if not isinstance(s, str) else s) for s in spans)


def test_different_texts_under_one_id_both_stay(spark):
    rnd = np.random.default_rng(1)
    say = lambda n: " ".join(f"w{i}" for i in rnd.integers(0, 5000, n))
    one, two, other = say(120), say(130), say(110)
    near = one.split()
    near[50] = "changed"
    rows = [(5, one, "a"), (5, two, "b"), (9, " ".join(near), "c"), (7, other, "d"), (7, other, "d"), (7, other, "e"), (None, one, "f"),
            (8, None, "g"), (8, "", "h")]
    df = spark.createDataFrame(rows, DOCS + ", _document string").repartition(3)
    kept = near_dups.drop_near_duplicates(df)
    assert kept.columns == df.columns
    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert (5, two) in texts and texts.count((7, other)) == 1 and (None, one) in texts
    assert ((5, one) in texts) != ((9, " ".join(near)) in texts)
    assert sorted(d for d, _ in texts if d is not None) in ([5, 5, 7, 8, 8], [5, 7, 8, 8, 9])
    again = near_dups.drop_near_duplicates(df.repartition(7))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, kept.collect()))
    # the search itself: links of either text of id 5 count, and sizes are each text's own
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dups.near_duplicates(
        df.where("doc_id in (5, 9)")).collect())
    assert found == [(5, 116, 5), (5, 126, 5), (9, 116, 5)]


def test_mix_takes_documents_with_clashing_columns(spark):
    df = spark.range(60).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words here"), "id").alias("text"),
                                F.lit("s").alias("source"), F.lit(3).alias("shards"), F.lit(1).alias("h"))
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and out.count() > 0
    placed = mixing.mixed_documents(df, placed=True)
    assert sorted(map(tuple, placed.collect())) == sorted(map(tuple, out.collect()))


def test_the_tree_decides_where_copies_stand(spark, monkeypatch):
    from collections import Counter

    df = spark.range(900).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words here"), "id").alias("text"),
                                 F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    shards: dict[int, Counter] = {}
    for r in mixing.mix(df).collect():
        for shard in r["shards"]:
            shards.setdefault(shard, Counter())[r["doc_id"]] += 1
    assert len(shards) == mixing.SHARDS
    for words, tasks in ((mixing.PART_WORDS, 1), (20, 4)):
        monkeypatch.setattr(mixing, "PART_WORDS", words)
        placed = mixing.mixed_documents(df, placed=True).withColumn("task", F.spark_partition_id()).collect()
        held: dict[int, Counter] = {}
        for r in placed:
            held.setdefault(r["task"], Counter())[r["doc_id"]] += 1
        assert sum(held.values(), Counter()) == sum(shards.values(), Counter())
        if tasks == 1:  # every task holds whole shards
            assert all(any(s <= h for h in held.values()) for s in shards.values())
    order = [r["doc_id"] for r in placed]
    assert order != sorted(order)
