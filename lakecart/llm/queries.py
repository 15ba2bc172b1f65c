"""The dealt operators as named queries over whole tables, and their DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecart.llm import (
    bpe, fill_middle, language_id, licenses, mixing, near_dups, pieces, quality, repeats, secrets, sharding, topk, whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_exact_topk(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    valid = table.where(topk.finite_vector(F.col("embedding")))
    vecs = valid.select(F.col("vec_id").alias("id"), F.transform(
        "embedding", lambda x: F.floor(x.cast("double") * 64).cast("long")).alias("vec"))
    return topk.exact_topk(vecs.where("id % 20 = 0"), vecs, 20)


@query
def op2_repeats(spark, sf_dir):
    return repeats.repeated_passages(_documents(spark, sf_dir))


@query
def op3_near_duplicates(spark, sf_dir):
    return near_dups.near_duplicates(_documents(spark, sf_dir), percent=85)


@query
def op4_secrets(spark, sf_dir):
    return secrets.secret_digest(secrets.find_secrets(_documents(spark, sf_dir)))


@query
def op5_licenses(spark, sf_dir):
    return licenses.license_digest(licenses.license_matches(_documents(spark, sf_dir)))


@query
def op6_language(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language_id.fit(docs.where(~F.coalesce(held, F.lit(False))).select("doc_id", "text", "lang"))
    out = language_id.predict_language(docs, model)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op7_mix(spark, sf_dir):
    return mixing.mix(_documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", F.array_join(F.col("shards").cast("array<string>"), ",").alias("shards"),
        F.array_join(F.col("places").cast("array<string>"), ",").alias("places"))


@query
def op8_shards(spark, sf_dir):
    return sharding.shard(_documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_byte_bpe(spark, sf_dir):
    return bpe.token_digests(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op10_quality(spark, sf_dir):
    return quality.quality(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_whitening(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vecs = table.where(whitening.finite_vector(F.col("embedding"))).select(
        F.col("vec_id").alias("id"), whitening.scaled(F.col("embedding")).alias("x"))
    return whitening.whiten(vecs, components=8).withColumnRenamed("id", "vec_id")


@query
def op12_fill_middle(spark, sf_dir):
    return fill_middle.fim_digests(_documents(spark, sf_dir), fill_middle.Rule(fim_percent=100, spm_percent=50, seed=7))


@query
def op13_pieces(spark, sf_dir):
    return pieces.token_digests(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _license_sql() -> str:
    templates = ", ".join(
        f"({i}, '{t.label}', {str(t.base).lower()}, {t.key_at}, {len(t.key.split())}, {len(licenses.rare_words(t))})"
        for i, t in enumerate(licenses.TEMPLATES))
    words = ", ".join(f"({i}, {o}, '{w}', {str(t.key_at <= o < t.key_at + len(t.key.split())).lower()})"
                      for i, t in enumerate(licenses.TEMPLATES) for o, w in licenses.rare_words(t))
    return f"""
WITH templates(t, label, base, key_at, key_words, n) AS (VALUES {templates}),
notice(t, place, word, is_key) AS (VALUES {words}),
docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
hits AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS p FROM docs),
votes AS (SELECT h.doc_id, n.t, h.p - n.place AS start, count(*) AS votes, count(*) FILTER (n.is_key) AS key_votes
          FROM hits h JOIN notice n ON h.word = n.word GROUP BY ALL),
found AS (SELECT v.doc_id, t.label, t.base, v.start + t.key_at AS place, v.votes / t.n::DOUBLE AS coverage
          FROM votes v JOIN templates t ON v.t = t.t WHERE v.key_votes = t.key_words),
per AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(place) FILTER (base) AS first_word,
          max(place) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
          string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM docs d LEFT JOIN per USING (doc_id)"""


def _digest(*parts: str) -> str:
    text = " || '|' || ".join([f"'{mixing.SEED}'", *(f"coalesce(({p})::VARCHAR, '~null')" for p in parts)])
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _fill_sql(name: str, unit: str, order: str, passes: int) -> str:
    """CTEs name1 … namePasses after name0, as `mixing.fill_room`."""
    return "".join(f""",
{name}t{j} AS (SELECT *, again = 0 AND {unit} <= room AND sum(CASE WHEN again = 0 AND {unit} <= room THEN {unit} END) OVER (
           PARTITION BY source ORDER BY {order} ROWS UNBOUNDED PRECEDING) <= room AS take FROM {name}{j - 1}),
{name}{j} AS (SELECT * EXCLUDE (again, room, take), CASE WHEN take THEN 1 ELSE again END AS again,
           room - coalesce(sum(CASE WHEN take THEN {unit} END) OVER (PARTITION BY source), 0)::BIGINT AS room FROM {name}t{j})"""
                   for j in range(1, passes + 1))


def _tree_sql() -> str:
    """CTEs of `mixing.split_quotas` over q1 (node, source, lo, n), for up to GROUP_SOURCES sources; the last is runs.

    A draw's distribution comes from log-gamma weights here, not from ratios of neighbours.
    """
    def weight(x: str) -> str:
        return f"-(lgamma({x} + 1) + lgamma(n - {x} + 1) + lgamma(todo - {x} + 1) + lgamma(total - n - todo + {x} + 1))"

    ctes, width = "", 1
    while width < mixing.SHARDS:
        ctes += f""",
o{width} AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY source NULLS FIRST) AS i, sum(n) OVER (PARTITION BY node)::BIGINT AS total,
        {_digest(str(width), "node", "source")} / 1152921504606846976::DOUBLE AS u FROM q{width}),
r{width}(node, i, source, lo, n, got, total, todo) AS (
  SELECT DISTINCT node, 0::BIGINT, NULL::VARCHAR, 0::BIGINT, 0::BIGINT, 0::BIGINT, total, (total + 1) // 2 FROM o{width}
  UNION ALL
  SELECT node, i, source, lo, n, got, total - n, todo - got FROM (
    SELECT *, low + len([k FOR k IN range(1, high - low + 1) IF list_sum(w[1:k]) < u * list_sum(w)])::BIGINT AS got FROM (
      SELECT *, [exp(l - list_max(ls)) FOR l IN ls] AS w FROM (
        SELECT *, [{weight("x")} FOR x IN range(low, high + 1)] AS ls FROM (
          SELECT *, greatest(0, todo - (total - n), floor(mean)::BIGINT - spread) AS low, least(n, todo, ceil(mean)::BIGINT + spread) AS high FROM (
            SELECT *, ceil(sqrt(mean * (1 - n / greatest(total, 1))) * 12 + 12)::BIGINT AS spread FROM (
              SELECT o.node, o.i, o.source, o.lo, o.n, o.u, r.total, r.todo, r.todo * o.n / greatest(r.total, 1) AS mean
              FROM r{width} r JOIN o{width} o ON o.node = r.node AND o.i = r.i + 1))))))),
q{2 * width} AS (SELECT node * 2 AS node, source, lo, got AS n FROM r{width} WHERE i > 0
        UNION ALL SELECT node * 2 + 1, source, lo + got, n - got FROM r{width} WHERE i > 0)"""
        width *= 2
    return ctes + f""",
runs AS (SELECT source, node AS shard, lo, lo + n AS hi FROM q{width} WHERE n > 0)"""


ORACLES: dict[str, str] = {
    "op1_exact_topk": """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE)::DOUBLE FOR x IN embedding] AS vec FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.vec, c.vec)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op3_near_duplicates": """
WITH RECURSIVE low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM low),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON s.doc_id = l.a""",
    "op5_licenses": _license_sql(),
    "op7_mix": f"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
h AS (SELECT *, {_digest("source", "doc_id", "size")} AS h FROM d),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS rows FROM h GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s0),
s2 AS (SELECT *, coalesce(sum(source_size) OVER f, 0)::BIGINT AS full_size, coalesce(sum(weight) OVER f, 0)::BIGINT AS done,
         sum(source_size) OVER ()::BIGINT AS all_size, sum(weight) OVER ()::BIGINT AS all_weight,
         row_number() OVER (ORDER BY source_size * 10::DOUBLE / weight, source NULLS LAST) AS nr FROM s1
       WINDOW f AS (ORDER BY source_size * 10::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, (all_size * 1.5::DOUBLE - full_size * 2.0::DOUBLE) / (all_weight - done) AS level FROM s2),
lv AS (SELECT level FROM s3 WHERE weight * level < source_size * 2.0::DOUBLE ORDER BY nr LIMIT 1),
s4 AS (SELECT source, source_size, rows, least(source_size * 2.0::DOUBLE, weight * coalesce((SELECT level FROM lv), 1e300)) AS target FROM s3),
s5 AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS passes,
         ceil(sqrt(rows))::BIGINT AS nb FROM s4),
s6 AS (SELECT *, target - passes * source_size AS part FROM s5),
b0 AS (SELECT h.*, s6.source_size, s6.target, s6.passes, s6.part, h.h % s6.nb AS block FROM h JOIN s6 ON h.source IS NOT DISTINCT FROM s6.source),
p0 AS (SELECT source, block, sum(size)::BIGINT AS words, first(part) AS room, 0 AS again,
         {_digest("'permuted'", "source", "block")} AS turn FROM b0 GROUP BY source, block){_fill_sql("p", "words", "turn, block", mixing.BLOCK_PASSES)},
pool AS (SELECT *, row_number() OVER (PARTITION BY source, again ORDER BY turn, block) AS spare FROM p{mixing.BLOCK_PASSES}),
ranked AS (SELECT source, block, room, again, CASE WHEN again = 1 THEN 2 WHEN room > 0 AND spare <= {mixing.POOL_BLOCKS} THEN 1 ELSE 0 END AS drawn,
             turn FROM pool),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY drawn = 0, turn, block) - 1 AS number,
             count(*) OVER (PARTITION BY source) AS n FROM ranked),
dealt AS (SELECT b0.*, r.room, r.drawn, r.number, r.n
          FROM b0 JOIN numbered r ON b0.source IS NOT DISTINCT FROM r.source AND b0.block = r.block),
q1 AS (SELECT 0::BIGINT AS node, r.source, 0::BIGINT AS lo, (first(s6.passes) * count(*) + count(*) FILTER (drawn > 0))::BIGINT AS n
       FROM ranked r JOIN s6 ON r.source IS NOT DISTINCT FROM s6.source GROUP BY r.source){_tree_sql()},
f0 AS (SELECT doc_id, source, h, sum(size)::BIGINT AS words, first(room) AS room, 0 AS again FROM dealt WHERE drawn = 1
       GROUP BY doc_id, source, h){_fill_sql("f", "words", "words DESC, h, doc_id", mixing.FILL_PASSES)},
decided AS (
  SELECT d.doc_id, d.source, d.h, size, source_size, target, number, n, least(2, passes + f.again) AS copies
  FROM dealt d JOIN f{mixing.FILL_PASSES} f ON d.h = f.h AND d.doc_id IS NOT DISTINCT FROM f.doc_id AND d.source IS NOT DISTINCT FROM f.source
  UNION ALL SELECT doc_id, source, h, size, source_size, target, number, n, least(2, passes + CASE WHEN drawn = 2 THEN 1 ELSE 0 END)
  FROM dealt WHERE drawn <> 1)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, concat_ws(',', a.shard, b.shard) AS shards,
       concat_ws(',', CASE WHEN copies > 0 THEN {_digest("'shuffle'", "1", "h")} END, CASE WHEN copies > 1 THEN {_digest("'shuffle'", "2", "h")} END) AS places
FROM decided d
LEFT JOIN runs a ON d.source IS NOT DISTINCT FROM a.source AND copies > 0 AND a.lo <= number AND number < a.hi
LEFT JOIN runs b ON d.source IS NOT DISTINCT FROM b.source AND copies > 1 AND b.lo <= n + number AND n + number < b.hi""",
    "op12_fill_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
                  regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
h AS (SELECT *, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
s AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
             array_to_string(u[b + 1:], '') AS suffix FROM f),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM s),
p AS (SELECT *, strpos(output, '<P>') AS ap, strpos(output, '<S>') AS az, strpos(output, '<M>') AS am FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
                        WHEN 'psm' THEN substr(output, ap + 3, az - ap - 3) || substr(output, am + 3) || substr(output, az + 3, am - az - 3)
                        ELSE substr(output, ap + 3, am - ap - 3) || substr(output, am + 3) || substr(output, az + 3, ap - az - 3) END) AS restored_sha256
FROM p""",
}
