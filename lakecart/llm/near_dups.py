"""Near-duplicate documents by min-max hashing (dealt operator 3)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecart.llm.components import connected_components
from lakecart.llm.store import written
from lakecart.llm.textbatch import mix, shingle_sets, slices

SHINGLE_WORDS = 5
# 40 permutations give 80 values (each one's minimum and maximum): 20 bands of 4.  A pair at similarity s misses every
# band with (1 - s^4)^20: 4e-7 at 0.85, 3e-5 at 0.8.
BANDS, PERMS_PER_BAND = 20, 2
PERMS = BANDS * PERMS_PER_BAND
# Members of one bucket compared in one row, and what one confirming group holds of a large candidate group.
BUCKET_BLOCK, GROUP_DOCS, GROUP_SHINGLES = 512, 512, 300_000
# Signature agreement below which two bucket members are not taken as candidates: 80 values of 8 bits put a pair at
# similarity 0.8 about 5.6 standard deviations above it.
AGREE = 0.55
_A = np.random.Generator(np.random.PCG64(31)).integers(1, 2**63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SIG_BYTES = 2 * PERMS


def sketch_batch(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text: set size, 128-bit set digest (two int64), band keys, and 8-bit min and max values."""
    n = len(texts)
    size, digest = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64)
    low, high = np.zeros((n, PERMS), np.uint64), np.zeros((n, PERMS), np.uint64)

    def flush(first: int, sets: list[np.ndarray]) -> None:
        filled = [i for i, s in enumerate(sets) if len(s)]
        if not filled:
            return
        flat = np.concatenate([sets[i] for i in filled])
        at = np.cumsum([0] + [len(sets[i]) for i in filled])[:-1]
        rows = first + np.array(filled)
        digest[rows, 0] = np.add.reduceat(mix(flat + np.uint64(1)), at)
        digest[rows, 1] = np.add.reduceat(mix(flat ^ np.uint64(0xD6E8FEB86659FD93)), at)
        for p in range(PERMS):
            v = flat * _A[p]
            low[rows, p], high[rows, p] = np.minimum.reduceat(v, at), np.maximum.reduceat(v, at)

    held, first, total = [], 0, 0
    for i, s in enumerate(shingle_sets(texts, k)):
        size[i] = len(s)
        held.append(s)
        total += len(s)
        if total > 200_000:
            flush(first, held)
            held, first, total = [], i + 1, 0
    flush(first, held)
    bands = np.zeros((n, BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(n, b + 1, np.uint64)
        for p in range(b * PERMS_PER_BAND, (b + 1) * PERMS_PER_BAND):
            h = mix(mix(h + low[:, p]) + high[:, p])
        bands[:, b] = h
    sig = (mix(np.concatenate([low, high], axis=1)) >> np.uint64(56)).astype(np.uint8)
    return size, digest.view(np.int64), bands.view(np.int64), sig


def sketches(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands, sig): set size, set digest, band keys and signature per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            size, digest, bands, sig = sketch_batch(batch.column("text").to_pylist(), k)
            n = len(size)
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(size), pa.array(np.ascontiguousarray(digest[:, 0])),
                pa.array(np.ascontiguousarray(digest[:, 1])), pa.ListArray.from_arrays(offsets, pa.array(bands.ravel())),
                pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(
                    (np.arange(n + 1, dtype=np.int32) * _SIG_BYTES).tobytes()), pa.py_buffer(sig.tobytes())]),
            ], names=["doc_id", "n_shingles", "d1", "d2", "bands", "sig"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sig binary")


def spanning_links(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Spanning links (root, member) of the graph in which `near(i, others)` marks i's neighbours among `others`.

    Breadth first: a member is compared only with what no earlier one has reached, so a group of copies costs one
    pass; no pair is left out that could join two parts.
    """
    links, left = [], np.arange(n)
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        queue = [root]
        while queue and len(left):
            hit = near(queue.pop(), left)
            if hit.any():
                new = left[hit].tolist()
                links += [(root, j) for j in new]
                queue += new
                left = left[~hit]
    return links


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        members = batch.column("members")
        flat, at = members.flatten(), members.offsets.to_numpy() - members.offsets[0].as_py()
        rep = flat.field("rep").to_numpy(zero_copy_only=False)
        sig = np.frombuffer(b"".join(flat.field("sig").to_pylist()), np.uint8).reshape(-1, _SIG_BYTES)
        a, b = [], []
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            order = lo + np.argsort(rep[lo:hi], kind="stable")
            ids, own = rep[order], sig[order]
            for i, j in spanning_links(hi - lo, lambda i, rest, own=own: (own[rest] == own[i]).mean(axis=1) >= AGREE):
                a.append(ids[i])
                b.append(ids[j])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def candidate_links(reps: DataFrame) -> DataFrame:
    """Links (a, b) whose components hold every pair that shares a band and agrees in its signature.

    reps: (rep, bands, sig), one row per distinct set.  Buckets over BUCKET_BLOCK members are cut into blocks, and
    each pair of blocks is compared in a row of its own.
    """
    spread = reps.select("rep", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BUCKET_BLOCK).cast("int")
    hot = spread.join(shared, "key").select("key", "rep", blocks.alias("nb"))
    hot = hot.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    hot = hot.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    hot = hot.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "rep")
    tiles = hot.join(reps.select("rep", "sig"), "rep").groupBy("key", "i", "j").agg(
        F.collect_list(F.struct("rep", "sig")).alias("members"))
    return tiles.where(F.size("members") > 1).select("members").mapInArrow(_bucket_links, "a long, b long").distinct()


def confirmed_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Spanning links among full sets with 100 * intersection >= percent * union."""
    sizes = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    at = np.cumsum(np.concatenate(([0], sizes)))
    mark = np.zeros(int(ids.max()) + 1, np.int64)
    view: dict = {}

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        if view.get("n", 0) == 0 or len(rest) < view["n"] // 2:  # gather the remaining sets anew as they get fewer
            view.update(n=len(rest), rows=rest, flat=np.concatenate([ids[at[j]:at[j + 1]] for j in rest]),
                        at=np.cumsum(np.concatenate(([0], sizes[rest])))[:-1])
        mine = ids[at[i]:at[i + 1]]
        mark[mine] = 1
        both = np.add.reduceat(mark[view["flat"]], view["at"])[np.searchsorted(view["rows"], rest)]
        mark[mine] = 0
        return 100 * both >= percent * (sizes[i] + sizes[rest] - both)

    return spanning_links(len(sets), near)


def _confirm_group(k: int, percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        pdf = pdf.sort_values(["comp", "rep"], kind="stable")
        for _, rows in pdf.groupby("comp", sort=False):
            if len(rows) > 1:
                # an id with two texts is there with both: a link of either counts for it, one between them is none
                ids = rows["rep"].tolist()
                out += [(ids[i], ids[j]) for i, j in confirmed_links(list(shingle_sets(rows["text"].tolist(), k)), percent)]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def exact_links(docs: DataFrame, candidates: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) confirmed on full sets; they connect exactly what all true links within each candidate group do.

    Small candidate groups share a task; a group beyond GROUP_DOCS or GROUP_SHINGLES is cut into blocks and every
    pair of blocks is confirmed in a group of its own, each giving only its spanning links.
    """
    comps = connected_components(candidates).withColumnRenamed("node", "rep").withColumnRenamed("component", "comp")
    sized = comps.join(reps.select("rep", "n_shingles"), "rep")
    totals = sized.groupBy("comp").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("shingles"))
    totals = totals.select("comp", "shingles", F.greatest(
        F.ceil(F.col("docs") / GROUP_DOCS), F.ceil(F.col("shingles") / GROUP_SHINGLES)).cast("int").alias("nb"))
    members = written(sized.join(totals, "comp").select("rep", "comp", "nb", "n_shingles"), "near-members")
    small = members.where("nb = 1").agg(F.sum("n_shingles")).first()[0] or 0
    bins = int(small // GROUP_SHINGLES) + 1
    mine = F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int")
    members = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    members = members.select("rep", "comp", F.when(F.col("nb") == 1, F.pmod(F.xxhash64("comp"), F.lit(bins))).otherwise(
        F.xxhash64("comp", F.least("mine", "other"), F.greatest("mine", "other"))).alias("grp"),
        F.when(F.col("nb") == 1, 0).otherwise(1).alias("kind"))
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    return members.join(texts, "rep").groupBy("kind", "grp").applyInPandas(_confirm_group(k, percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, k: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Min-max hashing: each permutation keeps both its minimum and its maximum, so half as many hash evaluations give
    the banded signature.  Equal sets form one class (grouped by a 128-bit digest); only class representatives are
    banded.  Candidate groups are confirmed on full sets, so a link is exact; what banding and the signature filter
    can miss is bounded above (BANDS, AGREE).  Links with 100 * intersection >= percent * union; component_id is the
    smallest doc_id reachable.

    Null or wordless text: empty set, linked with nothing.  Null doc_id: null component_id, kept.  Repeated rows give
    repeated, equal results.  Different texts under one doc_id are one document with several texts: each has its own
    n_shingles, and a link of any of them counts for the id.  Other columns are not read.  An empty table gives an empty
    result.
    """
    sk = written(sketches(docs, k), "near-sketch")
    keyed = sk.where("doc_id is not null and n_shingles > 0")
    classes = keyed.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = written(classes, "near-classes")
    own = keyed.select("d1", "d2", F.col("doc_id").alias("rep"), "n_shingles", "bands", "sig")
    reps = classes.join(own, ["d1", "d2", "rep"]).dropDuplicates(["d1", "d2", "rep"])
    reps = written(reps.select("rep", "n_shingles", "bands", "sig"), "near-reps")
    links = written(exact_links(docs, written(candidate_links(reps), "near-candidates"), reps, k, percent), "near-links")
    comps = connected_components(links)
    joined = classes.join(comps, classes.rep == comps.node, "left")
    named = joined.where("copies > 1 or component is not null").select(
        "d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    out = sk.select("doc_id", "n_shingles", "d1", "d2").join(named, ["d1", "d2"], "left")
    comp = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(
        F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id")).withColumn(
        "kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, percent: int = 80, k: int = SHINGLE_WORDS) -> DataFrame:
    """`docs` with one document of each near-duplicate group, all columns kept as they are.

    Of a group the document with the smallest doc_id stays.  A row repeated with one doc_id and text is a group too: one of
    it stays, the first by a hash of all its columns.  If some doc_id has different texts, documents go by a 64-bit hash of
    id and text instead, so such texts are documents of their own, and the smallest hash of a group stays.  Rows without a
    doc_id stay.
    """
    text = F.xxhash64(F.col("text").cast("string"))
    texts = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(text).alias("low"), F.max(text).alias("high"))
    if texts.where("low <> high").isEmpty():
        return _one_of_each(docs, "doc_id", percent, k)
    own = "_document"
    while own in docs.columns:
        own += "_"
    keyed = docs.withColumn(own, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.col("text").cast("string"))))
    return _one_of_each(keyed, own, percent, k).drop(own)


def _one_of_each(docs: DataFrame, key: str, percent: int, k: int) -> DataFrame:
    """One row of each near-duplicate group of `docs`, whose documents are told apart by the long column `key`."""
    gone = near_duplicates(docs.select(F.col(key).alias("doc_id"), "text"), percent, k)
    state = gone.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("kept").alias("kept")).where("doc_id is not null")
    state = written(state.where("n > 1 or not kept").withColumnRenamed("doc_id", key), "near-gone")
    out = docs.join(state.where("not kept").select(key), key, "left_anti").select(*docs.columns)
    if state.where("kept").isEmpty():
        return out
    again = state.where("kept").select(key)
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*docs.columns)))
    repeats = out.join(again, key, "left_semi").select(*docs.columns, first.alias("_first")).where("_first = 1")
    return out.join(again, key, "left_anti").select(*docs.columns).union(repeats.select(*docs.columns))
