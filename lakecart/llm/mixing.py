"""Mixing sources to target weights with a splitting tree (dealt operator 7, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecart.llm.store import written
from lakecart.operators.joins import fits_broadcast

WEIGHTS, BUDGET, CAP = (5, 2, 1), 1.5, 2
SHARDS = 16
# Words of a shard that one task places.
PART_WORDS = 20_000_000
# Sources that are drawn one after another in one row; more are drawn in groups of about so many.
GROUP_SOURCES = 1024
# Tables of the plan up to this size are broadcast to the texts.
PLAN_ROWS, PLAN_BYTES = 500_000, 32 * 1024 * 1024
# Passes over a source's blocks, blocks whose documents fill what whole blocks leave, and passes over those documents.
BLOCK_PASSES, POOL_BLOCKS, FILL_PASSES = 3, 4, 4
SEED = "lakecart-mix"
WORD = r"[^\x20\x09-\x0D]+"


def _digest(*parts: Column) -> Column:
    """60 bits of an MD5, the same in every engine; nulls read as a mark of their own."""
    text = F.concat_ws("|", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("~null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _uniform(*parts: Column) -> Column:
    return _digest(*parts) / F.lit(float(2**60))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, rows, weight, target) from (source, size) rows.

    Sources in code point order, null last, weigh WEIGHTS in turn and share BUDGET times all sizes.  A target stops
    at CAP times its source's size; what is over goes to the rest by weight.  The fixed point of that is
    min(cap, weight * level), found by one running sum over the sources in the order in which they fill up.
    One row per source: the single-task windows below run over sources, not documents.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (turn + 1).cast("int")).cast("long"))
    # Compare size / weight without division: exact order of filling up.
    fill = Window.orderBy((F.col("source_size") * F.lit(10) / F.col("weight")), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(1))
    s = s.select("*", F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("full"),
                 F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("done"),
                 F.sum("source_size").over(everything).alias("all_size"), F.sum("weight").over(everything).alias("all_weight"))
    level = (F.col("all_size") * F.lit(BUDGET) - F.col("full") * F.lit(float(CAP))) / (F.col("all_weight") - F.col("done"))
    s = s.withColumn("level", level).withColumn("open", F.col("weight") * F.col("level") < F.col("source_size") * F.lit(float(CAP)))
    # The level is that of the first source that does not fill up (all later ones have the same share per weight).
    s = s.withColumn("level", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    cap = F.col("source_size") * F.lit(float(CAP))
    return s.select("source", "source_size", "rows", "weight",
                    F.when(F.col("level").isNull(), cap).otherwise(F.least(cap, F.col("weight") * F.col("level"))).alias("target"))


def _left_share(total: Column, mine: Column, left: Column, u: Column) -> Column:
    """A hypergeometric draw: of `left` blocks drawn from `total`, how many are of the `mine` of one kind.

    Inverse of the distribution at u, over the support within 12 standard deviations of the mean, weights from the
    recurrence of neighbouring probabilities.
    """
    low = F.greatest(F.lit(0), left - (total - mine))
    high = F.least(mine, left)
    mean = left * mine / F.greatest(total, F.lit(1))
    spread = F.ceil(F.sqrt(mean * (1 - mine / F.greatest(total, F.lit(1)))) * 12 + 12).cast("long")
    low = F.greatest(low, F.floor(mean).cast("long") - spread)
    high = F.least(high, F.ceil(mean).cast("long") + spread)
    ratio = lambda x: ((mine - x) * (left - x)).cast("double") / ((x + 1) * (total - mine - left + x + 1)).cast("double")
    start = F.struct(F.lit(1.0).alias("p"), F.lit(1.0).alias("sum"))
    steps = F.sequence(low, high)
    whole = F.aggregate(steps, start, lambda a, x: F.struct(
        (a["p"] * F.when(x < high, ratio(x)).otherwise(0.0)).alias("p"),
        (a["sum"] + a["p"] * F.when(x < high, ratio(x)).otherwise(0.0)).alias("sum")), lambda a: a["sum"])
    first = F.struct(F.lit(1.0).alias("p"), F.lit(1.0).alias("sum"), low.alias("at"))
    return F.aggregate(steps, first, lambda a, x: F.struct(
        (a["p"] * F.when(x < high, ratio(x)).otherwise(0.0)).alias("p"),
        (a["sum"] + a["p"] * F.when(x < high, ratio(x)).otherwise(0.0)).alias("sum"),
        F.when((a["sum"] < u * whole) & (x < high), x + 1).otherwise(a["at"]).alias("at")), lambda a: a["at"])


def _draw_left(items: DataFrame, keys: list[str], left: Column, u: Column) -> DataFrame:
    """`items` (`keys`, name, n, at) with `left`: each item's part of the `left` units that its keys draw from all.

    A multivariate hypergeometric draw made item by item in the order of name, from what is left to draw.  The items of
    one key meet in one row: about GROUP_SOURCES or as many groups.  u(name) is the item's uniform number, as column `u`.
    """
    own = items.withColumn("u", u).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("name", "n", "at", "u"))).alias("parts"), F.sum("n").alias("total"),
        F.first("draw").alias("draw"))

    def draw(a, p):
        # a: units of the key not yet looked at, and how many of them go left.
        got = _left_share(a["total"], p["n"], a["left"], p["u"])
        return F.struct((a["total"] - p["n"]).alias("total"), (a["left"] - got).alias("left"), F.concat(a["out"], F.array(
            F.struct(p["name"].alias("name"), p["n"].alias("n"), p["at"].alias("at"), got.alias("left")))).alias("out"))

    name = items.schema["name"].dataType.simpleString()
    empty = F.array().cast(f"array<struct<name:{name},n:bigint,at:bigint,left:bigint>>")
    start = F.struct(F.col("total").alias("total"), left.alias("left"), empty.alias("out"))
    return own.select(*keys, F.explode(F.aggregate("parts", start, draw, lambda a: a["out"])).alias("d")).select(*keys, "d.*")


def split_quotas(quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(source, shard, lo, hi): which of each source's permuted blocks, numbered from 0, each shard draws.

    quotas: (source, blocks).  A binary tree over the shards: at each node the left half's blocks are a multivariate
    hypergeometric draw from the node's, so every split keeps each source's total exact and the halves equal to a
    block.  Beyond GROUP_SOURCES sources a node first draws for groups of sources, then each group for its own, which
    is the same distribution and keeps every row small.  Draws are a function of (seed, node, source) only.
    `shards`: a power of two.
    """
    groups = -(-quotas.count() // GROUP_SOURCES)
    group = F.pmod(_digest(F.lit("group"), F.col("source")), F.lit(max(1, groups)))
    nodes = quotas.select(F.lit(0).alias("node"), group.alias("group"), F.col("source").alias("name"),
                          F.lit(0).cast("long").alias("at"), F.col("blocks").cast("long").alias("n"))
    width = 1
    while width < shards:
        mark, node = F.lit(width), F.col("node")
        half = ((F.col("total") + 1) / 2).cast("long")
        if groups > 1:
            whole = nodes.groupBy("node", F.col("group").alias("name")).agg(F.sum("n").alias("n")).select(
                "*", F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("draw"))
            per = _draw_left(whole, ["node"], half, _uniform(F.lit("group"), mark, node, F.col("name"))).select(
                "node", F.col("name").alias("group"), F.col("left").alias("draw"))
            done = _draw_left(nodes.join(per, ["node", "group"]), ["node", "group"], F.col("draw"), _uniform(mark, node, F.col("name")))
        else:
            done = _draw_left(nodes.withColumn("draw", F.lit(0)), ["node", "group"], half, _uniform(mark, node, F.col("name")))
        nodes = done.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), "group", "name", "at", F.col("left").alias("n")),
            F.struct((F.col("node") * 2 + 1).alias("node"), "group", "name", (F.col("at") + F.col("left")).alias("at"),
                     (F.col("n") - F.col("left")).alias("n")),
        )).alias("s")).select("s.*")
        nodes = written(nodes, "mix-tree")
        width *= 2
    return nodes.select(F.col("name").alias("source"), F.col("node").alias("shard"), F.col("at").alias("lo"),
                        (F.col("at") + F.col("n")).alias("hi"))


def fill_room(rows: DataFrame, unit: str, order: list[Column], passes: int) -> DataFrame:
    """`rows` (source, room, `unit`, …) with `again`: 1 for rows whose units fill their source's room.

    Each pass takes rows that still fit, in the given order, as far as their running sum fits; the room that is left
    shrinks from pass to pass.  `room` is what stays empty.
    """
    own = Window.partitionBy("source")
    c = rows.withColumn("again", F.lit(0))
    for _ in range(passes):
        c = c.withColumn("fit", F.when((F.col("again") == 0) & (F.col(unit) <= F.col("room")), F.col(unit)))
        upto = F.sum("fit").over(own.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
        c = c.withColumn("take", F.coalesce(F.col("fit").isNotNull() & (upto <= F.col("room")), F.lit(False)))
        c = c.withColumn("again", F.when(F.col("take"), 1).otherwise(F.col("again")))
        c = c.withColumn("room", F.col("room") - F.coalesce(F.sum(F.when(F.col("take"), F.col(unit))).over(own), F.lit(0)))
    return c.drop("fit", "take")


def _sized(docs: DataFrame) -> Column:
    return F.regexp_count(F.coalesce(docs["text"].cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(sizes, sources, blocks, fills): the mix as a table of documents' sizes and three small ones that decide.

    sizes: (doc_id, source, size, h).  sources: (source, source_size, target, nb, …).  blocks: (source, block, copies,
    pool, turns); copies: how often its documents are taken, pool: whether single documents of it fill up; turns: the
    shard of each copy.  fills: (doc_id, source, h), the documents of pool blocks that are taken once more.

    A source is cut into about sqrt(rows) blocks by a hash of its documents, and its blocks are permuted by another.
    Whole passes over the source come first; the last, partial pass takes blocks in permuted order as far as they fit
    the rest of the target, and documents of a few further blocks fill what is left (`fill_room`), so taken words
    stay below the target by less than a small document.  Blocks touched in all passes are the source's quota; a
    splitting tree deals the quotas to the shards, each drawing a disjoint run of the permuted blocks.  No window is
    larger than one source's blocks or a few blocks' documents.
    """
    sizes = docs.select("doc_id", "source", _sized(docs).alias("size"))
    sizes = written(sizes.withColumn("h", _digest(F.col("source"), F.col("doc_id"), F.col("size"))), "mix-sizes")
    sources = source_targets(sizes.select("source", "size"))
    whole = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size")).cast("int"))
    sources = written(sources.withColumn("passes", whole).withColumn(
        "part", F.col("target") - F.col("passes") * F.col("source_size")).withColumn(
        "nb", F.ceil(F.sqrt("rows")).cast("long")), "mix-sources")

    d = sizes.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.*", "passes", "part", F.pmod("h", "nb").alias("block"))
    blocks = d.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("part").alias("room"),
                                              F.first("passes").alias("passes"))
    permuted = [F.col("turn"), F.col("block")]
    blocks = blocks.withColumn("turn", _digest(F.lit("permuted"), F.col("source"), F.col("block")))
    blocks = fill_room(blocks, "words", permuted, BLOCK_PASSES)
    spare = F.row_number().over(Window.partitionBy("source", "again").orderBy(*permuted))
    drawn = F.when(F.col("again") == 1, 2).when((F.col("room") > 0) & (spare <= POOL_BLOCKS), 1).otherwise(0)
    blocks = blocks.withColumn("drawn", drawn).withColumn("number", F.row_number().over(
        Window.partitionBy("source").orderBy((F.col("drawn") == 0).cast("int"), *permuted)) - 1)
    blocks = written(blocks.select("source", "block", "number", "passes", "drawn", "room"), "mix-blocks")

    own = blocks.where("drawn = 1").alias("b")
    crossing = d.alias("d").join(own, F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.block") == F.col("b.block"))).select(
        "d.doc_id", "d.source", "d.h", "d.size", "b.room")
    # Repeats of one row are taken together or not at all.
    crossing = crossing.groupBy("doc_id", "source", "h").agg(F.sum("size").alias("words"), F.first("room").alias("room"))
    crossing = fill_room(crossing, "words", [F.desc("words"), F.col("h"), F.col("doc_id")], FILL_PASSES)
    fills = written(crossing.where("again = 1").select("doc_id", "source", "h"), "mix-fills")

    per_source = blocks.groupBy("source").agg(
        F.max("passes").alias("passes"), F.count("*").alias("n"), F.count(F.when(F.col("drawn") > 0, 1)).alias("some"))
    runs = split_quotas(per_source.select("source", (F.col("passes") * F.col("n") + F.col("some")).alias("blocks")))
    runs = runs.where("lo < hi").groupBy("source").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "shard"))).alias("runs"))
    per = per_source.alias("p").join(runs.alias("r"), F.col("p.source").eqNullSafe(F.col("r.source"))).select("p.source", "n", "runs")

    def shard(turn: Column) -> Column:
        at = turn * F.col("n") + F.col("number")  # each pass numbers its blocks in permuted order
        return F.get(F.filter("runs", lambda r: (r["lo"] <= at) & (at < r["hi"])), F.lit(0))["shard"]

    turns = F.least(F.lit(CAP), F.col("passes") + (F.col("drawn") > 0).cast("int"))
    turns = F.transform(F.filter(F.array(*map(F.lit, range(CAP))), lambda c: c < turns), shard)
    copies = F.least(F.lit(CAP), F.col("passes") + (F.col("drawn") == 2).cast("int"))
    # A source without any quota has no runs and takes nothing.
    blocks = blocks.alias("b").join(per.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")), "left").select(
        "b.source", "block", copies.alias("copies"), (F.col("drawn") == 1).alias("pool"), turns.alias("turns"))
    return sizes, sources, written(blocks, "mix-turns"), fills


def _decided(rows: DataFrame, sources: DataFrame, blocks: DataFrame, fills: DataFrame, hint=lambda df: df) -> DataFrame:
    """`rows` (_mix_id, _mix_source, _mix_h and more) with _mix_source_size, _mix_target and _mix_shards."""
    s = hint(sources.select(F.col("source").alias("_s"), F.col("nb").alias("_nb"), F.col("source_size").alias("_mix_source_size"),
                            F.col("target").alias("_mix_target")))
    b = hint(blocks.select(F.col("source").alias("_bs"), F.col("block").alias("_b"), "copies", "pool", "turns").withColumnsRenamed(
        {"copies": "_copies", "pool": "_pool", "turns": "_turns"}))
    f = hint(fills.select(F.col("doc_id").alias("_fi"), F.col("source").alias("_fs"), F.col("h").alias("_fh")))
    out = rows.join(s, F.col("_mix_source").eqNullSafe(F.col("_s")))
    out = out.join(b, F.col("_mix_source").eqNullSafe(F.col("_bs")) & (F.pmod("_mix_h", "_nb") == F.col("_b")))
    out = out.join(f, F.col("_pool") & F.col("_mix_source").eqNullSafe(F.col("_fs")) & F.col("_mix_id").eqNullSafe(F.col("_fi"))
                   & (F.col("_mix_h") == F.col("_fh")), "left")
    taken = F.least(F.lit(CAP), F.col("_copies") + F.col("_fh").isNotNull().cast("int"))
    return out.withColumn("_mix_shards", F.slice("_turns", 1, taken)).drop(
        "_s", "_nb", "_bs", "_b", "_copies", "_pool", "_turns", "_fi", "_fs", "_fh")


def _place(copy: Column, h: Column) -> Column:
    """Where a copy stands in its shard: a hash that orders the shard's rows."""
    return _digest(F.lit("shuffle"), copy, h)


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, h, size, source_size, target, shards, places, taken.

    shards: the output shard of each copy that the mix takes (none, one or two), as the splitting tree dealt the copy's
    block (`plan`); places: the copies' places in the hashed order of their shards; taken: the words of these copies.
    All choices are functions of (seed, source, doc_id, size), so reruns agree.

    Null text: size 0.  Null source: a source of its own, last.  Repeated rows count each; where
    single documents fill up a source, equal rows are taken together or not at all.  An empty table gives no rows.  Other columns are not read.
    """
    sizes, sources, blocks, fills = plan(docs)
    rows = sizes.withColumnsRenamed({"doc_id": "_mix_id", "source": "_mix_source", "h": "_mix_h"})
    d = _decided(rows, sources, blocks, fills)
    places = F.transform("_mix_shards", lambda _, i: _place(i + 1, F.col("_mix_h")))
    return d.select(F.col("_mix_id").alias("doc_id"), F.col("_mix_source").alias("source"), F.col("_mix_h").alias("h"), "size",
                    F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
                    F.col("_mix_shards").alias("shards"), places.alias("places"),
                    (F.size("_mix_shards") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, placed: bool = True) -> DataFrame:
    """`docs` as the mix takes them: a document appears once per taken copy, all its columns kept.

    Rows stand in the shard that the splitting tree drew for the copy, in the order of a hash of the copy, so both copies
    of a document part.  The plan's tables (sources, about sqrt(rows) blocks of each, the documents of a few blocks) meet
    the texts by broadcast behind a check of their size, so texts move once, straight to their shards; beyond PLAN_ROWS
    or PLAN_BYTES they are decided for the narrow sizes and the texts meet that table in a shuffle first.  A shard of more
    than PART_WORDS words is dealt to several tasks by the hash, each holding a run of the order; tasks follow the shards.  A row of size 0 counts
    no words; it stays as often as its block is taken.  placed: False leaves copies where their documents were read.
    Nulls, repeats and empty tables as in `mix`; columns may have any names but those that start with `_mix_`.
    """
    _, sources, blocks, fills = plan(docs.select("doc_id", "text", "source"))
    keyed = docs.select("*", docs["doc_id"].alias("_mix_id"), docs["source"].alias("_mix_source"),
                        _digest(docs["source"], docs["doc_id"], _sized(docs)).alias("_mix_h"))
    small = [sources.select("source", "nb", "source_size", "target"), blocks, fills]
    if all(fits_broadcast(t, PLAN_ROWS, PLAN_BYTES) for t in small):
        decided = _decided(keyed, sources, blocks, fills, F.broadcast)
    else:
        own = keyed.select("_mix_id", "_mix_source", "_mix_h").distinct()
        own = _decided(own, sources, blocks, fills).where(F.size("_mix_shards") > 0).select(
            F.col("_mix_id").alias("_i"), F.col("_mix_source").alias("_s"), F.col("_mix_h").alias("_h"), "_mix_shards")
        decided = keyed.join(own.hint("shuffle_hash"), (F.col("_mix_h") == F.col("_h")) & F.col("_mix_id").eqNullSafe(F.col("_i"))
                             & F.col("_mix_source").eqNullSafe(F.col("_s")))
    names = [F.col(f"`{c}`") for c in docs.columns]
    copies = decided.select(*names, "_mix_h", F.posexplode("_mix_shards").alias("_mix_copy", "_mix_shard"))
    copies = copies.select(*names, "_mix_shard", _place(F.col("_mix_copy") + 1, F.col("_mix_h")).alias("_mix_place"))
    if not placed:
        return copies.select(*names)
    words = sources.agg(F.sum("target")).first()[0] or 0
    parts = int(words // (SHARDS * PART_WORDS)) + 1
    part = F.least(F.lit(parts - 1), F.floor(F.col("_mix_place") / F.lit(2.0**60 / parts)))
    task = (F.col("_mix_shard") * parts + part).cast("int")
    return copies.repartitionById(SHARDS * parts, task).sortWithinPartitions("_mix_place").select(*names)
