"""Mixing sources to target weights with exact quotas, split over output shards by a tree.

Targets: the sources share ``share`` of all words by weight; none takes more than ``most`` times its
own size, and what it leaves goes to the others by weight.

Blocks: a document belongs to a block of its source by hash; blocks stand in a hash order. A source
that takes more than its size takes all blocks so many times, and of the rest the first blocks of
the order up to its target. The block at the end is taken document by document, in a hash order
too, and the last document word by word, so that each source takes exactly its target.

Tree: the numbers of blocks each source gives are split over the shards by halving the shards again
and again. Of the blocks at a node, the left half of its shards gets a number in proportion, and how
many of them come from each source is drawn from the multivariate hypergeometric distribution: one
hypergeometric draw per source by inverse distribution, from a hash of node and source. Each shard
then takes the next blocks of each source's order, so shards are disjoint, and shuffles its own
documents by hash.

Everything is DataFrame expressions. Sources are few by nature (a weight is given for each), blocks
have about ``block_words`` words and shards about ``shard_words``, so no window outgrows its task.
Null texts have no words; a null source is a source of its own; documents without words are never
taken, and sources without any take nothing. Rows equal in doc_id, source and text are alike: any of
them may be the one that is cut. No row order enters, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.tables import packed, staged, text_of, unpacked

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2.0, 20240229
BLOCK_WORDS, SHARD_WORDS = 250_000, 20_000_000
#: A hypergeometric draw looks this many standard deviations to either side of its mean.
REACH = 12


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def unit(*columns) -> Column:
    """A number in [0, 1) from a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns), 11)
    return bits.cast("double") / float(1 << 53)


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes`` (source, source_size, weight) with target.

    Sources are full in the order of room per weight. With k sources full, the others share the
    rest by weight; the level is the first at which no further source would be full.
    """
    room = F.col("source_size") * most
    by_room = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    ranked = sizes.withColumn("_ratio", room / F.col("weight"))
    total = F.sum("source_size").over(everyone) * share
    full = F.coalesce(F.sum(room).over(before), F.lit(0.0))
    weight = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = ranked.withColumn("_level", (total - full) / weight)
    # The first source that is not full at the level of those from it on sets the level for all;
    # to take later sources for full only lowers it.
    level = F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(everyone)
    target = F.least(room, F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return ranked.withColumn("target", target).drop("_ratio", "_level")


def weighed(sizes: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """Weights by the code point order of the sources, null last, repeating."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return sizes.withColumn("weight", F.element_at(cycle, F.pmod(place - 1, F.lit(len(weights))) + 1))


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``good``: the smallest x whose distribution
    function reaches u. Weights relative to the mean's run outward by ratios of neighbours."""
    total, good, drawn = (c.cast("double") for c in (total, good, drawn))
    low, high = F.greatest(F.lit(0.0), drawn + good - total), F.least(good, drawn)
    mean = F.when(total > 0, drawn * good / total).otherwise(0.0)
    spread = F.when(
        total > 1, F.sqrt(drawn * good / total * (total - good) / total * (total - drawn) / (total - 1))
    ).otherwise(0.0)
    start = F.least(F.greatest(F.floor(mean).cast("double"), low), high)
    first = F.greatest(low, start - F.ceil(REACH * spread + 10))
    last = F.least(high, start + F.ceil(REACH * spread + 10))

    def ratio(x: Column) -> Column:  # weight of x + 1 per weight of x
        return (good - x) * (drawn - x) / ((x + 1) * (total - good - drawn + x + 1))

    steps = lambda a, b: F.when(a < b, F.sequence(a.cast("long"), (b - 1).cast("long"))).otherwise(F.array().cast("array<long>"))
    one = lambda: F.struct(F.lit(1.0).alias("w"), F.array(F.lit(1.0)).alias("all"))
    grow = lambda a, w: F.struct(w.alias("w"), F.concat(a["all"], F.array(w)).alias("all"))
    up = F.aggregate(steps(start, last), one(), lambda a, x: grow(a, a["w"] * ratio(x.cast("double"))))["all"]
    down = F.aggregate(
        F.reverse(steps(first, start)), one(), lambda a, x: grow(a, a["w"] / ratio(x.cast("double")))
    )["all"]
    weights = F.concat(F.reverse(F.slice(down, F.lit(2), F.greatest(F.size(down) - 1, F.lit(0)))), up)
    need = u * F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
    below = F.aggregate(
        weights,
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n")),
        lambda a, w: F.struct((a["sum"] + w).alias("sum"), (a["n"] + (a["sum"] + w <= need).cast("long")).alias("n")),
    )["n"]
    return F.least(first + below, last).cast("long")


def quotas(draws: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(shard, source, quota) from (source, draws): the splitting tree, one level at a time.

    A level is a table of (node, shards, source, quota); the draw of a source depends on what the
    sources before it left, so the sources of a node stand in one array.
    """
    spec = F.struct("source", F.col("draws").alias("n"))
    order = lambda c: F.array_sort(F.collect_list(c))
    level = draws.agg(order(spec).alias("left")).select(
        F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("shards"), "left"
    )
    depth = max(0, (shards - 1).bit_length())
    for _ in range(depth):
        half = F.floor(F.col("shards") / 2)
        total = F.aggregate("left", F.lit(0).cast("long"), lambda a, s: a + s["n"])
        level = level.withColumns({"_half": half, "_total": total})
        level = level.withColumn("_take", F.floor(F.col("_total") * F.col("_half") / F.col("shards")))
        state = F.struct(
            F.col("_total").alias("total"), F.col("_take").alias("take"), F.array().cast("array<long>").alias("got")
        )

        def split(a: Column, s: Column) -> Column:
            u = unit(F.lit(seed), F.col("first"), F.col("shards"), s["source"], F.size(a["got"]))
            x = hypergeometric(a["total"], s["n"], a["take"], u)
            return F.struct(
                (a["total"] - s["n"]).alias("total"), (a["take"] - x).alias("take"), F.concat(a["got"], F.array(x)).alias("got")
            )

        level = level.withColumn("_got", F.aggregate("left", state, split)["got"])
        part = lambda n: F.zip_with("left", "_got", lambda s, x: F.struct(s["source"].alias("source"), n(s, x).alias("n")))
        lower = F.struct(F.col("first"), F.col("_half").alias("shards"), part(lambda s, x: x).alias("left"))
        upper = F.struct(
            (F.col("first") + F.col("_half")).alias("first"),
            (F.col("shards") - F.col("_half")).alias("shards"),
            part(lambda s, x: s["n"] - x).alias("left"),
        )
        children = F.when(F.col("shards") > 1, F.array(lower, upper)).otherwise(
            F.array(F.struct("first", "shards", "left"))
        )
        # A written table between levels: the expression of one level would hold those of all above it.
        level = staged(level.select(F.explode(children).alias("c")).select("c.*"), "tree")
    return level.select(F.col("first").alias("shard"), F.explode("left").alias("s")).select(
        "shard", F.col("s.source").alias("source"), F.col("s.n").alias("quota")
    )


def _cumulated(frame: DataFrame, value: str, by: Window) -> Column:
    return F.coalesce(F.sum(value).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def allocation(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, text_hash, size, source_size, target, copies.

    copies is an array of (pass, shard, words): what the mix takes of the document.
    """
    own = docs.select("doc_id", "source", F.xxhash64(text_of()).alias("text_hash"), n_words().alias("size"))
    own = staged(own, "sizes")
    totals = own.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(weighed(totals, weights), share, most).withColumns(
        {
            "blocks": F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)),
            "passes": F.when(
                F.col("source_size") > 0, F.floor(F.round(F.col("target")) / F.col("source_size"))
            ).otherwise(0),
            "words": F.round(F.col("target")).cast("long"),
        }
    )
    plan = staged(plan.withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size")), "sources")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    place = plan.select("source", "blocks", "rest")
    placed = own.join(place, same(own, place)).select(
        own["*"], "rest", F.pmod(F.xxhash64(F.lit(seed), own["doc_id"], "text_hash"), F.col("blocks")).alias("block")
    )
    # The order of the blocks, and where each starts in words. Every block is there, also an empty one.
    every = plan.select("source", "rest", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    filled = placed.groupBy("source", "block").agg(F.sum("size").alias("block_words"))
    blocks = every.join(filled, same(every, filled) & (every["block"] == filled["block"]), "left").select(
        every["*"], F.coalesce("block_words", F.lit(0)).alias("block_words")
    )
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 1), "source", "block"), "block")
    blocks = blocks.withColumns(
        {"rank": (F.row_number().over(order) - 1).cast("long"), "start": _cumulated(blocks, "block_words", order)}
    )
    blocks = staged(blocks, "blocks")

    # Each pass draws its blocks in order; a source's draws are numbered over all passes.
    some = blocks.where("start < rest").groupBy("source").agg(F.count("*").alias("some"))
    drawn = plan.join(some, same(plan, some), "left").select(
        plan["source"], "blocks", "passes", (F.col("passes") * F.col("blocks") + F.coalesce("some", F.lit(0))).alias("draws")
    )
    total = plan.agg(F.sum("words")).first()[0] or 0
    shards = max(1, -(-int(total) // shard_words))
    shared = quotas(drawn.where("draws > 0").select("source", "draws"), shards, seed)
    upto = Window.partitionBy("source").orderBy("shard")
    spans = shared.withColumn("from", _cumulated(shared, "quota", upto)).where("quota > 0")
    spans = spans.select("source", "shard", F.explode(F.expr("sequence(`from`, `from` + quota - 1)")).alias("draw"))
    turns = F.struct(F.floor(F.col("draw") / F.col("blocks")).alias("pass"), "shard")
    spans = spans.join(drawn, same(spans, drawn)).select(
        spans["source"], F.pmod("draw", F.col("blocks")).alias("rank"), "passes", turns.alias("turn")
    )
    spans = spans.groupBy("source", "rank", "passes").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    given = blocks.join(spans, same(blocks, spans) & (blocks["rank"] == spans["rank"]), "left").select(
        blocks["source"], "block", "block_words", "start", "passes", "turns"
    )

    # Only the block in which the rest ends is looked at document by document.
    joined = placed.join(given, same(placed, given) & (placed["block"] == given["block"]), "left").select(
        placed["*"], "block_words", "start", "passes", "turns"
    )
    end = F.col("rest") - F.col("start")
    ends_here = (end > 0) & (end < F.col("block_words"))
    within = Window.partitionBy("source", "block").orderBy(
        F.xxhash64(F.lit(seed + 2), "doc_id", "text_hash"), "doc_id", "text_hash"
    )
    cut = joined.where(ends_here).withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), end - _cumulated(joined, "size", within))))
    whole = joined.where(~ends_here | ends_here.isNull()).withColumn("part", F.when(end > 0, F.col("size")).otherwise(0))
    taken = cut.unionByName(whole)
    words = lambda t: F.when(t["pass"] < F.col("passes"), F.col("size")).otherwise(F.col("part"))
    copies = F.transform(
        "turns", lambda t: F.struct(t["pass"].alias("pass"), t["shard"].alias("shard"), words(t).alias("words"))
    )
    none = F.array().cast("array<struct<pass:bigint,shard:bigint,words:bigint>>")
    taken = taken.withColumn("copies", F.coalesce(F.filter(copies, lambda c: c["words"] > 0), none))
    known = plan.select("source", "source_size", "target")
    return taken.join(known, same(taken, known)).select(
        "doc_id", taken["source"], "text_hash", "size", "source_size", "target", "copies"
    )


def digest(allocated: DataFrame) -> DataFrame:
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return allocated.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs`` for every copy, and mix_shard, mix_position, mix_pass, mix_words.

    The position is the place within the shard, after its shuffle. A document of which only the
    first mix_words words are taken keeps its whole text. Rows equal in id, source and text share
    their copies evenly, each row its own.
    """
    seed = options.get("seed", SEED)
    chosen = allocation(docs, **options).where(F.size("copies") > 0)
    # One key for id, source and text, so that the join's partitioning serves the window after it.
    key = F.xxhash64("doc_id", "source", "text_hash").alias("_key")
    names = ("doc_id", "source", "text_hash")
    chosen = chosen.select(key, F.struct(*names).alias("_of"), "copies").groupBy("_key", "_of")
    chosen = chosen.agg(F.sort_array(F.collect_list("copies")).alias("_lists"))
    rows = packed(docs, "doc_id", "source", F.xxhash64(text_of()).alias("text_hash"))
    joined = rows.withColumn("_key", key).join(chosen, "_key")
    # Rows that repeat id, source and text take their lists in turn.
    twins = Window.partitionBy("_key", *names).orderBy("_key")
    own = F.when(F.struct(*names).eqNullSafe(F.col("_of")), F.try_element_at("_lists", F.row_number().over(twins)))
    dealt = joined.withColumn("_own", own).select("_doc", "doc_id", "text_hash", F.explode("_own").alias("_copy"))
    shuffled = Window.partitionBy(F.col("_copy.shard")).orderBy(
        F.xxhash64(F.lit(seed + 3), "doc_id", "text_hash", F.col("_copy.pass")), "doc_id", "text_hash", F.col("_copy.pass")
    )
    return dealt.select(
        *unpacked(docs),
        F.col("_copy.shard").alias("mix_shard"),
        F.row_number().over(shuffled).alias("mix_position"),
        F.col("_copy.pass").alias("mix_pass"),
        F.col("_copy.words").alias("mix_words"),
    )
