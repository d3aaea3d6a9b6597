"""Mixing sources to target weights by a golden-ratio schedule over shuffled equal-token blocks. DataFrame only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellrisk.llm.common import WORD, spare, store, table

#: Fractional part of the golden ratio, times 2^32: slot i lies at frac(i * ratio), in whole numbers.
GOLDEN = 2654435769
CHUNK = 4096
KEY_BITS = 60
#: Sources whose target is below this many blocks take their target to the word: slots are too coarse for them.
FEW = 64


def word_count(col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")


def running_sum(df: DataFrame, group: str, order: list[str], value: str, out: str, rows: int) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows before this one in its group, by `order`.

    `order[0]` must be an evenly spread hash of `KEY_BITS` bits: its top bits cut a group into parts of about `CHUNK` rows, each
    summed on its own; the sums of parts are summed in the same way a level up. No group meets in one task.
    """
    bits = max(0, (max(rows, 1) // CHUNK).bit_length())
    part = F.shiftright(F.col(order[0]), KEY_BITS - bits)
    df = df.withColumn("_part", part)
    inside = W.partitionBy(group, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inner = df.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0).cast("long")))
    totals = df.groupBy(group, "_part").agg(F.sum(value).alias("_sum"))
    if bits > 12:
        spread = (F.col("_part") * F.lit(1 << (KEY_BITS - bits))).alias("_spread")
        before = running_sum(totals.withColumn("_spread", spread), group, ["_spread"], "_sum", "_before", 1 << bits)
    else:
        upto = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
        before = totals.withColumn("_before", F.coalesce(F.sum("_sum").over(upto), F.lit(0).cast("long")))
    before = before.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), "_before")
    joined = inner.join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn(out, F.col("_in") + F.col("_before")).drop("_part", "_in", "_before", "_g", "_p")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3) -> DataFrame:
    """(source, source_size, target): all words shared by weight, no source above `epochs` times its size.

    `sizes` has one row per source. Sources by code point, null last, take the weights in turn, those without words too. The excess of a
    capped source goes to the others by weight: each gets min(cap, weight * level). Sources sorted by
    cap / weight are capped up to the first whose fair share of what is left lies below its cap; running sums
    find it without a loop. Whole numbers up to the last division, so the result is the same in any order.
    """
    dec = lambda c: F.col(c).cast("decimal(38,0)")
    by_name = W.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name) - 1).where("source_size > 0")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = ranked.withColumn("_w", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("_cap", F.col("source_size") * epochs)
    order = W.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    every = W.partitionBy(F.lit(1))
    ranked = ranked.withColumn("_left", F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
    ranked = ranked.withColumn("_weights", F.sum("_w").over(after)).withColumn("_place", F.row_number().over(order))
    free = dec("_cap") * dec("_weights") > dec("_left") * dec("_w")
    level = F.min(F.when(free, F.struct("_place", "_left", "_weights"))).over(every)
    ranked = ranked.withColumn("_level", level)
    share = (F.col("_w") * F.col("_level._left")).cast("double") / F.col("_level._weights").cast("double")
    capped = F.col("_level").isNull() | (F.col("_place") < F.col("_level._place"))
    ranked = ranked.withColumn("target", F.when(capped, F.col("_cap").cast("double")).otherwise(share))
    none = sizes.where("source_size <= 0").select("source", "source_size", F.lit(0.0).alias("target"))
    return ranked.select("source", "source_size", "target").unionByName(none)


def schedule(goals: DataFrame, total: int, block: int, epochs: int = 3) -> DataFrame:
    """(slot, source, rank): slot i falls to the source whose stretch of the cumulative targets holds frac(i * ratio).

    rank counts the source's slots before it. Slots and stretches meet on 4,096 cells of [0, 1), so neither side
    is broadcast nor compared in full. Ranks are counted in runs of slots and carried over from run to run.
    Slots beyond a source's `epochs` passes (less than one block per source) stay empty.
    """
    by_name = W.orderBy(F.col("source").isNull(), F.col("source"))
    every = W.partitionBy(F.lit(1))
    cuts = goals.where("target > 0").withColumn("_n", F.row_number().over(by_name))
    cuts = cuts.withColumn("_sum", F.sum("target").over(by_name.rowsBetween(W.unboundedPreceding, 0)))
    cuts = cuts.withColumn("_hi", F.col("_sum") / F.max("_sum").over(every))
    cuts = cuts.withColumn("_lo", F.coalesce(F.lag("_hi").over(W.orderBy("_n")), F.lit(0.0)))
    cell = lambda c: F.least(F.floor(c * CHUNK), F.lit(CHUNK - 1))
    cuts = cuts.select(
        "source", "_lo", "_hi", F.ceil(F.col("source_size") * epochs / F.lit(block)).alias("_most"),
        F.explode(F.sequence(cell(F.col("_lo")), cell(F.col("_hi")))).alias("_cell"),
    )
    slots = goals.sparkSession.range(-(-total // block)).withColumnRenamed("id", "slot")
    point = ((F.col("slot") % F.lit(1 << 31)) * F.lit(GOLDEN) % F.lit(1 << 32)) / F.lit(float(1 << 32))
    slots = slots.withColumn("_u", point).withColumn("_cell", cell(F.col("_u")))
    dealt = slots.join(cuts, "_cell").where("_u >= _lo and _u < _hi")
    dealt = dealt.withColumn("_run", F.floor(F.col("slot") / (16 * CHUNK)))
    dealt = dealt.withColumn("_k", F.row_number().over(W.partitionBy("source", "_run").orderBy("slot")) - 1)
    upto = W.partitionBy("source").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    carried = dealt.groupBy("source", "_run").agg(F.count("*").alias("_n")).select(
        F.col("source").alias("_s"), F.col("_run").alias("_q"), F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_b")
    )
    dealt = dealt.join(carried, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_run") == F.col("_q")))
    return dealt.withColumn("rank", (F.col("_k") + F.col("_b")).cast("long")).where("rank < _most").select("slot", "source", "rank")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, slots: int = 1 << 17) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): how many of a document's words the mix takes.

    A source's documents, shuffled by a hash of doc_id, form a stream of words that is read up to `epochs` times and
    cut into blocks of equally many words; the block with a slot's rank fills the slot. The mix is as long as all
    documents, in about `slots` slots, so every source comes within a block or two of its target. Blocks grow with the
    corpus: a source with a target below `FEW` blocks may get no slot or one too many, so it takes its target, rounded to whole
    words, from its stream instead, the last block in part.
    A document without words (null or blank text) has size 0 and gives nothing; a null source is a source of its
    own; rows that repeat count each. No documents: no rows. Columns of other names play no part.
    """
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    sized = store(docs.select("doc_id", "source", word_count().alias("size"), key.alias("_key")), "mix")
    rows, total = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = max(1, -(-total // slots))
    goals = store(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs), "mix")
    filled = schedule(goals, total, block, epochs).select(F.col("source").alias("_fs"), F.col("rank").alias("_fr"))

    stream = running_sum(sized, "source", ["_key", "doc_id", "size"], "size", "_start", rows)
    known = goals.select(F.col("source").alias("_gs"), "source_size", "target")
    stream = stream.join(known, F.col("source").eqNullSafe(F.col("_gs"))).drop("_gs")
    begin = F.col("_start") + F.col("_pass") * F.col("source_size")
    pieces = stream.where("size > 0").withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    pieces = pieces.withColumn("_a", begin).withColumn("_z", F.col("_a") + F.col("size"))
    first, last = F.floor(F.col("_a") / block), F.floor((F.col("_z") - 1) / block)
    pieces = pieces.withColumn("_block", F.explode(F.sequence(first, last)))
    from_, to = F.greatest(F.col("_a"), F.col("_block") * block), F.least(F.col("_z"), (F.col("_block") + 1) * block)
    by_slots = F.when(F.col("_fr").isNull(), F.lit(0)).otherwise(to - from_)
    by_target = F.greatest(F.least(to, F.round("target").cast("long")) - from_, F.lit(0))
    words = F.when(F.col("target") < FEW * block, by_target).otherwise(by_slots)
    pieces = pieces.join(filled, F.col("source").eqNullSafe(F.col("_fs")) & (F.col("_block") == F.col("_fr")), "left")
    kept = ["doc_id", "source", "size", "source_size", "target", "_start"]
    taken = pieces.groupBy(*kept).agg(F.sum(words).cast("long").alias("taken"))
    empty = stream.where("size = 0").select(*kept, F.lit(0).cast("long").alias("taken"))
    return taken.unionByName(empty).drop("_start")


def repeated(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3) -> DataFrame:
    """The rows of `docs` as often as the mix reads them: 0 to `epochs` times, with the columns they came with.

    A document that a source's last pass reads in part is rounded to whole passes. A document without words adds nothing to
    a mix and stays once. Rows with equal doc_id, source and size share the mean of what is taken of them.
    """
    sizes = mix(docs, weights, epochs).groupBy("doc_id", "source", "size").agg(F.avg("taken").alias("_taken"))
    times = F.when(F.col("size") > 0, F.round(F.col("_taken") / F.col("size"))).otherwise(1).cast("int")
    key, home, size, often, turn = spare(docs, "_id", "_source", "_size", "_times", "_pass")
    known = store(
        sizes.select(F.col("doc_id").alias(key), F.col("source").alias(home), F.col("size").alias(size), times.alias(often)), "mix"
    )
    same = F.col("doc_id").eqNullSafe(F.col(key)) & F.col("source").eqNullSafe(F.col(home)) & (word_count() == F.col(size))
    rows = docs.join(known.where(F.col(often) > 0), same).withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(often))))
    return rows.select(*docs.columns)
