"""Exact top-k by Hamming distance over 64-bit codes: incremental multi-index hashing."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellrisk.llm.common import bounded_batches, release, store

BITS = 64
#: Queries of one row of the probe table; more queries that probe the same bucket are dealt to more rows.
TOGETHER = 4096
#: Rows that a task keeps before it hands them on.
HELD = 2_000_000


def sign_code(vector: str = "embedding") -> Column:
    """64-bit code of a vector: bit i is set if component i is positive; components from 64 on are folded in by xor.

    Null for vectors that are null or empty or hold a null or non-finite component.
    """
    numbers = F.col(vector).cast("array<double>")
    sound = (F.size(numbers) > 0) & F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bits = F.expr(f"aggregate(transform(`{vector}`, (x, i) -> if(x > 0, shiftleft(1L, i % {BITS}), 0L)), 0L, (a, b) -> a ^ b)")
    return F.when(F.coalesce(sound, F.lit(False)), bits)


def segments(count: int) -> list[tuple[int, int]]:
    """(first bit, width) of about 64 / log2(count / 4) segments: a bucket then holds four codes or so by chance.

    Narrower segments are more in number, so a smaller radius covers the same distance, with far fewer buckets to probe.
    """
    width = min(20, max(4, int(np.log2(max(count, 2)) - 1.5)))
    n = -(-BITS // width)
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]


def _segment(code: str, first: int, width: int) -> Column:
    return F.shiftrightunsigned(F.col(code), first).bitwiseAND(F.lit((1 << width) - 1))


def _segmented(df: DataFrame, code: str, parts: list[tuple[int, int]]) -> DataFrame:
    """Rows (s, width, value) for each segment of `code`."""
    each = F.array(*[F.struct(F.lit(i).alias("s"), F.lit(w).alias("width"), _segment(code, a, w).alias("value")) for i, (a, w) in enumerate(parts)])
    return df.withColumn("_s", F.explode(each)).select(*df.columns, "_s.*")


def _closest(q: np.ndarray, d: np.ndarray, code: np.ndarray, low: np.ndarray, k: int) -> list[np.ndarray]:
    """The k nearest codes of each query, each code once."""
    order = np.lexsort((low, d, q))
    q, d, code, low = q[order], d[order], code[order], low[order]
    # A code met in several segments counts once, else it would push others out of the k.
    new = np.append(True, (q[1:] != q[:-1]) | (low[1:] != low[:-1])) if len(q) else np.zeros(0, bool)
    q, d, code, low = q[new], d[new], code[new], low[new]
    first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return [x[rank < k] for x in (q, d, code, low)]


def _nearest(k: int):
    """Keeps, of all codes met in a task, the k nearest of each query, if no farther than the query's k-th so far: (q, d, code, low).

    What is kept is cut back whenever it has doubled; beyond `HELD` rows it is handed on, so the memory of a task is bounded.
    """

    def run(batches):
        held, waiting, size, limit = None, [], 0, 1 << 16

        def cut():
            parts = [*([held] if held else []), *waiting]
            return _closest(*(np.concatenate([p[i] for p in parts]) for i in range(4)), k) if parts else None

        batch_of = lambda kept: pa.RecordBatch.from_arrays([pa.array(x) for x in kept], ["q", "d", "code", "low"])
        for batch in batches:
            lists = batch.column("queries")
            each, n = lists.flatten(), np.diff(lists.offsets.to_numpy())
            q, farthest = each.field("q").to_numpy(), each.field("kth").to_numpy()
            code = np.repeat(batch.column("code").to_numpy(), n)
            low = np.repeat(batch.column("low").to_numpy(), n)
            d = np.bitwise_count((q ^ code).view(np.uint64)).astype(np.int32)
            near = d <= farthest
            waiting.append([x[near] for x in (q, d, code, low)])
            size += int(near.sum())
            if size >= limit:
                held, waiting, size = cut(), [], 0
                if len(held[0]) >= HELD:
                    yield batch_of(held)
                    held = None
                limit = max(1 << 16, len(held[0]) if held else 0)
        held = cut()
        if held is not None:
            yield batch_of(held)

    return run


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, id, distance): the k rows of `codes` nearest to each row of `queries`, itself left out.

    Both have `id` and `code`. Equal distances go to the smaller id; with fewer than k other rows, all come. Rows without
    an id or a code are neither found nor asked. A code is kept once with its smallest ids, so repeated ones cost nothing.

    Codes are cut into m segments. In round r each query probes, in every segment, the buckets at a distance of
    just r from its own. A code not met by then differs by more than r in each segment, by m (r + 1) or more in all:
    once the k-th verified distance is below that, a query is done. The others go on to the next radius.
    """
    spark = codes.sparkSession
    most = k + 1  # the query's own row may be among them
    known = codes.where("id is not null and code is not null").select("id", "code").distinct()
    by_id = W.partitionBy("code").orderBy("id")
    few = known.withColumn("_n", F.row_number().over(by_id)).where(F.col("_n") <= most)
    index = store(few.groupBy("code").agg(F.min("id").alias("low"), F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    asked = queries.where("id is not null and code is not null").select(F.col("id").alias("query_id"), F.col("code").alias("q")).distinct()
    active = store(asked.select("q").distinct().withColumn("kth", F.lit(BITS)), "queries")
    count, left = index.count(), active.count()
    parts = segments(count)
    table = _segmented(index.select("code", "low"), "code", parts).select("s", "value", "code", "low")
    salts = max(1, -(-left // TOGETHER))
    best, radius = None, 0
    while left:
        masks = [(w, sum(1 << i for i in bits)) for w in sorted({w for _, w in parts}) for bits in itertools.combinations(range(w), radius)]
        if not masks:
            break
        probes = _segmented(active, "q", parts).join(spark.createDataFrame(masks, "width int, mask long"), "width")
        probes = probes.withColumn("value", F.col("value").bitwiseXOR(F.col("mask"))).withColumn("salt", F.pmod(F.xxhash64("q"), F.lit(salts)))
        probes = probes.groupBy("s", "value", "salt").agg(F.collect_list(F.struct("q", "kth")).alias("queries"))
        bounded_batches(spark, rows=2000)
        met = table.join(probes, ["s", "value"]).select("code", "low", "queries")
        met = met.mapInArrow(_nearest(most), "q long, d int, code long, low long")
        if best is not None:
            met = met.unionByName(best)
        met = met.dropDuplicates(["q", "code"])
        nearest = met.withColumn("_n", F.row_number().over(W.partitionBy("q").orderBy("d", "low"))).where(F.col("_n") <= most).drop("_n")
        after = store(nearest, "nearest")
        if best is not None:
            release(best)
        best = after
        covered = len(parts) * (radius + 1) - 1
        sizes = best.join(index.select("code", F.size("ids").alias("_ids")), "code")
        sure = sizes.where(F.col("d") <= covered).groupBy("q").agg(F.sum("_ids").alias("_sure")).where(F.col("_sure") >= most)
        # Of a query with enough codes, only those no farther than its last one can still come in.
        full = best.groupBy("q").agg(F.when(F.count("*") >= most, F.max("d")).alias("_kth"))
        open_ = active.join(sure, "q", "left_anti").join(full, "q", "left").select("q", F.coalesce("_kth", F.lit(BITS)).alias("kth"))
        more = store(open_, "queries")
        release(active)
        active, radius, left = more, radius + 1, more.count()
    if best is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, distance int")
    found = best.join(index.select("code", "ids"), "code").select("q", "d", F.explode("ids").alias("id"))
    rows = asked.join(found, "q").where("id != query_id")
    ranked = rows.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("d", "id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", F.col("d").alias("distance"))
