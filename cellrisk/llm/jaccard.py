"""Exact Jaccard join of word-shingle sets by pivots, Voronoi regions and triangle-inequality windows."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import bounded_batches, free_shuffles, narrowed, release, spare, store, utf8
from cellrisk.llm.components import components
from cellrisk.llm.hashing import shingles

WORDS = 5
#: Documents link from this share of common shingles on, in hundredths.
SIMILAR = 75
#: Frequent shingles go last in the order of pivots. They are known by 2^23 bits, set by at most 2^19 shingles; which ones
#: they are decides how large regions get, never which documents link.
BITS = 23
FREQUENT = 1 << 19
RUN = 1 << 22
#: Parity bits of a set, unless its size decides: those of two sets differ in at most as many bits as the sets differ in shingles.
PARITY = 2048
#: Rounds in which a region's pivot is a document; what is then left of a region is compared pair by pair.
ROUNDS = 3
#: Members of a ball, about, that a set beyond it is compared with at first; with the others only if that connects it nowhere.
TRIES = 8
#: Sets that are compared with one set in one task.
BLOCK = 256


def sets_of(values: list[bytes | None], size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z are lower-cased, other bytes stay."""
    return [shingles(v.lower(), size) if v else np.zeros(0, np.uint64) for v in values]


def fingerprint(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def home_pivots(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The one-shingle pivots in whose regions a set has to stand, nearest first.

    A set x lies at distance 1 - 1/|x| from {s} for each s in x, and at 1 from all others: its shingles are its nearest
    pivots, ties broken by one order for all (frequent ones last, then by hash). A set that lacks the first k of them lies
    at k/|x| or more from x. So two sets within the distance share a pivot among the first (1 - t)|x| + 1 of each, and
    x stands in just these regions.
    """
    late = (frequent[found >> np.uint64(67 - BITS)] >> (found >> np.uint64(64 - BITS) & np.uint64(7)).astype(np.uint8)) & 1
    few = len(found) - -(-SIMILAR * len(found) // 100) + 1
    order = np.argsort(late, kind="stable")[:few]
    return found[order]


def parity(found: np.ndarray, bits: int = PARITY) -> np.ndarray:
    """Bit i: whether an odd number of the shingles falls on i. Half of the bits: one half XOR the other."""
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def parity_bits(n: int) -> int:
    """Bits for a set of n shingles: four to eight a shingle, so that unrelated sets differ in most of what they may."""
    return max(256, 1 << (4 * n - 1).bit_length())


def _survey(docs: DataFrame) -> DataFrame:
    """Per row its set's size and fingerprint; and, marked by a null size, how often shingles occurred in runs of texts.

    Runs hold about `RUN` shingles; what occurs twice in a run or less often is not told.
    """

    def survey(batches):
        pending, held = [], 0

        def counts():
            found, n = np.unique(np.concatenate(pending), return_counts=True)
            found, n = found[n > 2], n[n > 2]
            none = pa.nulls(len(n), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, pa.nulls(len(n), pa.binary()), pa.array(found.view(np.int64)), pa.array(n)], names)

        names = ["doc_id", "n", "fp", "shingle", "times"]
        for batch in batches:
            found = sets_of(batch.column("_bytes").to_pylist())
            none = pa.nulls(len(found), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in found], pa.int64()), pa.array([fingerprint(x) for x in found], pa.binary()), none, none], names
            )
            pending += found
            held += sum(map(len, found))
            if held > RUN:
                yield counts()
                pending, held = [], 0
        if pending:
            yield counts()

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), utf8().alias("_bytes")).mapInArrow(survey, "doc_id long, n long, fp binary, shingle long, times long")


def _frequent(survey: DataFrame) -> np.ndarray:
    top = survey.where("n is null").groupBy("shingle").agg(F.sum("times").alias("times")).where("times >= 32")
    top = top.orderBy(F.desc("times"), "shingle").limit(FREQUENT).select("shingle").toPandas()["shingle"].to_numpy(dtype=np.int64)
    at = np.unique(top.view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int64)
    bits = np.zeros(1 << (BITS - 3), dtype=np.uint8)
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bits


def _representatives(docs: DataFrame, frequent) -> DataFrame:
    """One row per distinct set: a doc_id that has it, size, fingerprint, pivots, how many of them are not frequent, parity bits."""

    def pivots(batches):
        bits = frequent.value
        for batch in batches:
            found = [x for x in sets_of(batch.column("_bytes").to_pylist())]
            some = [i for i, x in enumerate(found) if len(x)]
            rows = [home_pivots(found[i], bits) for i in some]
            rare = [int((~((bits[r >> np.uint64(67 - BITS)] >> (r >> np.uint64(64 - BITS) & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)).sum()) for r in rows]
            cuts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            flat = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
            odd = pa.array([parity(found[i], parity_bits(len(found[i]))) for i in some], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(some, pa.int64())), pa.array([len(found[i]) for i in some], pa.int32()),
                 pa.array([fingerprint(found[i]) for i in some], pa.binary()), pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat)), pa.array(rare, pa.int32()), odd],
                ["doc_id", "n", "fp", "pivots", "rare", "parity"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), utf8().alias("_bytes")).mapInArrow(pivots, "doc_id long, n int, fp binary, pivots array<long>, rare int, parity array<long>")
    same = [F.first(c).alias(c) for c in ("n", "pivots", "rare", "parity")]
    one = rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), *same)
    return one.withColumn("rid", F.monotonically_increasing_id())


def _runs(batches):
    """Rows sorted by (u, rid): those of runs of two or more, each with its run's first rid as pivot.

    The last row waits for the next batch. Closed runs of two sets that cannot reach the similarity, by their sizes and
    by what they have from the shingle on, are dropped; the bound holds at the first shingle that two sets share.
    """
    held = None  # u, rid, meta, pivot and whether its run has rows before it
    names = ["u", "rid", "n", "at", "pivot"]

    def told(u, r, m, p):
        kind = pa.int32()
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(r), pa.array((m >> 32).astype(np.int32), kind), pa.array((m & 0xFFFFFFFF).astype(np.int32), kind), pa.array(p)], names)

    for batch in batches:
        u, r, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("u", "rid", "meta"))
        if not len(u):
            continue
        before = held is not None and held[4]
        if held is not None:
            u, r, m = (np.concatenate([[x], y]) for x, y in zip(held, (u, r, m)))
        first = np.ones(len(u), dtype=bool)
        first[1:] = u[1:] != u[:-1]
        begin, run = np.flatnonzero(first), np.cumsum(first) - 1
        size = np.diff(np.append(begin, len(u)))
        pivot = r[begin][run]
        keep = size[run] > 1
        if before:
            pivot[run == 0], keep[run == 0] = held[3], True
        two = np.flatnonzero(size[:-1] == 2)
        two = two[two > 0] if before else two
        a, b = begin[two], begin[two] + 1
        na, nb = m[a] >> 32, m[b] >> 32
        rest = np.minimum(na - (m[a] & 0xFFFFFFFF), nb - (m[b] & 0xFFFFFFFF))
        fits = (100 * np.minimum(na, nb) >= SIMILAR * np.maximum(na, nb)) & ((100 + SIMILAR) * rest >= SIMILAR * (na + nb))
        keep[a[~fits]] = keep[b[~fits]] = False
        held = (u[-1], r[-1], m[-1], pivot[-1], bool(keep[-1]))
        at = np.flatnonzero(keep[:-1])
        yield told(u[at], r[at], m[at], pivot[at])
    if held is not None and held[4]:
        yield told(*(np.array([x]) for x in held[:4]))


def _regions(reps: DataFrame) -> DataFrame:
    """(u, rid, n, at, pivot): members of regions with two or more sets; the smallest rid is the region's pivot.

    Regions of frequent shingles, which may hold any share of all sets, get theirs from an aggregate that is joined back;
    the many small ones in one pass over sorted rows.
    """
    rows = reps.select("rid", "n", "rare", F.posexplode("pivots").alias("at", "u"))
    few = rows.where("at < rare").select("u", "rid", (F.col("n").cast("long") * F.lit(1 << 32) + F.col("at")).alias("meta"))
    bounded_batches(reps.sparkSession, rows=100_000)
    small = few.repartition("u").sortWithinPartitions("u", "rid").mapInArrow(_runs, "u long, rid long, n int, at int, pivot long")
    many = rows.where("at >= rare").select("u", "rid", "n", "at")
    pivots = many.groupBy("u").agg(F.count("*").alias("_n"), F.min("rid").alias("pivot")).where("_n > 1").drop("_n")
    return small.unionByName(many.join(pivots, "u"))


def _within(pairs: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) that may have `least` hundredths of their shingles in common, by sizes and parity bits.

    The bound is exact: sets that are that similar differ in at most (100 - least) / (100 + least) of the sum of their
    sizes, and their parity bits in no more. Of sizes that pass one is at most twice the other, and so are the numbers of
    their bits: the longer array is folded once. What is dropped here need not have its sets fetched.
    """
    side = lambda c: reps.select(F.col("rid").alias(c), F.col("n").cast("long").alias(f"_n{c}"), F.col("parity").alias(f"_p{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    short = F.least(F.size("_pa"), F.size("_pb"))
    half = lambda p: F.zip_with(F.slice(p, 1, short), F.slice(p, short + 1, short), lambda x, y: x.bitwiseXOR(y))
    fold = lambda p: F.when(F.size(p) == short, F.col(p)).otherwise(half(p))
    differ = F.aggregate(F.zip_with(fold("_pa"), fold("_pb"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)
    sizes = F.least("_na", "_nb") * 100 >= F.greatest("_na", "_nb") * least
    return both.where(sizes).where(differ * (100 + least) <= (F.col("_na") + F.col("_nb")) * (100 - least)).select("a", "b")


def _measured(pairs: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b, common, whole): sizes of intersection and union of each pair's sets.

    Pairs are dealt in blocks of one b and about `BLOCK` of its a. Only sets that stand in a pair leave their text: that of
    b once per block, that of a once per pair, and each block meets in one task, b first. Texts that no pair asks for are
    left out before texts and ids meet (`narrowed`), so what is shuffled follows the pairs, not the corpus.
    """
    spark = docs.sparkSession
    blocks = pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK).alias("_of"))
    cut = pairs.join(blocks, "b").select("a", "b", F.pmod(F.xxhash64("a"), "_of").cast("int").alias("block"))
    asked = cut.select("b", "block", F.lit(1).alias("side"), F.col("a").alias("rid"))
    asked = asked.unionByName(cut.select("b", "block", F.lit(0).alias("side"), F.col("b").alias("rid")).distinct())
    asked = store(asked.join(reps.select("rid", "doc_id", "fp"), "rid"), "asked")
    count = asked.count()
    if not count:
        return spark.createDataFrame([], "a long, b long, common long, whole long")
    keys = ["b", "block", "side", "rid"]

    def members(batches):
        value, found, mark = None, None, None
        for batch in batches:
            same, sets = [], []
            for i, (text, fp) in enumerate(zip(batch.column("_bytes").to_pylist(), batch.column("fp").to_pylist())):
                if found is None or text != value:
                    value, found = text, sets_of([text])[0]
                    mark = fingerprint(found)
                if mark == fp:
                    same.append(i)
                    sets.append(found.view(np.int64))
            some = pa.array(same, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(some) for k in keys), pa.array(sets, pa.list_(pa.int64()))], [*keys, "members"])

    def measure(batches):
        block, last, pivot = None, None, None
        for batch in batches:
            b, part, side, rid = (batch.column(k).to_numpy(zero_copy_only=False) for k in keys)
            sets, out = batch.column("members"), []
            for i in range(batch.num_rows):
                found = sets[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                if side[i] == 0:
                    block, pivot = (b[i], part[i]), found
                elif (b[i], part[i], rid[i]) != last and block == (b[i], part[i]):
                    last = (b[i], part[i], rid[i])
                    common = len(np.intersect1d(pivot, found, assume_unique=True))
                    out.append((rid[i], b[i], common, len(pivot) + len(found) - common))
            columns = np.array(out, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(columns[:, k]) for k in range(4)], ["a", "b", "common", "whole"])

    bounded_batches(spark)
    text = docs.select(F.col("doc_id").cast("long").alias("_id"), utf8().alias("_bytes"))
    text = narrowed(text, "_id", asked, "doc_id", count)
    rows = text.join(asked, F.col("_id").eqNullSafe(F.col("doc_id"))).select("_bytes", "fp", *keys)
    sets = rows.mapInArrow(members, "b long, block int, side int, rid long, members array<long>")
    return sets.repartition("b", "block").sortWithinPartitions(*keys).mapInArrow(measure, "a long, b long, common long, whole long")


def _linked() -> Column:
    return F.col("common") * 100 >= F.col("whole") * SIMILAR


def _possible(x: str, y: str) -> Column:
    """Whether rows x and y of a region may be similar, by their sizes and by what they have from the shingle on."""
    col = lambda t, c: F.col(f"{t}.{c}").cast("long")
    least, most = F.least(col(x, "n"), col(y, "n")), F.greatest(col(x, "n"), col(y, "n"))
    rest = F.least(col(x, "n") - col(x, "at"), col(y, "n") - col(y, "at"))
    return (least * 100 >= most * SIMILAR) & (rest * (100 + SIMILAR) >= (col(x, "n") + col(y, "n")) * SIMILAR)


def _near(outside: DataFrame, balls: DataFrame) -> DataFrame:
    """Pairs (a, b) of a member of a ball and a set beyond it that may be similar by their distances to the ball's pivot."""
    window = F.expr("4 * (x.common * y.whole - y.common * x.whole) <= x.whole * y.whole")
    same = F.expr("x.u = y.u and x.pivot = y.pivot")
    near = outside.alias("y").join(balls.alias("x"), same).where(window & _possible("x", "y"))
    return near.select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b")).distinct()


def _some(balls: DataFrame) -> DataFrame:
    """About `TRIES` members of each ball, others in each region that a ball stands in; small balls stay whole."""
    sizes = balls.groupBy("u").agg(F.expr(f"shiftleft(1L, int(greatest(0, ceil(log2(count(*) / {TRIES})))))").alias("_of"))
    return balls.join(sizes, "u").where("pmod(xxhash64(rid, u), _of) = 0").drop("_of")


def _star_links(docs: DataFrame, reps: DataFrame, rows: DataFrame) -> list[DataFrame]:
    """Links (a, b) between representatives by their regions `rows`: enough to connect all similar ones, not every similar pair.

    Within a region the pivot is a document p. Members within the distance t = 0.25 of p link to it: its ball. A member y
    beyond it can be similar to some x of the ball only if d(y, p) - d(x, p) <= t (triangle inequality), so only those
    up to 2t away are compared with the ball, and only within that window: at first with some of the ball. What lies
    outside the ball is joined among itself in the next round, with a new pivot. Distances of more than 2t are not needed,
    so pairs that sizes or parity bits show to be that far apart are not measured. After the rounds the sets that are still
    not connected with the pivot of a ball are compared with all of it, and what no ball took is compared pair by pair.
    """
    spark = docs.sparkSession
    free_shuffles(spark)
    found: list[DataFrame] = []
    rounds: list[DataFrame] = []
    outside = F.expr("2 * common >= whole") & ~_linked()
    for _ in range(ROUNDS):
        star = rows.where("rid != pivot").select(F.col("rid").alias("a"), F.col("pivot").alias("b")).distinct()
        star = store(_within(star, reps, 2 * SIMILAR - 100), "stars")
        known = store(_measured(star, docs, reps), "stars")
        free_shuffles(spark)
        found.append(known.where(_linked()).select("a", "b"))
        far = known.select(F.col("a").alias("rid"), F.col("b").alias("pivot"), "common", "whole")
        placed = rows.where("rid != pivot").join(far, ["rid", "pivot"], "left").fillna({"common": 0, "whole": 1})
        placed = store(placed, "regions")
        rounds.append(placed.where("2 * common >= whole"))
        some = _near(placed.where(outside), _some(placed.where(_linked())))
        edge = store(_within(some, reps, SIMILAR), "edges")
        found.append(store(_measured(edge, docs, reps).where(_linked()).select("a", "b"), "edges"))
        beyond = placed.where(~_linked())
        again = beyond.groupBy("u").agg(F.count("*").alias("_n"), F.min("rid").alias("_new")).where("_n > 1")
        after = store(beyond.join(again, "u").select("u", "rid", "n", "at", F.col("_new").alias("pivot")), "regions")
        release(rows)
        free_shuffles(spark)
        rows = after
        if rows.isEmpty():
            break
    roots = components(_union(found))
    root = lambda node, name: roots.select(F.col("node").alias(node), F.col("root").alias(name))
    placed = _union(rounds)
    apart = placed.where(outside).join(root("rid", "_r"), "rid", "left").join(root("pivot", "_p"), "pivot", "left")
    apart = apart.where("coalesce(_r, rid) != coalesce(_p, pivot)").drop("_r", "_p")
    left = rows.join(root("rid", "_r"), "rid", "left").withColumn("_r", F.coalesce("_r", "rid"))
    left = left.alias("x").join(left.alias("y"), "u").where("x.rid < y.rid and x._r != y._r").where(_possible("x", "y"))
    last = left.select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b")).unionByName(_near(apart, placed.where(_linked())))
    edge = store(_within(last.distinct(), reps, SIMILAR), "edges")
    found.append(store(_measured(edge, docs, reps).where(_linked()).select("a", "b"), "edges"))
    for frame in (*rounds, rows):
        release(frame)
    return found


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of `docs`, by whole texts and exact similarity.

    A set holds the distinct five-word shingles; with fewer words, all words as one; a null or blank text has none and
    links with nothing. Rows with equal sets are one representative. component_id is the smallest doc_id that links
    reach, the row's own included; a row without an id takes part and shows the smallest id of its group, or null.
    """
    survey = store(_survey(docs), "survey")
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(survey))
    pivots = store(_representatives(docs, frequent), "representatives")
    regions = store(_regions(pivots), "regions")
    reps = store(pivots.drop("pivots", "rare"), "representatives")
    release(pivots)
    roots = components(_union(_star_links(docs, reps, regions)))
    rows = survey.where("n is not null").select("doc_id", F.col("n").alias("n_shingles"), "fp")
    groups = reps.select("fp", "rid").join(roots.withColumnRenamed("node", "rid"), "rid", "left")
    groups = groups.select("fp", F.coalesce("root", "rid").alias("_group"))
    known = store(rows.where("n_shingles > 0").join(groups, "fp").select("doc_id", "n_shingles", "_group"), "groups")
    least = known.groupBy("_group").agg(F.min("doc_id").alias("component_id"))
    out = known.join(least, "_group").select("doc_id", "n_shingles", "component_id")
    return out.unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest doc_id; rows that repeat it count as copies too.

    Rows without an id or without words stay as they are.
    """
    groups = near_groups(docs)
    (key,) = spare(docs, "_id")
    keep = groups.where("doc_id is not null").select(F.col("doc_id").alias(key), "n_shingles", "component_id")
    keep = keep.groupBy(key).agg(F.max("n_shingles").alias("_n"), F.min("component_id").alias("_c"))
    keep = keep.where((F.col("_n") == 0) | (F.col("_c") == F.col(key))).select(key)
    with_id = docs.where("doc_id is not null").join(keep, F.col("doc_id").cast("long") == F.col(key)).drop(key)
    first = with_id.dropDuplicates(["doc_id"])
    return first.unionByName(docs.where("doc_id is null"))
