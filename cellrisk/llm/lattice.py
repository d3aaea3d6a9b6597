"""Near-duplicate vectors: random projections decoded to E8 lattice points, neighbouring points probed, cosine verified."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import bounded_batches, store
from cellrisk.llm.components import components

_U = np.uint64


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Twice the nearest E8 lattice point of each row of 8 (twice, so that half-integers are whole numbers).

    E8 is D8 and D8 shifted by one half; the nearest point of D8 is the rounded row, with the coordinate of the largest
    rounding error rounded the other way if the sum is odd.
    """

    def d8(x):
        near = np.rint(x)
        miss = x - near
        odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
        worst = np.abs(miss[odd]).argmax(axis=1)
        near[odd, worst] += np.where(miss[odd, worst] >= 0, 1, -1)
        return near

    whole, half = d8(y), d8(y - 0.5) + 0.5
    closer = ((y - half) ** 2).sum(axis=1) < ((y - whole) ** 2).sum(axis=1)
    return np.rint(2 * np.where(closer[:, None], half, whole)).astype(np.int64)


def shortest_vectors() -> np.ndarray:
    """Twice the 240 shortest vectors of E8: the steps to the cells that touch a cell most widely."""
    pairs = [v for v in itertools.product((-2, 0, 2), repeat=8) if sum(map(abs, v)) == 4]
    halves = [v for v in itertools.product((-1, 1), repeat=8) if v.count(-1) % 2 == 0]
    return np.array(pairs + halves, dtype=np.int64)


_STEPS = shortest_vectors()
#: Cells probed besides a vector's own, rows of one block, and vectors that share a cell by chance on average.
PROBES = 4
BLOCK = 512
CROWD = 8
#: Cells are made smaller freely down to this chance that a pair at the threshold meets in one table.
HIT = 0.05


def projection(table: int, dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, table, dims]).normal(size=(dims, 8))


def cells(unit: np.ndarray, table: int, scale: float, seed: int, probes: int = PROBES) -> np.ndarray:
    """Keys [row, 1 + probes]: the lattice point a row decodes to, then the neighbouring points it lies closest to."""
    return _keys(scale * unit @ projection(table, unit.shape[1], seed), table * 1000003 + unit.shape[1], probes)


def _keys(y: np.ndarray, start: int, probes: int = PROBES) -> np.ndarray:
    point = nearest_e8(y)
    gain = (y - point / 2) @ _STEPS.T
    near = np.argpartition(-gain, probes, axis=1)[:, :probes]
    points = np.concatenate([point[:, None, :], point[:, None, :] + _STEPS[near]], axis=1)
    key = np.full(points.shape[:2], start, dtype=_U)
    for k in range(8):
        key = (key ^ (points[:, :, k].astype(_U) * _U(0x9E3779B97F4A7C15))) * _U(0xFF51AFD7ED558CCD)
        key ^= key >> _U(32)
    return key.view(np.int64)


def hit_chance(scale: float, cosine: float, seed: int = 7, least: int = 2000, pairs: int = 20000, rounds: int = 50) -> float:
    """Chance that a pair of this cosine meets in one table, less two standard errors: 0 if next to none meets.

    A pair's two projections are normal and correlated by its cosine in each of 8 coordinates, whatever the dimensions, so
    pairs are drawn there, until `least` have met or `rounds` draws are made.
    """
    rng, met, drawn = np.random.default_rng(seed), 0, 0
    while met < least and drawn < rounds * pairs:
        a, b = rng.normal(size=(2, pairs, 8))
        one, two = _keys(scale * a, 0), _keys(scale * (cosine * a + np.sqrt(max(0.0, 1 - cosine**2)) * b), 0)
        met += int(((one == two[:, :1]).any(axis=1) | (two == one[:, :1]).any(axis=1)).sum())
        drawn += pairs
    return max(0.0, met - 2 * np.sqrt(met)) / drawn


def share_chance(scale: float, dims: int, seed: int = 7, trials: int = 2000) -> float:
    """Chance that two random vectors decode to one cell: counted, or by density where too few of the trials do.

    Cells of volume 1 against a normal density of deviation `scale` in 8 dimensions give (4 pi scale^2)^-4.
    """
    unit = np.random.default_rng(seed).normal(size=(trials, dims))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    same = np.unique(cells(unit, 0, scale, seed)[:, 0], return_counts=True)[1]
    shared = int((same * (same - 1)).sum())
    return shared / (trials * (trials - 1)) if shared >= 200 else (4 * np.pi * scale**2) ** -4.0


def plan(count: int, dims: int, cosine: float, recall: float, seed: int = 7, trials: int = 2000) -> tuple[float, int]:
    """(scale, tables): cells small enough for `CROWD` chance neighbours, tables enough for the recall at the threshold.

    Smaller cells need more tables. Once a pair at the threshold meets with a chance below `HIT`, cells shrink further only
    as long as that makes less work, tables times (`BLOCK` + neighbours); fuller cells are cut into blocks. The
    number of tables always follows from the chance that was measured.
    """
    best = None
    for scale in np.arange(0.4, 4.0, 0.1):
        hit = min(hit_chance(scale, cosine, seed), 0.999)
        if not hit:
            break
        crowd = count * share_chance(scale, dims, seed, trials)
        tables = max(2, int(np.ceil(np.log(1 - recall) / np.log(1 - hit))))
        work = tables * (BLOCK + crowd)
        if best and hit < HIT and work >= best[0]:
            break
        best = work, float(scale), tables
        if crowd <= CROWD:
            break
    if best is None:
        raise ValueError(f"pairs of cosine {cosine} do not meet in any cells")
    return best[1:]


def _units(values) -> np.ndarray:
    rows = np.asarray(values, dtype=np.float64)
    # By the largest component first, whose square neither vanishes nor overflows.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _by_length(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit rows) of the vectors of each length."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, at = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(sizes) - sizes
    return [(rows, _units(flat[at[rows][:, None] + np.arange(size)])) for size in np.unique(sizes) for rows in [np.flatnonzero(sizes == size)]]


def _visits(vectors: DataFrame, scale: float, tables: int, seed: int) -> DataFrame:
    """(key, home, rid): the cell of each vector in each table, and the cells it probes."""

    def visit(batches):
        for batch in batches:
            rid = batch.column("rid").to_numpy()
            for rows, unit in _by_length(batch.column("embedding")):
                for table in range(tables):
                    key = cells(unit, table, scale, seed)
                    home = np.zeros(key.shape, dtype=bool)
                    home[:, 0] = True
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.ravel()), pa.array(np.full(key.size, table, dtype=np.int32)), pa.array(home.ravel()), pa.array(np.repeat(rid[rows], key.shape[1]))],
                        ["key", "table", "home", "rid"],
                    )

    bounded_batches(vectors.sparkSession)
    return vectors.select("rid", "embedding").mapInArrow(visit, "key long, table int, home boolean, rid long")


def _blocks(visits: DataFrame) -> DataFrame:
    """Visits dealt to blocks (key, i, j) of at most about `BLOCK` residents and visitors each.

    Residents of block i meet visitors of block j, and the residents of all blocks from i on. Cells in which nobody meets are left out.
    """
    counts = visits.groupBy("key").agg(F.sum(F.col("home").cast("long")).alias("_h"), F.count("*").alias("_n")).where("_h > 0 and _n > 1")
    rows = visits.join(counts, "key")
    parts_h = F.ceil(F.col("_h") / BLOCK).cast("int")
    parts_v = F.ceil((F.col("_n") - F.col("_h")) / BLOCK).cast("int")
    at = F.when(F.col("home"), F.pmod(F.xxhash64("rid"), parts_h)).otherwise(F.pmod(F.xxhash64("rid"), parts_v)).cast("int")
    rows = rows.withColumn("_at", at).withColumn("_ph", parts_h).withColumn("_pv", parts_v)
    # A resident joins the blocks (own, every visitor part) and, as the other side, (every part up to its own, -1 - own).
    homes = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("_pv") - 1, F.lit(1)), lambda j: F.struct(F.col("_at").alias("i"), j.alias("j"), F.lit(0).alias("side"))),
    )
    none = F.array().cast("array<struct<i:int,j:int,side:int>>")
    homes = F.when(F.col("_pv") > 0, homes).otherwise(none)
    mutual = F.concat(
        F.transform(F.sequence(F.col("_at"), F.col("_ph") - 1), lambda j: F.struct(F.col("_at").alias("i"), (-1 - j).alias("j"), F.lit(0).alias("side"))),
        F.when(F.col("_at") > 0, F.transform(F.sequence(F.lit(0), F.col("_at") - 1), lambda i: F.struct(i.alias("i"), (-1 - F.col("_at")).alias("j"), F.lit(1).alias("side")))).otherwise(none),
    )
    mutual = F.when(F.col("_h") > 1, mutual).otherwise(none)
    guests = F.transform(F.sequence(F.lit(0), F.col("_ph") - 1), lambda i: F.struct(i.alias("i"), F.col("_at").alias("j"), F.lit(1).alias("side")))
    where = F.when(F.col("home"), F.concat(homes, mutual)).otherwise(guests)
    return rows.select("key", "table", "rid", F.explode(where).alias("_b")).select("key", "table", "rid", "_b.i", "_b.j", "_b.side")


def _links_in_blocks(blocks: DataFrame, vectors: DataFrame, cosine: float, scale: float, seed: int) -> DataFrame:
    """(rid, other, n): `n` copies that a vector links with, told once over all tables; `other` joins a block's groups.

    A pair that an earlier table brings together as well counts there, and one that meets in both of its cells
    in the cell of the smaller rid; so counts add up without any pair being written.
    """

    def meets(one, two, tables):
        """Whether row pairs meet in any of the first `tables` tables."""
        open_ = np.arange(len(one))
        for table in range(tables):
            if not len(open_):
                break
            x, y = cells(one[open_], table, scale, seed), cells(two[open_], table, scale, seed)
            open_ = open_[~((x == y[:, :1]).any(axis=1) | (y == x[:, :1]).any(axis=1))]
        found = np.ones(len(one), dtype=bool)
        found[open_] = False
        return found

    def told(outer, inner, table, rid, weight, side, unit):
        left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        mutual = inner < 0
        if mutual and -1 - inner == outer:
            right = left
        if not len(left) or not len(right):
            return None
        i, j = np.nonzero(unit[left] @ unit[right].T >= cosine - 1e-9)
        i, j = left[i], right[j]
        once = rid[i] < rid[j] if right is left else np.ones(len(i), dtype=bool)
        i, j = i[once], j[once]
        close = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
        i, j = i[close], j[close]
        if not len(i):
            return None
        fresh = np.ones(len(i), dtype=bool)
        step = 1 << 14
        for k in range(0, len(i), step):
            a, b = i[k : k + step], j[k : k + step]
            fresh[k : k + step] = ~meets(unit[a], unit[b], table)
            if not mutual:  # a resident here, b a visitor: b's own cell brings them together as well if a probes it
                both = (cells(unit[a], table, scale, seed) == cells(unit[b], table, scale, seed)[:, :1]).any(axis=1)
                fresh[k : k + step] &= ~both | (rid[a] < rid[b])
        i, j = i[fresh], j[fresh]
        if not len(i):
            return None
        n = np.bincount(i, weights=weight[j], minlength=len(rid)) + np.bincount(j, weights=weight[i], minlength=len(rid))
        root = np.arange(len(rid))
        while True:
            low = root.copy()
            np.minimum.at(low, i, root[j])
            np.minimum.at(low, j, root[i])
            low = low[low]
            if (low == root).all():
                break
            root = low
        some = np.flatnonzero(n)
        return rid[some], rid[root[some]], n[some].astype(np.int64)

    def run(batches):
        held = None
        for batch in batches:
            part = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "i", "j", "table", "rid", "weight", "side")]
            vector = batch.column("embedding")
            sizes = np.diff(vector.offsets.to_numpy())
            rows = np.array(np.split(vector.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(sizes)[:-1]) + [None], dtype=object)[:-1]
            part.append(rows)
            if held is not None:
                part = [np.concatenate([a, b]) for a, b in zip(held, part)]
            if not len(part[0]):
                continue
            turn = np.flatnonzero((np.diff(part[0]) != 0) | (np.diff(part[1]) != 0) | (np.diff(part[2]) != 0)) + 1
            cuts = np.concatenate([[0], turn])
            yield from out_of([[x[a:b] for x in part] for a, b in zip(cuts[:-1], cuts[1:])])
            held = [x[cuts[-1] :] for x in part]
        if held is not None:
            yield from out_of([held])

    def out_of(groups):
        found = []
        for _, outer, inner, table, rid, weight, side, rows in groups:
            if len(rid) > 1:
                hit = told(int(outer[0]), int(inner[0]), int(table[0]), rid, weight, side, _units(np.stack(rows)))
                if hit is not None:
                    found.append(hit)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["rid", "other", "n"])

    rows = blocks.join(vectors.select("rid", "embedding", "weight"), "rid")
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    bounded_batches(vectors.sparkSession, rows=4096)
    return rows.select("key", "i", "j", "table", "rid", "weight", "side", "embedding").mapInArrow(run, "rid long, other long, n long")


def near_vectors(vectors: DataFrame, cosine: float = 0.9, recall: float = 0.97, seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row, from pairs of a cosine of at least `cosine`, in doubles.

    Pairs come from E8 cells of random projections; no pair below the threshold is linked, and the number of tables makes
    a pair at the threshold be found with about the chance `recall`, nearer ones more often. Equal vectors are one with a
    weight, so copies never meet one by one. A vector that is null, empty, zero or holds a null, NaN or infinity links
    with nothing, and vectors of different lengths do not link. A row without an id takes part; its component is
    the smallest id of its group, or null.
    """
    numbers = F.col("embedding").cast("array<double>")
    sound = F.coalesce(
        F.col("embedding").isNotNull() & F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(numbers, lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(sound, numbers).alias("embedding"))
    distinct = rows.where("embedding is not null").groupBy("embedding").agg(F.count("*").alias("weight"))
    distinct = store(distinct.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    count, dims = distinct.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not count:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    scale, tables = plan(count, dims, cosine, recall, seed)
    visits = store(_visits(distinct, scale, tables, seed), "visits")
    told = store(_links_in_blocks(_blocks(visits), distinct, cosine, scale, seed), "links")
    sums = told.groupBy("rid").agg(F.sum("n").alias("_n"))
    roots = components(told, "rid", "other").withColumnRenamed("node", "rid")
    groups = distinct.join(sums, "rid", "left").join(roots, "rid", "left")
    groups = groups.select("embedding", (F.coalesce("_n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "rid").alias("_group"))
    known = store(rows.where("embedding is not null").join(groups, "embedding").select("vec_id", "n_links", "_group"), "groups")
    least = known.groupBy("_group").agg(F.min("vec_id").alias("component_id"))
    linked = known.join(least, "_group").select("vec_id", "n_links", "component_id")
    alone = rows.where("embedding is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
