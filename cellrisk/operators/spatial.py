"""Nearest-site and radius joins that stay exact without comparing every row with every site.

Points are placed in cubes on three-dimensional coordinates of the globe, so cell bounds are plain
box distances and neither the date line nor the poles are special. Level 0 cubes have an edge of
2^-7 km, and each level doubles it.

Three ideas keep the work small under skew:

* Sites at the same coordinates are merged first, and counted.
* Rows are never compared with sites directly at first. The *cells* rows fall into are compared with
  the cells sites fall into, and whole site cells are ruled out (nearest) or counted (radius) by
  their bounds. A cell stands for its rows however many they are.
* A row cell with too many candidate sites is split, and its site cells with it, until few are left.
  So a spot with a third of all sites, a third of all rows, or both, costs depth and not pairs.

What remains is a table of row cells with a short list of candidate sites each. Every row meets its
own cell's list once, by an equi-join on the cell key; nothing is grouped by row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrisk.functions.geo import EARTH_RADIUS_KM, haversine_km
from cellrisk.functions.numeric import np_round
from cellrisk.session import checkpointed

ROOT = 21
_POSITION = ["x", "y", "z"]
_OWN = ["_x", "_y", "_z"]
OFFSET_KM = 8192.0
CELLS_PER_KM = 128.0
MASK = (1 << ROOT) - 1
TIE_DIGITS = 9
SLACK_KM = 1e-6

# A row cell is split when its list is longer than LONGEST_LIST, or when it is longer than
# SHORT_LIST and rows x sites of the cell exceed CELL_WORK.
LONGEST_LIST = 1024
SHORT_LIST = 64
CELL_WORK = 200_000


def _shift(value: Column, by: Column | int) -> Column:
    return F.call_function("shiftright", value, F.lit(by) if isinstance(by, int) else by)


def _pack(ix: Column, iy: Column, iz: Column) -> Column:
    return F.shiftleft(ix, 2 * ROOT).bitwiseOR(F.shiftleft(iy, ROOT)).bitwiseOR(iz)


def _axes(key: Column) -> tuple[Column, Column, Column]:
    return F.shiftright(key, 2 * ROOT), F.shiftright(key, ROOT).bitwiseAND(F.lit(MASK)), key.bitwiseAND(F.lit(MASK))


def _up(key: Column, levels: Column | int) -> Column:
    """Key of the enclosing cell some levels up."""
    return _pack(*[_shift(a, levels) for a in _axes(key)])


def _xyz(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Position in km from the centre of the globe."""
    phi, lam, radius = F.radians(lat), F.radians(lon), F.lit(EARTH_RADIUS_KM)
    return radius * F.cos(phi) * F.cos(lam), radius * F.cos(phi) * F.sin(lam), radius * F.sin(phi)


def _point_key(lat: Column, lon: Column) -> Column:
    cells = [F.floor((a + F.lit(OFFSET_KM)) * F.lit(CELLS_PER_KM)).cast("bigint") for a in _xyz(lat, lon)]
    return _pack(*cells)


def _chord_km(radius_km: float) -> float:
    """Straight distance that belongs to a distance along the surface."""
    return 2.0 * EARTH_RADIUS_KM * math.sin(radius_km / (2.0 * EARTH_RADIUS_KM))


def edge_km(level: int) -> float:
    return 2.0**level / CELLS_PER_KM


def _with_neighbors(df: DataFrame, key: Column, level: Column, name: str) -> DataFrame:
    """One row for the cell itself and for every cell around it that exists at that level."""
    around = df.withColumns({"_k": key, "_top": _shift(F.lit(MASK), level)}).withColumn(
        "_step", F.explode(F.sequence(F.lit(0), F.lit(26)))
    )
    step = F.col("_step")
    moves = (step % 3 - 1, (step / 3).cast("int") % 3 - 1, (step / 9).cast("int") - 1)
    axes = {f"_a{i}": a + m for i, (a, m) in enumerate(zip(_axes(F.col("_k")), moves, strict=True))}
    top = F.col("_top")
    inside = F.col("_a0").between(0, top) & F.col("_a1").between(0, top) & F.col("_a2").between(0, top)
    packed = _pack(F.col("_a0"), F.col("_a1"), F.col("_a2"))
    return around.withColumns(axes).filter(inside).withColumn(name, packed).drop("_k", "_top", "_step", *axes)


def _box_bounds(row_cell: Column, site_cell: Column) -> tuple[Column, Column]:
    """Squared least and greatest distance between a cell and one of the next level up, in units of
    the smaller edge. Whole numbers, so comparisons are exact."""
    least, most = [], []
    for q, s in zip(_axes(row_cell), _axes(site_cell), strict=True):
        low, high = s * 2, s * 2 + 2
        gap = F.greatest(low - (q + 1), q - high, F.lit(0))
        span = F.greatest(high - q, q + 1 - low)
        least.append(gap * gap)
        most.append(span * span)
    return reduce(Column.__add__, least), reduce(Column.__add__, most)


@dataclass(frozen=True)
class SiteIndex:
    """Merged sites (kind, lat, lon, id, n, info, key, position) and their cells at every level
    (kind, level, cell, sites, weight), both as tables in the shared folder."""

    sites: DataFrame
    cells: DataFrame
    base_level: int
    empty: bool


def index_sites(
    df: DataFrame, id_col: str, info: str | None = None, kind: str | None = None, lat: str = "latitude", lon: str = "longitude"
) -> SiteIndex:
    """Merge sites at equal coordinates and count them per cell and level.

    `info` is carried from the site with the smallest id. `kind` splits sites into categories that
    are searched separately. One small job reads the number of cells per level, 22 rows.
    """
    placed = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        (F.col(kind) if kind else F.lit("all")).alias("kind"),
        F.col(lat).cast("double").alias("lat"),
        F.col(lon).cast("double").alias("lon"),
        F.col(id_col).alias("id"),
        (F.col(info) if info else F.lit(None).cast("string")).alias("info"),
    )
    merged = placed.groupBy("kind", "lat", "lon").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.min_by("info", "id").alias("info")
    )
    position = dict(zip(_POSITION, _xyz(F.col("lat"), F.col("lon")), strict=True))
    sites = checkpointed(merged.withColumns({"key": _point_key(F.col("lat"), F.col("lon")), **position}))
    levels = F.explode(F.sequence(F.lit(0), F.lit(ROOT))).alias("level")
    cells = checkpointed(
        sites.select("kind", "n", "key", levels)
        .groupBy("kind", "level", _up(F.col("key"), F.col("level")).alias("cell"))
        .agg(F.count(F.lit(1)).alias("sites"), F.sum("n").alias("weight"))
    )
    # At most 22 rows: mean sites per occupied cell, by level.
    means = {
        row["level"]: row["m"]
        for row in cells.groupBy("level").agg((F.sum("sites") / F.count(F.lit(1))).alias("m")).collect()
    }
    crowded = [k for k in range(ROOT + 1) if means.get(k, 0.0) >= 2.0]
    base = max(min(crowded) - 2, 0) if crowded else ROOT - 3
    return SiteIndex(sites, cells, min(base, ROOT - 3), not means)


def _located(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())


def _row_keys(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Finest key of every located row; reads two columns of the table. Callers group it by cells."""
    key = _point_key(F.col(lat).cast("double"), F.col(lon).cast("double"))
    return _located(df, lat, lon).select(key.alias("key"))


_CELL = ["kind", "level", "cell"]


def _with_bounds(pairs: DataFrame) -> DataFrame:
    least, most = _box_bounds(F.col("cell"), F.col("site_cell"))
    return pairs.withColumns({"least": least, "most": most})


def _nearest_rule(pairs: DataFrame) -> DataFrame:
    """Drop site cells that lie farther away than another is sure to reach."""
    reach = F.min("most").over(Window.partitionBy(*_CELL))
    kept = _with_bounds(pairs).withColumn("reach", reach).filter(F.col("least") <= F.col("reach"))
    return kept.drop("least", "most", "reach")


def _radius_rule(radii: Sequence[float]) -> Callable[[DataFrame], DataFrame]:
    """Count site cells inside a radius as a whole, drop those outside, keep the undecided."""
    chords = [_chord_km(r) for r in radii]

    def rule(pairs: DataFrame) -> DataFrame:
        edge = F.pow(F.lit(2.0), F.col("level")) / F.lit(CELLS_PER_KM)
        bounded = _with_bounds(pairs)
        near, far = F.sqrt(F.col("least").cast("double")) * edge, F.sqrt(F.col("most").cast("double")) * edge
        inside = [far <= F.lit(c - SLACK_KM) for c in chords]
        outside = [near > F.lit(c + SLACK_KM) for c in chords]
        decided = reduce(Column.__and__, [i | o for i, o in zip(inside, outside, strict=True)])
        known = F.coalesce(decided, F.lit(True))
        # A pair without a site cell stands for a row cell with no site near it.
        whole = Window.partitionBy(*_CELL)
        counted = bounded.withColumn("_known", known)
        for i, c in enumerate(inside):
            gain = F.when(F.col("_known") & c, F.col("weight")).otherwise(F.lit(0))
            counted = counted.withColumn(f"base_{i}", F.col(f"base_{i}") + F.sum(gain).over(whole))
        open_pairs = F.sum((~F.col("_known")).cast("int")).over(whole)
        first = F.row_number().over(whole.orderBy(F.col("_known"), "site_cell"))
        kept = counted.withColumns({"_open": open_pairs, "_first": first}).filter(
            ~F.col("_known") | ((F.col("_open") == 0) & (F.col("_first") == 1))
        )
        cleared = kept.withColumns(
            {
                "site_cell": F.when(~F.col("_known"), F.col("site_cell")),
                "sites": F.when(~F.col("_known"), F.col("sites")),
                "weight": F.when(~F.col("_known"), F.col("weight")),
            }
        )
        return cleared.drop("least", "most", "_known", "_open", "_first")

    return rule


def _nearest_start(keys: DataFrame, index: SiteIndex) -> DataFrame:
    """Row cells sized by how far their nearest site is, with the site cells around them.

    A level reaches a cell when a site lies in it or next to it. The row cell is one level below the
    first level that reaches it: sites are then neither next to it nor far beyond its parent's
    neighbours. Row cells do not overlap, as a level above a reached one is reached as well.
    """
    base = index.base_level
    occupied = index.cells.filter(F.col("level") > base)
    reached = (
        _with_neighbors(occupied.select("kind", "level", "cell"), F.col("cell"), F.col("level"), "anchor")
        .select("kind", "level", "anchor")
        .distinct()
    )
    fine = keys.groupBy(_up(F.col("key"), base).alias("fine")).agg(F.count(F.lit(1)).alias("rows"))
    climbed = fine.select("fine", "rows", F.explode(F.sequence(F.lit(base + 1), F.lit(ROOT))).alias("level"))
    climbed = climbed.withColumn("anchor", _up(F.col("fine"), F.col("level") - base))
    first = (
        climbed.join(reached, ["level", "anchor"])
        .groupBy("fine", "kind", "rows")
        .agg((F.min("level") - 1).alias("level"))
    )
    row_cells = first.groupBy("kind", "level", _up(F.col("fine"), F.col("level") - base).alias("cell")).agg(
        F.sum("rows").alias("rows")
    )

    area = F.least(F.col("level") + 3, F.lit(ROOT))
    searched = _with_neighbors(row_cells, _up(F.col("cell"), area - F.col("level")), area, "near")
    lift = F.least(F.lit(2), F.lit(ROOT) - F.col("level"))
    site_cells = index.cells.select(
        "kind",
        (F.col("level") - 1).alias("level"),
        _up(F.col("cell"), lift).alias("near"),
        F.col("cell").alias("site_cell"),
        "sites",
        "weight",
    )
    pairs = searched.join(site_cells, ["kind", "level", "near"])
    return pairs.select(*_CELL, "rows", "site_cell", "sites", "weight")


def _radius_start(keys: DataFrame, index: SiteIndex, radii: Sequence[float]) -> DataFrame:
    """Row cells with an edge of the largest radius, and the next-level site cells around them."""
    level = next(k for k in range(ROOT) if edge_km(k) >= max(radii))
    row_cells = keys.groupBy(
        F.lit("all").alias("kind"), F.lit(level).alias("level"), _up(F.col("key"), level).alias("cell")
    ).agg(F.count(F.lit(1)).alias("rows"))
    searched = _with_neighbors(row_cells, _up(F.col("cell"), 1), F.lit(level + 1), "site_cell")
    site_cells = index.cells.filter(F.col("level") == level + 1).select(
        "kind", F.col("cell").alias("site_cell"), "sites", "weight"
    )
    pairs = searched.join(site_cells, ["kind", "site_cell"]).select(*_CELL, "site_cell", "sites", "weight")
    with_empty = row_cells.join(pairs, _CELL, "left")
    return with_empty.withColumns({f"base_{i}": F.lit(0).cast("bigint") for i in range(len(radii))})


def _split(over: DataFrame, keys: DataFrame, index: SiteIndex, levels: Sequence[int]) -> DataFrame:
    """Replace overfull row cells by the occupied cells one level down, and their site cells too."""
    carried = [c for c in over.columns if c not in ("rows", "site_cell", "sites", "weight", "total")]
    parents = over.select(*_CELL).distinct()
    climbed = keys.select("key", F.explode(F.array(*[F.lit(k) for k in levels])).alias("level")).withColumn(
        "cell", _up(F.col("key"), F.col("level"))
    )
    children = (
        climbed.join(parents, ["level", "cell"])
        .groupBy(*_CELL, _up(F.col("key"), F.col("level") - 1).alias("child"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # Site cells sit one level above their row cell, so their children are at the row cell's level.
    site_children = index.cells.select(
        "kind",
        "level",
        _up(F.col("cell"), 1).alias("site_cell"),
        F.col("cell").alias("site_child"),
        "sites",
        "weight",
    )
    pairs = over.select(*carried, "site_cell").join(children, _CELL)
    return pairs.join(site_children, ["kind", "level", "site_cell"]).select(
        *[c for c in carried if c not in ("level", "cell")],
        (F.col("level") - 1).alias("level"),
        F.col("child").alias("cell"),
        "rows",
        F.col("site_child").alias("site_cell"),
        "sites",
        "weight",
    )


def _candidates(
    start: DataFrame, keys: DataFrame, index: SiteIndex, rule: Callable[[DataFrame], DataFrame], extra: Sequence[str]
) -> tuple[DataFrame, list[int]]:
    """(kind, level, cell, extra.., near): the short list of sites for every row cell."""
    total = F.coalesce(F.sum("sites").over(Window.partitionBy(*_CELL)), F.lit(0))
    state = checkpointed(rule(start).withColumn("total", total))
    much = (F.col("total") > SHORT_LIST) & (F.col("total") * F.col("rows") > CELL_WORK)
    full = ((F.col("total") > LONGEST_LIST) | much) & (F.col("level") > 0)
    finished, levels = [], set()
    while True:
        # At most one row per level.
        found = state.groupBy("level").agg(F.count_if(full).alias("over"), F.count_if(~full).alias("done")).collect()
        levels |= {row["level"] for row in found if row["done"]}
        finished.append(state.filter(~full))
        split = sorted(row["level"] for row in found if row["over"])
        if not split:
            break
        state = checkpointed(
            rule(_split(state.filter(full), keys, index, split)).withColumn("total", total)
        )
    pairs = reduce(DataFrame.unionByName, finished).drop("total", "rows", "sites", "weight")
    site_levels = F.explode(F.array(*[F.lit(k) for k in sorted(levels)])).alias("level")
    sites = index.sites.select("*", site_levels).select(
        "kind",
        "level",
        _up(F.col("key"), F.col("level") + 1).alias("site_cell"),
        F.struct("lat", "lon", "id", "n", "info", *_POSITION).alias("site"),
    )
    # The lists are bounded by LONGEST_LIST, or at level 0 by the places in a cell of 8 m.
    listed = (
        pairs.join(sites, ["kind", "level", "site_cell"], "left")
        .groupBy(*_CELL, *extra)
        .agg(F.collect_list("site").alias("near"))
    )
    return checkpointed(listed), sorted(levels)


def _meet(df: DataFrame, lists: DataFrame, levels: Sequence[int], lat: str, lon: str) -> DataFrame:
    """Join each row with the list of the one row cell that contains it.

    A located row looks its cell up at every level in use, and exactly one look-up meets a list. A row
    without coordinates looks nothing up and keeps a NULL list. The table is read once.

    A small file is one task's input, but its rows measure up to LONGEST_LIST sites each: rows are dealt out first.
    """
    place = F.col(lat).cast("double"), F.col(lon).cast("double")
    located = place[0].isNotNull() & place[1].isNotNull()
    tried = F.when(located, F.array(*[F.lit(k) for k in levels])).otherwise(F.array(F.lit(None).cast("int")))
    # A fixed number of parts: adaptive execution would merge rows of few bytes into one task again.
    keyed = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))).select(
        "*",
        _point_key(*place).alias("_key"),
        *[c.alias(name) for name, c in zip(_OWN, _xyz(*place), strict=True)],
        F.explode(tried).alias("level"),
    )
    keyed = keyed.withColumn("cell", _up(F.col("_key"), F.col("level"))).drop("_key")
    met = keyed.join(lists, ["level", "cell"], "left")
    return met.filter(F.col("near").isNotNull() | F.col("level").isNull()).drop("level", "cell")


def _squared_chord(site: Column) -> Column:
    gaps = [F.col(mine) - site[theirs] for mine, theirs in zip(_OWN, _POSITION, strict=True)]
    return reduce(Column.__add__, [g * g for g in gaps])


def _best(lat: str, lon: str, index: SiteIndex) -> Column:
    """Nearest of the list as (rounded distance, id, distance, info): equal distances go to the
    smaller id. One pass over the list keeps the best so far, and spends the great-circle formula on
    a site only if its straight distance is not clearly longer."""
    id_type, info_type = (index.sites.schema[c].dataType.simpleString() for c in ("id", "info"))
    best_type = f"struct<tie:double,id:{id_type},d:double,info:{info_type}>"
    start = F.struct(F.lit(float("inf")).alias("limit"), F.lit(None).cast(best_type).alias("best"))

    def take(so_far: Column, site: Column) -> Column:
        c = _squared_chord(site)
        d = haversine_km(F.col(lat), F.col(lon), site["lat"], site["lon"])
        entry = F.struct(
            np_round(d, TIE_DIGITS).alias("tie"), site["id"].alias("id"), d.alias("d"), site["info"].alias("info")
        )
        limit = F.sqrt(c) + F.lit(SLACK_KM)
        better = F.struct(
            F.least(so_far["limit"], limit * limit).alias("limit"), F.least(so_far["best"], entry).alias("best")
        )
        return F.when(c > so_far["limit"], so_far).otherwise(better)

    return F.aggregate("near", start, take, lambda so_far: so_far["best"])


def with_nearest(
    df: DataFrame,
    index: SiteIndex,
    distance: str = "dist_to_nearest_tower_km",
    info: str | None = "nearest_tower_radio",
    site_id: str | None = None,
    digits: int = 3,
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Add the distance to the nearest site, and its `info` and id. Rows without coordinates keep NULL."""
    outputs = {distance: (np_round("_best.d", digits), "double")}
    if info:
        outputs[info] = (F.col("_best.info"), index.sites.schema["info"].dataType)
    if site_id:
        outputs[site_id] = (F.col("_best.id"), index.sites.schema["id"].dataType)
    nothing = {name: F.lit(None).cast(kind) for name, (_, kind) in outputs.items()}
    if index.empty:
        return df.withColumns(nothing)
    keys = _row_keys(df, lat, lon)
    lists, levels = _candidates(_nearest_start(keys, index), keys, index, _nearest_rule, [])
    if not levels:
        return df.withColumns(nothing)
    met = _meet(df, lists.drop("kind"), levels, lat, lon).withColumn("_best", _best(lat, lon, index))
    return met.withColumns({name: value for name, (value, _) in outputs.items()}).drop("near", "_best", *_OWN)


def with_radius_counts(
    df: DataFrame,
    index: SiteIndex,
    radii: Sequence[float] = (1.0, 2.0),
    names: Sequence[str] = ("towers_within_1km", "towers_within_2km"),
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Add the number of sites within each radius, bounds included; 0 where there are none."""
    zeros = {name: F.lit(0).cast("bigint") for name in names}
    if index.empty:
        return df.withColumns(zeros)
    keys = _row_keys(df, lat, lon)
    bases = [f"base_{i}" for i in range(len(radii))]
    start = _radius_start(keys, index, radii)
    lists, levels = _candidates(start, keys, index, _radius_rule(radii), bases)
    if not levels:
        return df.withColumns(zeros)
    met = _meet(df, lists.drop("kind"), levels, lat, lon)

    measured = met.withColumn(
        "_near",
        F.transform(
            "near",
            lambda s: F.struct(
                _squared_chord(s).alias("c"), s["n"].alias("n"), s["lat"].alias("lat"), s["lon"].alias("lon")
            ),
        ),
    )

    def within(radius: float) -> Column:
        chord = _chord_km(radius)
        surely, maybe = (chord - SLACK_KM) ** 2, (chord + SLACK_KM) ** 2

        def add(total: Column, site: Column) -> Column:
            exact = haversine_km(F.col(lat), F.col(lon), site["lat"], site["lon"]) <= F.lit(float(radius))
            hit = (site["c"] < F.lit(surely)) | ((site["c"] <= F.lit(maybe)) & exact)
            return total + F.when(hit, site["n"]).otherwise(F.lit(0))

        return F.aggregate("_near", F.lit(0).cast("bigint"), add)

    counts = {
        name: F.coalesce(F.col(base) + within(r), F.lit(0).cast("bigint"))
        for name, base, r in zip(names, bases, radii, strict=True)
    }
    return measured.withColumns(counts).drop("near", "_near", *bases, *_OWN)


def nearest_by_kind(
    df: DataFrame,
    key: str,
    index: SiteIndex,
    kinds: Sequence[str],
    name: str = "dist_to_{}_km",
    digits: int = 3,
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """(key, one distance per kind). A kind without sites, and a row without coordinates, give NULL."""
    narrow = df.select(key, lat, lon)
    columns = [name.format(k) for k in kinds]
    if index.empty:
        return narrow.select(key, *[F.lit(None).cast("double").alias(c) for c in columns])
    keys = _row_keys(narrow, lat, lon)
    lists, levels = _candidates(_nearest_start(keys, index), keys, index, _nearest_rule, [])
    if not levels:
        return narrow.select(key, *[F.lit(None).cast("double").alias(c) for c in columns])
    # The result is grouped by row in any case, so the lists are unrolled: the distances are then
    # generated code, and their minima combine before the shuffle.
    each = (
        _meet(narrow, lists, levels, lat, lon)
        .select(key, lat, lon, "kind", F.explode_outer("near").alias("site"))
        .select(key, "kind", haversine_km(F.col(lat), F.col(lon), F.col("site.lat"), F.col("site.lon")).alias("d"))
    )
    return each.groupBy(key).agg(
        *[
            np_round(F.min(F.when(F.col("kind") == k, F.col("d"))), digits).alias(c)
            for k, c in zip(kinds, columns, strict=True)
        ]
    )


def tower_features(df: DataFrame, towers: DataFrame, id_col: str = "tower_id", info: str = "radio") -> DataFrame:
    """Distance and radio of the nearest tower, and towers within 1 km and 2 km."""
    index = index_sites(towers, id_col, info)
    return with_radius_counts(with_nearest(df, index), index)
