"""Seeded samples, splits and folds that depend on row keys only, not on partitioning or order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
HASH_BITS = 16
#: Hexadecimal digits per step of the search for a sample's threshold.
DIGITS = 4


def key_hash(key: str, seed: int = SEED) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def uniform(key: Column | str, *salt: Column | int) -> Column:
    """Number in [0, 1) from a key and salts, the same on every run."""
    parts = [F.lit(s) if isinstance(s, int) else s for s in salt]
    first = F.col(key) if isinstance(key, str) else key
    bits = F.shiftrightunsigned(F.xxhash64(first, *parts), 11)
    return bits.cast("double") / F.lit(float(2**53))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """`n` rows without replacement. Each task keeps its `n` smallest hashes only."""
    return df.orderBy(key_hash(key, seed), F.col(key)).limit(n)


def sample_per_group(df: DataFrame, key: str, group: str, n: int, seed: int = SEED) -> DataFrame:
    """`n` rows of each group without replacement (all of a smaller one): those whose md5 of `seed:key` comes first.

    No group is ordered. Counts by the leading digits of the hash say in which prefix the n-th row lies; counts of the
    next digits narrow that prefix to about one row in 2^32, and only there are rows ranked. Rows of a NULL key count as
    rows of an empty one; rows that share a key at the cut are interchangeable.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    rows = df.withColumns({"_md5": digest, "_left": F.lit(n).cast("bigint"), "_in": F.lit(False)})
    for start in (1, 1 + DIGITS):
        part = F.substring("_md5", start, DIGITS)
        counted = rows.filter(~F.col("_in")).groupBy(F.col(group).alias("_g"), part.alias("_p"), "_left").agg(
            F.count(F.lit(1)).alias("_n")
        )
        # At most 16^DIGITS rows of each group.
        upto = F.sum("_n").over(Window.partitionBy("_g").orderBy("_p"))
        cut = counted.withColumn("_upto", upto).filter(F.col("_upto") - F.col("_n") < F.col("_left"))
        edges = cut.groupBy("_g").agg(
            F.max_by("_p", "_upto").alias("_cut"),
            F.max_by(F.col("_left") - F.col("_upto") + F.col("_n"), "_upto").alias("_rest"),
        )
        joined = rows.join(edges, F.col(group).eqNullSafe(F.col("_g")), "left")
        rows = (
            joined.filter(F.col("_in") | (part <= F.col("_cut")))
            .withColumns({"_in": F.col("_in") | (part < F.col("_cut")), "_left": F.col("_rest")})
            .drop("_g", "_cut", "_rest")
        )
    ranked = rows.filter(~F.col("_in")).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(group).orderBy("_md5"))
    )
    # The literal lets each task keep n rows at most before they meet.
    last = ranked.filter((F.col("_rank") <= n) & (F.col("_rank") <= F.col("_left")))
    return rows.filter("_in").select(*df.columns).unionByName(last.select(*df.columns))


def hash_ranks(df: DataFrame, key: str, group: str, seed: int = SEED, name: str = "hash_rank") -> DataFrame:
    """Exact 0-based rank by key hash within each group, plus the group size `<name>_n`.

    Groups are few and huge (two labels), so each is cut into 2^16 parts by the leading hash bits:
    part sizes give the offsets, and a task ranks one part at a time.
    """
    part = F.shiftrightunsigned(key_hash(key, seed), 64 - HASH_BITS).cast("int")
    parted = df.withColumn("_part", part)
    sizes = parted.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(group).alias("_group"),
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_size").over(Window.partitionBy(group)).alias(f"{name}_n"),
    )
    inside = Window.partitionBy(group, "_part").orderBy(key_hash(key, seed), key)
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_p"))
    return (
        parted.join(offsets, same)
        .withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_group", "_p", "_part", "_offset")
    )


def stratified_split(
    df: DataFrame, key: str, label: str = "churned", test_share: float = 0.2, seed: int = SEED, exact: bool = True
) -> DataFrame:
    """Add `is_test`. Exact: each class gives its rounded share. Otherwise: by hash, with no shuffle."""
    if not exact:
        return df.withColumn("is_test", uniform(key, seed) < F.lit(test_share))
    ranked = hash_ranks(df, key, label, seed, "_r")
    cut = F.rint(F.col("_r_n") * F.lit(test_share))
    return ranked.withColumn("is_test", F.col("_r") < cut).drop("_r", "_r_n")


def stratified_folds(df: DataFrame, key: str, label: str = "churned", k: int = 5, seed: int = SEED) -> DataFrame:
    """Add `fold`, 0 to k-1, balanced to within one row per class."""
    return hash_ranks(df, key, label, seed, "_r").withColumn("fold", (F.col("_r") % k).cast("int")).drop("_r", "_r_n")
