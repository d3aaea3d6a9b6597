"""Tables, stored intermediate results and bounded Arrow batches for the operators of this package."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrisk.session import scratch_path

#: Words are runs of bytes outside these; the same six characters that bytes.split() splits on.
WORD = r"[^\x20\x09-\x0D]+"
#: Words of 64 bits that `narrowed` broadcasts at most.
MARKS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before each as it takes to be no column of `df`."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def store(df: DataFrame, name: str = "llm") -> DataFrame:
    """Write `df` into the shared folder and read it back: cuts lineage and outlives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    spark = df.sparkSession
    fs = spark._jvm.org.apache.hadoop.fs
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are stored by now.

    It does so when the driver collects its garbage, which by default is every half hour.
    """
    gc.collect()
    spark._jvm.System.gc()


def narrowed(rows: DataFrame, key: str, ids: DataFrame, name: str, count: int) -> DataFrame:
    """The rows whose `key` may be among the `count` values of `ids`: all that are, and about one in forty of the others.

    For joins that shuffle wide rows to few ids. Each id, a null too, sets by its hash one of 32 to 64 bits an id; only the
    words of bits are broadcast, `MARKS` of them at most, so with more ids than that more rows pass, and none is lost.
    """
    if rows.schema[key].dataType != ids.schema[name].dataType:
        return rows
    bits = 64 << min(MARKS.bit_length() - 1, max(10, (max(count, 1) // 2).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    word, mark, own = spare(rows, "_word", "_mark", "_place")
    marks = ids.select(place(name).alias("_at")).select(F.shiftright("_at", 6).alias(word), F.expr("shiftleft(1L, int(_at & 63))").alias("_bit"))
    marks = F.broadcast(marks.groupBy(word).agg(F.bit_or("_bit").alias(mark)))
    placed = rows.withColumn(own, place(key)).withColumn(word, F.shiftright(own, 6))
    passed = placed.join(marks, word).where(F.getbit(mark, F.col(own).bitwiseAND(F.lit(63)).cast("int")) == 1)
    return passed.select(*rows.columns)


def bounded_batches(spark: SparkSession, rows: int = 1000, mb: int = 16) -> None:
    """Arrow batches of at most `rows` rows and about `mb` MB (one longer text makes a batch of its own)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def utf8(col: str = "text") -> Column:
    """The text's bytes; no text has no bytes."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def schema_of(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def map_batches(df: DataFrame, fn: Callable, ddl: str) -> DataFrame:
    """`fn(batch: pa.RecordBatch) -> pa.RecordBatch | None` over every Arrow batch."""

    def run(batches):
        for batch in batches:
            out = fn(batch)
            if out is not None:
                yield out

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, ddl)
