"""Flat token files, and token counts of their documents by a separator scan stitched across blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellrisk.llm.bpe import read_ranks
from cellrisk.llm.common import bounded_batches, map_batches, store

#: Tokens of one scanned block, and documents of one written file, so that a file stays small enough for a task.
BLOCK = 1 << 19
DOCUMENTS = 2048


def write_flat(docs: DataFrame, folder: str, vocabulary: str, pattern: str, separator: int, width: int = 2) -> None:
    """Write the texts' token ids as flat little-endian files: ids of `width` bytes, `separator` after each document.

    No index, header or length is written. Rows stay in their partitions and in their order; a partition's files follow
    each other by name. Spark's text writer puts the separator where it would end a line, so no file passes through the
    driver. A null or empty text is a document without tokens.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    kind = f"<u{width}"

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        rows = [np.array(coder.encode_ordinary(t), dtype=kind).tobytes() if t else b"" for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["tokens"])

    packed = map_batches(docs.select("text"), pack, "tokens binary").select(F.col("tokens").cast("string"))
    end = int(separator).to_bytes(width, "little").decode("latin-1")
    packed.write.option("lineSep", end).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", DOCUMENTS).text(folder)


def _scanned(spark: SparkSession, folder: str, separator: int, width: int) -> DataFrame:
    """(file, block, n, at): tokens of each block and the places of its separators."""

    def scan(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                data = np.frombuffer(content.as_buffer(), dtype=f"<u{width}", count=len(content.as_buffer()) // width)
                for k in range(0, max(1, len(data)), BLOCK):
                    block = data[k : k + BLOCK]
                    at = np.flatnonzero(block == separator).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([k // BLOCK]), pa.array([len(block)]), pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pa.array(at))],
                        ["file", "block", "n", "at"],
                    )

    bounded_batches(spark, rows=8)
    files = spark.read.format("binaryFile").load(folder)
    return files.select("path", "content").mapInArrow(scan, "file string, block long, n long, at array<int>")


def document_tokens(spark: SparkSession, folder: str, separator: int, width: int = 2, stream: str = r"part-(\d+)-") -> DataFrame:
    """(stream, document, begin, n_tokens, closed) of every document in the flat token files below `folder`.

    Files whose names agree in the group of `stream` are one stream of tokens in the order of their names; documents run
    across blocks and files. document counts from 0, begin is the place of the first token. Tokens after the last
    separator of a stream are a document that is not closed. Two separators in a row hold an empty document; a trailing
    part of a token is ignored; an empty folder or file has no documents.

    Blocks are searched on their own. A prefix scan then carries from block to block, and from file to file, what a block
    cannot know: tokens and documents before it, and where the document begins that its first separator ends.
    """
    blocks = store(_scanned(spark, folder, separator, width), "blocks")
    base = blocks.select("file", "block", "n", "at", F.size("at").alias("docs"), F.when(F.size("at") > 0, F.element_at("at", -1) + 1).alias("_last"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    inside = base.withColumn("_n", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("_docs", F.coalesce(F.sum("docs").over(before), F.lit(0)))
    inside = inside.withColumn("_end", F.col("_n") + F.col("_last")).withColumn("_open", F.max("_end").over(before))

    files = inside.groupBy("file").agg(F.sum("n").alias("fn"), F.sum("docs").alias("fdocs"), F.max("_end").alias("fend"))
    files = files.withColumn("stream", F.regexp_extract("file", stream, 1))
    prior = W.partitionBy("stream").orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    files = files.withColumn("f0", F.coalesce(F.sum("fn").over(prior), F.lit(0))).withColumn("d0", F.coalesce(F.sum("fdocs").over(prior), F.lit(0)))
    files = files.withColumn("open0", F.coalesce(F.max(F.col("f0") + F.col("fend")).over(prior), F.lit(0)))
    files = store(files, "files")

    placed = inside.where("docs > 0").join(files.select("file", "stream", "f0", "d0", "open0"), "file")
    begin = F.coalesce(F.col("f0") + F.col("_open"), F.col("open0"))
    offset = F.col("f0") + F.col("_n")
    ends = F.transform("at", lambda x: x + offset)
    starts = F.concat(F.array(begin), F.transform(F.slice("at", 1, F.size("at") - 1), lambda x: x + offset + 1))
    rows = placed.select("stream", (F.col("d0") + F.col("_docs")).alias("_d"), F.posexplode(F.arrays_zip(starts.alias("begin"), ends.alias("end"))).alias("_i", "_x"))
    closed = rows.select("stream", (F.col("_d") + F.col("_i")).alias("document"), "_x.begin", (F.col("_x.end") - F.col("_x.begin")).alias("n_tokens"), F.lit(True).alias("closed"))

    rest = files.groupBy("stream").agg(F.sum("fn").alias("_n"), F.sum("fdocs").alias("document"), F.coalesce(F.max(F.col("f0") + F.col("fend")), F.lit(0)).alias("begin"))
    rest = rest.where("_n > begin").select("stream", "document", "begin", (F.col("_n") - F.col("begin")).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(rest)


def counted(docs: DataFrame, folder: str, vocabulary: str, pattern: str, separator: int) -> DataFrame:
    """(doc_id, stream, document, begin, n_tokens): `docs` written as flat files, counted there, and told by doc_id.

    `docs` must be read straight from files, so that reading it again gives the same partitions in the same order; a
    partition whose documents and separators differ in number is an error.
    """
    write_flat(docs, folder, vocabulary, pattern, separator)
    found = store(document_tokens(docs.sparkSession, folder, separator), "counts")
    place = F.monotonically_increasing_id()
    order = docs.select("doc_id", F.spark_partition_id().cast("long").alias("_part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("document"))
    order = store(order, "order")
    told = found.withColumn("_part", F.col("stream").cast("long"))
    sizes = order.groupBy("_part").agg(F.count("*").alias("_n")).join(told.groupBy("_part").agg(F.count("*").alias("_m")), "_part", "full")
    if not sizes.where("not (_n <=> _m)").isEmpty():
        raise ValueError("documents and separators differ in number")
    return order.join(told, ["_part", "document"]).select("doc_id", "stream", "document", "begin", "n_tokens")
