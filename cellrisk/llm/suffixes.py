"""Removal of repeated byte strings by bucket-pointer refinement over content-chosen positions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import bounded_batches, store, utf8
from cellrisk.llm.hashing import BLOCK, mixed, prefix_sums, ranges

#: Strings of LENGTH bytes are looked for; buckets start from GRAM bytes; offsets of a bucket are refined in cells of CELL.
LENGTH, GRAM, CELL = 400, 32, 24
REACH = LENGTH - GRAM
_LOW = np.uint64((1 << 21) - 1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def joined(bucket: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Identifier of a refined bucket: its parent's, and those of the bytes by which it reaches further."""
    return mixed(bucket.view(np.uint64) + left * _A + right * _B)


def _shape(string: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mixed(string + first.astype(np.uint64) * _A + last.astype(np.uint64) * _B)


def pointers(data: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
    """The chosen position of each string of LENGTH bytes that begins at one of `begins` (sorted).

    It is the place of the least q-gram hash in the string, the first of equal ones: equal strings have it at equal
    offsets. Neighbouring strings that share it become one row: position `a`, first and last begin `lo` and `hi`, the
    q-gram's `bucket`, and `all`, an identifier of the bytes of all these strings and of their offsets.
    """
    sums = prefix_sums(data)
    count = len(data) - GRAM + 1
    grams = ranges(sums, np.arange(count), np.arange(GRAM, GRAM + count))
    least, width = (grams & ~_LOW) | np.arange(count, dtype=np.uint64), 1
    while width * 2 <= REACH + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < REACH + 1:
        more = REACH + 1 - width
        least = np.minimum(least[:-more], least[more:])
    at = (least[begins] & _LOW).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    lo, hi, a = begins[first], begins[np.append(first[1:], len(begins)) - 1], at[first]
    every = _shape(ranges(sums, lo, hi + LENGTH), a - hi, a - lo)
    return {"a": a, "lo": lo, "hi": hi, "bucket": grams[a].view(np.int64), "all": every.view(np.int64)}


def _stretches(texts: list[bytes]):
    """(text numbers, their offsets, bytes, begins): short texts together, long ones in blocks that overlap."""
    group, size = [], 0
    for i, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        if len(text) > BLOCK:
            for at in range(0, len(text) - LENGTH + 1, BLOCK):
                data = np.frombuffer(text, np.uint8)[at : at + BLOCK + LENGTH - 1]
                yield np.array([i]), np.array([-at]), data, np.arange(len(data) - LENGTH + 1)
            continue
        group.append(i)
        size += len(text)
        if size > BLOCK // 2:
            yield _together(texts, group)
            group, size = [], 0
    if group:
        yield _together(texts, group)


def _together(texts: list[bytes], group: list[int]):
    sizes = np.array([len(texts[i]) for i in group])
    starts = np.cumsum(sizes) - sizes
    inside = np.concatenate([np.arange(s, s + n - LENGTH + 1) for s, n in zip(starts, sizes)])
    return np.array(group), starts, np.frombuffer(b"".join(texts[i] for i in group), np.uint8), inside


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id with no nulls, a key of the row's content (rows that repeat share it), and the bytes."""
    data = docs.withColumn("_bytes", utf8())
    return data.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"), F.xxhash64(F.col("doc_id").isNull(), "_bytes").alias("k"), F.col("doc_id"), "_bytes"
    )


def _first_buckets(keyed: DataFrame) -> DataFrame:
    names = ["id", "k", "a", "lo", "hi", "bucket", "all"]

    def find(batches):
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy() for c in ("id", "k"))
            for group, starts, data, begins in _stretches(batch.column("_bytes").to_pylist()):
                found = pointers(data, begins)
                row = np.searchsorted(starts, found["lo"], side="right") - 1
                columns = [ids[group[row]], keys[group[row]], *(found[c] - starts[row] for c in ("a", "lo", "hi")), found["bucket"], found["all"]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    bounded_batches(keyed.sparkSession)
    return keyed.select("id", "k", "_bytes").mapInArrow(find, "id long, k long, a long, lo long, hi long, bucket long, all long")


def _sorted_out(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(settled, open) rows of buckets with more than one row.

    Where all strings of a row stand elsewhere as well, in the same order, it is settled: they repeat. A row alone in
    its bucket has none that repeats and goes. In buckets of several kinds of rows, one row of each kind stays open:
    it has to be refined, to find what it shares with other kinds. Counts combine map-side.
    """
    columns = ["id", "k", "a", "x", "lo", "hi"]
    kinds = rows.groupBy("bucket", "all").agg(F.count("*").alias("_n"), F.min(F.struct(*columns)).alias("_one"))
    kinds = store(kinds, "kinds")
    settled = rows.join(kinds.where("_n > 1").select("bucket", "all"), ["bucket", "all"]).select("id", "k", "lo", "hi")
    mixed_up = kinds.groupBy("bucket").agg(F.count("*").alias("_kinds")).where("_kinds > 1").drop("_kinds")
    return settled, kinds.join(mixed_up, "bucket").select("_one.*", "bucket")


def _refined(keyed: DataFrame, rows: DataFrame, finest: bool) -> DataFrame:
    """The open rows' buckets refined by the identifiers of the bytes at further offsets, read from the texts again.

    Offsets of begins before position a are cut into cells [x, y]. All strings of a cell hold the bytes from a - x to
    a - y + LENGTH: the new bucket. The finest cells are single offsets, whose bucket is the string itself.
    """
    names = ["id", "k", "a", "x", "lo", "hi", "bucket", "all"]

    def part(at: int, data: np.ndarray, r: np.ndarray):
        """Rows whose strings lie within `data`, which begins at byte `at`."""
        sums = prefix_sums(data)
        a, lo, hi, old, bucket = r["a"] - at, r["lo"] - at, r["hi"] - at, r["x"], r["bucket"]
        step = 1 if finest else CELL
        first, last = (a - hi) // step, (a - lo) // step
        n = last - first + 1
        row = np.repeat(np.arange(len(a)), n)
        x = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[row]) * step
        y = np.minimum(x + step - 1, REACH)
        a, lo, hi, old, bucket = a[row], np.maximum(lo[row], a[row] - y), np.minimum(hi[row], a[row] - x), old[row], bucket[row]
        core_begin, core_end = (a - old, a - np.minimum(old + CELL - 1, REACH) + LENGTH) if finest else (a, a + GRAM)
        left, right = ranges(sums, a - x, core_begin), ranges(sums, core_end, a - y + LENGTH)
        every = _shape(ranges(sums, lo, hi + LENGTH), a - hi, a - lo)
        return row, [a + at, x, lo + at, hi + at, joined(bucket, left, right).view(np.int64), every.view(np.int64)]

    kind = np.dtype([(c, np.int64) for c in ("a", "x", "lo", "hi", "bucket")])

    def refine(batches):
        for batch in batches:
            for text, found, i, k in zip(*(batch.column(c) for c in ("_bytes", "rows", "id", "k"))):
                values = found.values
                r = np.empty(len(values), dtype=kind)
                for c in kind.names:
                    r[c] = values.field(c).to_numpy()
                text = np.frombuffer(text.as_py(), np.uint8)
                block = r["lo"] // BLOCK
                for b in np.unique(block):
                    own = r[block == b]
                    for cut in range(0, len(own), 1 << 15):
                        mine = own[cut : cut + (1 << 15)]
                        row, columns = part(int(b) * BLOCK, text[b * BLOCK : (b + 1) * BLOCK + LENGTH + REACH], mine)
                        size = len(row)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(size, i.as_py())), pa.array(np.full(size, k.as_py())), *map(pa.array, columns)], names)

    bounded_batches(keyed.sparkSession)
    lists = rows.groupBy("id", "k").agg(F.collect_set(F.struct(*kind.names)).alias("rows"))
    with_text = keyed.select("id", "k", "_bytes").join(lists, ["id", "k"])
    return with_text.mapInArrow(refine, "id long, k long, a long, x long, lo long, hi long, bucket long, all long")


def repeats(docs: DataFrame) -> DataFrame:
    """(id, k, lo, hi): begins lo to hi of strings of LENGTH bytes that also start anywhere else; ids as in `_keyed`.

    Buckets of equal q-grams at the chosen positions come first; open ones are refined in cells of offsets, then offset
    by offset. Each level sorts only what the one before left open, and goes on from its identifiers.
    """
    keyed = _keyed(docs)
    start = store(_first_buckets(keyed).withColumn("x", F.lit(0).cast("long")), "pointers")
    settled, still = _sorted_out(start)
    cells = store(_refined(keyed, still, False), "pointers")
    more, still = _sorted_out(cells)
    single, _ = _sorted_out(store(_refined(keyed, still, True), "pointers"))
    return settled.unionByName(more).unionByName(single)


def without_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, n_bytes, `kept` (the bytes that stay) and `removed` (maximal removed runs, end exclusive).

    A byte goes when a string of LENGTH bytes over it also starts anywhere else, in another row or in its own, overlaps
    included; all strings are judged on the input. Rows that repeat are elsewhere to each other. A null text is empty;
    a text shorter than LENGTH bytes stays whole. Matches never cross rows.
    """
    marks = repeats(docs).groupBy("id", "k").agg(F.collect_set(F.struct("lo", "hi")).alias("marks"))
    names = list(dict.fromkeys(keep))
    keyed = _keyed(docs).select("id", "k") if not names else docs.select(
        *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(names)], *[x for x in ()],
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"), F.xxhash64(F.col("doc_id").isNull(), utf8()).alias("k"), utf8().alias("_bytes"),
    )
    own = [f"_keep_{i}" for i in range(len(names))]
    runs = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def cut(batches):
        for batch in batches:
            kept, removed, sizes = [], [], []
            for text, found in zip(batch.column("_bytes").to_pylist(), batch.column("marks")):
                spans = _covered(found.values) if found.is_valid else []
                out, at = [], 0
                for begin, end in spans:
                    out.append(text[at:begin])
                    at = end
                kept.append(b"".join([*out, text[at:]]))
                removed.append([{"begin": b, "end": e} for b, e in spans])
                sizes.append(len(text))
            new = [pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, runs)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in own] + new, [*own, "n_bytes", "kept", "removed"])

    bounded_batches(docs.sparkSession)
    rows = keyed.join(marks, ["id", "k"], "left").select(*own, "_bytes", "marks")
    ddl = ", ".join([f"{o} {docs.schema[c].dataType.simpleString()}" for o, c in zip(own, names)] + ["n_bytes long, kept binary, removed array<struct<begin:bigint,end:bigint>>"])
    out = rows.mapInArrow(cut, ddl)
    return out.select(*[F.col(o).alias(c) for o, c in zip(own, names)], "n_bytes", "kept", "removed")


def _covered(marks) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the marked strings cover."""
    lo, hi = marks.field("lo").to_numpy(), marks.field("hi").to_numpy() + LENGTH
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    first = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    return list(zip(lo[first].tolist(), hi[np.append(first[1:], len(lo)) - 1].tolist()))
