"""Toxicity: cumulative-link ordinal regression over sparse text features."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import bounded_batches, narrowed, store
from cellrisk.llm.hashing import LETTERS, mixed, words

BUCKETS = 1 << 18
#: Stems are the first so many bytes of a word; a word as a whole is a feature too.
STEMS = (4, 5, 6)
#: Bounds of the model, whatever the data: features with a weight, and labelled rows that the weights are fitted on.
FEATURES = 4096
FITTED_ROWS = 20_000


def occurrences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket) of every word and stem of lower-case letters in each text, and words per text."""
    rows, buckets, sizes = [], [], np.zeros(len(texts), dtype=np.int64)
    for part in _groups(texts):
        coded = [(texts[i] or "").lower().encode() + b" " for i in part]
        data = b"".join(coded)
        begin, end, whole = words(data, LETTERS)
        row = np.array(part)[np.searchsorted(np.cumsum(list(map(len, coded))), begin, side="right")]
        sizes += np.bincount(row, minlength=len(texts))
        rows.append(row)
        buckets.append(whole % np.uint64(BUCKETS))
        plain = np.frombuffer(data, np.uint8)
        for size in STEMS:
            longer = np.flatnonzero(end - begin >= size)
            packed = np.full(len(longer), size, dtype=np.uint64)
            for k in range(size):
                packed = packed << np.uint64(8) | plain[begin[longer] + k]
            rows.append(row[longer])
            buckets.append(mixed(packed) % np.uint64(BUCKETS))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), sizes
    return np.concatenate(rows).astype(np.int64), np.concatenate(buckets).astype(np.int64), sizes


def _groups(texts, limit: int = 1 << 20):
    part, size = [], 0
    for i, text in enumerate(texts):
        if part and size + len(text or "") > limit:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(text or "")
    if part:
        yield part


def _distinct(rows: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, n = np.unique(rows * BUCKETS + buckets, return_counts=True)
    return key // BUCKETS, key % BUCKETS, n


def feature_counts(labelled: DataFrame, flag: str) -> DataFrame:
    """(bucket, marked, plain): in how many rows with and without the flag each feature occurs, over all rows."""

    def count(batches):
        sums = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            flags = np.array(batch.column(flag).to_pylist(), dtype=bool)
            rows, buckets, _ = occurrences(batch.column("text").to_pylist())
            rows, buckets, _ = _distinct(rows, buckets)
            for k in (0, 1):
                sums[k] += np.bincount(buckets[flags[rows] == bool(k)], minlength=BUCKETS)
        some = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some.astype(np.int32)), "marked": pa.array(sums[1][some]), "plain": pa.array(sums[0][some])})

    bounded_batches(labelled.sparkSession)
    counts = labelled.select("text", flag).mapInArrow(count, "bucket int, marked long, plain long")
    return counts.groupBy("bucket").agg(F.sum("marked").alias("marked"), F.sum("plain").alias("plain"))


def choose(counts: DataFrame, marked: int, plain: int, most: int = FEATURES) -> np.ndarray:
    """Buckets of the features that tell the two kinds of rows apart best, by a two-proportion z score over 4."""
    p, q = F.col("marked") / F.lit(max(1, marked)), F.col("plain") / F.lit(max(1, plain))
    both = (F.col("marked") + F.col("plain")) / F.lit(max(1, marked + plain))
    spread = F.sqrt(both * (1 - both) * (1 / max(1, marked) + 1 / max(1, plain)))
    z = F.abs(p - q) / F.when(spread > 0, spread)
    top = counts.withColumn("z", z).where("z > 4").orderBy(F.desc("z"), "bucket").limit(most)
    return np.array(sorted(r["bucket"] for r in top.select("bucket").collect()), dtype=np.int64)


def sparse_rows(docs: DataFrame, keep: list[str], chosen: np.ndarray) -> DataFrame:
    """`keep` columns, n_words, and arrays `at` and `n`: the chosen features of each whole text and their counts."""
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def rows_of(batches):
        for batch in batches:
            rows, buckets, sizes = occurrences(batch.column("_text").to_pylist())
            at = shared.value[buckets]
            rows, at, n = _distinct(rows[at >= 0], at[at >= 0].astype(np.int64))
            cuts = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(cuts), pa.array(values, kind))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(sizes), lists(at.astype(np.int32), pa.int32()), lists(n.astype(np.float64), pa.float64())],
                [*keep, "n_words", "at", "n"],
            )

    bounded_batches(docs.sparkSession)
    ddl = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + ["n_words long", "at array<int>", "n array<double>"])
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(rows_of, ddl)


def fit_ordinal(at: list, n: list, grade: np.ndarray, features: int, grades: int, rounds: int = 600, ridge: float = 1e-5):
    """(weights, thresholds) of P(y <= k) = sigmoid(threshold_k - w x), x = log(1 + count), by gradient descent.

    One weight per feature for all thresholds. Thresholds stay in order because all but the first are stored as
    logarithms of their steps. Adam steps over all rows, so the result does not depend on the order of the rows.
    """
    row = np.repeat(np.arange(len(at)), [len(x) for x in at])
    col = np.concatenate([np.asarray(x, dtype=np.int64) for x in at]) if len(row) else np.zeros(0, np.int64)
    val = np.log1p(np.concatenate([np.asarray(x, dtype=float) for x in n])) if len(row) else np.zeros(0)
    share = np.clip(np.cumsum(np.bincount(grade, minlength=grades))[:-1] / max(1, len(grade)), 1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    free = np.concatenate([[first[0]], np.log(np.maximum(np.diff(first), 1e-2)), np.zeros(features)])
    m, v = np.zeros_like(free), np.zeros_like(free)
    for step in range(1, rounds + 1):
        theta = np.cumsum(np.concatenate([[free[0]], np.exp(free[1 : grades - 1])]))
        w = free[grades - 1 :]
        score = np.bincount(row, weights=val * w[col], minlength=len(at))
        below = 1 / (1 + np.exp(-np.clip(theta[None, :] - score[:, None], -40, 40)))
        low = np.concatenate([np.zeros((len(at), 1)), below], axis=1)[np.arange(len(at)), grade]
        high = np.concatenate([below, np.ones((len(at), 1))], axis=1)[np.arange(len(at)), grade]
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        by_score = (d_high - d_low) / max(1, len(at))  # of the loss, by w x
        by_theta = np.zeros(grades - 1)
        for k in range(grades - 1):
            by_theta[k] = (np.where(grade == k + 1, d_low, 0).sum() - np.where(grade == k, d_high, 0).sum()) / max(1, len(at))
        tail = np.cumsum(by_theta[::-1])[::-1]
        grad = np.concatenate([[tail[0]], tail[1:] * np.exp(free[1 : grades - 1]), np.bincount(col, weights=val * by_score[row], minlength=features) + ridge * w])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        free = free - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return free[grades - 1 :], np.cumsum(np.concatenate([[free[0]], np.exp(free[1 : grades - 1])]))


def grade_probabilities(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    below = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - score[:, None], -40, 40)))
    edges = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
    return np.diff(edges, axis=1)


def severity_model(docs: DataFrame, labels: DataFrame, most_rows: int = FITTED_ROWS) -> dict:
    """Weights, thresholds and chosen features, learned from the rows of `labels` that say toxic or not.

    Grade 0 is not toxic. A toxic row has grade 1 or 2: 2 where marked words are at least as dense as in the median
    toxic row. Which features are marked is counted over all labelled rows; the weights are fitted on those
    `most_rows` with the smallest hash of doc_id. A row with a null id, label or text teaches nothing. With
    one kind of rows only, nothing is toxic, or everything.
    """
    flags = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("_toxic"))
    flags = store(flags, "flags")
    # Texts without a label stay where they are; the others meet their labels in one shuffle at any size.
    texts = docs.where("text is not null").select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    known = store(narrowed(texts, "doc_id", flags, "doc_id", flags.count()).join(flags.hint("merge"), "doc_id"), "toxic")
    sizes = {r[0]: r[1] for r in known.groupBy("_toxic").count().collect()}
    marked, plain = sizes.get(True, 0), sizes.get(False, 0)
    chosen = choose(feature_counts(known, "_toxic"), marked, plain)
    # Numbers of rows are sorted, not texts; those picked are `most_rows` at most.
    picked = known.select("doc_id", "_row").orderBy(F.xxhash64("doc_id"), "doc_id", "_row").limit(most_rows).select("_row")
    sample = known.join(F.broadcast(picked), "_row", "left_semi")
    got = sparse_rows(sample, ["_row", "_toxic"], chosen).toPandas().sort_values("_row")
    toxic = got["_toxic"].to_numpy(dtype=bool)
    density = np.array([sum(x) for x in got["n"]], dtype=float) / np.maximum(got["n_words"].to_numpy(dtype=float), 1)
    middle = np.median(density[toxic]) if toxic.any() else 0.0
    grade = np.where(toxic, 1 + (density >= middle), 0).astype(np.int64)
    if not toxic.any() or toxic.all():
        return {"chosen": chosen[:0], "weights": np.zeros(0), "thresholds": np.array([-30.0, 30.0] if toxic.any() else [30.0, 60.0])}
    weights, thresholds = fit_ordinal(list(got["at"]), list(got["n"]), grade, len(chosen), 3)
    return {"chosen": chosen, "weights": weights, "thresholds": thresholds}


def grade_texts(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, severity (expected grade), grade (the likeliest), p_toxic and toxic of every whole text.

    A null or blank text has no feature and gets what the thresholds alone give: not toxic.
    """
    names, shared = list(keep), docs.sparkSession.sparkContext.broadcast((model["weights"], model["thresholds"]))

    def score(batches):
        for batch in batches:
            weights, thresholds = shared.value
            at, n = batch.column("at"), batch.column("n")
            row = np.repeat(np.arange(batch.num_rows), np.diff(at.offsets.to_numpy()))
            value = np.log1p(n.flatten().to_numpy()) * weights[at.flatten().to_numpy()] if len(row) else np.zeros(0)
            p = grade_probabilities(np.bincount(row, weights=value, minlength=batch.num_rows), thresholds)
            new = [pa.array(p @ np.arange(p.shape[1])), pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(1 - p[:, 0]), pa.array(p[:, 0] < 0.5)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + new, [*names, "severity", "grade", "p_toxic", "toxic"])

    ddl = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names] + ["severity double, grade int, p_toxic double, toxic boolean"])
    return sparse_rows(docs, names, model["chosen"]).mapInArrow(score, ddl)
