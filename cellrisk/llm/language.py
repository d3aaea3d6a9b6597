"""Language ID: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import bounded_batches, spare

BUCKETS = 1 << 16
GRAMS = (1, 2, 3)
UNKNOWN = "und"
_KNOWN_LETTERS = 0x3000
_LETTER = np.array([chr(i).isalpha() for i in range(_KNOWN_LETTERS)])


def held_out(col: str = "doc_id") -> Column:
    """Rows kept for measuring; a null id is not among them."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def gram_buckets(texts: list[str], seen: list[int] | None = None):
    """For each n the buckets of all n-grams of lower-case letters, and the place where each text's begin.

    `seen` tells how many characters a part of a text shares with the part before it; n-grams within those were
    counted there. What is no letter counts as a space, and n-grams with two spaces in a row are left out. Characters from
    U+3000 on count as letters.
    """
    low = [t.lower() for t in texts]
    at = np.cumsum([0] + [len(t) + 1 for t in low])
    points = np.frombuffer((" ".join(low) + " ").encode("utf-32-le"), dtype=np.uint32) if low else np.zeros(0, np.uint32)
    letter = np.where(points < _KNOWN_LETTERS, _LETTER[np.minimum(points, _KNOWN_LETTERS - 1)], True)
    points = np.where(letter, points, 32).astype(np.uint64)
    again = [(at[i], k) for i, k in enumerate(seen or []) if k]
    pair = np.zeros(len(points), dtype=bool)
    pair[:-1] = ~letter[:-1] & ~letter[1:]
    code, bad = np.zeros(len(points), dtype=np.uint64), np.zeros(len(points), dtype=bool)
    for n in range(1, max(GRAMS) + 1):
        size = len(points) - n + 1
        if size <= 0:
            return
        code, bad = code[:size] * np.uint64(0x1000193) + points[n - 1 :], bad[:size]
        if n > 1:
            bad = bad | pair[n - 2 : n - 2 + size]
        if n in GRAMS:
            mix = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            bucket = (mix >> np.uint64(48)).astype(np.int64)
            skip = ~letter[:size] if n == 1 else bad.copy()
            for begin, k in again:
                skip[begin : begin + max(0, k - n + 1)] = True
            keep = np.flatnonzero(~skip)
            yield bucket[keep], np.searchsorted(keep, at[:-1])


def _batches(texts: list[str], limit: int = 1 << 20):
    """Runs of (text number, part, characters shared with the part before) of about `limit` characters each."""
    run, size = [], 0
    for i, text in enumerate(texts):
        for k in range(0, max(1, len(text)), limit):
            shared = min(k, max(GRAMS) - 1)
            part = text[k - shared : k + limit]
            if run and size + len(part) > limit:
                yield run
                run, size = [], 0
            run.append((i, part, shared))
            size += len(part)
    if run:
        yield run


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n): counts over all rows with a text and a lang. Each task adds up before it sends."""

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lang in set(langs):
                total = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                own = [t for t, x in zip(texts, langs) if x == lang]
                for run in _batches(own):
                    for buckets, _ in gram_buckets([x[1] for x in run], [x[2] for x in run]):
                        total += np.bincount(buckets, minlength=BUCKETS)
        for lang, total in sums.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(some), pa.string()), "bucket": pa.array(some.astype(np.int32)), "n": pa.array(total[some])})

    bounded_batches(labelled.sparkSession)
    rows = labelled.where("text is not null and lang is not null").select("lang", "text")
    counts = rows.mapInArrow(count, "lang string, bucket int, n long")
    return counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, alpha: float = 0.5) -> tuple[list[str], np.ndarray]:
    """(languages, log-probability matrix [language, bucket], the last column the log prior).

    Counts cover all labelled rows; only languages x buckets of them reach the driver.
    """
    docs = {r[0]: r[1] for r in labelled.where("text is not null and lang is not null").groupBy("lang").count().collect()}
    langs = sorted(docs)
    logs = np.zeros((len(langs), BUCKETS + 1))
    if not langs:
        return langs, logs
    counts = gram_counts(labelled).toPandas()
    logs[counts["lang"].map(langs.index).to_numpy(dtype=int), counts["bucket"].to_numpy(dtype=int)] = counts["n"].to_numpy()
    logs[:, :BUCKETS] += alpha
    logs[:, :BUCKETS] = np.log(logs[:, :BUCKETS] / logs[:, :BUCKETS].sum(axis=1, keepdims=True))
    logs[:, BUCKETS] = np.log(np.array([docs[x] for x in langs]) / sum(docs.values()))
    return langs, logs


def score_texts(texts: list[str], logs: np.ndarray) -> np.ndarray:
    """Log score [text, language]: the batch's sparse n-gram counts times the log-probability matrix.

    Each occurrence is one entry of the sparse matrix; its product is a gather and a sum by text.
    """
    out = np.tile(logs[:, BUCKETS], (len(texts), 1))
    for run in _batches(texts):
        rows = np.array([x[0] for x in run])
        for buckets, begin in gram_buckets([x[1] for x in run], [x[2] for x in run]):
            if not len(buckets):
                continue
            for k in range(logs.shape[0]):
                sums = np.concatenate([[0.0], np.cumsum(logs[k].take(buckets))])
                np.add.at(out[:, k], rows, sums[np.append(begin[1:], len(buckets))] - sums[begin])
    return out


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """Adds lang_pred and score (the posterior of that language) to every row, by its whole text alone.

    A null text, or one without a letter, is `und` with score 0, and so is every text if nothing was learned.
    Equal scores go to the language that comes first by name. Columns named lang_pred or score are replaced.
    """
    langs, logs = model
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(logs))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def guess(batches):
        letter = regex.compile(r"\p{L}").search
        for batch in batches:
            texts = batch.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if langs and t and letter(t)]
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known:
                found = score_texts([texts[i] for i in known], shared.value)
                best = found.argmax(axis=1)
                top = 1 / np.exp(found - found.max(axis=1, keepdims=True)).sum(axis=1)
                for i, k, p in zip(known, best, top):
                    names[i], scores[i] = langs[k], p
            columns = [batch.column(c) for c in kept] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "lang_pred", "score"])

    bounded_batches(docs.sparkSession)
    ddl = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + ["lang_pred string", "score double"])
    return docs.select(*kept).mapInArrow(guess, ddl)


def identify(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, held_out, lang_pred and score for every row; learned from the rows that are not held out.

    Only text and lang of those rows are learned from, only text decides a prediction.
    """
    model = fit(docs.where(~held_out()).select("lang", "text"))
    return predict(docs.select(*keep, held_out().alias("held_out"), "text"), model).drop("text")


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows whose language is known with a posterior of at least `least`, with the columns they came with."""
    model = fit(docs.where(~held_out()).select("lang", "text"))
    # Columns that predict would replace stand aside under names of their own.
    clash = [c for c in docs.columns if c.lower() in ("lang_pred", "score")]
    aside = dict(zip(clash, spare(docs, *clash)))
    known = predict(docs.withColumnsRenamed(aside), model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return known.drop("lang_pred", "score").withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)
