"""Secrets: fixed patterns, and strings near sensitive words that a primed compressor cannot shorten."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import map_batches

# The base patterns and their least lengths, in the order of the kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "novel")
SENSITIVE = re.compile(r"password|passwd|secret|token|api_?key|credential|private_?key|bearer|authorization", re.I | re.A)

_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST = 16
_IN_RUN = re.compile(r"[A-Za-z0-9+/_=-]")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
_WORD = re.compile(r"[A-Za-z_]{4,24}")

#: How far after a sensitive word a candidate may begin, or before one end, and how much code on either side primes the compressor.
REACH = 64
AROUND = 256
#: A candidate is reported when it adds at least this many compressed bytes per character.
NOVELTY = 0.7
#: Identifiers of the dictionary, so its size is bounded: at most 24 bytes each.
IDENTIFIERS = 2000


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(begin, end, kind) of the fixed patterns: leftmost and not overlapping within a kind."""
    found = []
    low = text.lower()
    if any(word in low for word in ("passw", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # Runs are maximal, so asking for the least length right away finds the same ones.
    found += [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]
    return found


def sensitive(text: str) -> bool:
    """Whether any sensitive word may occur: a plain search, much faster than the pattern."""
    low = text.lower()
    return any(w in low for w in ("passw", "secret", "token", "api", "credential", "private", "bearer", "authorization"))


def candidates(text: str) -> list[tuple[int, int]]:
    """Long runs without white space that begin within `REACH` characters after a sensitive word, or end as near before one.

    They hold a digit or both cases. What begins within a run already looked at belongs to that run.
    """
    found, seen = [], 0

    def look(begin: int, limit: int, end: int) -> None:
        """Take the runs of text[:end] that begin from `begin` on and before `limit`."""
        nonlocal seen
        while begin < limit and (run := _RUN.search(text, begin, min(end, limit + SHORTEST - 1))):
            begin = seen = _RUN.match(text, run.start(), end).end()
            if re.search("[0-9]|[a-z].*[A-Z]|[A-Z].*[a-z]", text[run.start() : seen]):
                found.append((run.start(), seen))

    for word in SENSITIVE.finditer(text) if sensitive(text) else ():
        back = max(seen, word.start() - REACH)
        while seen < back < word.start() and _IN_RUN.match(text, back - 1):
            back -= 1
        look(back, word.start(), word.start())
        look(max(word.end(), seen), word.end() + REACH + 1, len(text))
    return found


def marginal_bytes(text: str, begin: int, end: int, dictionary: zstandard.ZstdCompressionDict) -> int:
    """Compressed bytes that text[begin:end] adds to the code around it, the dictionary known to the compressor."""
    press = zstandard.ZstdCompressor(level=19, dict_data=dictionary, write_content_size=False, write_dict_id=False)
    before, after = text[max(0, begin - AROUND) : begin], text[end : end + AROUND]
    size = lambda s: len(press.compress(s.encode()))
    return size(before + after + text[begin:end]) - size(before + after)


def spans(text: str, dictionary: zstandard.ZstdCompressionDict) -> list[tuple[int, int, str]]:
    """All spans by begin, then kind. A novel one that meets a base span is not told again."""
    base = base_spans(text)
    for begin, end in candidates(text):
        if any(b < end and begin < e for b, e, _ in base):
            continue
        if marginal_bytes(text, begin, end, dictionary) >= NOVELTY * (end - begin):
            base.append((begin, end, "novel"))
    return sorted(base, key=lambda s: (s[0], KINDS.index(s[2])))


def identifiers(docs: DataFrame, text: str = "text", most: int = IDENTIFIERS) -> list[str]:
    """The words of letters and `_` that stand around sensitive words in most texts, most frequent last.

    Counted over all texts, once per text; words within candidates do not count. A compressor reaches what stands
    last in a dictionary most cheaply.
    """

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums: dict[str, int] = {}
        for value in batch.column("text").to_pylist():
            seen = set()
            if value and sensitive(value):
                skip = None
                for m in SENSITIVE.finditer(value):
                    if skip is None:
                        skip = candidates(value)
                    for w in _WORD.finditer(value, max(0, m.start() - AROUND), min(len(value), m.end() + AROUND)):
                        if not any(b < w.end() and w.start() < e for b, e in skip):
                            seen.add(w.group())
            for w in seen:
                sums[w] = sums.get(w, 0) + 1
        return pa.RecordBatch.from_pydict({"word": pa.array(list(sums), pa.string()), "n": pa.array(list(sums.values()), pa.int64())})

    counts = map_batches(docs.select(F.col(text).alias("text")), words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.where("n > 1").orderBy(F.desc("n"), "word").limit(most).collect()
    return [r["word"] for r in reversed(top)]


def _dictionary(words: list[str]) -> zstandard.ZstdCompressionDict:
    raw = " ".join(words).encode() or b"password secret token api_key"
    return zstandard.ZstdCompressionDict(raw.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", known: list[str] | None = None) -> DataFrame:
    """`keep` columns and `found` array of (begin, end, kind) over whole texts, in code points, end exclusive.

    A null or empty text has an empty array. `known` gives the identifier dictionary; by default it comes from
    `docs` itself.
    """
    words = identifiers(docs, text) if known is None else known
    names = list(keep)
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        dictionary = _dictionary(words)
        rows = [[dict(zip(("begin", "end", "kind"), s)) for s in spans(t, dictionary)] if t else [] for t in batch.column("_text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(rows, kind)], [*names, "found"])

    ddl = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names] + ["found array<struct<begin:bigint,end:bigint,kind:string>>"])
    return map_batches(docs.select(*names, F.col(text).alias("_text")), find, ddl)


def report(found: DataFrame) -> DataFrame:
    """Counts by kind, all spans as kind:start:end joined by commas, and the digest of the base ones."""
    line = lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("found", lambda s: s["kind"] != "novel")
    return found.select(
        *[c for c in found.columns if c != "found"], *[count(k) for k in KINDS],
        F.sha2(F.array_join(F.transform(base, line), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("found", line), ",").alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """All rows with every span of the text replaced by `mark`, overlapping spans by one; n_chars, if there, follows.

    Other columns, null texts and texts without a span stay as they are.
    """
    words = identifiers(docs)
    names = docs.columns

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        dictionary, texts = _dictionary(words), batch.column("text").to_pylist()
        for i, text in enumerate(texts):
            for begin, end in _merged(spans(text, dictionary))[::-1] if text else []:
                texts[i] = texts[i][:begin] + mark + texts[i][end:]
        columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
        return pa.RecordBatch.from_arrays(columns, names)

    ddl = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    out = map_batches(docs, clean, ddl)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*names)


def _merged(found: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end, _ in sorted(found):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]
