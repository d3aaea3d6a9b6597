"""Byte-level BPE by prefix dynamic programming: each byte prefix has one valid last token."""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import map_batches

#: Distinct pieces whose ids a Python worker remembers; beyond, it forgets those not met since the last time.
REMEMBERED = 300_000
#: Prefixes and pairs of tokens that it remembers; beyond, it forgets all. And the bytes up to which pieces share their prefixes.
STORED = 600_000
SHARED = 64
#: Tokens are looked for by the last so many bytes of a prefix.
ENDING = 4


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file with a base64 token and a rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def adjacent(a: int, b: int, halves: list, joined: dict) -> bool:
    """Whether tokens a, b may stand side by side: merging the bytes of both again gives just these two.

    The merges that made the two tokens are taken back, latest first. At each point the two parts that touch must
    not have a merge of their own that would have come earlier than those already taken back.
    """
    top = 1 << 60
    while True:
        own = joined.get((a, b))
        if own is not None and own < top:
            return False
        if a > b:
            top, parts = a, halves[a]
            if parts is None:
                top, parts = b + 1, halves[b]
                if parts is None:
                    return True
                b = parts[0]
            else:
                a = parts[1]
        else:
            top, parts = b + 1, halves[b]
            if parts is None:
                top, parts = a, halves[a]
                if parts is None:
                    return True
                a = parts[1]
            else:
                b = parts[0]


def merge_tables(ranks: dict[bytes, int]) -> dict:
    """What encoding needs, built once: bytes by id, the halves of each token, the id of each such pair, and the
    lengths of tokens by their last bytes. `known` and `fits` remember pieces and pairs while a worker runs.

    Tokens come in the order of their ranks; the halves of a token are the one cut into earlier tokens that may
    stand side by side before the token exists. Bytes, and tokens that no merge reaches, have none.
    """
    size = max(ranks.values(), default=-1) + 1
    halves: list = [None] * size
    joined: dict = {}
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        for cut in range(len(token) - 1, 0, -1):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None and a < rank and b < rank and adjacent(a, b, halves, joined):
                halves[rank], joined[a, b] = (a, b), rank
                break
    texts: list = [b""] * size
    for token, rank in ranks.items():
        texts[rank] = token
    longer: dict[bytes, set[int]] = {}
    for token in ranks:
        if len(token) > ENDING:
            longer.setdefault(token[-ENDING:], set()).add(len(token))
    ends = {end: tuple(sorted(found, reverse=True)) for end, found in longer.items()}
    return {"ranks": ranks, "texts": texts, "halves": halves, "joined": joined, "longer": ends, "ends": {}, "known": {}, "before": {}, "lasts": {}, "fits": {}}


def ending(end: bytes, tables: dict) -> tuple[int, ...]:
    """Lengths, longest first, that a token may have at the end of a prefix whose last bytes (`ENDING` at most) are `end`."""
    found = tables["ends"].get(end)
    if found is None:
        if len(tables["ends"]) >= STORED:
            tables["ends"].clear()
        short = tuple(n for n in range(len(end), 0, -1) if end[-n:] in tables["ranks"])
        found = tables["ends"][end] = tables["longer"].get(end, ()) + short
    return found


class Prefixes:
    """Encodes a growing string: `last[i]` is the last token of the encoding of the first i bytes.

    For each prefix exactly one token both ends it and may follow the last token of what is before it. So an
    append only adds entries, cutting back only drops some, and an edit is coded again from its place on; all of
    them give the ids of the whole string coded at once.
    """

    def __init__(self, tables: dict):
        self.tables, self.data, self.last = tables, bytearray(), [-1]

    def append(self, more: bytes) -> None:
        t = self.tables
        rank_of, halves, joined, fits, last = t["ranks"].get, t["halves"], t["joined"], t["fits"], self.last
        self.data += more
        data = bytes(self.data)
        for end in range(len(last), len(data) + 1):
            for length in ending(data[max(0, end - ENDING) : end], t):
                begin = end - length
                if begin < 0:
                    continue
                token = rank_of(data[begin:end])
                if token is None:
                    continue
                if not begin:
                    break
                pair = last[begin] << 32 | token
                ok = fits.get(pair)
                if ok is None:
                    if len(fits) > 1_000_000:
                        fits.clear()
                    ok = fits[pair] = adjacent(last[begin], token, halves, joined)
                if ok:
                    break
            else:
                raise ValueError(f"the vocabulary has no token for byte {data[end - 1]}")
            last.append(token)

    def cut(self, size: int) -> None:
        """Keep the first `size` bytes."""
        del self.data[size:], self.last[size + 1 :]

    def replace(self, begin: int, end: int, by: bytes) -> None:
        """Put `by` in the place of bytes begin to end; what lies before is not coded again."""
        rest = bytes(self.data[end:])
        self.cut(begin)
        self.append(by + rest)

    def ids(self) -> list[int]:
        out, end, texts = [], len(self.data), self.tables["texts"]
        while end:
            out.append(self.last[end])
            end -= len(texts[out[-1]])
        return out[::-1]


def encode_piece(piece: bytes, tables: dict) -> tuple[int, ...]:
    """Ids of one match of the pattern. A piece that is a token is that token, as in the public libraries.

    Pieces share their prefixes' last tokens in `tables["lasts"]`: only the prefixes that no earlier piece had
    are worked out. Long pieces, whose prefixes are hardly shared, keep theirs to themselves.
    """
    whole = tables["ranks"].get(piece)
    if whole is not None:
        return (whole,)
    if len(piece) > SHARED:
        coder = Prefixes(tables)
        coder.append(piece)
        return tuple(coder.ids())
    lasts, fits, rank_of, ends = tables["lasts"], tables["fits"], tables["ranks"].get, tables["ends"].get
    if len(lasts) > STORED:
        lasts.clear()
    if len(fits) > STORED:
        fits.clear()
    size = len(piece)
    have = size
    while have and piece[:have] not in lasts:
        have -= 1
    for end in range(have + 1, size + 1):
        prefix = piece[:end]
        for length in ends(prefix[-ENDING:]) or ending(prefix[-ENDING:], tables):
            token = rank_of(prefix[-length:]) if length <= end else None
            if token is None:
                continue
            if length == end:
                break
            pair = lasts[prefix[:-length]] << 32 | token
            ok = fits.get(pair)
            if ok is None:
                ok = fits[pair] = adjacent(pair >> 32, token, tables["halves"], tables["joined"])
            if ok:
                break
        else:
            raise ValueError(f"the vocabulary has no token for byte {prefix[-1]}")
        lasts[prefix] = token
    out, texts = [], tables["texts"]
    while size:
        token = lasts[piece[:size]]
        out.append(token)
        size -= len(texts[token])
    return tuple(out[::-1])


def encode_text(text: str, matches, tables: dict) -> list[int]:
    """Ids of a whole text; `matches` finds the pattern's pieces, each coded by itself.

    Pieces are remembered in two generations: when the newer is full, it becomes the older, and what was met in neither goes.
    """
    known, before, out = tables["known"], tables["before"], []
    for piece in matches(text):
        ids = known.get(piece)
        if ids is None:
            if len(known) >= REMEMBERED:
                tables["before"], tables["known"] = known, {}
                known, before = tables["known"], known
            ids = before.get(piece)
            if ids is None:
                ids = encode_piece(piece.encode("utf-8", "surrogatepass"), tables)
            if len(piece) <= 64:
                known[piece] = ids
        out.extend(ids)
    return out


def decode_ids(ids: list[int], tables: dict) -> bytes:
    return b"".join(map(tables["texts"].__getitem__, ids))


def encode(docs: DataFrame, vocabulary: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep` columns and `ids` array<int>: the whole text's token ids. A null or empty text has none.

    The vocabulary file is read by the driver and broadcast; its size is that of the file, whatever the data.
    """
    return _coded(docs, vocabulary, pattern, keep, text, "ids array<int>", lambda rows, tables: [pa.array(rows, pa.list_(pa.int32()))])


def decode(coded: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns and `bytes`: the bytes that `ids` stand for; null ids give no bytes."""
    tables = coded.sparkSession.sparkContext.broadcast({"texts": merge_tables_texts(read_ranks(vocabulary))})
    names = list(keep)

    def back(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [decode_ids(ids or [], tables.value) for ids in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(found, pa.binary())], [*names, "bytes"])

    ddl = ", ".join([f"`{c}` {coded.schema[c].dataType.simpleString()}" for c in names] + ["bytes binary"])
    return map_batches(coded.select(*names, "ids"), back, ddl)


def merge_tables_texts(ranks: dict[bytes, int]) -> list[bytes]:
    texts: list = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        texts[rank] = token
    return texts


def digests(docs: DataFrame, vocabulary: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep` columns, n_tokens, ids_sha256 and decoded_sha256 of the whole text, coded and decoded in one pass."""

    def columns(rows, tables):
        sha = lambda data: hashlib.sha256(data).hexdigest()
        decimal = (tables.get("decimals") or tables.setdefault("decimals", list(map(str, range(len(tables["texts"])))))).__getitem__
        return [
            pa.array(list(map(len, rows)), pa.int64()),
            pa.array([sha(",".join(map(decimal, ids)).encode()) for ids in rows], pa.string()),
            pa.array([sha(decode_ids(ids, tables)) for ids in rows], pa.string()),
        ]

    return _coded(docs, vocabulary, pattern, keep, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", columns)


def _coded(docs: DataFrame, vocabulary: str, pattern: str, keep: tuple[str, ...], text: str, ddl: str, columns) -> DataFrame:
    tables = docs.sparkSession.sparkContext.broadcast(merge_tables(read_ranks(vocabulary)))
    names = list(keep)

    def code(batch: pa.RecordBatch) -> pa.RecordBatch:
        matches = regex.compile(pattern).findall
        rows = [encode_text(t, matches, tables.value) if t else [] for t in batch.column("_text").to_pylist()]
        new = columns(rows, tables.value)
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in names] + new, [*names, *(x.split()[0] for x in ddl.split(", "))]
        )

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return map_batches(docs.select(*names, F.col(text).alias("_text")), code, f"{kept}, {ddl}" if kept else ddl)
