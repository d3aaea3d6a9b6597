"""BPE encoding and decoding with content-defined chunks: a chunk that many documents share is encoded once."""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import map_batches
from cellrisk.llm.hashing import BLOCK, _BYTES

#: A cut depends on so many bytes before it. Chunks have about `MEAN` bytes, more than `LEAST` and at most `MOST`.
WINDOW, LEAST, MEAN, MOST = 32, 128, 1024, 8192
#: A piece is settled by its own characters and at most so many after its end.
LOOK = 8
#: Chunks and pieces a Python worker remembers in each of two generations; longer pieces are not remembered.
CHUNKS, PIECES, SHORT = 10_000, 300_000, 64

#: The pattern of the byte-level pre-tokenizer (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def cuts(data: bytes) -> list[int]:
    """Byte offsets of the chunks of a text, 0 and its length included, always between characters.

    A rolling hash of the last `WINDOW` bytes decides where a chunk may end, so a passage is cut alike wherever it
    stands, up to a chunk or two at its beginning.
    """
    found, before = [0], np.zeros(0, np.uint8)
    plain = np.frombuffer(data, np.uint8)
    spots = []
    for begin in range(0, len(data), BLOCK):
        part = np.concatenate([before, plain[begin : begin + BLOCK]])
        if len(part) < WINDOW:
            break
        rolled, step, factor = (_BYTES[part] >> np.uint64(32)).astype(np.uint32), 1, 0x9E3779B1
        while step < WINDOW:
            rolled = rolled[step:] + rolled[:-step] * np.uint32(factor)
            step, factor = step * 2, factor * factor % (1 << 32)
        rolled ^= rolled >> np.uint32(15)
        spots.append(np.flatnonzero(rolled * np.uint32(0x85EBCA6B) >> np.uint32(16) < np.uint32(65536 // MEAN)) + (begin - len(before) + WINDOW))
        before = part[1 - WINDOW :]
    for spot in np.concatenate(spots).tolist() if spots else ():
        while spot < len(data) and data[spot] & 0xC0 == 0x80:
            spot += 1
        while spot - found[-1] > MOST:
            found.append(_whole(data, found[-1] + MOST))
        if spot - found[-1] > LEAST and spot < len(data):
            found.append(spot)
    while len(data) - found[-1] > MOST:
        found.append(_whole(data, found[-1] + MOST))
    return [*found, len(data)] if data else [0]


def _whole(data: bytes, at: int) -> int:
    while data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others in order from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def _unsettled() -> re.Pattern:
    """Characters that Unicode 3.2 had not assigned: on those, libraries of different age may see different classes."""
    late = [c for c in range(0x110000) if unicodedata.ucd_3_2_0.category(chr(c)) == "Cn" or 0xD800 <= c < 0xE000]
    runs, start = [], late[0]
    for a, b in zip(late, [*late[1:], -1]):
        if b != a + 1:
            runs.append((start, a))
            start = b
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]")


def specification(path: str, special: bool = True) -> dict:
    """What workers need of a tokenizer file: its text and the strings that are tokens as such (none if not `special`).

    Only byte-level BPE that splits by its usual pattern is known here; another file is refused.
    """
    with open(path, encoding="utf-8") as file:
        text = file.read()
    told = json.loads(text)
    split, model = told.get("pre_tokenizer") or {}, told.get("model") or {}
    fit = told.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    plain = model.get("type") == "BPE" and not model.get("dropout") and (told.get("decoder") or {}).get("type") == "ByteLevel"
    added = told.get("added_tokens") or []
    odd = [t for t in added if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized")]
    if not fit or not plain or odd:
        raise ValueError("only a byte-level BPE without normalizer, dropout or stripping added tokens is handled")
    return {"text": text, "added": {t["content"]: t["id"] for t in added} if special else {}, "special": special}


class Coder:
    """Encodes whole texts chunk by chunk, and remembers chunks and pieces. Lives as long as its Python worker."""

    def __init__(self, told: dict):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(told["text"])
        self.library.encode_special_tokens = True  # those that count have been cut out before
        self.library.no_truncation()
        self.library.no_padding()
        self.added = told["added"]
        names = sorted(self.added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, names)) + ")").split if names else None
        self.matches, self.unsettled = regex.compile(PATTERN).findall, _unsettled().search
        vocabulary, byte = self.library.get_vocab(with_added_tokens=True), byte_of()
        self.texts = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            known = all(c in byte for c in token)
            self.texts[i] = bytes(map(byte.__getitem__, token)) if known else token.encode()
        self.sizes = np.array(list(map(len, self.texts)), np.int64)
        self.decimals = list(map(str, range(len(self.texts))))
        #: Whether each byte is a token, so that no text loses any.
        self.lossless = {bytes([b]) for b in range(256)} <= set(self.texts)
        self.merge, self.letters = self.library.model.tokenize, {b: c for c, b in byte.items()}
        self.known, self.before, self.pieces, self.older = {}, {}, {}, {}

    def pieces_of(self, text: str) -> list[str]:
        """The pre-tokenizer's pieces of a text by itself."""
        if text.isascii() or not self.unsettled(text):
            return self.matches(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def ids_of(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Ids of each piece; those not met lately are merged by the library's model."""
        known, older = self.pieces, self.older
        out = list(map(known.get, pieces))
        missing = [i for i, ids in enumerate(out) if ids is None]
        for i in missing:
            piece = pieces[i]
            ids = known.get(piece) or older.get(piece)
            if ids is None:
                ids = tuple([token.id for token in self.merge(piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters))])
            out[i] = ids
            if len(piece) <= SHORT:
                known[piece] = ids
        if len(known) >= PIECES:
            self.pieces, self.older = {}, known
        return out

    def chunk(self, text: str) -> tuple[list[str], list[tuple[int, ...]]]:
        """(pieces, ids of each) of a chunk by itself."""
        entry = self.known.get(text)
        if entry is None:
            entry = self.before.get(text)
            if entry is None:
                pieces = self.pieces_of(text)
                entry = (pieces, self.ids_of(pieces))
            if len(self.known) >= CHUNKS:
                self.before, self.known = self.known, {}
            self.known[text] = entry
        return entry

    def stretch(self, text: str) -> list[int]:
        """Ids of a text without added tokens.

        `open_` is a boundary between pieces of the whole text; the ids of all before it are out. A chunk that begins there
        (or has a boundary there) is right from there on, but for pieces that reach to within `LOOK` characters of its end.
        Across a join the text is encoded anew from `open_` until a boundary agrees with one of the next chunk; the rest of
        that chunk is then taken as it is. What is encoded anew is right up to `LOOK` characters before its own end, so it is kept.
        """
        coded = text.encode("utf-8", "surrogatepass")
        places = cuts(coded)
        if len(coded) != len(text):
            heads = np.append(0, np.cumsum((np.frombuffer(coded, np.uint8) & 0xC0) != 0x80))
            places = heads[places].tolist()
        out, open_, size = [], 0, len(text)
        for a, b in zip(places[:-1], places[1:]):
            if open_ >= b:
                continue
            pieces, ids = self.chunk(text[a:b])
            end, first, grow = a, 0, 3 * LOOK
            while open_ != end and open_ < b:
                while end < open_:
                    end += len(pieces[first])
                    first += 1
                if end == open_:
                    break
                q = min(size, max(a, open_) + grow)
                again, settled = self.pieces_of(text[open_:q]), False
                for piece, anew in zip(again, self.ids_of(again)):
                    if open_ + len(piece) > q - LOOK and q < size:
                        break
                    open_ += len(piece)
                    out.append(anew)
                    settled = True
                    while end < open_ and first < len(pieces):
                        end += len(pieces[first])
                        first += 1
                    if open_ == end:
                        break
                grow = grow if settled else 2 * grow
            if open_ >= b:
                continue
            last, end = len(pieces), b
            if b < size:
                while last > first and end > b - LOOK:
                    last -= 1
                    end -= len(pieces[last])
            if last > first:
                out += ids[first:last]
                open_ = end
        return list(chain.from_iterable(out))

    def plain(self, text: str) -> list[int]:
        """Ids of a text without added tokens, in one go: for texts that share little."""
        return list(chain.from_iterable(self.ids_of(self.pieces_of(text))))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.split is None:
            return self.stretch(text)
        parts = self.split(text)
        out = self.stretch(parts[0]) if parts[0] else []
        for token, rest in zip(parts[1::2], parts[2::2]):
            out.append(self.added[token])
            if rest:
                out += self.stretch(rest)
        return out

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.texts.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return self.bytes_of(ids).decode("utf-8", "replace")


def shared_coder(df: DataFrame, tokenizer: str, special: bool = True):
    """A function that gives a worker's coder: the file goes out once as a broadcast of its own size, whatever the data."""
    told = df.sparkSession.sparkContext.broadcast({"told": specification(tokenizer, special)})

    def coder() -> Coder:
        state = told.value
        if "coder" not in state:
            state["coder"] = Coder(state["told"])
        return state["coder"]

    return coder


def _mapped(df: DataFrame, tokenizer: str, special: bool, column: str, keep: tuple[str, ...], ddl: str, columns) -> DataFrame:
    coder, names = shared_coder(df, tokenizer, special), list(keep)
    new = [x.split()[0] for x in ddl.split(", ")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names))] + columns(coder(), batch.column("_in").to_pylist()), [*names, *new])

    kept = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names]
    return map_batches(df.select(*names, F.col(column).alias("_in")), run, ", ".join([*kept, ddl]))


def encode(docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", special: bool = True) -> DataFrame:
    """`keep` columns and `ids` array<int>: the whole text's ids, as the file's own library gives them without added ones.

    With `special`, strings of added tokens inside a text are those tokens, else plain text. Null and empty texts have no
    ids; rows that repeat come as often; no rows give none; columns not in `keep` play no part. Chunks are remembered by each
    Python worker (`CHUNKS` in each of two generations), so one that is shared is encoded again only by another worker or after long.
    """
    return _mapped(docs, tokenizer, special, text, keep, "ids array<int>", lambda coder, texts: [pa.array([coder.encode(t) for t in texts], pa.list_(pa.int32()))])


def decode(coded: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """`keep` columns and `text`: what the ids stand for, special tokens included; null ids give an empty text."""
    return _mapped(coded, tokenizer, True, ids, keep, "text string", lambda coder, rows: [pa.array([coder.decode(r or []) for r in rows], pa.string())])


def digests(docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", special: bool = True) -> DataFrame:
    """`keep` columns, n_tokens, ids_sha256 and decoded_sha256 of each whole text, encoded and decoded in one pass."""

    def columns(coder: Coder, texts: list):
        sha, rows = (lambda data: hashlib.sha256(data).hexdigest()), []
        for t in texts:
            ids = coder.encode(t)
            rows.append((len(ids), sha(",".join(map(coder.decimals.__getitem__, ids)).encode()), sha(coder.decode(ids).encode("utf-8"))))
        n, coded, back = zip(*rows) if rows else ((), (), ())
        return [pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(back, pa.string())]

    return _mapped(docs, tokenizer, special, text, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string", columns)
