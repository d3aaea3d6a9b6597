"""Fill-in-middle by displacement scatter: difference arrays say how far every byte of a batch moves."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import map_batches
from cellrisk.llm.hashing import SPACED

MARKS = ("<P>", "<S>", "<M>")
#: Bytes whose displacements are held at once; the rest of a batch costs its own bytes and those of its output.
BLOCK = 1 << 20
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")


def moved(data: np.ndarray, at: np.ndarray, by: np.ndarray, size: int, inverse: bool = False) -> np.ndarray:
    """Every byte i of `data` at i + shift(i); inverse: `size` bytes, byte i taken from i + shift(i).

    `at`, in order, are the places where the shift changes and `by` the differences there (several at one place add up).
    A cumulative sum over the difference array of a block, carried on from block to block, gives each byte its shift.
    """
    out = np.zeros(size, np.uint8)
    carried, n = 0, size if inverse else len(data)
    for begin in range(0, n, BLOCK):
        end = min(n, begin + BLOCK)
        lo, hi = np.searchsorted(at, (begin, end))
        steps = np.zeros(end - begin, np.int64)
        np.add.at(steps, at[lo:hi] - begin, by[lo:hi])
        place = np.cumsum(steps) + carried
        carried = int(place[-1])
        place += np.arange(begin, end)
        if inverse:
            out[begin:end] = data[place]
        else:
            out[place] = data[begin:end]
    return out


def placed(starts: np.ndarray, shifts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Difference array, as (places, differences), of segments that begin at `starts` (in order) with the given shifts."""
    return starts, np.diff(shifts, prepend=0)


def found(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Where `mark` begins."""
    at = np.flatnonzero(data[: max(0, len(data) - len(mark) + 1)] == mark[0])
    for k in range(1, len(mark)):
        at = at[data[at + k] == mark[k]]
    return at


def owners(bounds: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the texts that hold the whole of what begins at `at`; what crosses from one text to the next has none."""
    text = np.searchsorted(bounds, at, side="right") - 1
    return text[at + size <= bounds[text + 1]]


def token_ends(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends of all tokens, tokens before each text): a token is a word with the white space before it, or white space at a text's end."""
    inside = SPACED[data]
    last = np.zeros(len(data) + 1, bool)
    last[1:] = inside
    last[1:-1] &= ~inside[1:]
    some = bounds[1:][np.diff(bounds) > 0]
    last[some] = True
    ends = np.flatnonzero(last)
    return ends, np.searchsorted(ends, bounds, side="right")


def draws(doc_ids: list, seed: int) -> np.ndarray:
    """Four whole numbers of 32 bits per document: the first 16 bytes of sha256("seed:doc_id"); a null doc_id is written as nothing."""
    digests = [hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).digest()[:16] for d in doc_ids]
    return np.frombuffer(b"".join(digests), ">u4").reshape(-1, 4).astype(np.int64)


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each begins and the last ends)."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    bounds = np.zeros(len(coded) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)), out=bounds[1:])
    return np.frombuffer(b"".join(coded), np.uint8), bounds


def strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    whole = data.tobytes()
    return pa.array([whole[a:b].decode("utf-8", "surrogatepass") for a, b in zip(bounds[:-1], bounds[1:])], pa.string())


def scattered(texts: list[str | None], doc_ids: list, marks: tuple[str, ...], seed: int, rate: int, spm: int):
    """(output, its bounds, tokens, forms, characters of prefix and middle) of a batch of texts."""
    data, bounds = joined(texts)
    n_texts, size = len(texts), np.diff(bounds)
    ends, before = token_ends(data, bounds)
    n = np.diff(before)
    h = draws(doc_ids, seed)
    marked = np.zeros(n_texts, bool)
    coded = [m.encode() for m in marks]
    for mark in coded:
        marked[owners(bounds, found(data, mark), len(mark))] = True
    form = np.where((size == 0) | marked | (h[:, 2] % 100 >= rate), PLAIN, np.where(h[:, 3] % 100 < spm, SPM, PSM))
    k = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    until = lambda c: np.where(c > 0, ends[np.maximum(before[:-1] + c - 1, 0)], bounds[:-1]) if len(ends) else bounds[:-1]
    one, two = until(k[:, 0]), until(k[:, 1])
    # Plain texts are one piece.
    one, two = np.where(form == PLAIN, bounds[1:], one), np.where(form == PLAIN, bounds[1:], two)
    p, m, s = one - bounds[:-1], two - one, bounds[1:] - two
    lp, ls, lm = map(len, coded)
    marks_size = np.where(form == PLAIN, 0, lp + ls + lm)
    out_bounds = np.append(0, np.cumsum(size + marks_size))
    o = out_bounds[:-1]
    to_p = np.select([form == PSM, form == SPM], [o + lp, o + ls + s + lp], o)
    to_m = np.select([form == PSM, form == SPM], [o + lp + p + ls + s + lm, o + ls + s + lp + p + lm], o + p)
    to_s = np.select([form == PSM, form == SPM], [o + lp + p + ls, o + ls], o + p + m)
    starts = np.stack([bounds[:-1], one, two], axis=1)
    out = moved(data, *placed(starts.ravel(), (np.stack([to_p, to_m, to_s], axis=1) - starts).ravel()), int(out_bounds[-1]))
    for mark, to in zip(coded, (to_p, to_s, to_m)):
        for i, byte in enumerate(mark):
            out[to[form != PLAIN] - len(mark) + i] = byte
    heads = lambda a, b: _characters(data, a, b)
    return out, out_bounds, n, form, heads(bounds[:-1], one), heads(one, two)


def _characters(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points between byte offsets `begin` and `end`, counted block by block."""
    at = np.unique(np.concatenate([begin, end]))
    upto, total = np.zeros(len(at), np.int64), 0
    for a in range(0, len(data) + 1, BLOCK):
        first = np.cumsum((data[a : a + BLOCK] & 0xC0) != 0x80)
        lo, hi = np.searchsorted(at, (a, a + BLOCK))
        upto[lo:hi] = total + np.append(0, first)[at[lo:hi] - a]
        total += int(first[-1]) if len(first) else 0
    return upto[np.searchsorted(at, end)] - upto[np.searchsorted(at, begin)]


def gathered(outputs: list[str | None], forms: list[str | None], marks: tuple[str, ...]):
    """(texts, their bounds): the inverse, by a gather over the same displacements."""
    data, bounds = joined(outputs)
    form = np.array([FORMS.index(f) if f in FORMS else PLAIN for f in forms], np.int64)
    coded = [m.encode() for m in marks]
    moved_ = np.flatnonzero(form != PLAIN)
    at = {}
    for name, mark in zip("psm", coded):
        hits = found(data, mark)
        text = np.searchsorted(bounds, hits, side="right") - 1
        whole = (hits + len(mark) <= bounds[text + 1]) & (form[text] != PLAIN)
        if not np.array_equal(text[whole], moved_):
            raise ValueError(f"a moved text must hold {mark.decode()} once")
        at[name] = hits[whole]
    begin, end = bounds[:-1].copy(), bounds[1:].copy()
    p, m, s = begin.copy(), end.copy(), end.copy()  # where the parts lie in the output
    pn, mn, sn = end - begin, np.zeros_like(begin), np.zeros_like(begin)
    lp, ls, lm = map(len, coded)
    psm = form[moved_] == PSM
    p[moved_], s[moved_], m[moved_] = at["p"] + lp, at["s"] + ls, at["m"] + lm
    pn[moved_] = np.where(psm, at["s"], at["m"]) - p[moved_]
    sn[moved_] = np.where(psm, at["m"], at["p"]) - s[moved_]
    mn[moved_] = end[moved_] - m[moved_]
    back = np.append(0, np.cumsum(pn + mn + sn))
    starts = np.stack([back[:-1], back[:-1] + pn, back[:-1] + pn + mn], axis=1)
    shifts = (np.stack([p, m, s], axis=1) - starts).ravel()
    return moved(data, *placed(starts.ravel(), shifts), int(back[-1]), inverse=True), back


def _checked(marks: tuple[str, ...]) -> tuple[str, ...]:
    if len(set(marks)) != 3 or any(not m for m in marks):
        raise ValueError("three different marks are needed")
    for a in marks:
        for b in marks:
            if any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b))):
                raise ValueError("no mark may begin as one ends, or hold another: they could not be found again")
            if a != b and a in b:
                raise ValueError("no mark may hold another")
    return tuple(marks)


def fill_in_middle(
    docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, marks: tuple[str, ...] = MARKS,
    keep: tuple[str, ...] = ("doc_id",), text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """`keep` columns, n, form, prefix_chars, middle_chars and output: each whole text as it is or with its middle moved last.

    Of 100 texts `rate` are moved, of those `spm` with the suffix first. Cuts lie between tokens (a word with the
    white space before it, or white space at the end). All draws depend on `seed` and `key` alone, so a rerun, another
    partitioning or a repeated row gives the same. A null or empty text, or one that holds a mark, stays plain (null as
    an empty text); plain texts have null prefix_chars and middle_chars. A null key draws as an empty one. No rows give
    no rows; columns not in `keep` play no part.
    """
    names, marks = list(keep), _checked(marks)

    def move(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, bounds, n, form, p, m = scattered(batch.column("_text").to_pylist(), batch.column("_key").to_pylist(), marks, seed, rate, spm)
        plain = form == PLAIN
        new = [
            pa.array(n.astype(np.int64)), pa.array([FORMS[f] for f in form], pa.string()),
            pa.array(p, pa.int64(), mask=plain), pa.array(m, pa.int64(), mask=plain), strings(out, bounds),
        ]
        return pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names))] + new, [*names, "n", "form", "prefix_chars", "middle_chars", "output"])

    ddl = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names] + ["n long, form string, prefix_chars long, middle_chars long, output string"])
    return map_batches(docs.select(*names, F.col(text).alias("_text"), F.col(key).cast("string").alias("_key")), move, ddl)


def restore(moved_: DataFrame, marks: tuple[str, ...] = MARKS, keep: tuple[str, ...] = ("doc_id",), output: str = "output", form: str = "form") -> DataFrame:
    """`keep` columns and `text`: the exact texts, from output and form alone. A null form is plain, a null output empty.

    A moved output must hold each mark just once, as `fill_in_middle` makes it; another one raises an error.
    """
    names, marks = list(keep), _checked(marks)

    def back(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, bounds = gathered(batch.column("_output").to_pylist(), batch.column("_form").to_pylist(), marks)
        return pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names))] + [strings(data, bounds)], [*names, "text"])

    ddl = ", ".join([f"`{c}` {moved_.schema[c].dataType.simpleString()}" for c in names] + ["text string"])
    return map_batches(moved_.select(*names, F.col(output).alias("_output"), F.col(form).alias("_form")), back, ddl)
