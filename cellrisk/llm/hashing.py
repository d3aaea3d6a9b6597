"""Hashes of all words or byte ranges of a text at once, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once, so that a very long text needs no more memory than this times some dozen.
BLOCK = 1 << 20
_POWERS: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values (the finalizer of splitmix64)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTES = mixed(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)


def _powers(name: str, base: int, size: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < size:
        steps = np.full(1 << max(10, (size - 1).bit_length()), base, dtype=_U)
        steps[0] = 1
        have = _POWERS[name] = np.multiply.accumulate(steps)
    return have


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """s[i]: sum of byte values times powers of the base over the first i bytes, modulo 2^64."""
    out = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTES[data] * _powers("up", _BASE, len(data) + 1)[: len(data)], out=out[1:])
    return out


def ranges(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range, the same wherever the range lies."""
    return mixed((sums[end] - sums[begin]) * _powers("down", _INVERSE, len(sums))[begin] + (end - begin).astype(_U))


def _blocks(data: bytes, inside: np.ndarray):
    """Cuts at bytes that no word holds; a word longer than a block stays whole."""
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + BLOCK)
        while end < len(data):
            flags = inside[np.frombuffer(data, np.uint8, end - begin, begin)]
            outside = np.flatnonzero(~flags)
            if len(outside):
                end = begin + int(outside[-1]) + 1
                break
            end = min(len(data), end + BLOCK)
        yield begin, np.frombuffer(data, np.uint8, end - begin, begin)
        begin = end


def words(data: bytes, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, hash) of every maximal run of bytes whose entry in `inside` (256 flags) is true.

    Words over 200 bytes, on which sums modulo 2^64 can be made to collide, are hashed by BLAKE2 instead.
    """
    found = []
    for at, block in _blocks(data, inside):
        flags = np.zeros(len(block) + 2, dtype=np.int8)
        flags[1:-1] = inside[block]
        turn = np.diff(flags)
        begin, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        if not len(begin):
            continue
        hashes = ranges(prefix_sums(block), begin, end)
        for i in np.flatnonzero(end - begin > 200):
            digest = hashlib.blake2b(block[begin[i] : end[i]].tobytes(), digest_size=8).digest()
            hashes[i] = int.from_bytes(digest, "little")
        found.append((begin + at, end + at, hashes))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    return tuple(np.concatenate(x) for x in zip(*found))


def _space() -> np.ndarray:
    inside = np.ones(256, dtype=bool)
    inside[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return inside


#: Words between white space; and words of letters, where every byte of a character beyond ASCII counts as one.
SPACED = _space()
LETTERS = np.array([chr(i).isalpha() and i < 128 or i >= 128 for i in range(256)])


def shingles(data: bytes, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; with fewer words, of the whole; without words, none."""
    found = words(data, SPACED)[2]
    if not len(found):
        return found
    size = min(size, len(found))
    out = np.zeros(len(found) - size + 1, dtype=_U)
    for k in range(size):
        out = out * _U(0x9FB21C651E98DF25) + found[k : len(found) - size + 1 + k]
    return np.unique(mixed(out + _U(size)))
