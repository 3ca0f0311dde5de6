"""Vectorised words, word hashes and rolling hashes of one text, used inside Spark tasks.

Words are maximal runs of bytes other than space and 0x09-0x0D in the UTF-8 text; those bytes never
occur inside a longer UTF-8 sequence, so bytes and characters give the same words.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

LONG = 256  # bytes of a word beyond which it is hashed by a digest
_KEYS = np.array([0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # masks of the first k bytes
_BASE = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and xor-shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse, kept per process and grown when needed."""
    known = _TABLES.get(seed)
    if known is None or len(known[0]) < length:
        size = 1 << max(12, (length - 1).bit_length())
        tables = []
        for base in (_BASE[seed], pow(_BASE[seed], -1, 1 << 64)):
            table = np.full(size, np.uint64(base))
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        known = _TABLES[seed] = (tables[0], tables[1])
    return known


def _sums(values: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _powers(len(values) + 1, seed)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return total, inverse


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text given as bytes."""
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[0::2], edges[1::2]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """One 64-bit hash per word; equal words have equal hashes wherever they stand.

    Eight bytes at a time are mixed into a state that starts from the length and the seed's key. Mixing is no
    polynomial, so words built to have equal sums have different hashes, and those of two seeds are independent.
    """
    length = ends - starts
    out = mix(length.astype(np.uint64) + _KEYS[seed])
    loads = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(9, np.uint8)]), strides=(1,))
    live = np.flatnonzero(length <= LONG)
    at, left = starts[live], length[live]
    while len(live):
        chunk = loads[at] & _KEEP[np.minimum(left, 8)]
        out[live] = mix((out[live] ^ chunk) * np.uint64(0x9FB21C651E98DF25) + _KEYS[seed])
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(length > LONG):
        digest = hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8, salt=bytes([seed])).digest()
        out[k] = np.frombuffer(digest, "<u8")[0]
    return out


def rolling(values: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Rabin-Karp hash (polynomial modulo 2^64) of every run of `width` values."""
    count = len(values) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total, inverse = _sums(values, seed)
    return mix((total[width:] - total[:count]) * inverse[:count])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` values, by doubling the covered length."""
    out, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        out = np.minimum(out[:-step], out[step:])
        covered += step
    return out


def as_bytes(column: pa.Array) -> list[np.ndarray | None]:
    """The texts of an Arrow column as byte arrays, without copying them."""
    column = column.cast(pa.large_binary())
    return [np.frombuffer(x.as_buffer(), np.uint8) if x.is_valid else None for x in column]


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def release_memory() -> None:
    """Give memory that earlier tasks of this worker have freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
