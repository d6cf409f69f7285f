"""Words and word-window digests of an Arrow text column, as numpy arrays.

Everything works on UTF-8 bytes. Short words and windows of words have polynomial hashes modulo 2**64 with fixed random
byte values, words of more than LONG_WORD bytes a BLAKE2 digest, since sequences of a thousand symbols can be chosen so
that such a polynomial does not tell them apart whatever its base. The same words have the same digest in every task and
every run. Sums run over some hundred thousand bytes or words at a time, so a long text needs no more memory for them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MODULUS = 1 << 64
#: Bytes of the longest word that is hashed by a polynomial, and bytes or words whose hashes are summed up at a time.
LONG_WORD, SUMMED = 128, 1 << 18
_WHITE = [0x20, *range(0x09, 0x0E)]


#: Frees large tables that operators which do not use this module keep in a worker; a worker lives on from task to task.
RELEASE: list[Callable[[], None]] = [pa.default_memory_pool().release_unused]


def byte_set(excluded: list[int]) -> np.ndarray:
    """Which of the 256 byte values belong to a word."""
    inside = np.ones(256, bool)
    inside[excluded] = False
    return inside


#: Words between ASCII white space: [^\x20\x09-\x0D]+
SPACED = byte_set(_WHITE)
#: Words of digits, letters and everything outside ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (of lower-cased text)
ALNUM = byte_set([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: Lower-cases A to Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and len + 1 offsets; null counts as empty."""
    for release in RELEASE:
        release()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most limit bytes, or of one row."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j
        i = j


def words(buf: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and len + 1 word offsets of the rows."""
    mask = inside[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    before = np.concatenate((np.zeros(1, bool), mask[:-1]))
    after = np.concatenate((mask[1:], np.zeros(1, bool)))
    starts = np.flatnonzero(mask & (edge[:-1] | ~before))
    ends = np.flatnonzero(mask & (edge[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(starts, offs)


@lru_cache(maxsize=8)
def _tables(seed: int) -> tuple[np.ndarray, int, int]:
    rng = np.random.default_rng(seed)
    values = rng.integers(0, MODULUS, 256, np.uint64) | np.uint64(1)
    # 3 modulo 8: its powers differ from one another in almost all bits.
    base = (int(rng.integers(0, MODULUS, dtype=np.uint64)) & ~7) | 3
    return values, base, pow(base, -1, MODULUS)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers; the longest tables of one operator's bases are kept."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        if known is None and len(_POWERS) >= 8:
            _POWERS.clear()
        size = max(1 << 16, 1 << int(n).bit_length())
        known = _POWERS[base] = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, base, np.uint64))))
    return known[:n]


def forget() -> None:
    """Frees the tables of powers, for operators that do not hash words."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, inverse: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(inverse, len(values) + 1)[starts])


def _stretches(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of spans, whose starts and ends ascend, that lie within SUMMED places; one longer span by itself."""
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SUMMED, "right")))
        yield i, j
        i = j


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A digest of every word; words ascend and do not overlap."""
    values, base, inverse = _tables(seed)
    out = np.zeros(len(starts), np.uint64)
    for i, j in _stretches(starts, ends):
        if ends[j - 1] - starts[i] <= SUMMED:
            first = starts[i]
            out[i:j] = _spans(values[buf[first : ends[j - 1]]], starts[i:j] - first, ends[i:j] - first, base, inverse)
    key = seed.to_bytes(8, "little")
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        out[k] = int.from_bytes(blake2b(buf[starts[k] : ends[k]], digest_size=8, key=key).digest(), "little")
    return out


def window_hashes(hashes: np.ndarray, starts: np.ndarray, size: int | np.ndarray, seed: int = 1) -> np.ndarray:
    """Digest of the size words from each start on; windows of a thousand words or more are not told apart safely."""
    _, base, inverse = _tables(seed + 1000)
    ends = starts + size
    if len(hashes) <= 2 * SUMMED or not ((starts[1:] >= starts[:-1]).all() and (ends[1:] >= ends[:-1]).all()):
        return _spans(hashes, starts, ends, base, inverse)
    out = np.zeros(len(starts), np.uint64)
    for i, j in _stretches(starts, ends):
        first = starts[i]
        out[i:j] = _spans(hashes[first : ends[j - 1]], starts[i:j] - first, ends[i:j] - first, base, inverse)
    return out


def window_starts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Every word with size words of its own row from it on, itself included."""
    counts = np.diff(bounds)
    row_end = np.repeat(bounds[1:], counts)
    at = np.arange(bounds[0], bounds[-1])
    return at[at + size <= row_end]


def texts_sha256(parts: Iterator[bytes]) -> list[str]:
    from hashlib import sha256

    return [sha256(x).hexdigest() for x in parts]
