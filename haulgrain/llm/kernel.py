"""Vectorised text kernel: bytes of many texts at once, split into words or lines and hashed.

All functions work on one chunk of whole texts: ``buf`` holds their UTF-8 bytes one after another
and ``offsets`` where each text starts.  A chunk is a few megabytes, or one text if that is longer,
so memory does not depend on the size of an Arrow batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_GRAM = np.uint64(0xD1342543DE82EF95)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # not on glibc: memory stays with the worker
    _libc = None

SPACES = b" \t\n\x0b\x0c\r"


def byte_table(true_for) -> np.ndarray:
    return np.array([bool(true_for(b)) for b in range(256)])


#: words of [^\x20\x09-\x0D]
NON_SPACE = byte_table(lambda b: b not in SPACES)
#: words of [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing: digits, a-z and all beyond ASCII
ALNUM = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pa.array(column).cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, place, data = column.buffers()
    place = np.frombuffer(place, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(place, place[row] + limit, "right")) - 1)
        yield row, end, data[place[row] : place[end]], place[row : end + 1] - place[row]
        row = end
    _give_back()


def _give_back() -> None:
    """Return freed memory to the system; a worker that lives on would keep what its largest chunk took."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def spans(keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of kept bytes inside each text, and each text's first run."""
    n = len(keep)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    heads = offsets[:-1][offsets[:-1] < n]
    begins = keep.copy()
    begins[1:] &= ~keep[:-1]
    begins[heads] = keep[heads]
    stops = np.empty(n, bool)
    stops[:-1] = ~keep[1:]
    stops[-1] = True
    tails = offsets[1:][offsets[1:] > 0] - 1
    stops[tails] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(keep & stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def split(buf: np.ndarray, offsets: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``str.split`` at one byte: starts, ends and each text's first piece; empty texts have one."""
    marks = np.flatnonzero(buf == mark)
    starts = np.concatenate([offsets[:-1], marks + 1])
    ends = np.concatenate([marks, offsets[1:]])
    text = np.searchsorted(offsets, marks, "right") - 1
    first = np.zeros(len(offsets), np.int64)
    np.cumsum(np.bincount(text, minlength=len(offsets) - 1) + 1, out=first[1:])
    whole = np.arange(len(offsets) - 1)
    # sorted by text first: a text that ends in the mark has its last, empty piece where the next text starts
    starts = starts[np.lexsort((starts, np.concatenate([whole, text])))]
    return starts, ends[np.lexsort((ends, np.concatenate([text, whole])))], first


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers[name]
    if len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps)
    return have[:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial hash of the bytes modulo 2^64; ``span_hash`` reads any span from it."""
    out = np.zeros(len(buf) + 1, np.uint64)
    out[1:] = buf
    out[1:] += np.uint64(1)
    out[1:] *= _power("up", _BASE, len(buf))
    return np.cumsum(out, out=out)


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, wherever the span stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    inverse = _power("down", _BASE_INVERSE, len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def owners(first: np.ndarray) -> np.ndarray:
    """Text number of each word, from each text's first word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def grams(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside a text, the position of each and each text's first run."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(first), np.int64)
    owner = owners(first)
    at = np.flatnonzero(owner[:n] == owner[k - 1 :])
    value = np.zeros(n, np.uint64)
    for j in range(k):
        value = value * _GRAM + hashes[j : j + n]
    return mix(value[at]), at, np.searchsorted(at, first)


def crossed(counts: np.ndarray) -> np.ndarray:
    """Position of each item inside its group, for groups of the given sizes."""
    total = np.arange(int(counts.sum()))
    return total - np.repeat(np.cumsum(counts) - counts, counts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
