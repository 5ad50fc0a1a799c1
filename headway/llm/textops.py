"""Vectorised text helpers used inside tasks.

Texts of one Arrow batch are cut into slices of bounded size, laid end to end
as one array of code points, and segmented and hashed with numpy, so no
Python object is made per word.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Fixed odd multipliers: two independent polynomial bases and the finaliser.
BASE_1, BASE_2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
#: Code points of text handled at once by a task.
SLICE_CHARS = 240_000
SLICE_ROWS = 1 << 13
N_CODES = 0x110000


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over all 64 output bits."""
    h = (h ^ (h >> U64(30))) * U64(MIX_1)
    h = (h ^ (h >> U64(27))) * U64(MIX_2)
    return h ^ (h >> U64(31))


@functools.cache
def lower_table() -> np.ndarray:
    """Code point -> its lower-case code point (where that is a single one)."""
    t = np.arange(N_CODES, dtype=np.uint32)
    for i in range(N_CODES):
        c = chr(i).lower()
        if len(c) == 1:
            t[i] = ord(c)
    return t


@functools.cache
def word_table() -> np.ndarray:
    """Code points that make up words: letters, digits, marks and ``_``."""
    t = np.zeros(N_CODES, dtype=bool)
    for i in range(N_CODES):
        c = chr(i)
        t[i] = c == "_" or unicodedata.category(c)[0] in "LNM"
    return t


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**k and base**-k modulo 2**64 for k < n."""
    inv = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inv):
        a = np.full(n, b, dtype=U64)
        a[0] = 1
        out.append(np.cumprod(a, dtype=U64))
    return out[0], out[1]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 18, 1 << int(n).bit_length())
    p, q = _powers(base, size)
    return p[:n], q[:n]


def numbered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each value among the distinct ones, and the place of the
    first occurrence of each of these."""
    number = pa.array(h).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    rep = np.zeros(int(number.max()) + 1 if len(number) else 0, dtype=np.int32)
    rep[number[::-1]] = np.arange(len(number), dtype=np.int32)[::-1]
    return number, rep


class Codes(NamedTuple):
    cp: np.ndarray      # uint32 code points of all texts, end to end
    bounds: np.ndarray  # int64, text i is cp[bounds[i]:bounds[i + 1]]


def codes(texts: list[str | None]) -> Codes:
    """Code points of the texts; None counts as empty."""
    texts = [t or "" for t in texts]
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    return Codes(np.frombuffer(raw, dtype=np.uint32), bounds)


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASE_1) -> np.ndarray:
    """64-bit polynomial hash of values[start:end] for every span, independent
    of where the span stands."""
    if not len(start):
        return np.zeros(0, dtype=U64)
    p, q = powers(base, len(values) + 1)
    acc = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum((values.astype(U64) + U64(1)) * p[:-1], out=acc[1:])
    return mix((acc[end] - acc[start]) * q[start] + (end - start).astype(U64) * U64(MIX_2))


class Words(NamedTuple):
    start: np.ndarray  # int64 position of each word's first code point
    end: np.ndarray
    first: np.ndarray  # int64, words of text i are first[i]:first[i + 1]
    lower: np.ndarray  # lower-cased code points of all texts


def words(c: Codes) -> Words:
    """Maximal runs of word characters, lower-cased."""
    n = len(c.cp)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return Words(z, z, np.zeros(len(c.bounds), dtype=np.int64), c.cp)
    isw = word_table()[c.cp]
    prev = np.zeros(n, dtype=bool)
    prev[1:] = isw[:-1]
    edge = c.bounds[:-1][c.bounds[:-1] < n]
    prev[edge] = False
    start = np.flatnonzero(isw & ~prev)
    nxt = np.zeros(n, dtype=bool)
    nxt[:-1] = isw[1:]
    last = c.bounds[1:] - 1
    nxt[last[last >= 0]] = False
    end = np.flatnonzero(isw & ~nxt) + 1
    return Words(start, end, np.searchsorted(start, c.bounds).astype(np.int64), lower_table()[c.cp])


def word_hashes(w: Words) -> np.ndarray:
    return span_hashes(w.lower, w.start, w.end)


def shingle_hashes(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words of each text; a text of fewer words (but
    at least one) has a single shingle of all its words.  Returns the hashes
    and the bounds of each text's shingles."""
    count = np.diff(first)
    k = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    bounds = np.zeros(len(first), dtype=np.int64)
    np.cumsum(k, out=bounds[1:])
    if not bounds[-1]:
        return np.zeros(0, dtype=U64), bounds
    pos = np.repeat(first[:-1] - bounds[:-1], k) + np.arange(bounds[-1])
    stop = np.repeat(first[1:], k)
    out = np.zeros(len(pos), dtype=U64)
    mult = 1
    for i in range(n):
        mult = mult * BASE_2 % (1 << 64)
        at = pos + i
        ok = at < stop
        out += np.where(ok, h[np.minimum(at, len(h) - 1)] * U64(mult), U64(0))
    return mix(out), bounds


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of whole rows whose texts have about ``limit``
    bytes together (one longer text is a piece of its own)."""
    col = batch.column(batch.schema.get_field_index(column))
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(size)
    at = 0
    while at < len(size):
        base = total[at - 1] if at else 0
        stop = min(max(at + 1, int(np.searchsorted(total, base + limit, side="right"))), at + SLICE_ROWS)
        yield batch.slice(at, stop - at)
        at = stop
