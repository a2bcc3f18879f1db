"""Words, shingle sets and fast similarity sketches of many texts at once (numpy, inside tasks).

A sketch of t coordinates is made by rounds of hashed bin placement. In round i < t every element of a set goes to a
hashed bin and bids i + v, where v is a hash in [0, 1); a bin keeps its lowest bid, so a bin filled in an early round is
settled. In round t + b every element bids for bin b alone, which fills whatever is still empty: every coordinate is
filled after 2t rounds at most, and after one or two for a set of many elements. Two sets agree in a coordinate with a
probability equal to their Jaccard similarity, and the number of agreements concentrates around its mean as for
independent coordinates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa

_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1

#: Bytes of text that are worked on at once.
CHUNK = 1 << 20

#: ASCII white space, which separates words: tab to carriage return, and space.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; a bijection."""
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(33))) * _MIX2
    return x ^ (x >> np.uint64(33))


def odd(i: int) -> np.uint64:
    """The i-th of a row of odd multipliers."""
    return np.uint64(((i + 1) * _STEP | 1) & _ALL)


@lru_cache(maxsize=2)
def _letters(fold_case: bool) -> np.ndarray:
    """A 64-bit number per byte; 0 for white space. Folding gives A to Z the numbers of a to z."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * odd(7))
    if fold_case:
        table[65:91] = table[97:123]
    table[SPACES] = 0
    return table


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2^64, and of its inverse."""
    base = int(odd(11))
    return tuple(
        np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]))
        for b in (base, pow(base, -1, 1 << 64))
    )


def _hash_words(data: np.ndarray, breaks: np.ndarray, fold_case: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word of a buffer; a word also ends at a break."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = ~SPACES[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    inner = breaks[(breaks > 0) & (breaks < n)]
    begins[inner] = inside[inner]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[inner - 1] = inside[inner - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    size = max(CHUNK, 1 << (n - 1).bit_length())
    powers, inverse = _powers(size)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_letters(fold_case)[data] * powers[:n], out=sums[1:])
    values = (sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64) * odd(3)
    return mix(values), starts


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """Cut one long text at white space into pieces of about CHUNK bytes."""
    at = 0
    while len(data) - at > CHUNK:
        spaces = np.flatnonzero(SPACES[data[at : at + CHUNK]])
        if len(spaces):
            end = at + int(spaces[-1]) + 1
        else:
            end = at + CHUNK
            while end < len(data) and not SPACES[data[end]]:
                end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def texts_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null counts as empty."""
    binary = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = binary.buffers()
    bounds = np.frombuffer(offsets, np.int64)[binary.offset : binary.offset + len(binary) + 1]
    return np.frombuffer(data, np.uint8) if data and data.size else np.empty(0, np.uint8), bounds


def words_of(
    texts: pa.Array, fold_case: bool = False
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Go through the texts in runs of about CHUNK bytes.

    Gives (first text, text after the last, bytes, bounds of the texts in these bytes, word hashes, bounds of the texts
    in these hashes). A longer text makes a run of its own, which is hashed in pieces.
    """
    data, offsets = texts_of(texts)
    i, n = 0, len(texts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1)
        part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        if j == i + 1 and len(part) > CHUNK:
            none = np.empty(0, np.int64)
            hashes = np.concatenate([_hash_words(p, none, fold_case)[0] for p in _pieces(part)])
            words = np.array([0, len(hashes)])
        else:
            hashes, starts = _hash_words(part, bounds, fold_case)
            words = np.searchsorted(starts, bounds)
        yield i, j, part, bounds, hashes, words
        i = j


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each window of `size` words, one window starting at every word that has enough followers."""
    n = max(0, len(hashes) - size + 1)
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += hashes[k : n + k] * odd(k)
    return mix(total)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Sorted distinct hashes of the word shingles of each text, as (number of the first text, sets), run by run.

    A to Z are lower-cased. A text of fewer words than a shingle has one shingle, all its words; a text without words has
    none.
    """
    for first, _, _, _, hashes, words in words_of(texts, fold_case=True):
        full = windows(hashes, size)
        sets = []
        for lo, hi in zip(words[:-1].tolist(), words[1:].tolist()):
            n = hi - lo
            if n >= size:
                sets.append(np.unique(full[lo : hi - size + 1]))
            else:
                sets.append(windows(hashes[lo:hi], n) if n else np.empty(0, np.uint64))
        yield first, sets


def set_digest(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def sketch_sets(sets: Sequence[np.ndarray], t: int) -> np.ndarray:
    """The sketches of non-empty sets, one row of t 64-bit coordinates each."""
    none = np.uint64(_ALL)
    out = np.zeros(len(sets) * t, np.uint64)
    if not len(sets):
        return out.reshape(0, t)
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
    items = np.concatenate(sets)
    is_open = np.ones(len(sets) * t, bool)
    for i in range(2 * t):
        bids = mix(items + odd(i))
        bins = owner * t + ((bids >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else owner * t + (i - t)
        wanted = is_open[bins]
        low = np.full(len(out), none)
        np.minimum.at(low, bins[wanted], mix(bids[wanted]))
        won = low != none
        out[won] = low[won] + odd(2 * t + i)
        is_open &= ~won
        alive = is_open.reshape(-1, t).any(axis=1)
        if not alive.any():
            break
        keep = alive[owner]
        items, owner = items[keep], owner[keep]
    return out.reshape(-1, t)


def band_shape(threshold: float, size: int = 128, miss: float = 1e-6) -> tuple[int, int]:
    """(bands, coordinates in a band): the longest bands for which a pair at the threshold is missed that rarely."""
    best = (size, 1)
    for rows in range(2, size + 1):
        bands = size // rows
        if (1 - threshold**rows) ** bands > miss:
            break
        best = (bands, rows)
    return best


def band_hashes(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band, salted with the band's number."""
    parts = sketches[:, : bands * rows].reshape(-1, bands, rows)
    total = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * odd(rows), (len(parts), 1))
    for k in range(rows):
        total = mix(total + parts[:, :, k] * odd(k))
    return total.view(np.int64)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
