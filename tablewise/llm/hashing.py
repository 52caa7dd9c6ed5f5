"""Vectorised text hashing for work inside Arrow tasks.

Everything works on whole record batches as NumPy arrays: words are cut at
ASCII white space and hashed from a running polynomial over the bytes, n-grams
of words are combined by doubling (so a 32-gram costs five steps, not 32).
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_CHUNK = 1 << 20
_PIECE = 1 << 14
#: Bytes that separate words: 0x09-0x0D and the space.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, piece by piece so that pieces stay in the cache."""
    out = np.empty_like(x)
    for i in range(0, len(x), _PIECE):
        y = out[i:i + _PIECE]
        np.right_shift(x[i:i + _PIECE], U(32), out=y)
        y ^= x[i:i + _PIECE]
        y *= U(0xD6E8FEB86659FD93)
        y ^= y >> U(32)
        y *= U(0xD6E8FEB86659FD93)
        y ^= y >> U(32)
    return out


def _table(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        n = max(n, _CHUNK + 1)
        have = np.empty(n, np.uint64)
        have[0] = 1
        size = 1
        while size < n:  # doubling
            m = min(size, n - size)
            have[size:size + m] = have[:m] * U(pow(base, size, 1 << 64))
            size += m
        _powers[name] = have
    return have[:n] if len(have) >= n else have


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span [start, end); spans ascend and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = max(int(np.searchsorted(ends, at + _CHUNK, "right")), i + 1)
        stop = int(ends[j - 1])
        n = stop - at
        run = np.zeros(n + 1, np.uint64)
        np.cumsum((raw[at:stop].astype(np.uint64) + U(1)) * _table("p", _P, n)[:n], out=run[1:])
        a, b = starts[i:j] - at, ends[i:j] - at
        h = (run[b] - run[a]) * _table("inverse", _PINV, n)[a]
        out[i:j] = mix(h + (b - a).astype(np.uint64) * U(0xA0761D6478BD642F))
        i = j
    return out


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each row's offset into the words."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _IS_SPACE[raw]
    cut = np.zeros(n + 1, bool)  # a row begins here
    cut[offsets] = True
    first = ~space
    last = first.copy()
    first[1:] &= space[:-1] | cut[1:n]
    last[:-1] &= space[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and each row's offset into them."""
    starts, ends, at = words(raw, offsets)
    return span_hashes(raw, starts, ends), at


def join_grams(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    return mix(left * U(salt | 1) + right)


def grams(w: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (positions whose n words leave
    the array are missing; those that cross a row are for the caller to leave out)."""
    if len(w) < n:
        return np.zeros(0, np.uint64)
    size, h = 1, w
    while size * 2 <= n:
        h = join_grams(h[:len(h) - size], h[size:], 0xE7037ED1A0B428DB + 2 * size)
        size *= 2
    if size < n:
        h = join_grams(h[:len(w) - n + 1], h[n - size:], 0x8EBC6AF09C88C6E3 + 2 * n)
    return h


def inside(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For n-grams over rows at ``offsets``: the positions that stay in their
    row, and the rows' offsets into those positions."""
    count = np.maximum(np.diff(offsets) - n + 1, 0)
    at = np.concatenate([[0], np.cumsum(count)])
    where = np.arange(at[-1]) + np.repeat(offsets[:-1] - at[:-1], count)
    return where, at


def distinct_sets(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the hashes of each row and drops repeats."""
    h = h.copy()
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a > 1:
            h[a:b].sort()
    if not len(h):
        return h, at
    keep = np.ones(len(h), bool)
    keep[1:] = h[1:] != h[:-1]
    keep[at[:-1][np.diff(at) > 0]] = True
    run = np.concatenate([[0], np.cumsum(keep)])
    return h[keep], run[at]


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return run[at[1:]] - run[at[:-1]]


def prime_from(n: int) -> int:
    while any(n % k == 0 for k in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def super_minhash(h: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash signatures of the sets ``h[at[i]:at[i+1]]``; ``m`` is prime, below 256.

    Each element has a permutation of the m slots (slot of rank j is
    ``(b + a*j) mod m`` with a, b from its hash) and offers ``j + u_j`` at the
    slot of rank j, u_j uniform on [0, 1); a slot keeps its least offer.  The
    ranks of one element differ in all slots, which lowers the variance against
    independent draws.  Ranks are taken in order for all elements at once; a
    set whose slots are all filled after rank j is finished, since later
    offers are j + 1 or more.  Offers are fixed-point: rank in the top byte.
    An empty set has the largest value in every slot.
    """
    rows = len(at) - 1
    unset = np.iinfo(np.uint64).max
    sig = np.full((rows, m), unset, np.uint64)
    flat = sig.ravel()
    row = np.repeat(np.arange(rows), np.diff(at))
    # rank 0, which every element takes: slot from the high half of one hash, u from its product
    seed = mix(h ^ U(0x589965CC75374CC3))
    slot = (((seed >> U(32)) * U(m)) >> U(32)).astype(np.int64)
    np.minimum.at(flat, row * m + slot, (seed * U(0xA0761D6478BD642F)) >> U(8))
    # later ranks offer more than any slot filled so far holds: only empty slots take them
    empty = (sig == unset).sum(axis=1)
    live = (empty > 0)[row]
    h, row, slot, seed = h[live], row[live], slot[live], seed[live]
    step, base = ((seed & U(0xFFFFFFFF)) % U(m - 1) + U(1)).astype(np.int64), row * m
    for j in range(1, m):
        if not len(h):
            break
        slot += step
        slot[slot >= m] -= m
        spot = base + slot
        taken = np.flatnonzero(flat[spot] == unset)
        if not len(taken):
            continue
        spot = spot[taken]
        np.minimum.at(flat, spot, (mix(h[taken] + U(j * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))) >> U(8)) | U(j << 56))
        np.subtract.at(empty, np.unique(spot) // m, 1)
        live = (empty > 0)[row]
        if live.mean() < 0.7:
            h, row, slot, step, base = h[live], row[live], slot[live], step[live], base[live]
    return sig


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each of ``bands`` bands of ``rows`` slots; the band number is in the hash."""
    out = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sig), (b + 1) * 0xC2B2AE3D27D4EB4F & (2 ** 64 - 1), np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            h = mix(h * U(0xFF51AFD7ED558CCD) + sig[:, k])
        out[:, b] = h
    return out
