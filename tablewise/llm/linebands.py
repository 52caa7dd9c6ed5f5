"""Band hashes of lines as sorted, compressed blocks.

A band entry is (band hash, class): 48 bits of the one and 40 of the other.  What is
left out makes chance meetings, which the exact comparison sorts out.  A run holds
the entries of some 65,000 classes in the order of their bands; each range of
hashes is a block of it, kept as byte planes of the differences, whose upper ones are all
zero.  That takes about 8 bytes an entry, half of what a row of two longs takes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column

from tablewise.llm import hashing as H
from tablewise.llm.common import arrow_bytes, slices

_SLICE = 1 << 20
_RUN_CLASSES = 1 << 16
_BAND_BITS, _CLASS_BITS = 48, 40
#: Hashes that one multiplication works on: small enough for the cache.
_CELLS = 1 << 16


def short(c: Column) -> Column:
    """The bits of a class hash that an entry keeps."""
    return c.bitwiseAND((1 << _CLASS_BITS) - 1)


def minhash(h: np.ndarray, at: np.ndarray, slots: int) -> np.ndarray:
    """MinHash signatures (slots x sets) of the sets ``h[at[i]:at[i+1]]``, none of them empty,
    repeats allowed: slot j has the least of the elements' hashes times the j-th odd factor,
    modulo 2 ** 32.  Sets of about one size are the columns of a matrix, so that the
    products and minima run along its rows."""
    h = (H.mix(h) >> H.U(32)).astype(np.uint32)
    factors = (H.mix(np.arange(1, slots + 1, dtype=np.uint64)) >> H.U(32)).astype(np.uint32) | np.uint32(1)
    size = np.diff(at)
    order = np.argsort(size, kind="stable")
    out = np.empty((slots, len(size)), np.uint32)
    i = 0
    while i < len(order):
        j = min(len(order), i + max(1, _CELLS // int(size[order[i]])))
        j = min(j, i + max(1, _CELLS // int(size[order[j - 1]])))
        sets = order[i:j]
        least = np.full((slots, len(sets)), np.iinfo(np.uint32).max, np.uint32)
        longest = int(size[sets[-1]])
        step = max(1, _CELLS // len(sets))
        for a in range(0, longest, step):
            rank = np.minimum(np.arange(a, min(longest, a + step))[:, None], size[sets][None, :] - 1)
            part = h[at[sets][None, :] + rank]
            product = np.empty_like(part)
            for s in range(slots):
                np.multiply(part, factors[s], out=product)
                np.minimum(least[s], product.min(axis=0), out=least[s])
        out[:, sets] = least
        i = j
    return out


def band_entries(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``bands`` hashes of ``rows`` slots for each set (bands x sets); the band's number is in its hash."""
    out = np.empty((bands, signature.shape[1]), np.uint64)
    for b in range(bands):
        h = np.full(signature.shape[1], (b + 1) * 0xC2B2AE3D27D4EB4F & (2 ** 64 - 1), np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            h = (h ^ signature[k]) * H.U(0xFF51AFD7ED558CCD)
            h ^= h >> H.U(29)
        out[b] = H.mix(h) >> H.U(64 - _BAND_BITS)
    return out


def planes(numbers: np.ndarray, width: int) -> bytes:
    """The lower ``width`` bytes of 64-bit numbers, all first bytes first."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def values(raw: np.ndarray, width: int) -> np.ndarray:
    """The numbers that ``planes`` wrote."""
    out = np.zeros((raw.size // width, 8), np.uint8)
    out[:, :width] = raw.reshape(width, -1).T
    return out.view(np.uint64).ravel()


def packed(band: np.ndarray, c: np.ndarray) -> bytes:
    """A block of entries that are sorted by band."""
    return zstandard.ZstdCompressor(level=1).compress(
        planes(np.diff(band, prepend=np.uint64(0)), _BAND_BITS // 8) + planes(c, _CLASS_BITS // 8))


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    width = _BAND_BITS // 8
    cut = raw.size // (width + _CLASS_BITS // 8) * width
    return np.cumsum(values(raw[:cut], width)), values(raw[cut:], _CLASS_BITS // 8)


def bander(k: int, bands: int, rows: int, ranges: int):
    """Texts -> (range, block): the band entries of their lines, a run at a time."""
    shift = H.U(_BAND_BITS - (ranges - 1).bit_length())
    mask = H.U((1 << _CLASS_BITS) - 1)

    def band(batches):
        from tablewise.llm.linededup import shingles, worded_lines
        held, signed = [], []

        def run():
            entries, c = np.concatenate(signed, axis=1), np.concatenate(held) & mask
            flat, own = entries.ravel(), np.tile(c, bands)
            order = np.argsort(flat)
            flat, own = flat[order], own[order]
            cut = np.searchsorted(flat >> shift, np.arange(ranges + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(cut)).tolist()
            return pa.RecordBatch.from_arrays([
                pa.array(some, pa.int32()), pa.array([packed(flat[cut[r]:cut[r + 1]], own[cut[r]:cut[r + 1]]) for r in some], pa.binary())],
                ["range", "block"])

        for batch in batches:
            raw, off = arrow_bytes(batch.column("text"))
            for a, b in slices(off, _SLICE):
                chars, starts, ends, _, _, c = worded_lines(raw[off[a]:off[b]], off[a:b + 1] - off[a])
                fresh = np.unique(c, return_index=True)[1]
                if held:  # a class is signed once a run
                    fresh = fresh[~np.isin(c[fresh], np.concatenate(held))]
                if not len(fresh):
                    continue
                held.append(c[fresh])
                signed.append(band_entries(minhash(*shingles(chars, starts[fresh], ends[fresh], k), bands * rows), bands, rows))
                if sum(map(len, held)) >= _RUN_CLASSES:
                    yield run()
                    held, signed = [], []
        if held:
            yield run()
    return band


def matcher(batches):
    """Blocks by range -> (b, short) of the bands that several classes have."""
    def met(blocks):
        band, c = (np.concatenate(x) for x in zip(*map(unpacked, blocks)))
        order = np.lexsort((c, band))
        band, c = band[order], c[order]
        first = np.ones(len(band), bool)
        first[1:] = (band[1:] != band[:-1]) | (c[1:] != c[:-1])
        band, c = band[first], c[first]
        same = np.zeros(len(band) + 1, bool)
        same[1:-1] = band[1:] == band[:-1]
        shared = same[1:] | same[:-1]
        return pa.RecordBatch.from_arrays([pa.array(band[shared].view(np.int64)), pa.array(c[shared].view(np.int64))], ["b", "short"])

    at, blocks = None, []
    for batch in batches:
        for r, block in zip(batch.column("range").to_pylist(), batch.column("block").to_pylist()):
            if r != at and blocks:
                yield met(blocks)
                blocks = []
            at = r
            blocks.append(block)
    if blocks:
        yield met(blocks)
