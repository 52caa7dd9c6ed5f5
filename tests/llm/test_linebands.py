"""Signatures and compressed blocks of line bands."""

import numpy as np
import pyarrow as pa
import pytest

from tablewise.llm import candidates
from tablewise.llm import hashing as H
from tablewise.llm import linebands as B
from tablewise.llm.linededup import _comparer, _rarest, _shingles_of


def test_minhash_is_the_least_product():
    rng = np.random.default_rng(0)
    sizes = np.concatenate([rng.integers(1, 90, 300), [1, 5000, 70_000]])
    at = np.concatenate([[0], np.cumsum(sizes)])
    h = rng.integers(0, 1 << 63, at[-1]).astype(np.uint64)
    got = B.minhash(h, at, 24)
    mixed = (H.mix(h) >> H.U(32)).astype(np.uint32)
    factors = (H.mix(np.arange(1, 25, dtype=np.uint64)) >> H.U(32)).astype(np.uint32) | np.uint32(1)
    for i in range(len(sizes)):
        part = mixed[at[i]:at[i + 1]]
        assert got[:, i].tolist() == [int((part * f).min()) for f in factors]


def test_shared_slots_estimate_the_similarity():
    rng, shares = np.random.default_rng(1), []
    for _ in range(150):
        common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (80, 10, 10))
        s = B.minhash(np.concatenate([common, a, common, b]), np.array([0, 90, 180]), 240)
        shares.append((s[:, 0] == s[:, 1]).mean())
    assert abs(np.mean(shares) - 0.8) < 0.01


def test_blocks_hold_their_entries():
    rng = np.random.default_rng(2)
    band = np.sort(rng.integers(0, 1 << 48, 5000).astype(np.uint64))
    c = rng.integers(0, 1 << 40, 5000).astype(np.uint64)
    back = B.unpacked(B.packed(band, c))
    assert (back[0] == band).all() and (back[1] == c).all()


def test_matcher_gives_shared_bands_only():
    entries = [(7, 1), (7, 2), (9, 3), (9, 3), (11, 4), (12, 5), (12, 6), (12, 5)]
    blocks = [B.packed(*(np.array(x, np.uint64) for x in zip(*sorted(entries[i::2])))) for i in range(2)]
    batch = pa.RecordBatch.from_arrays([pa.array([0, 0], pa.int32()), pa.array(blocks, pa.binary())], ["range", "block"])
    out = [tuple(r.values()) for b in B.matcher([batch]) for r in b.to_pylist()]
    assert sorted(out) == [(7, 1), (7, 2), (12, 5), (12, 6)]


def edited(seed: int) -> list[str]:
    """Lines of one head and several tails: some similar, most not, all sharing the head's shingles."""
    rng, letters = np.random.default_rng(seed), list("abcdefghijklmnop ")
    head, out = "".join(rng.choice(letters, 120)), []
    for size in (20, 25, 90, 95, 100, 110) * 4:
        tail = "".join(rng.choice(letters, size))
        out += [head + tail, head + tail[:-3] + "xyz"]
    return out


def jaccard(a: str, b: str) -> float:
    a, b = ({s[i:i + 5] for i in range(len(s) - 4)} for s in (a, b))
    return len(a & b) / len(a | b)


def test_sketches_differ_in_no_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(5)
    for size in (0, 1, 90, 2000):
        a, b = (rng.integers(0, max(1, 2 * size), size).astype(np.uint64) for _ in range(2))
        sets = [np.unique(a), np.unique(b)]
        m = candidates.sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
        assert m.shape == (2, candidates.SKETCH_BITS // 64)
        assert np.bitwise_count(m[0] ^ m[1]).sum() <= len(np.setxor1d(*sets))


@pytest.mark.parametrize("most", [candidates.MOST_MET, 10])
def test_bucket_meetings_compare_few_pairs_and_lose_none(spark, monkeypatch, most):
    """One bucket holds every line; the lines' shared head is rare in nobody's eyes but each twin's."""
    monkeypatch.setattr(candidates, "MOST_MET", most)
    lines, compared = edited(3), []
    column = pa.array(lines)
    h, at = H.distinct_sets(*_shingles_of(column, 5))
    sets = spark.createDataFrame([(i, n, s, m) for i, (n, s, m) in enumerate(zip(np.diff(at).tolist(), lines, candidates.sketches(h, at).tolist()))],
                                 "c long, n long, s string, m array<bigint>")
    # a second bucket, small enough to meet at 10
    members = spark.createDataFrame([(1, i) for i in range(len(lines))] + [(2, i) for i in range(8)], "b long, c long")

    def similar(both, percent):
        compared.append(both.count())
        return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_comparer(5, percent), "a long, b long")

    got = {r.node: r.component for r in candidates.linked(members, lambda classes: sets.join(classes, "c"), 80, similar, _rarest(5)).collect()}
    label, links = list(range(len(lines))), [(a, b) for a in range(len(lines)) for b in range(a) if jaccard(lines[a], lines[b]) >= 0.8]
    for _ in lines:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {i: c for i, c in enumerate(label) if label.count(c) > 1}
    if most > len(lines):  # the star's pairs, then only what the sketches leave
        assert sum(compared[1:]) <= 2 * len(links) < len(lines) * (len(lines) - 1) // 4
