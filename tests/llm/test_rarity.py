"""The rarest elements of sets, by blocks, against counting them."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tablewise.llm import candidates, rarity
from tablewise.llm import hashing as H
from tablewise.llm.linededup import _rarest, _shingles_of

K, PERCENT = 5, 80


@pytest.fixture(scope="module")
def lines():
    """(family, c, s): families of edited copies, a line without shingles of its own and a very common one."""
    rng, out = np.random.default_rng(3), []
    for family in range(6):
        base = "".join(rng.choice(list("abcdefgh "), 90))
        for i in range(12):
            at = int(rng.integers(0, 80))
            out.append((family - 3, family * 100 + i, base[:at] + "".join(rng.choice(list("xyz"), 1 + i % 4)) + base[at:]))
    return out + [(-3, 900, "aa"), (7, 901, "alone in its family")]


def shingles(text: str) -> list[int]:
    return H.distinct_sets(*_shingles_of(pa.array([text]), K))[0].tolist()


def told(lines):
    """c -> (n, u, {x: rank}) by counting."""
    sets = {c: (family, shingles(s)) for family, c, s in lines}
    times = Counter((family, x) for family, xs in sets.values() for x in xs)
    out = {}
    for c, (family, xs) in sets.items():
        order = sorted(xs, key=lambda x: (times[family, x], x))
        first = order[:len(xs) - -(-PERCENT * len(xs) // 100) + 1]
        out[c] = (len(xs), sum(times[family, x] == 1 for x in first),
                  {x: i + 1 for i, x in enumerate(first) if times[family, x] > 1})
    return out


def table(spark, lines):
    return spark.createDataFrame([(f, c, len(shingles(s)), s) for f, c, s in lines], "family long, c long, n long, s string")


@pytest.mark.parametrize("bits", [20, 7])
def test_rarest_shared_elements(spark, lines, monkeypatch, bits):
    monkeypatch.setattr(rarity, "_RUN_BITS", bits)
    found = rarity.rarest(table(spark, lines), lambda column: H.distinct_sets(*_shingles_of(column, K)), PERCENT).collect()
    assert len(found) == len(lines)
    assert {r.c: (r.n, r.u, {x % 2 ** 64: i for x, i in zip(r.x, r["rank"])}) for r in found} == told(lines)
    if bits == 7:  # many runs and ranges
        assert sum(len(shingles(s)) for *_, s in lines) >> bits > 16


def test_elements_of_one_set_are_no_rows(spark, lines):
    ranked, size = _rarest(K)(table(spark, lines), PERCENT)
    expected = told(lines)
    assert ranked.columns == ["family", "x", "c", "n", "rank"]
    assert ranked.count() == sum(len(ranks) for *_, ranks in expected.values())
    assert {r.c: r.u for r in size.collect()} == {c: u for c, (_, u, _) in expected.items()}


def test_both_ways_propose_the_same(spark, lines):
    """Arrays by rows and texts by blocks: equal numbers of own elements, and equal meetings."""
    texts = table(spark, lines)
    arrays = spark.createDataFrame([(f, c, len(shingles(s)), [x - 2 ** 64 if x >= 2 ** 63 else x for x in shingles(s)]) for f, c, s in lines],
                                   "family long, c long, n long, s array<bigint>")
    placed = texts.selectExpr("c", "c as component")
    own, pairs = [], []
    for ranked, size in (_rarest(K)(texts, PERCENT), candidates.rarest_elements(arrays, PERCENT)):
        own.append(sorted(map(tuple, size.select("c", "n", "u").collect())))
        pairs.append({tuple(r) for r in candidates._rare_meetings(ranked, placed, PERCENT).collect()})
    assert own[0] == own[1]
    similar = {(a, b) for fa, a, sa in lines for fb, b, sb in lines if fa == fb and a < b
               and 100 * len(set(shingles(sa)) & set(shingles(sb))) >= PERCENT * len(set(shingles(sa)) | set(shingles(sb)))}
    assert similar and all(similar <= p for p in pairs)


def test_no_sets(spark):
    empty = spark.createDataFrame([], "family long, c long, n long, s string")
    assert rarity.rarest(empty, lambda column: H.distinct_sets(*_shingles_of(column, K)), PERCENT).count() == 0
