"""The training-data operators against SQL and brute force on the smallest tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pandas as pd
import pytest

import __spark_entry__ as entry
from tests.oracle import duck

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def run(spark, name):
    return entry.queries()[name](spark, SF).toPandas()


def nullable(df):
    """Whole numbers beside a null, which pandas may hold as floats, as nullable integers."""
    return df.convert_dtypes(convert_string=False, convert_boolean=False, convert_floating=False)


def components(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if re.match(r"op\d", n)))
def test_sql(spark, name):
    got = run(spark, name)
    told = duck(SF).execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(told.columns)
    columns = sorted(got.columns)
    rows = lambda df: sorted(tuple("-" if pd.isna(x) else str(x) for x in r)
                             for r in nullable(df[columns]).astype(object).itertuples(index=False))
    assert rows(got) == rows(told)


def test_op1_base_spans(spark, docs):
    assign = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    for r in run(spark, "op1_secret_ownership").itertuples():
        text = docs[r.doc_id]
        found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[1]) >= 6]
        found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        listed = [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == f[3] for f in found) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",") if r.spans else [])


def test_op1_owned_and_copied(spark):
    from tablewise.llm.secret_scan import scan_secrets
    own, shared = "Zx81kQ93mPw7Lr2Vt6Yb4N", "Aa11Bb22Cc33Dd44Ee55Ff"
    rows = [(i, f"see {shared} and {own if i == 0 else 'nothing'} password = hunter{i}22", f"o{i}") for i in range(4)]
    out = {r.doc_id: r for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    kinds = lambda r: [x.kind for x in r.spans]
    assert kinds(out[0]) == [3, 0] and [kinds(out[i]) for i in (1, 2, 3)] == [[0]] * 3
    assert [r.live for r in (out[0], out[1])] == [2, 1]


def test_op4_brute_force(spark, docs):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    rows = [(i, j, x.translate(lower)) for i in sorted(docs) for j, x in enumerate(docs[i].split("\n")) if WORD.search(x)]
    lines = sorted({x for _, _, x in rows})
    sets = [{x[i:i + 5] for i in range(max(1, len(x) - 4))} for x in lines]
    holders, links = defaultdict(set), set()
    rarity = Counter(s for x in sets for s in x)
    for k, x in enumerate(sets):  # exact prefix filtering
        near = set()
        for s in sorted(x, key=lambda s: (rarity[s], s))[:len(x) - math.ceil(0.8 * len(x)) + 1]:
            near |= holders[s]
            holders[s].add(k)
        links |= {(k, y) for y in near if 100 * len(x & sets[y]) >= 80 * len(x | sets[y])}
    group = components(range(len(lines)), links)
    number, first, gone = {x: k for k, x in enumerate(lines)}, {}, defaultdict(set)
    for i, j, x in rows:
        if first.setdefault(group[number[x]], (i, j)) != (i, j):
            gone[i].add(j)
    for r in run(spark, "op4_fuzzy_line_dedup").itertuples():
        rest = "\n".join(x for j, x in enumerate(docs[r.doc_id].split("\n")) if j not in gone[r.doc_id])
        assert (r.n_removed, r.kept_sha256) == (len(gone[r.doc_id]), hashlib.sha256(rest.encode()).hexdigest())


def test_op6_base(spark, docs):
    rejected = 0
    for r in run(spark, "op6_adaptive_quality").itertuples():
        words = WORD.findall(docs[r.doc_id])
        grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for k in range(5)}
        lines = [x for x in docs[r.doc_id].split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", docs[r.doc_id])), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (r.base_failed and r.kept)
        rejected += not r.kept
    assert rejected < len(docs) / 3


def test_op6_fence_follows_its_group(spark):
    from tablewise.llm.quality import quality_report
    plain = "one two three four five six seven eight nine ten eleven twelve word%d"
    rows = [(i, plain % i, "a") for i in range(20)] + [(50, "one# two# three# four# five# six# seven# eight# nine# ten# it%d" % 1, "a")]
    rows += [(100 + i, " | ".join((plain % i).split()[i % 3:]), "b") for i in range(20)]
    kept = {r.doc_id: r.kept for r in quality_report(spark.createDataFrame(rows, "doc_id long, text string, source string"), by=("source",)).collect()}
    assert not kept[50] and all(kept[i] for i in kept if i != 50)


def test_op9_finds_copies_and_edits(spark, docs):
    from tablewise.llm.decontam import contaminated
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r.item_id: " ".join(WORD.findall(r.text)) for r in items.collect()}
    whole = {(i, k) for i, t in docs.items() for k, x in texts.items() if x in " ".join(WORD.findall(t))}
    got = run(spark, "op9_benchmark_decontamination")
    assert whole <= set(zip(got.doc_id, got.item_id))
    assert set(got.doc_id) == {i for i, _ in whole}
    longest = max(texts, key=lambda k: len(texts[k].split()))
    words = texts[longest].split()
    edited = [w if i % 8 else "changed" for i, w in enumerate(words)]
    cut = words[:5] + ["inserted", "twice"] + words[7:]
    rows = [(1, " ".join(["before"] * 50 + edited + ["after"] * 50)), (2, " ".join(cut)), (3, "nothing of the kind " * 30)]
    for block_bytes in (4 << 20, 500):
        found = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items, block_bytes=block_bytes).collect()
        assert {(r.id, r.item) for r in found} == {(1, longest), (2, longest)}


def test_op9_alignment():
    import numpy as np

    from tablewise.llm.decontam import GAP, MATCH, MISMATCH, align
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = rng.integers(2, 6, rng.integers(1, 9)), rng.integers(2, 6, rng.integers(1, 12))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                h[i + 1, j + 1] = max(0, h[i, j] + (MATCH if x == y else MISMATCH), h[i, j + 1] + GAP, h[i + 1, j] + GAP)
        got = align(np.array([a], np.uint64), np.array([len(a)]), np.array([[*b, 1]], np.uint64))
        assert got[0] == h.max()


def test_op10_targets_and_draws(spark, docs):
    got = run(spark, "op10_source_mixing")
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    size = Counter()
    for i, t in docs.items():
        size[source[i]] += len(WORD.findall(t))
    names = sorted(size)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full = set()
    while True:
        level = (sum(size.values()) - 3 * sum(size[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        more = {s for s in names if s not in full and weight[s] * level > 3 * size[s]}
        if not more:
            break
        full |= more
    taken = Counter()
    for r in got.itertuples():
        s = source[r.doc_id]
        assert r.size == len(WORD.findall(docs[r.doc_id])) and r.source_size == size[s] and r.taken <= 3 * r.size
        assert r.target == pytest.approx(3 * size[s] if s in full else weight[s] * level)
        taken[s] += r.taken
    for s in names:
        assert taken[s] == pytest.approx(3 * size[s] if s in full else weight[s] * level, rel=0.05)
    again = run(spark, "op10_source_mixing")
    assert sorted(zip(got.doc_id, got.taken)) == sorted(zip(again.doc_id, again.taken))


def test_op10_tree(spark):
    from tablewise.llm.mixing import laid_out, mixture, split_quotas
    quotas = spark.createDataFrame([(0, 1000), (1, 10), (2, 0), (3, 333)], "source_no int, draws long")
    parts = split_quotas(quotas, 3, 1).collect()
    total, by_shard = Counter(), Counter()
    for r in parts:
        assert r.draws >= 0
        total[r.source_no] += r.draws
        by_shard[r.shard] += r.draws
    assert dict(total) == {0: 1000, 1: 10, 2: 0, 3: 333}
    assert max(by_shard.values()) - min(by_shard.values()) <= 1 and len(by_shard) == 8
    draws = mixture(laid_out(spark.read.parquet(f"{SF}/documents.parquet")), shards=4, block_words=64).collect()
    assert {r.shard for r in draws} == {0, 1, 2, 3}
    seen = Counter((r.source_no, r.start, r.epoch, r.first) for r in draws)
    assert max(seen.values()) == 1  # no part is drawn twice in an epoch


def test_op8_zip64(monkeypatch, tmp_path):
    import zipfile

    import pyarrow as pa

    from tablewise.llm import warczip
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    record = warczip._record(7, "http://x", b"payload", hashlib.sha1(b"payload").hexdigest(), "response", None)
    import gzip
    packed = gzip.compress(record)
    path = tmp_path / "a.wacz"
    path.write_bytes(warczip._pack([(packed, {"id": 7, "type": "response"})]))
    with pa.OSFile(str(path)) as f:
        view = warczip.ZipView(f)
        assert set(view.members) == {warczip.DATA, warczip.INDEX}
        at, size = view.place(warczip.DATA)
        fields, payload = warczip.parse_record(f.read_at(size, at))
    assert payload == b"payload" and fields["WARC-Record-ID"] == "<urn:page:7>"


def test_op8_revisits(spark):
    from tablewise.llm.warczip import round_trip
    long = "x" * 1000
    rows = [(1, "u", long), (2, "u", long), (3, None, long), (4, "u", "short"), (5, "u", "short"), (6, "u", None)]
    out = {r.page_id: r for r in round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [(out[i].record_type, out[i].refers_to) for i in range(1, 7)] == [
        ("revisit", 3), ("revisit", 3), ("response", None), ("response", None), ("response", None), ("response", None)]
    assert [out[i].payload_bytes for i in range(1, 7)] == [1000, 1000, 1000, 5, 5, 0]


def test_union_find(spark):
    from tablewise.llm.graph import components as found
    links = [(i, i + 1) for i in range(1, 200)] + [(500, 900), (700, 900), (-5, 1000), (3, 3)]
    got = {r.node: r.component for r in found(spark.createDataFrame(links, "a long, b long")).collect()}
    want = components({x for a, b in links if a != b for x in (a, b)}, links)
    assert got == want


def test_near_duplicate_families(spark):
    """Independent edits of one text: exact components, whatever stars were chosen."""
    import random

    from tablewise.llm.neardup import near_duplicates
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(80):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(120)] = rng.choice(["the", "of", f"n{rng.randrange(40)}"])
        rows.append((i, " ".join(words)))
    sets = {i: {tuple(t.split()[k:k + 2]) for k in range(119)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()}
    assert got == components(sets, links)


def _made_up_items(spark, lengths):
    words = [[f"w{k}x{i}" for i in range(n)] for k, n in enumerate(lengths)]
    return words, spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(words)], "item_id long, text string")


@pytest.mark.parametrize("leaked", [False, True])
def test_op9_regular_edits(spark, leaked):
    """Every 4th or 5th word replaced, and a word inserted after every second one, which breaks all 3-grams."""
    from tablewise.llm.decontam import contaminated
    words, items = _made_up_items(spark, [40, 41, 24, 5, 3])
    edits = {(k, e): x for k, w in enumerate(words[:3]) for e, x in (
        (4, [x if i % 4 != 3 else "changed" for i, x in enumerate(w)]), (5, [x if i % 5 != 4 else "changed" for i, x in enumerate(w)]),
        (2, [y for i, x in enumerate(w) for y in ([x, "more"] if i % 2 else [x])]))}
    edits |= {(k, 1): " more ".join(words[k]).split() for k in (3, 4)}
    rows = [(10 * k + e, " ".join(["before"] * 30 + x + ["after"] * 30)) for (k, e), x in edits.items()]
    if leaked:
        rows += [(1000 + k, " ".join(w)) for k, w in enumerate(words)]
    found = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert {(r.id, r.item) for r in found} == {(10 * k + e, k) for k, e in edits} | {(1000 + k, k) for k in range(5) if leaked}


def test_op9_insertions_and_neighbours(spark):
    """One long insertion, which parts an item's seeds, and copies side by side."""
    from tablewise.llm.decontam import contaminated
    words, items = _made_up_items(spark, [40])
    w, around = words[0], ["around"] * 60
    rows = [(1, around + w[:20] + ["more"] * 30 + w[20:] + around, [(60, 130)]), (2, w[:30] + ["more"] * 30 + w[30:], [(0, 30)]),
            (3, w[:20] + ["more"] * 33 + w[20:], []), (4, around + w * 3 + around, [(60, 100), (100, 140), (140, 180)]),
            (5, w + ["more"] * 5 + w[:20] + ["more"] * 30 + w[20:], [(0, 40), (45, 115)])]
    found = contaminated(spark.createDataFrame([(i, " ".join(x)) for i, x, _ in rows], "doc_id long, text string"), items).collect()
    assert sorted((r.id, r.first, r.last) for r in found) == [(i, a, b) for i, _, places in rows for a, b in places]


def test_op9_against_all_pairs(spark):
    """Random edits around the threshold: what Smith-Waterman over the whole text finds."""
    import random

    import numpy as np

    from tablewise.llm.decontam import _words, align, contaminated
    from tablewise.llm.common import arrow_bytes
    import pyarrow as pa
    rng = random.Random(5)
    words, items = _made_up_items(spark, [3, 4, 5, 6, 9, 17, 33, 60])
    rows = []
    for i in range(240):
        w, rate = words[i % 8], rng.choice([0.2, 0.25, 0.3, 0.4])
        text = []
        for x in w:
            edit = rng.random()
            text += [x] if edit > rate else [["a"], [], [x, "b"], ["c"] * 3 + [x]][rng.randrange(4)]
        rows.append((i, " ".join(["the"] * rng.randrange(9) + text + ["of"] * rng.randrange(9))))
    want = set()
    for i, text in rows:
        for k, w in enumerate(words):
            (a, _), (b, _) = (_words(*arrow_bytes(pa.array([x]))) for x in (" ".join(w), text))
            if len(b) and 100 * align(a[None], np.array([len(a)]), b[None])[0] >= 60 * 2 * len(a):
                want.add((i, k))
    got = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert {(r.id, r.item) for r in got} == want and 60 < len(want) < 230


def test_op6_small_groups_borrow_their_fence(spark):
    """Junk that is alone in its source, against fences by brute force."""
    from tablewise.llm.quality import FENCE_WIDTH, FENCES, OWN_ROWS, adaptive_thresholds, quality_features, quality_report
    plain = "one two three four five six seven eight nine ten eleven twelve word%d"
    rows = [(i, plain % i, "en", "a") for i in range(40)]
    rows += [(100 + i, "one### two### three### four### five### six### seven### eight### nine### ten### it%d" % i, "en", f"s{i}" if i else None) for i in range(8)]
    rows += [(200 + i, plain % i, "en", f"t{i}") for i in range(8)] + [(300 + i, plain % i, None, "u") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_report(df).collect()}
    assert {i for i, k in kept.items() if not k} == set(range(100, 108))
    ratio = lambda t: len(re.findall(r"[#*$%&|<>]", t)) / sum(map(len, WORD.findall(t)))
    quartiles = lambda rs: [sorted(ratio(t) for _, t, _, _ in rs)[math.ceil(p * len(rs)) - 1] for p in (0.25, 0.75)]

    def mixed(rs, above):
        w = len(rs) ** 2 / (len(rs) ** 2 + OWN_ROWS ** 2)
        return [w * a + (1 - w) * b for a, b in zip(quartiles(rs), above)]
    for r in adaptive_thresholds(quality_features(df), ["lang", "source"]).collect():
        of_lang = [x for x in rows if x[2] == r.lang]
        low, high = mixed([x for x in of_lang if x[3] == r.source], mixed(of_lang, quartiles(rows)))
        assert r.fences["symbol_ratio"] == pytest.approx(high + FENCE_WIDTH * max(high - low, FENCES["symbol_ratio"]))


def test_op4_pairs_near_the_threshold(spark):
    """Lines with a single partner of similarity 0.81, whom bands must not miss."""
    import random

    from tablewise.llm.linededup import line_digests
    rng, rows = random.Random(7), []
    for i in range(600):
        x = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100))
        y = "".join({30: "0", 60: "1"}.get(j, c) for j, c in enumerate(x))
        a, b = ({t[j:j + 5] for j in range(96)} for t in (x, y))
        assert 80 * len(a | b) <= 100 * len(a & b) <= 82 * len(a | b)
        rows += [(i, x), (1000 + i, y)]
    removed = {r.doc_id: r.n_removed for r in line_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert removed == {i: int(i >= 1000) for i, _ in rows}
