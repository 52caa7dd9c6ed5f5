"""op11, op12 and op13 against brute force, on the smallest tables and on odd ones."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from tablewise.llm import alignment, simhash, trie

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BYTES, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


# --- op11 -------------------------------------------------------------------

def brute_trie(rows):
    """{(role, text) path: (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, hash)} of rows (conv, turn, role, text)."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    turns = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        paths[c] = tuple(turns.get(base, [])[:h] + own[h:])
    held, children = defaultdict(list), defaultdict(set)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            held[paths[c][:d]].append(c)
            if d:
                children[paths[c][:d - 1]].add(paths[c][:d])
    leaves, saved = Counter(), Counter()
    for p, convs in held.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(convs) - 1) * len(WORD.findall(p[-1][1])) if p else 0
    return {p: (min(v), len(p), min(held[p[:-1]]) if p else None, len(v), len(children[p]), leaves[p], saved[p],
                hashlib.sha256(",".join(str(c) for c in v if len(paths[c]) == len(p)).encode()).hexdigest()) for p, v in held.items()}


def trie_rows(df):
    return sorted(map(str, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
                      .rdd.map(tuple).collect()))


def test_op11_brute_force(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    told = brute_trie([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])
    assert trie_rows(entry.queries()["op11_prefix_trie"](spark, SF)) == sorted(str(v) for v in told.values())


SCHEMA = "conv_id long, turn int, role string, text string, node string, conv long, depth int, words int, key string, total int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "y", 4) for r in rows], SCHEMA).repartition(5)


def test_op11_odd_conversations(spark):
    rows = [(20, t, "user", f"turn {t} of it") for t in range(300)]                      # longer than a task's share
    rows += [(c, t, "user", f"turn {t} of it") for c in (21, 22, 39) for t in range(40)]  # copies of its start
    rows += [(1, 0, None, None), (1, None, "user", "null turn first"), (2, 0, "", "")]    # no base
    rows += [(40, 5, "a", "tie"), (40, 5, "a", "eit"), (40, 5, "a", "tie"), (41, 0, "a", "tie")]
    rows += [(-7, 0, "user", "negative"), (-20, 0, "user", "base of it"), (-20, 1, "user", "é 😀"), (None, 0, "user", "of none")]
    rows += [(c, 0, "user", "") for c in range(60, 64)]                                    # shorter than what they give up
    rows += [(c, 0, "user", "same") for c in range(100, 20_100, 20)] + [(c, 1, "user", "again") for c in range(100, 20_100, 20)]
    told = brute_trie(rows)
    assert trie_rows(trie.prefix_trie(conversations(spark, rows))) == sorted(str(v) for v in told.values())


def test_op11_empty_table(spark):
    assert trie.prefix_trie(conversations(spark, []).limit(0)).collect() == []


def test_op11_bands_hold_few(spark):
    rows = [(20, t, "user", str(t)) for t in range(70)]
    paths = trie.members(conversations(spark, rows)).select("conv", "depth", "node")
    sizes = [len(r.above) for r in trie._ancestors(paths).collect()]
    assert len(sizes) == 71 and max(sizes) == trie._BAND


# --- op12 -------------------------------------------------------------------

def brute_fingerprint(text, n=3):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(max(len(w) - n + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, radius=3):
    """{id: least id reachable} of rows (id, fingerprint)."""
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    f = np.array([x for _, x in rows], np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius):
            up[root(int(j))] = root(i)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        least[root(i)].append(k)
    return [(k, f"{x:016x}", min((y for y in least[root(i)] if y is not None), default=None)) for i, (k, x) in enumerate(rows)]


def listed(rows):
    return sorted(map(str, rows))


def test_op12_brute_force(spark):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = entry.queries()["op12_simhash_tiles"](spark, SF).collect()
    assert listed(tuple(r) for r in got) == listed(brute_components(rows))


def test_op12_odd_texts(spark):
    long = " ".join(f"w{i % 900}" for i in range(150_000))
    rows = [(1, "One two"), (2, "one  TWO"), (3, None), (4, ""), (5, " \n\t"), (None, None), (6, long), (6, long), (7, long + " x"),
            (None, "é 😀 ñ Ä"), (8, "É 😀 ñ Ä"), (9, "\x0bone\x0ctwo\r")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, component int").repartition(3)
    got = simhash.simhash_groups(df).collect()
    assert listed(tuple(r) for r in got) == listed(brute_components([(k, brute_fingerprint(t)) for k, t in rows]))
    assert simhash.simhash_groups(df.limit(0)).collect() == []


def test_op12_links_of_dense_fingerprints(spark):
    """Chains, families inside one cell and pairs at the radius and beyond, in cells of several tiles."""
    rng = np.random.default_rng(5)
    fps = set(range(2500)) | {int(x) for x in rng.integers(0, 2 ** 63, 500)}
    fps |= {x ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for x, (a, b, c) in zip(sorted(fps)[::7], rng.integers(0, 63, (400, 3)))}
    df = spark.createDataFrame([(x,) for x in sorted(fps)], "fp long")
    links = [(r.a, r.b) for r in simhash.links(df, 3).collect()]
    assert all(bin(a ^ b).count("1") <= 64 for a, b in links) and len(links) < 40 * len(fps)
    rows = [(x, x) for x in sorted(fps)]
    least = {k: c for k, _, c in brute_components(rows)}
    up = {x: x for x in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    assert {x: root(x) for x in fps} == least


def test_op12_skipped_cells_hold_no_link():
    """Cells farther apart than the radius are skipped: the counts differ by no more than the bits."""
    rng = np.random.default_rng(3)
    steps = set(simhash._offsets(3)) | {-x for x in simhash._offsets(3)} | {0}
    cell = lambda x: sum(bin(x >> 16 * k & 0xFFFF).count("1") << 5 * k for k in range(4))
    for x in rng.integers(0, 2 ** 63, 300).tolist():
        y = x
        for b in rng.integers(0, 64, 3).tolist():
            y ^= 1 << b
        assert cell(y) - cell(x) in steps
    assert len(steps) == 129


# --- op13 -------------------------------------------------------------------

@pytest.fixture(scope="module")
def coders():
    import json

    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    names = {i: x for x, i in json.load(open(BYTES))["model"]["vocab"].items()} | {50256: "<|endoftext|>"}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(x): x for x in printable}
    for x in range(256):
        if x not in printable:
            chars[chr(256 + len(chars) - len(printable))] = x

    def encode(text):
        """(A ids, B ids, groups, linked pairs)"""
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bx = [bytes(chars[c] for c in names[i]) for i in x]
        by = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not text or b"".join(bx) != (" " + text).encode() or b"".join(by) != (" " + text).encode():
            return [], [], [], []
        at = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
        ex, ey = at(bx), at(by)
        groups, i, j = [], 0, 0
        for e in sorted(set(ex) & set(ey)):
            p, r = ex.index(e) + 1, ey.index(e) + 1
            groups.append((x[i:p], y[j:r]))
            i, j = p, r
        return x, y, groups, [(g[0][-1], g[1][-1]) for g in groups]
    return encode


def brute_alignment(encode, rows):
    told = [(k, *encode(t or "")) for k, t in rows]
    counts = Counter(p for x in told for p in x[4])
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for k, x, y, groups, links in told:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((k, len(x), len(y), len(groups), len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if x else ""))
    return out, counts


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_op13_brute_force(spark, coders):
    rows = [(r.doc_id, (r.text or "")[:4000]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out, pairs = alignment.align(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), BYTES, PIECES)
    told, counts = brute_alignment(coders, rows)
    assert listed(tuple(r) for r in out.select(*COLUMNS).collect()) == listed(told)
    assert {(r.a_id, r.b_id): r.links for r in pairs.collect()} == counts


def test_op13_query_on_whole_texts(spark, coders):
    got = entry.queries()["op13_tokenizer_alignment"](spark, SF).toPandas()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(got.doc_id) == sorted(texts) and tuple(sorted(got.columns)) == tuple(sorted(COLUMNS))
    for i in sorted(texts, key=lambda i: len(texts[i]))[:100]:
        x, y, groups, _ = coders(texts[i])
        r = got[got.doc_id == i].iloc[0]
        assert (r.n_a, r.n_b, r.n_groups) == (len(x), len(y), len(groups))


def test_op13_odd_texts_and_many_runs(spark, coders, monkeypatch):
    monkeypatch.setattr(alignment, "_FAN", 3)
    monkeypatch.setattr(alignment, "_SHARE", 2)
    rows = [(1, None), (2, ""), (3, " "), (4, "  two  spaces\n\n\ttab "), (5, "<|endoftext|> and <s> </s> <unk> <0x41>"), (6, "ﬁ ① ｆｕｌｌ"),
            (7, "😀 日本語 naïve​ x"), (8, "▁ lower one eighth"), (None, "a null id"), (9, "the same text"), (9, "the same text"),
            (10, "x" * 5000), (11, "\x00\x01"), (12, "word " * 3000)]
    rows += [(100 + i, f"the same text and {i % 5} the other one {i}") for i in range(40)]
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows], "doc_id long, text string, run int, bucket string, frames int").repartition(20)
    told, counts = brute_alignment(coders, rows)
    out, pairs = alignment.align(df, BYTES, PIECES, buckets=5)
    assert listed(tuple(r) for r in out.select(*COLUMNS).collect()) == listed(told)
    assert {(r.a_id, r.b_id): r.links for r in pairs.collect()} == counts
    texts = {r.doc_id: r.groups for r in alignment.groups(df, BYTES, PIECES).collect()}
    assert all(hashlib.sha256(texts[t[0]].encode()).hexdigest() == t[7] if t[7] else texts[t[0]] == "" for t in told)
    none, pairs = alignment.align(df.limit(0), BYTES, PIECES)
    assert none.collect() == [] and pairs.collect() == []


def test_op13_merge_of_runs():
    """K-way merge over frame borders, equal limits and runs that end early; maxima across chunks."""
    rng, runs, told = np.random.default_rng(1), [], Counter()
    for k in range(9):
        keys = np.unique(rng.integers(0, 400, 50 * k)) | (rng.integers(0, 2) << 33)
        keys.sort()
        times = rng.integers(1, 9, len(keys))
        for x, n in zip(keys.tolist(), times.tolist()):
            told[x] += n
        runs.append([alignment._pack(keys[i:i + 7], times[i:i + 7]) for i in range(0, len(keys), 7)])
    chunks = list(alignment._with_best(alignment._merged(runs)))
    keys, sums, best = (np.concatenate(x) for x in zip(*chunks))
    assert keys.tolist() == sorted(told) and dict(zip(keys.tolist(), sums.tolist())) == told
    highest = {}
    for x, n in told.items():
        highest[x >> 32] = max(n, highest.get(x >> 32, 0))
    assert best.tolist() == [told[x] == highest[x >> 32] for x in keys.tolist()]
