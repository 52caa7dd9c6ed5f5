"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column
names: no operator or stage fails, and each gives its stated result."""

import pytest

import corpus_pipeline
from tablewise.llm import (decontam, licences, linededup, mixing, neardup, preference, quality, rlz, secret_scan, warczip)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, key string, features string, "
          "removed string, c long, spans string, kept boolean, by_0 string, bucket int")
LONG = " ".join(f"word{i % 5000}" for i in range(60_000))
TEXT = "The quick brown fox jumps over the lazy dog near the river bank today\nand another line of it follows here"


def row(i, text, lang="en", source="s"):
    return (i, text, lang, source, None, "x", "y", "z", None, 1, "q", True, None, 3)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [row(1, TEXT), row(1, TEXT), row(2, TEXT), row(3, None), row(4, ""), row(5, " \n\t "), row(6, "word"), row(None, "some null id text"),
            row(None, None, None, None), row(7, LONG), row(8, "x" * 100_000, None, None), row(9, "\n" * 1000 + "é 😀 ñ"),
            row(10, " ".join(["same"] * 3000), "en", None), row(11, "token = abcdef123456 " * 3)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


OPERATORS = {
    "secrets": secret_scan.scan_secrets, "near": neardup.near_duplicates, "lines": linededup.line_digests,
    "licences": licences.match_licences, "quality": quality.quality_report, "repeats": rlz.repeat_digests, "mix": mixing.mix,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_each(odd, empty, name):
    out = OPERATORS[name](odd)
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r.doc_id) for r in odd.select("doc_id").collect())
    assert OPERATORS[name](empty).collect() == []


def test_repeated_rows_and_nulls(odd):
    near = {}
    for r in neardup.near_duplicates(odd).collect():
        near.setdefault(r.doc_id, []).append(r)
    assert [r.component_id for r in near[1] + near[2]] == [1, 1, 1] and [r.kept for r in near[1]] == [True, True]
    assert all(r.n_shingles == 0 and r.kept for i in (3, 4, 5) for r in near[i])
    cut = {r.doc_id: r for r in rlz.repeat_digests(odd, window=5, anchor=3).collect()}
    assert cut[1].n_removed == cut[1].n_words and cut[10].n_removed == 3000 and cut[3].n_words == 0
    lines = {r.doc_id: r for r in linededup.line_digests(odd).collect()}
    assert (lines[1].n_removed, lines[2].n_removed, lines[3].n_lines) == (0, 2, 0)
    taken = mixing.mix(odd).collect()
    assert all(r.taken <= 3 * r["size"] for r in taken) and sum(r["size"] == 0 for r in taken) == 4


STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, odd, empty, name):
    sf = "/root/testdata/sf0.001"
    out = STAGES[name](spark, odd, sf)
    rows = out.collect()
    if name != "mixing":
        assert out.columns == odd.columns and 0 < len(rows) <= odd.count()
    else:
        assert len(rows) == odd.count()
    assert STAGES[name](spark, empty, sf).collect() == []


def test_near_stage_keeps_one(spark, odd):
    kept = [r.doc_id for r in STAGES["near_duplicates"](spark, odd, "").collect()]
    assert kept.count(1) == 1 and 2 not in kept and {3, 4, 5, 6, 7, 8, 9, 10, 11} <= set(kept)


def test_line_stage_drops_copies(spark, odd):
    kept = [r.doc_id for r in STAGES["lines"](spark, odd, "").collect()]
    assert 2 not in kept and kept.count(1) == 2 and {3, 4, 5} <= set(kept)


def test_remove_repeats(odd):
    out = rlz.remove_repeats(odd, window=5, anchor=3)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == odd.columns and texts[1] == "" and texts[6] == "word" and texts[3] is None


def test_pipeline_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert 0 < len(out) < docs and out.doc_id.is_unique and (out.taken <= 3 * out["size"]).all()


def test_benchmark_oddities(spark, odd, empty):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "two words"), (None, TEXT)], "item_id long, text string")
    got = {(r.id, r.item) for r in decontam.contaminated(odd, items).collect()}
    assert got == {(1, None), (2, None)}
    assert decontam.contaminated(odd, items.limit(0)).collect() == []
    assert decontam.decontaminate(empty, items).collect() == []


def test_pages(spark):
    schema = "page_id long, url string, html string, digest string, kind string, path string"
    rows = [(1, None, None, "", "", ""), (1, None, None, "", "", ""), (None, "u", "x" * 2000, "", "", ""), (2, "u", "x" * 2000, "", "", ""),
            (2, "u", "x" * 2000, "", "", ""), (3, "u", "é" * 500_000, "", "", "")]
    out = sorted(((r.page_id or -1, r.payload_bytes, r.record_type, r.refers_to) for r in warczip.round_trip(spark.createDataFrame(rows, schema)).collect()))
    assert out == [(-1, 2000, "revisit", 2), (1, 0, "response", None), (1, 0, "response", None), (2, 2000, "response", None),
                   (2, 2000, "response", None), (3, 1_000_000, "response", None)]
    assert warczip.round_trip(spark.createDataFrame([], schema)).collect() == []


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, turns string, n int, conv string"
    rows = [(1, 0, "user", "hi", "", 1, ""), (1, 0, "user", "hi", "", 1, ""), (1, 1, "assistant", "yes", "", 1, ""),
            (2, 0, None, None, "", 1, ""), (2, None, "system", "be", "", 1, ""), (2, 1, "assistant", "no", "", 1, ""),
            (None, 0, "assistant", "x", "", 1, ""), (3, 0, "user", "alone", "", 1, "")]
    convs = preference.conversations(spark.createDataFrame(rows, schema))
    out = {r.pair: r for r in preference.format_preferences(preference.swapped_endings(convs)).collect()}
    assert set(out) == {1, 2} and (out[1].n_common, out[2].n_common) == (1, 2)
    assert out[1].prompt == "<|im_start|>user\nhi<|im_end|>\n" and out[1].chosen == "<|im_start|>assistant\nyes<|im_end|>\n"
    assert out[1].rejected == "<|im_start|>assistant\nno<|im_end|>\n"
    a, b = out[1].chosen_mask[0]
    assert out[1].chosen[a:b] == "yes<|im_end|>\n"
    none = spark.createDataFrame([(1, None, None)], "pair long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    assert preference.format_preferences(none).first().prompt == ""
    assert preference.format_preferences(none.limit(0)).collect() == []
