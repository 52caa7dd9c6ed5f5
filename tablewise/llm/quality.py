"""Quality rules with thresholds learned from the corpus (native expressions only).

Features of every text are higher-order array expressions over its words; the
thresholds of a feature are outer fences ``q3 + width * max(q3 - q1, floor)``
of mergeable quantile sketches per language and source.  A fence follows its
group: where tables of symbols are usual, more symbols are allowed.  A small
group says little about what is usual: its quartiles are mixed with those of
its language, and those with the corpus's, by weights that grow with the rows
(``OWN_ROWS``), so that the junk of a small source doesn't set its fence.  The floor
is the least spread a group is credited with, so that a group whose documents
all have the same value (no symbol at all, say) doesn't reject its first other
document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewise.functions.core import q
from tablewise.llm.common import SPACE, WORD, free_name, row_key, stored, without

#: Features that have an upper fence, with the floor of their quartile distance.
FENCES = {"symbol_ratio": 0.02, "dup_line_ratio": 0.15, "upper_ratio": 0.10, "word_length": 2.0}
FENCE_WIDTH = 3.0
#: Rows at which a group's own quartiles weigh as much as those of the level above: n^2 / (n^2 + OWN_ROWS^2).
OWN_ROWS = 10.0
#: Relative accuracy of the sketches (rank error of one in this many rows).
SKETCH_ACCURACY = 10_000


def _repeat_words(packed: Column, mask: Column, n: int) -> Column:
    """Words in n-word windows found twice or more: ``packed`` has the sorted
    longs (window hash, place); equal hashes are neighbours."""
    same = F.zip_with(packed, F.concat(F.array(F.lit(None).cast("long")), packed),
                      lambda x, before: F.coalesce((x.bitwiseXOR(before)).bitwiseAND(F.bitwise_not(mask)) == 0, F.lit(False)))
    follows = F.slice(same, 2, F.size(packed))  # the next one equals this one
    places = F.filter(F.zip_with(packed, F.zip_with(same, follows, lambda a, b: a | F.coalesce(b, F.lit(False))),
                                 lambda x, hit: F.when(hit, x.bitwiseAND(mask))), lambda x: x.isNotNull())
    covered = F.aggregate(F.array_sort(places), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-n).cast("long").alias("at")),
                          lambda acc, x: F.struct((acc["n"] + F.least(F.lit(n).cast("long"), x - acc["at"])).alias("n"), x.alias("at")))
    return covered["n"]


def quality_features(df: DataFrame, text_col: str = "text", window: int = 5) -> DataFrame:
    """``df`` without its text, with a struct column ``features``.

    A null text counts as empty: all counts are 0.
    """
    names = {n: free_name(df, f"feature_{n}") for n in ("text", "words", "lines", "packed", "mask")}
    text, words, lines, packed, mask = (q(n) for n in names.values())
    out = df.withColumn(names["text"], F.coalesce(q(text_col), F.lit("")))
    out = out.withColumns({
        names["words"]: F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)),
        names["lines"]: F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))})
    # place in the low bits, as many as the text needs; the window's hash above them
    out = out.withColumn(names["mask"], F.pow(F.lit(2), F.ceil(F.log2(F.size(words) + 2))).cast("long") - 1)
    starts = F.when(F.size(words) >= window, F.sequence(F.lit(1), F.size(words) - window + 1)).otherwise(F.array().cast("array<int>"))
    gram = lambda i: F.xxhash64(*(F.element_at(words, i + k) for k in range(window)))
    out = out.withColumn(names["packed"], F.sort_array(F.transform(
        starts, lambda i: gram(i).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))))
    letters = F.length(F.regexp_replace(text, r"[^\p{Lu}\p{Ll}]+", ""))
    n_words = F.size(words).cast("long")
    features = F.struct(
        n_words.alias("n_words"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        _repeat_words(packed, mask, window).alias("n_repeat_words"),
        letters.cast("long").alias("n_letters"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"))
    name = free_name(df, "features")
    return out.withColumn(name, features).select(
        *(q(c) for c in df.columns), q(name))


def measures(features: Column) -> dict[str, Column]:
    """The ratios that have a fence; null where a text has nothing to measure."""
    part = lambda a, b: F.when(features[b] > 0, features[a] / features[b])
    return {"symbol_ratio": part("n_symbols", "word_chars"), "dup_line_ratio": part("n_dup_lines", "n_lines"),
            "upper_ratio": part("n_upper", "n_letters"),
            "word_length": part("word_chars", "n_words")}


def base_failed(features: Column, min_words: int = 10, most_repeat_percent: int = 20) -> Column:
    return (features["n_words"] < min_words) | (100 * features["n_repeat_words"] > most_repeat_percent * features["n_words"])


def _sketches(featured: DataFrame, by: list[str], features: str) -> DataFrame:
    """Quartiles ``q`` and number ``n`` of each measure by group; documents that fail the base rules don't count."""
    m = measures(q(features))
    return featured.where(~base_failed(q(features))).groupBy(*(q(c) for c in by)).agg(*(
        F.struct(F.percentile_approx(m[k], [0.25, 0.75], SKETCH_ACCURACY).alias("q"), F.count(m[k]).cast("double").alias("n")).alias(k)
        for k in FENCES))


def _mixed(own: Column, above: Column) -> Column:
    weight = own["n"] * own["n"] / (own["n"] * own["n"] + OWN_ROWS ** 2)
    return F.when(own["q"].isNull(), above).otherwise(F.zip_with(own["q"], above, lambda a, b: weight * a + (1 - weight) * b))


def adaptive_thresholds(featured: DataFrame, by: list[str], features: str = "features") -> DataFrame:
    """One row per group ``by`` (nulls are a group): the fence of each measure.

    The levels are the corpus, the first column of ``by``, the first two and so
    on; each level's quartiles are mixed with those of the one above.  Sketches
    merge map-side, so a group of any size sends one sketch per task.
    """
    level = _sketches(featured, [], features).select(*(F.col(k)["q"].alias(k) for k in FENCES))
    for i in range(1, len(by) + 1):
        above = level.select(*(q(c).alias(f"above_{j}") for j, c in enumerate(by[:i - 1])), *(F.col(k).alias(f"above_{k}") for k in FENCES))
        on = F.lit(True)
        for j, c in enumerate(by[:i - 1]):
            on = on & q(c).eqNullSafe(F.col(f"above_{j}"))
        own = _sketches(featured, by[:i], features)
        level = (own.join(above, on) if i > 1 else own.crossJoin(above)).select(
            *(q(c) for c in by[:i]), *(_mixed(F.col(k), F.col(f"above_{k}")).alias(k) for k in FENCES))
    return level.select(*(q(c) for c in by), F.struct(*(
        (F.col(k)[1] + FENCE_WIDTH * F.greatest(F.col(k)[1] - F.col(k)[0], F.lit(floor))).alias(k)
        for k, floor in FENCES.items())).alias("fences"))


def judged(featured: DataFrame, thresholds: DataFrame, by: list[str], features: str = "features") -> DataFrame:
    """``featured`` with boolean columns ``base_failed`` and ``kept``."""
    names = {c: free_name(featured, f"group_{i}") for i, c in enumerate(by)}
    limits = thresholds.select(*(q(c).alias(n) for c, n in names.items()), q("fences").alias(free_name(featured, "fences")))
    fences = q(free_name(featured, "fences"))
    same = [q(c).eqNullSafe(q(n)) for c, n in names.items()]
    on = same[0]
    for x in same[1:]:
        on = on & x
    failed = base_failed(q(features))
    over = F.lit(False)
    for k, v in measures(q(features)).items():
        over = over | F.coalesce(v > fences[k], F.lit(False))
    return (featured.join(limits, on, "left")
            .withColumns({"base_failed": failed, "kept": ~failed & ~over}).drop(*names.values()))


def _key(id_col: str, text_col: str, by: tuple[str, ...]) -> Column:
    return row_key(q(id_col), F.coalesce(q(text_col), F.lit("")), *(q(c) for c in by))


def quality_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """One row per input row: id, key, the features, base_failed, kept.

    ``kept`` is false for a text of fewer than 10 words, one with over 20 % of
    its words in repeated 5-word windows, or one beyond a fence of its group
    (which a small group borrows from the level above).
    Null and empty texts fail the base rules.  Rows equal in id, text and group
    share ``key`` and are judged alike; an empty table gives an empty result.
    """
    groups = [f"by_{i}" for i in range(len(by))]
    slim = df.select(q(id_col).alias("id"), _key(id_col, text_col, by).alias("key"), q(text_col).alias("text"),
                     *(q(c).alias(g) for c, g in zip(by, groups)))
    # written once: a filter on the verdict must not be pushed into the features' array expressions
    featured = stored(quality_features(slim).drop("text"), "features")
    out = judged(featured, adaptive_thresholds(featured, groups), groups)
    return out.select(q("id").alias(id_col), q("key"), "features.*", "base_failed", "kept")


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``df`` without the documents that ``quality_report`` rejects."""
    key = free_name(df, "quality_key")
    rejected = stored(quality_report(df, id_col, text_col, by).where(~F.col("kept")).select("key").distinct(), "rejected")
    return without(df.withColumn(key, _key(id_col, text_col, by)), rejected, key).select(*(q(c) for c in df.columns))
