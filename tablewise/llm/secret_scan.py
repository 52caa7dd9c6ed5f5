"""Secret scans with corpus-wide ownership frequency (native expressions only).

Three base patterns give spans in every text.  Their secrets, and those of a
wider pattern for opaque tokens, are hashed and counted by distinct owners and
repositories.  A wide candidate becomes a span of its own kind, ``owned``, if
it looks live (mixed character classes, many different characters) and belongs
to few owners; what many owners hold is a copied example.  Base spans stay
whatever their frequency, which comes with them as a verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewise.functions.core import q
from tablewise.llm.common import row_key, stored

#: The base patterns, in the order in which kinds are listed.
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\x22']?\x20*[:=]\x20*[\x22']?([A-Za-z0-9+/_.=-]+)"
PATTERNS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]{24,}"}
KINDS = ("assign", "access", "hex", "owned")
LEAST = {"access": 20, "hex": 24}
LEAST_ASSIGNED = 6
#: Opaque tokens: a run of token characters.
WIDE = r"[A-Za-z0-9+/_-]{20,}"
#: A mark that the texts don't have: U+0001 becomes U+0002 there, which no pattern knows either.
_MARK = "\x01"


def _marked(text: Column, pattern: str) -> Column:
    """The text cut at the matches: gaps at even places, matches at odd ones."""
    return F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}")), _MARK)


def _spans(text: Column, pattern: str, secret_of) -> Column:
    """[(start, end, secret)] of the matches, in code points, end exclusive."""
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("odd"),
                     F.array().cast("array<struct<start:int,end:int,secret:string>>").alias("out"))

    def step(s: Column, part: Column) -> Column:
        end = s["at"] + F.length(part)
        found = F.array(F.struct(s["at"].alias("start"), end.alias("end"), secret_of(part).alias("secret")))
        return F.struct(end.alias("at"), (~s["odd"]).alias("odd"),
                        F.when(s["odd"], F.concat(s["out"], found)).otherwise(s["out"]).alias("out"))
    none = F.array().cast("array<struct<start:int,end:int,secret:string>>")
    return F.when(text.rlike(pattern), F.aggregate(_marked(text, pattern), start, step)["out"]).otherwise(none)


def _kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"), x["secret"].alias("secret")))


def candidates(text: Column) -> tuple[Column, Column]:
    """Base spans and wide candidates: arrays of (start, kind, end, secret)."""
    assigned = F.filter(_spans(text, ASSIGN, lambda m: F.regexp_extract(m, ASSIGN, 2)),
                        lambda x: F.length(x["secret"]) >= LEAST_ASSIGNED)
    plain = [_kind(_longer(_spans(text, PATTERNS[k], lambda m: m), LEAST[k]), k) for k in ("access", "hex")]
    base = F.array_sort(F.concat(_kind(assigned, "assign"), *plain))
    wide = F.filter(_kind(_spans(text, WIDE, lambda m: m), "owned"), lambda x: looks_live(x["secret"]))
    return base, wide


def _longer(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda x: x["end"] - x["start"] >= least)


def looks_live(secret: Column, least_different: int = 10) -> Column:
    """Digits and letters, and many different characters: random rather than a word or a rule."""
    return (secret.rlike("[0-9]") & secret.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.filter(F.split(secret, ""), lambda x: x != ""))) >= least_different))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def ownership(found: DataFrame) -> DataFrame:
    """(secret, owners, repositories) of (secret, owner, repository) rows.

    Each step combines map-side, so a secret that a third of all rows holds
    sends a row per task and owner.  A null owner or repository counts as one.
    """
    some = found.groupBy("secret", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = some.groupBy("secret", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return owners.groupBy("secret").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repository_col: str = "doc_id", copied_owners: int = 3) -> DataFrame:
    """One row per input row: id, base (spans of the patterns), spans (base and
    owned ones), live and copied (how many spans are owner-specific and widely
    copied).  Spans are (start, kind, end, secret hash), by start, then kind.

    A secret held by ``copied_owners`` owners or more is copied.  A wide
    candidate that is copied, or that a base span overlaps, is no span.  Null
    and empty texts have no spans; rows equal in id, text, owner and repository
    get the same answer; an empty table gives an empty result.
    """
    text = F.replace(F.coalesce(q("text"), F.lit("")), F.lit(_MARK), F.lit("\x02"))
    slim = df.select(q(id_col).alias("id"), q(owner_col).cast("string").alias("owner"),
                     q(repository_col).cast("string").alias("repository"), q(text_col).alias("text"))
    slim = slim.withColumn("key", row_key("id", "owner", "repository", F.coalesce("text", F.lit(""))))
    base, wide = candidates(text)
    # secrets stay hashes from here on
    hashed = lambda c: F.transform(c, lambda x: F.struct(
        x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), F.xxhash64(x["secret"]).alias("secret")))
    found = stored(slim.select("id", "owner", "repository", "key", hashed(base).alias("base"), hashed(wide).alias("wide")), "candidates")
    apart = F.filter("wide", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    each = (found.withColumn("wide", apart).where("size(base) + size(wide) > 0")
            .select("key", "owner", "repository", F.explode(F.concat("base", "wide")).alias("span")))
    frequency = ownership(each.select(F.col("span.secret").alias("secret"), "owner", "repository"))
    told = (each.select("key", "span", F.col("span.secret").alias("secret")).distinct().join(frequency, "secret")
            .withColumn("copied", F.col("owners") >= copied_owners)
            .where(~F.col("copied") | (F.col("span.kind") < KINDS.index("owned")))
            .groupBy("key").agg(F.array_sort(F.collect_list("span")).alias("spans"),
                                F.sum((~F.col("copied")).cast("long")).alias("live"),
                                F.sum(F.col("copied").cast("long")).alias("copied")))
    return found.select("id", "key", "base").join(told, "key", "left").select(
        F.col("id").alias(id_col), "base", F.coalesce("spans", "base").alias("spans"),
        F.coalesce("live", F.lit(0)).cast("long").alias("live"), F.coalesce("copied", F.lit(0)).cast("long").alias("copied"))
