"""Secret scans with corpus-wide ownership frequency.

Base spans are what the published patterns match. The method adds spans of generic
tokens: long runs that mix letters and digits. Whether such a token is live cannot be
told from its text, so all candidate values are hashed and, over the whole corpus, the
distinct repositories and owners that hold a hash are counted. A value of many owners is
an example that was copied around; one of a single owner, or few, looks like a credential
of that owner. Generic spans are added only for values that look live.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadglass.llm.common import TEXT_HASH, let, match, sums_before, text_hash, written

# ---- Fixed values: the published patterns, in order, and their least lengths -----
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH = 8
ACCESS_LENGTH = 16
HEX_LENGTH = 32
KINDS = ["assign", "access", "hex"]
# ----------------------------------------------------------------------------------

# A generic token: a run of at least so many characters with a lower-case letter, an
# upper-case letter and a digit in it.
GENERIC = "generic"
GENERIC_LENGTH = 24
_GENERIC = (
    r"(?<![A-Za-z0-9_-])(?=[A-Z0-9_-]*[a-z])(?=[a-z0-9_-]*[A-Z])(?=[A-Za-z_-]*[0-9])"
    rf"[A-Za-z0-9_-]{{{GENERIC_LENGTH},}}"
)

# A value of more owners than this is an example.
LIVE_OWNERS = 2

SPAN = "struct<start: int, rank: int, end: int, value: string>"


def _spans(text: Column, pattern: str, rank: int, keep, value) -> Column:
    """Spans (start, rank, end, value) of all matches, leftmost and apart; ``keep`` tells
    from a match and its value which stay.

    The places follow from the lengths of what stands between the matches.
    """
    none = F.expr(f"cast(array() as array<{SPAN}>)")

    def spans(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))
        lengths = F.transform(pairs, lambda x: F.length(x["gap"]) + F.length(x["hit"]))
        placed = F.arrays_zip(let(lengths, sums_before).alias("at"), gaps.alias("gap"), hits.alias("hit"))
        return F.transform(
            F.filter(placed, lambda x: keep(x["hit"])),
            lambda x: F.struct(
                (x["at"] + F.length(x["gap"])).alias("start"),
                F.lit(rank).alias("rank"),
                (x["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"),
                value(x["hit"]).alias("value"),
            ),
        )

    # Texts that hold no match, which are most, are scanned once and not taken apart.
    walked = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)
    return F.when(F.rlike(text, F.lit(pattern)), walked).otherwise(none)


def find_spans(text: Column) -> tuple[Column, Column]:
    """The base spans of a text, in order, and its generic spans."""
    same = lambda hit: hit
    assigned = lambda hit: F.regexp_extract(hit, ASSIGN, 1)
    base = F.concat(
        _spans(text, ASSIGN, 0, lambda hit: F.length(assigned(hit)) >= ASSIGN_LENGTH, assigned),
        _spans(text, ACCESS, 1, lambda hit: F.length(hit) >= ACCESS_LENGTH, same),
        # Shorter runs of hex digits are apart from longer ones, so they need no match.
        _spans(text, f"[0-9a-f]{{{HEX_LENGTH},}}", 2, lambda hit: F.lit(True), same),
    )
    return F.array_sort(base), _spans(text, _GENERIC, 3, lambda hit: F.lit(True), same)


def ownership(candidates: DataFrame) -> DataFrame:
    """(value_hash, repositories, owners, live) of rows (value_hash, owner, repository).

    Each holder counts once. A null owner or repository is one like any other.
    """
    return (
        candidates.select("value_hash", "owner", "repository")
        .distinct()
        .groupBy("value_hash", "owner")
        .agg(F.count("*").alias("repositories"))
        .groupBy("value_hash")
        .agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"))
        .withColumn("live", F.col("owners") <= LIVE_OWNERS)
    )


def scan_secrets(documents: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """Per row of ``documents`` (doc_id, text and what owner and repository are made of):
    doc_id, ``base`` spans, ``base_live``, whether the value of each of these looks live,
    ``generic`` spans of live-looking values, and ``holders``: of each value found its hash,
    repositories, owners and whether it looks live.

    Owners alone decide: an owner's credential may be in all of their repositories, whose
    number is told beside it. Spans are (start, rank, end, value) in code points, end
    exclusive, in order. Null and empty texts have none; ``base_live`` and ``holders`` are
    null without a span. Very long texts are scanned whole, in time that grows as their
    length and number of spans. Repeated rows have equal spans and count as one holder. Only
    doc_id, text and what owner and repository are made of are read, so other columns may
    have any name. Without documents there are no rows.
    """
    base, generic = find_spans(F.coalesce("text", F.lit("")))
    scanned = written(
        documents.select(
            "doc_id",
            text_hash().alias(TEXT_HASH),
            owner.alias("owner"),
            repository.alias("repository"),
            base.alias("base"),
            generic.alias("generic"),
        ),
        "secrets",
    )
    key = ["doc_id", TEXT_HASH]
    candidates = written(
        scanned.select(*key, "owner", "repository", F.inline(F.concat("base", "generic")))
        .select(*key, "owner", "repository", F.xxhash64("value").alias("value_hash"))
        .distinct(),
        "secrets-candidates",
    )
    held = written(ownership(candidates), "secrets-owners")
    holders = (
        candidates.select(*key, "value_hash")
        .distinct()
        .join(held, "value_hash")
        .groupBy(*key)
        .agg(
            F.array_sort(
                F.collect_list(F.struct("value_hash", "repositories", "owners", "live"))
            ).alias("holders")
        )
    )
    # Each span meets the verdict on its value in a join: a look through all values of a text
    # for each of its spans would be quadratic.
    spans = ["start", "rank", "end", "value"]
    judged = (
        scanned.select(*key, F.inline(F.concat("base", "generic")))
        .distinct()
        .withColumn("value_hash", F.xxhash64("value"))
        .join(held.select("value_hash", "live"), "value_hash")
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(F.struct(*spans, "live"))).alias("judged"))
    )
    generic = F.transform(
        F.filter("judged", lambda x: (x["rank"] == F.lit(len(KINDS))) & x["live"]),
        lambda x: F.struct(*(x[name].alias(name) for name in spans)),
    )
    base_live = F.transform(
        F.filter("judged", lambda x: x["rank"] < len(KINDS)), lambda x: x["live"]
    )
    found = match(scanned.drop("owner", "repository", "generic"), holders, key)
    return match(found, judged, key).select(
        "doc_id",
        "base",
        base_live.alias("base_live"),
        F.coalesce(generic, F.expr(f"cast(array() as array<{SPAN}>)")).alias("generic"),
        "holders",
    )


def digest_text(spans: Column) -> Column:
    """kind:start:end of spans in order of start and kind, comma-joined."""
    kind = F.array(*map(F.lit, [*KINDS, GENERIC]))
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda span: F.concat_ws(
                ":", F.element_at(kind, span["rank"] + 1), span["start"], span["end"]
            ),
        ),
        ",",
    )
