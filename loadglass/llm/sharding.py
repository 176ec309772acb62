"""Shards by extendible hashing.

A document's key is a 60-bit hash of its id and text. The directory begins as one
bucket; a bucket with more bytes than the limit is split on the next bit of the key, and
only such buckets are. A shard is a bucket at the end, named by the bits that lead to it.

Buckets are split for several bits at once: the bytes of all prefixes of the next bits
are summed, map-side first, and each key's shard is its shortest prefix that fits. What
does not fit after these bits goes on to the next ones, and nothing else does.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadglass.llm.common import repeated, written

# 64 MiB: large enough for sequential reads, small enough to shuffle in memory.
MAX_BYTES = 64 << 20
KEY_BITS = 60
# Bits beyond those that the mean needs, and bits of a later pass.
SPARE_BITS = 4
PASS_BITS = 8


def shard_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The 60-bit key: the first 15 hex digits of the MD5 of id and text."""
    parts = F.concat_ws(
        ":",
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
        F.coalesce(F.col(text), F.lit("")),
    )
    return F.conv(F.substring(F.md5(parts), 1, 15), 16, 10).cast("long")


def text_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def directory(keys: DataFrame, max_bytes: int = MAX_BYTES) -> list[tuple[int, DataFrame]]:
    """The directory of rows (key, bytes): for each pass the number of bits it looks at
    and a table (fine, depth), which tells for the first so many bits of a key how many
    of them name its shard.

    A shard has at most ``max_bytes`` or a single key, which no bit can split. Of each
    pass the driver learns only whether keys are left.
    """
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    start = 0
    end = min(KEY_BITS, math.ceil(math.log2(max(1, total / max_bytes))) + SPARE_BITS)
    left, passes = keys, []
    while True:
        fine = written(
            left.groupBy(F.shiftright("key", KEY_BITS - end).alias("fine")).agg(
                F.sum("bytes").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")
            ),
            "sharding-buckets",
        )
        prefixes = fine.withColumn(
            "depth", F.explode(F.sequence(F.lit(start), F.lit(end)))
        ).withColumn("prefix", F.expr(f"shiftright(fine, {end} - depth)"))
        fits = (
            prefixes.groupBy("depth", "prefix")
            .agg(
                F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high")
            )
            .where((F.col("bytes") <= max_bytes) | (F.col("low") == F.col("high")))
        )
        # The prefixes count to Spark as one row for each of ``fine``, and must not be broadcast
        # for that.
        placed = written(
            prefixes.select("fine", "depth", "prefix")
            .hint("merge")
            .join(fits.select("depth", "prefix"), ["depth", "prefix"])
            .groupBy("fine")
            .agg(F.min("depth").alias("depth")),
            "sharding-directory",
        )
        passes.append((end, placed))
        rest = fine.select("fine").join(placed, "fine", "left_anti")
        if rest.isEmpty():
            return passes
        left = written(
            left.withColumn("fine", F.shiftright("key", KEY_BITS - end))
            .join(rest, "fine", "left_semi")
            .select("key", "bytes"),
            "sharding-left",
        )
        start, end = end + 1, min(KEY_BITS, end + PASS_BITS)


def placed(keyed: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows of ``keyed``, which have ``key`` and ``bytes``, with ``depth``, ``shard``
    (s and the bits that name it) and ``page``.

    Rows of equal key are equal rows. If they alone exceed the limit, their shard goes on
    in pages of as many rows as fit, and of one row at least.
    """
    columns = keyed.columns
    keyed = written(keyed, "sharding-keys")
    depth = F.lit(None).cast("int")
    rows = keyed
    for number, (bits, table) in enumerate(directory(keyed.select("key", "bytes"), max_bytes)):
        fine, found = f"fine__{number}", f"depth__{number}"
        table = table.select(F.col("fine").alias(fine), F.col("depth").alias(found))
        rows = rows.withColumn(fine, F.shiftright("key", KEY_BITS - bits)).join(table, fine, "left")
        depth = F.coalesce(depth, F.col(found))
    rows = rows.select(*columns, depth.alias("depth"))
    full = (
        keyed.groupBy("key").agg(F.sum("bytes").alias("all")).where(F.col("all") > max_bytes)
    ).select(F.col("key").alias("key__full"))
    rows = rows.join(full, F.col("key") == F.col("key__full"), "left")
    page = F.expr(f"(k - 1) div greatest(1, {max_bytes} div greatest(1, bytes))")
    counted = (
        rows.where("key__full IS NOT NULL").groupBy(*columns, "depth").agg(F.count("*").alias("n"))
    )
    paged = repeated(counted, "n", "k", ["key"]).select(*columns, "depth", page.alias("page"))
    bits = F.lpad(F.bin("key"), KEY_BITS, "0")
    return (
        rows.where("key__full IS NULL")
        .select(*columns, "depth", F.lit(0).cast("long").alias("page"))
        .unionByName(paged)
        .withColumn("shard", F.concat(F.lit("s"), F.substring(bits, F.lit(1), F.col("depth"))))
    )


def assign(documents: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, bytes, depth, shard and page.

    The same rows always get the same shards. Null ids and texts count as empty; a text
    of its own over the limit has a shard of its own. Rows equal in id and text stay
    together, on further pages of their shard if they alone exceed the limit. Without
    documents there are no rows.
    """
    keyed = documents.select("doc_id", shard_key().alias("key"), text_bytes().alias("bytes"))
    return placed(keyed, max_bytes).select("doc_id", "bytes", "depth", "shard", "page")


def write_shards(documents: DataFrame, path: str, max_bytes: int = MAX_BYTES) -> None:
    """Write all columns of ``documents`` as Parquet, a folder for each shard and page;
    columns that are called shard or page are left out.

    The cases of :func:`assign` apply. Equal ids and texts with other columns that differ
    are equal rows only in part; their pages count each kind on its own.
    """
    columns = [name for name in documents.columns if name not in ("shard", "page")]
    rows = documents.select(
        F.struct(*columns).alias("row"), shard_key().alias("key"), text_bytes().alias("bytes")
    )
    (
        placed(rows, max_bytes)
        .select("row.*", "shard", "page")
        .repartition("shard", "page")
        .write.partitionBy("shard", "page")
        .parquet(path)
    )


def assign_sql(max_bytes: int = MAX_BYTES, documents: str = "documents") -> str:
    """:func:`assign` in DuckDB's SQL, by all depths of all keys."""
    return f"""
WITH keyed AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':'
            || coalesce(text, '')), 1, 15) AS BIGINT) AS k
    FROM {documents}
), bits AS (
    SELECT *, to_base(k, 2, {KEY_BITS}) AS bits,
        row_number() OVER (PARTITION BY k) AS copy, sum(bytes) OVER (PARTITION BY k) AS alone
    FROM keyed
), keys AS (
    SELECT k, bits, sum(bytes) AS bytes FROM bits GROUP BY k, bits
), prefixes AS (
    SELECT k, depth, sum(bytes) OVER bucket AS total, count(*) OVER bucket AS members
    FROM keys, range({KEY_BITS} + 1) AS depths(depth)
    WINDOW bucket AS (PARTITION BY depth, substr(bits, 1, CAST(depth AS INTEGER)))
), leaves AS (
    SELECT k, min(depth) AS depth FROM prefixes
    WHERE total <= {max_bytes} OR members = 1 GROUP BY k
)
SELECT doc_id, CAST(bytes AS BIGINT) AS bytes, CAST(depth AS INTEGER) AS depth,
    's' || substr(bits, 1, CAST(depth AS INTEGER)) AS shard,
    CAST(CASE WHEN alone > {max_bytes}
        THEN (copy - 1) // greatest(1, {max_bytes} // greatest(1, bytes)) ELSE 0 END AS BIGINT)
        AS page
FROM bits JOIN leaves USING (k)"""
