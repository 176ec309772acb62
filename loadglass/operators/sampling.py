"""Samples of an exact size, repeatable because they are chosen by hash.

The n rows with the smallest hash of their id are a uniform sample. Two passes find
them, for any number of samples at once. The first counts, per sample, the rows of each
hash prefix, nearly all of it before the shuffle; the counts tell which prefix the n-th
row falls into. The second keeps the rows of smaller prefixes and ranks those of that
prefix alone, one in a million. The table is not sorted; the rows of the samples go
through one shuffle.

Ids should be unique. A sample has its exact size all the same: rows of equal hash are
cut off at the last rank. Rows without an id are no part of the population.
"""

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the hash that are counted: 1,048,576 prefixes, found in two steps so
# that no window runs over more than 4,096 counts of a sample.
PREFIX = 5
FIRST_STEP = 2


def id_hash(id_column: Column, salt: str = "") -> Column:
    """Hash of the id; samples with different salts are independent."""
    text = id_column.cast("string")
    return F.md5(F.concat(F.lit(salt), text) if salt else text)


def fixed_size(fraction: float) -> Callable[[Column], Column]:
    """The fraction of the rows, cut to a whole number, at least 1."""
    return lambda rows: F.greatest(
        F.lit(1).cast("long"), F.floor(rows * F.lit(float(fraction)))
    )


def rounded_fraction(fraction: float) -> Callable[[Column], Column]:
    """The fraction of the rows, rounded to a whole number, ties to even."""
    return lambda rows: F.rint(rows * F.lit(float(fraction))).cast("long")


@dataclass(frozen=True)
class Draw:
    """How a sample is drawn: its size from the number of rows, and its salt."""

    size: Callable[[Column], Column]
    salt: str = ""


def _edge(counts: DataFrame) -> DataFrame:
    """Of each sample the prefix that its last row falls into, and the rank there."""
    within = Window.partitionBy("sample").orderBy("prefix")
    before = F.sum("n").over(within) - F.col("n")
    return (
        counts.withColumn("before", before)
        .filter(
            (F.col("wanted") > F.col("before"))
            & (F.col("wanted") <= F.col("before") + F.col("n"))
        )
        .select("sample", "prefix", (F.col("wanted") - F.col("before")).alias("rank"))
    )


def _edges(hashed: DataFrame, draws: Mapping[str, Draw]) -> DataFrame:
    """(sample, edge, rank): one row for each sample that has any rows."""
    fine = hashed.groupBy("sample", F.substring("hash", 1, PREFIX).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n")
    )
    coarse = fine.groupBy("sample", F.substring("prefix", 1, FIRST_STEP).alias("prefix")).agg(
        F.sum("n").alias("n")
    )
    rows = F.sum("n").over(Window.partitionBy("sample"))
    wanted = F.lit(None).cast("long")
    for name, draw in draws.items():
        wanted = F.when(F.col("sample") == name, draw.size(F.col("rows"))).otherwise(wanted)
    first = _edge(coarse.withColumn("rows", rows).withColumn("wanted", wanted)).select(
        "sample", F.col("prefix").alias("first"), F.col("rank").alias("wanted")
    )
    inside = fine.join(F.broadcast(first), "sample").filter(
        F.col("prefix").startswith(F.col("first"))
    )
    return _edge(inside).withColumnRenamed("prefix", "edge")


def samples(rows: DataFrame, id_column: str, draws: Mapping[str, Draw]) -> DataFrame:
    """The rows of each sample, with its name in ``sample``."""
    # As hashes that cannot be NULL the joins below add no filter on them, and both uses
    # of the counts share one shuffle.
    drawn = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("sample"),
                    F.coalesce(id_hash(F.col(id_column), draw.salt), F.lit("")).alias("hash"),
                )
                for name, draw in draws.items()
            ]
        )
    ).alias("drawn")
    hashed = rows.filter(F.col(id_column).isNotNull()).select("*", drawn)
    hashed = hashed.select(*rows.columns, "drawn.*")
    # One row for each sample, as many as the caller named.
    edges = F.broadcast(_edges(hashed.select("sample", "hash"), draws))
    near = hashed.join(edges, "sample").withColumn("prefix", F.substring("hash", 1, PREFIX))
    last = F.col("prefix") == F.col("edge")
    # Only rows of the last prefix are ranked together; any other is on its own.
    group = F.when(last, F.lit(-1).cast("long")).otherwise(F.monotonically_increasing_id())
    return (
        near.filter("prefix <= edge")
        .withColumn("group", group)
        .withColumn(
            "position",
            F.row_number().over(Window.partitionBy("sample", "group").orderBy("hash")),
        )
        .filter((F.col("group") >= 0) | (F.col("position") <= F.col("rank")))
        .select("sample", *rows.columns)
    )


def sample(
    rows: DataFrame,
    id_column: str,
    size: Callable[[Column], Column],
    salt: str = "",
) -> DataFrame:
    """Exactly ``size(number of rows)`` rows, or all that have an id if there are fewer."""
    return samples(rows, id_column, {"only": Draw(size, salt)}).drop("sample")
