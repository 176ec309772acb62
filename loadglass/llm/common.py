"""What the corpus operators share: reading, keys, and tables between steps.

A document is known by ``doc_id`` and the hash of its text together, so rows that
repeat an id with another text stay apart, and rows that repeat both share a result.
"""

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import loadglass
from loadglass.session import scratch_folder

# Functions reach the Python workers as they are, so that no worker needs this package.
cloudpickle.register_pickle_by_value(loadglass)

# Texts that a Python worker turns into objects at a time.
ROWS_AT_ONCE = 256

# Numbers that are folded into an array at a time.
FOLD = 512

# Copies of a row that one task makes at a time.
COPIES = 4096

# Columns of our own beside those of an input begin with two underscores.
TEXT_HASH = "__text_hash"
ROWS = "__rows"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows, once, as Parquet in the folder that all executors share.

    Later steps read the files instead of computing the rows again, also after an
    executor is lost, and the optimizer knows their true size.
    """
    spark = frame.sparkSession
    path = scratch_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_hash(column: str = "text") -> Column:
    return F.xxhash64(F.col(column))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` has it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


Combine = Callable[[Column, Column], Column]


def _folded_before_few(numbers: Column, start: Column, combine: Combine, kind: str) -> Column:
    return F.aggregate(
        numbers,
        F.struct(
            start.alias("done"), F.expr(f"cast(array() as array<{kind}>)").alias("before")
        ),
        lambda state, x: F.struct(
            combine(state["done"], x).alias("done"),
            F.concat(state["before"], F.array(state["done"])).alias("before"),
        ),
        lambda state: state["before"],
    )


def folded_before(numbers: Column, start: Column, combine: Combine, kind: str) -> Column:
    """For each number of an array, of the type ``kind``, those before it, combined; ``start``
    is neutral.

    A fold copies what it holds at each step, so numbers are folded in blocks, and then what
    the blocks come to: the time grows as the numbers do.
    """
    blocks = F.when(
        F.size(numbers) > 0,
        F.transform(
            F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / FOLD).cast("int")),
            lambda block: F.slice(numbers, block * FOLD + 1, F.lit(FOLD)),
        ),
    ).otherwise(F.expr(f"cast(array() as array<array<{kind}>>)"))

    def shifted(blocks: Column) -> Column:
        whole = F.transform(blocks, lambda block: F.aggregate(block, start, combine))
        return let(
            _folded_before_few(whole, start, combine, kind),
            lambda before: F.flatten(
                F.transform(
                    blocks,
                    lambda block, at: F.transform(
                        _folded_before_few(block, start, combine, kind),
                        lambda x: combine(F.get(before, at), x),
                    ),
                )
            ),
        )

    return let(blocks, shifted)


def sums_before(numbers: Column) -> Column:
    """For each int of an array the sum of those before it."""
    return folded_before(numbers, F.lit(0), lambda a, b: a + b, "int")


def greatest_before(numbers: Column) -> Column:
    """For each long of an array, none below 0, the greatest of those before it, or -1."""
    return folded_before(numbers, F.lit(-1).cast("long"), lambda a, b: F.greatest(a, b), "bigint")


def repeated(rows: DataFrame, times: str, number: str, keys: list[str]) -> DataFrame:
    """Each row as often as its column ``times`` says, numbered from 1 in ``number``.

    Copies go to the tasks in blocks of ``COPIES``, by block and ``keys``, so that no task has
    all copies of a row. It shuffles the rows, so it is for the few that have many copies.
    """
    block = "__block"
    return (
        rows.where(F.col(times) > 0)
        .withColumn(block, F.explode(F.expr(f"sequence(0L, ({times} - 1) div {COPIES})")))
        .repartition(block, *keys)
        .withColumn(
            number,
            F.explode(
                F.expr(
                    f"sequence({block} * {COPIES} + 1, least({times}, ({block} + 1) * {COPIES}))"
                )
            ),
        )
        .drop(block)
    )


def match(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """A join on equal keys, null to null, that keeps the keys of the left side once."""
    other = {key: f"{key}__right" for key in keys}
    right = right.withColumnsRenamed(other)
    condition = reduce(
        and_, (F.col(key).eqNullSafe(F.col(name)) for key, name in other.items())
    )
    return left.join(right, condition, how).drop(*other.values())


def chosen_parts(
    documents: DataFrame, picked: DataFrame, keys: list[str]
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``documents``, which have the ``keys``, that ``picked`` has, one for
    each; ``picked`` also has ``ROWS``, how many rows have this key, and its other columns
    are added. First those of one row, then those of several.

    Only keys of several rows need their rows together.
    """
    alone = match(documents, picked.where(F.col(ROWS) == 1), keys, "inner")
    several = match(documents, picked.where(F.col(ROWS) > 1), keys, "inner")
    return alone.drop(ROWS), several.dropDuplicates(keys).drop(ROWS)


def chosen(documents: DataFrame, picked: DataFrame, keys: list[str]) -> DataFrame:
    """Both parts of :func:`chosen_parts`."""
    alone, several = chosen_parts(documents, picked, keys)
    return alone.unionByName(several)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)
