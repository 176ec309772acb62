"""Which folders of a growing rollup count, and which input files are in them.

A batch is a folder ``batch=NAME`` of its own, with a name that is never used again. It counts
from the moment its record is in ``_ledger``: one Parquet file, which appears whole or not at
all. The record names the input files of the batch and the batches that it replaces. So a
batch that was cut off is never read, and files that are in a batch are known without any
other memory, also when the checkpoint of a stream is lost. One writer at a time.
"""

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Input files are known by name and time, as the file source knows them.
FILE_NAME = "source_file"
FILE_TIME = "source_file_time"
FILE = [FILE_NAME, FILE_TIME]

# A row has a file, or a batch that is replaced, or neither: this one is the batch itself.
LEDGER = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField(FILE_NAME, T.StringType()),
        T.StructField(FILE_TIME, T.TimestampType()),
        T.StructField("replaced", T.StringType()),
    ]
)


def new_batch() -> str:
    return uuid.uuid4().hex


def folder_of(path: str, batch: str) -> str:
    return f"{path.rstrip('/')}/batch={batch}"


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The records at ``path``; None where no batch has been recorded yet."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{path.rstrip('/')}/_ledger")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def record(
    spark: SparkSession,
    path: str,
    batch: str,
    level: int = 0,
    files: DataFrame | None = None,
    replaced: Sequence[str] = (),
) -> None:
    """Make a batch count, and those it replaces no longer."""
    own = [(batch, level, None, None, name) for name in [None, *replaced]]
    rows = spark.createDataFrame(own, LEDGER)
    if files is not None:
        rows = rows.unionByName(
            files.select(*FILE).withColumns(
                {
                    "batch": F.lit(batch),
                    "level": F.lit(level),
                    "replaced": F.lit(None).cast("string"),
                }
            )
        )
    rows.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/_ledger")


def recorded(ledger: DataFrame) -> DataFrame:
    """The batches that were ever recorded, with their level."""
    return ledger.where(F.col(FILE_NAME).isNull() & F.col("replaced").isNull()).select(
        "batch", "level"
    )


def live(ledger: DataFrame) -> dict[int, list[str]]:
    """The batches that count, by level. Merging keeps them few, see ``streaming``."""
    gone = ledger.where(F.col("replaced").isNotNull()).select(F.col("replaced").alias("batch"))
    levels: dict[int, list[str]] = {}
    for row in recorded(ledger).join(gone, "batch", "left_anti").orderBy("batch").collect():
        levels.setdefault(row["level"], []).append(row["batch"])
    return levels


def live_folders(spark: SparkSession, path: str) -> list[str] | None:
    """The folders to read instead of ``path``; None if it has no ledger."""
    ledger = read_ledger(spark, path)
    if ledger is None:
        return None
    return [folder_of(path, batch) for level in live(ledger).values() for batch in level]
