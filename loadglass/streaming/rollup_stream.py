"""Incremental rollup of a growing folder of raw CSV logs.

Every micro-batch is cleaned with the batch rules and rolled up into a folder of its own.
Counts add up over batches, so no state is kept and late rows need no watermark.

Each input file counts once, whatever fails: a batch counts when the ledger has its record
(see ``sources.ledger``), and a batch that is run again, or a stream that begins again without
its checkpoint, leaves out the files that the ledger has.

Whenever a level has ``FAN_IN`` batches they are rolled up into one of the next level, so each
row is written again once a level, and n batches leave some ``FAN_IN * log(n)`` folders to
read. What was replaced stays on disk until its owner deletes it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loadglass import schema
from loadglass.operators.cleaning import clean_log, parse_log, rejected_log
from loadglass.plans.rollup import read_folders, roll_up
from loadglass.session import scratch_folder
from loadglass.sources import ledger
from loadglass.sources.logs import text_schema

FAN_IN = 8


def read_raw_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """New raw CSV files of a folder, typed like ``read_raw_log``, malformed lines among
    them, and the file of each row."""
    reader = (
        spark.readStream.schema(
            text_schema(schema.RAW_LOG).add(schema.MALFORMED, T.StringType())
        )
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schema.MALFORMED)
        .option("columnPruning", False)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(path)
    return parse_log(
        rows.select(
            *rows.columns,
            F.col("_metadata.file_path").alias(ledger.FILE_NAME),
            F.col("_metadata.file_modification_time").alias(ledger.FILE_TIME),
        )
    )


def _write(rollup: DataFrame, folder: str) -> None:
    rollup.hint("rebalance", "date").write.partitionBy("date").parquet(folder)


def add_batch(rows: DataFrame, path: str, rejects: str | None = None) -> None:
    """Add those rows of a micro-batch whose files are not in the rollup at ``path`` yet."""
    spark = rows.sparkSession
    staged = scratch_folder(spark, "micro-batch")
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    files = rows.select(*ledger.FILE).distinct()
    known = ledger.read_ledger(spark, path)
    if known is not None:
        known = known.select(*ledger.FILE).distinct()
        if not files.join(known, ledger.FILE, "left_semi").isEmpty():
            rows = rows.join(known, ledger.FILE, "left_anti").select(*rows.columns)
            files = files.join(known, ledger.FILE, "left_anti")
    if files.isEmpty():
        return
    batch = ledger.new_batch()
    _write(roll_up(clean_log(rows)), ledger.folder_of(path, batch))
    if rejects:
        rejected_log(rows).write.parquet(ledger.folder_of(rejects, batch))
    ledger.record(spark, path, batch, files=files)


def merge_batches(spark: SparkSession, path: str, fan_in: int = FAN_IN) -> None:
    """Roll up levels that have ``fan_in`` batches, the lowest first."""
    if fan_in < 2:
        raise ValueError("at least two batches make one")
    known = ledger.read_ledger(spark, path)
    levels = ledger.live(known) if known is not None else {}
    level = 0
    while levels and level <= max(levels):
        batches = levels.get(level, [])
        if len(batches) >= fan_in:
            merged = ledger.new_batch()
            folders = [ledger.folder_of(path, batch) for batch in batches]
            _write(
                roll_up(read_folders(spark, path, folders)), ledger.folder_of(path, merged)
            )
            ledger.record(spark, path, merged, level + 1, replaced=batches)
            levels[level] = []
            levels.setdefault(level + 1, []).append(merged)
        level += 1


def start_rollup(
    raw_stream: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    rejects: str | None = None,
    fan_in: int = FAN_IN,
) -> StreamingQuery:
    """Keep the rollup at ``path`` up to date; ``read_rollup`` and the reports read it.

    ``raw_stream`` is one of ``read_raw_stream``. Rejected rows go to the folder ``rejects``,
    which ``read_rejects`` reads. ``available_now`` processes what is there and ends;
    otherwise the query runs on. One stream at a time may write to ``path``.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch, path, rejects)
        merge_batches(batch.sparkSession, path, fan_in)

    writer = raw_stream.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_rejects(spark: SparkSession, path: str, rejects: str) -> DataFrame:
    """The rejected rows of the batches that are in the rollup at ``path``, with the reason,
    the text of malformed lines and the file they came from."""
    known = ledger.read_ledger(spark, path)
    rows = spark.read.parquet(rejects)
    if known is None:
        return rows.limit(0).drop("batch")
    # All batches that were ever recorded: merging moves no rejects.
    return rows.join(ledger.recorded(known), "batch", "left_semi").drop("batch")
