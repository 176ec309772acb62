"""Writes whose tasks fail once each at their end; see test_gathered.py."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402

from loadglass.session import session  # noqa: E402
from loadglass.sources import logs  # noqa: E402
from test_gathered import assert_as_scanned, written  # noqa: E402


def main(folder):
    import pathlib

    folder = pathlib.Path(folder)
    spark = session(
        "retried", "local[2,3]",
        {"spark.checkpoint.dir": str(folder / "scratch"), "spark.sql.shuffle.partitions": "1"},
    )
    spark.sparkContext.setLogLevel("OFF")
    def fails_at_first(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")

    raw = logs.read_raw_log(spark, str(folder / "0.csv")).coalesce(1)
    tables = written(
        raw, folder, lambda rows: rows.mapInArrow(fails_at_first, rows.schema)
    )
    assert_as_scanned(tables, raw)
    tracker = spark.sparkContext.statusTracker()
    stages = [
        tracker.getStageInfo(number)
        for job in tracker.getJobIdsForGroup() for number in tracker.getJobInfo(job).stageIds
    ]
    print("failed attempts:", sum(x.numFailedTasks for x in stages if x))
    spark.stop()


main(sys.argv[1])
