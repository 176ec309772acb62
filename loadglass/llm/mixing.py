"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, the number of times the mix takes it. Among all rates that
give every source its target of words, entropy balancing picks those nearest to 1 in
relative entropy, counted by words: the minimum of sum(size * (r log r - r)). Its dual is
convex, and its solution tilts the rates exponentially: r = exp(sum of the multipliers
of the constraints that the document is in). Newton steps on the multipliers solve it.

Documents enter only through their constraint values, so the iteration runs over cells:
words per combination of constraint values, summed once before the shuffle. Each
constraint column is a block of the dual whose Hessian is diagonal; blocks take their
steps in turn. One block, as for sources alone, needs no shuffle after the first.

Rates become whole copies by chunks of a source, a few hundred documents each: from the
longest to the shortest, each takes the number of copies next to its rate that keeps the
sum of words closest to what the rates ask for. What is left over at the end is about the
size of the shortest documents of the chunk.
"""

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadglass.llm.common import (
    COPIES,
    ROWS,
    TEXT_HASH,
    chosen_parts,
    match,
    repeated,
    written,
)

# ---- Fixed values: the published mix ----------------------------------------------
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = [1, 2, 3]
MAX_REPEATS = 3
# -----------------------------------------------------------------------------------

CHUNK_DOCUMENTS = 500
# Newton steps of a block. Far from the target they move by about 1, near it they
# converge quadratically.
STEPS = 64
# Rounds over all blocks, if there are several, and the error that ends them.
ROUNDS = 50
TOLERANCE = 1e-9


def words(text: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in code point order, null last, weigh 1, 2, 3 and so on again. They share
    all words; a target stops at three times its source's words and the excess is shared
    anew by weight among the others.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source; only their order needs them in one place.
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(rank, F.lit(len(WEIGHTS))) + 1)
    sources = written(
        sources.withColumn("weight", weight).withColumn(
            "limit", MAX_REPEATS * F.col("source_size")
        ),
        "mixing-sources",
    )
    # A source takes min(limit, level * weight). The level rises as sources drop out.
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, free = (total / weights if weights else 0.0), weights
    while free:
        full = F.col("limit") <= level * F.col("weight")
        spent, left = sources.agg(
            F.sum(F.when(full, F.col("limit")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
        ).first()
        if left == free or not left:
            break
        level, free = (total - spent) / left, left
    return sources.select(
        "source",
        "source_size",
        F.least(F.col("limit").cast("double"), F.lit(float(level)) * F.col("weight")).alias(
            "target"
        ),
    )


def _newton(mass: Column, target: Column, multiplier: Column) -> Column:
    """Newton steps on one multiplier: the gradient of the dual is mass * exp(x) - target
    and its Hessian mass * exp(x). A step is at most 1 up, as exp overshoots."""
    steps = F.sequence(F.lit(1), F.lit(STEPS))
    solved = F.aggregate(
        steps,
        F.lit(0.0),
        lambda x, _: x + F.least(target / (mass * F.exp(x)) - 1, F.lit(1.0)),
    )
    return F.when((mass > 0) & (target > 0), multiplier + solved).otherwise(multiplier)


def multipliers(cells: DataFrame, targets: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Of each constraint column a table (value, multiplier).

    ``cells`` has the constraint columns and ``size``; ``targets`` gives for each column
    a table (value, target). Targets that contradict each other end at ``ROUNDS``.
    """
    found = {
        name: table.select("value", "target", F.lit(0.0).alias("multiplier"))
        for name, table in targets.items()
    }
    for _ in range(ROUNDS if len(found) > 1 else 1):
        worst = 0.0
        for name in found:
            masses = (
                rated(cells, found)
                .groupBy(F.col(name).alias("value"))
                .agg(F.sum(F.col("size") * F.col("rate")).alias("mass"))
            )
            state = written(
                match(found[name], masses, ["value"]).withColumn(
                    "mass", F.coalesce("mass", F.lit(0.0))
                ),
                "mixing-multipliers",
            )
            if len(found) == 1:
                moved = _newton(F.col("mass"), F.col("target"), F.col("multiplier"))
                return {name: state.select("value", "target", moved.alias("multiplier"))}
            gap = F.abs(F.col("mass") - F.col("target")) / F.col("target")
            worst = max(
                worst, state.where("mass > 0 AND target > 0").agg(F.max(gap)).first()[0] or 0.0
            )
            moved = _newton(F.col("mass"), F.col("target"), F.col("multiplier"))
            found[name] = state.select("value", "target", moved.alias("multiplier"))
        if worst < TOLERANCE:
            break
    return found


def rated(rows: DataFrame, found: Mapping[str, DataFrame]) -> DataFrame:
    """The rows with their exponentially tilted ``rate``; values without a target are 1."""
    exponent = F.lit(0.0)
    for number, (name, table) in enumerate(found.items()):
        column = f"multiplier__{number}"
        renamed = table.select(F.col("value").alias(name), F.col("multiplier").alias(column))
        rows = match(rows, renamed, [name])
        exponent = exponent + F.coalesce(column, F.lit(0.0))
    return rows.withColumn("rate", F.exp(exponent)).drop(
        *(f"multiplier__{number}" for number in range(len(found)))
    )


def round_rates(frame: pd.DataFrame) -> pd.DataFrame:
    """Copies of the rows of one chunk. ``n`` equal rows share theirs as evenly as can be:
    ``copies`` for each and one more for the first ``extra``."""
    frame = frame.sort_values(["size", "tie"], ascending=[False, True], kind="stable")
    owed, copies, extra = 0.0, [], []
    for size, rate, n in zip(frame["size"], frame["rate"], frame["n"]):
        low, high = int(rate) * n, min(MAX_REPEATS, int(rate) + 1) * n
        owed += rate * size * n
        taken = max(low, min(high, round(owed / size))) if size else low
        owed -= taken * size
        copies.append(taken // n)
        extra.append(taken % n)
    return frame.assign(copies=copies, extra=extra)[["row", "n", "copies", "extra"]]


def _planned(documents: DataFrame, tie: Column) -> DataFrame:
    """(doc_id, source, size, tie, source_size, target, n, copies, extra) of each group of
    ``n`` equal rows."""
    rows = written(
        documents.select("doc_id", "source", words().alias("size"), tie.alias("tie"))
        .groupBy("doc_id", "source", "size", "tie")
        .agg(F.count("*").alias("n")),
        "mixing-sizes",
    )
    cells = written(
        rows.groupBy("source").agg(
            F.sum(F.col("size") * F.col("n")).alias("size"), F.count("*").alias("documents")
        ),
        "mixing-cells",
    )
    targets = written(source_targets(cells), "mixing-targets")
    constraint = targets.select(F.col("source").alias("value"), "target")
    found = multipliers(cells, {"source": constraint})
    plan = written(
        match(rated(cells.drop("size"), found), targets, ["source"]), "mixing-rates"
    )
    chunks = F.ceil(F.col("documents") / CHUNK_DOCUMENTS)
    chunked = match(rows, plan, ["source"]).select(
        F.pmod(F.xxhash64("doc_id", "tie"), chunks).alias("chunk"),
        "source", "size", "rate", "n",
        F.xxhash64("tie", "doc_id").alias("tie"),
        F.struct("doc_id", "source", "size", "tie", "source_size", "target").alias("row"),
    )
    out = T.StructType(
        [
            chunked.schema["row"],
            *(T.StructField(name, T.LongType()) for name in ["n", "copies", "extra"]),
        ]
    )
    return (
        chunked.groupBy("source", "chunk")
        .applyInPandas(round_rates, out)
        .select("row.*", "n", "copies", "extra")
    )


def mix(documents: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text, source): doc_id, source, size in words,
    source_size, target, ``copies`` (0 to 3) and ``taken``, size times copies.

    Null and empty texts have size 0 and count as their source's documents. A null source
    is a source. Equal rows take as many copies together as their rates ask for, and which
    of them takes one more does not matter. A very long text is one document, whose size
    counts in full. Only doc_id, text and source are read, so other columns may have any name.
    Without words nothing is taken, without documents there are no rows. The same rows in any
    order give the same mix.
    """
    planned = written(_planned(documents, F.xxhash64("text")), "mixing-plan")
    few = planned.where(F.col("n") <= COPIES)
    many = planned.where(F.col("n") > COPIES)
    rows = few.withColumn("k", F.explode(F.expr("sequence(1L, n)"))).unionByName(
        repeated(many, "n", "k", ["doc_id", "source", "tie"])
    )
    copies = F.col("copies") + F.when(F.col("k") <= F.col("extra"), 1).otherwise(0)
    return rows.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the mix takes, each as often as it takes it, with
    all their columns.

    The cases of :func:`mix` apply. Documents without words are never taken. Columns that
    begin with two underscores are the operator's; others may have any name.
    """
    tie = F.xxhash64(*documents.columns)
    times = "__times"
    taken = written(
        _planned(documents, tie)
        .select(
            "doc_id",
            "source",
            "size",
            F.col("tie").alias(TEXT_HASH),
            F.col("n").alias(ROWS),
            (F.col("n") * F.col("copies") + F.col("extra")).alias(times),
        )
        .where((F.col("size") > 0) & (F.col(times) > 0))
        .drop("size"),
        "mixing-taken",
    )
    keys = ["doc_id", "source", TEXT_HASH]
    alone, several = chosen_parts(documents.withColumn(TEXT_HASH, tie), taken, keys)
    copy = "__copy"
    # A row of its own is taken three times at most; equal rows may be any number.
    copies = alone.withColumn(
        copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))
    ).unionByName(repeated(several, times, copy, keys))
    return copies.select(*documents.columns)
