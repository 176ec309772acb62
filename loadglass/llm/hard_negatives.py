"""Hard-negative mining by exact products of anchors and candidates.

Vectors become whole numbers. Rows are packed into blocks of bounded size, anchors into blocks
of their own, and each pair of an anchor block and a candidate block is one tile. A task
multiplies a tile by Strassen's recursion, in 64-bit integers: halves that are odd are filled
with zeros, and all additions are exact. Results wrap around only beyond 64 bits, where no
score can be, so what wraps on the way comes back.

From a tile, only heaps of fixed size leave: first, for each anchor the best rows of its label
(positives); then, with each positive's window of scores known, the best rows of other labels
within the window. Heaps of different tiles of an anchor merge, some at a time, until one is
left. So no task holds more than a tile, or the heaps of one anchor block from a few tiles.

All anchors meet all rows: the products grow with the square of the rows, as the question does.
Blocks are sent to each tile once; a tile of 2 MiB a side takes a second or so to multiply. Only
numbers of blocks reach the driver.

Cases: rows without a label or a vector, or with a null or non-finite component, take no part.
Vectors of different lengths are filled with zeros. Rows that repeat are rows of their own, so a
copy of an anchor can be its positive, and each of them is an anchor. Equal scores are ordered by
id; a row without an id comes last, is no anchor, and is returned with a null id. An anchor
without positives has no rows in the result, nor has a positive with an empty window. Empty tables
give an empty one. Only the columns named are read, so others may have any name. A vector whose
product with itself does not fit into 62 bits raises a ``ValueError``.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loadglass.llm.common import written
from loadglass.llm.vector_codes import usable, vectors, whole

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# A negative's score over its positive's, in hundredths.
WINDOW = (50, 95)

# Bytes of a block of vectors, and the rows of an anchor block multiplied at a time.
BLOCK_BYTES = 2 << 20
ANCHORS_AT_ONCE = 256
# Halves are not cut any further at this width.
LEAST_WIDTH = 32
# Heaps of an anchor block that are merged at a time.
HEAPS_AT_ONCE = 32
MAX_TASKS = 1 << 15

# No score is that low, and no heap holds an id above a missing one.
NOTHING = np.iinfo(np.int64).min
NO_ID = np.iinfo(np.int64).max
SELF_BITS = 62

BLOCK = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("width", T.IntegerType()),
        *(T.StructField(name, T.BinaryType()) for name in ("rows", "ids", "labels", "vectors")),
    ]
)
HEAPS = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("slot", T.LongType()),
        T.StructField("scores", T.BinaryType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` by Strassen's seven products of halves."""
    m, k = a.shape
    n = len(b)
    if min(m, k, n) <= LEAST_WIDTH:
        return a @ b.T
    if m % 2 or k % 2 or n % 2:
        even = [(0, m % 2), (0, k % 2), (0, n % 2)]
        return product(np.pad(a, (even[0], even[1])), np.pad(b, (even[2], even[1])))[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    # b is given by columns: its upper right quarter is at the lower left here.
    b11, b12, b21, b22 = b[:n, :k], b[n:, :k], b[:n, k:], b[n:, k:]
    p1 = product(a11 + a22, b11 + b22)
    p2 = product(a21 + a22, b11)
    p3 = product(a11, b12 - b22)
    p4 = product(a22, b21 - b11)
    p5 = product(a11 + a12, b22)
    p6 = product(a21 - a11, b11 + b12)
    p7 = product(a12 - a22, b21 + b22)
    whole_product = np.empty((2 * m, 2 * n), np.int64)
    whole_product[:m, :n] = p1 + p4 - p5 + p7
    whole_product[:m, n:] = p3 + p5
    whole_product[m:, :n] = p2 + p4
    whole_product[m:, n:] = p1 - p2 + p3 + p6
    return whole_product


def best(scores: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` best of each row of scores, whose columns are in the order of ``ids``.
    ``scores`` is used up."""
    found = np.full((len(scores), size), NOTHING, np.int64)
    whose = np.full((len(scores), size), NO_ID, np.int64)
    if scores.shape[1]:
        every = np.arange(len(scores))
        for place in range(min(size, scores.shape[1])):
            # The first of the best, so the smallest id.
            at = scores.argmax(axis=1)
            found[:, place] = scores[every, at]
            whose[:, place] = ids[at]
            scores[every, at] = NOTHING
    whose[found == NOTHING] = NO_ID
    return found, whose


def merge(scores: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """One heap of ``size`` from several beside each other, in the last axis."""
    by_id = np.argsort(ids, axis=-1, kind="stable")
    scores, ids = np.take_along_axis(scores, by_id, -1), np.take_along_axis(ids, by_id, -1)
    # A stable sort of the complement, which does not overflow, keeps equal scores by id.
    order = np.argsort(~scores, axis=-1, kind="stable")[..., :size]
    return np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)


class Rows:
    """Rows of a block: row numbers, ids, labels, vectors, in the order of ids."""

    def __init__(self, rows, ids, labels, values):
        order = np.lexsort((rows, ids))
        self.rows, self.ids, self.labels = rows[order], ids[order], labels[order]
        self.values = np.ascontiguousarray(values[order])

    @classmethod
    def read(cls, row: dict) -> "Rows":
        flat = [np.frombuffer(row[name], np.int64) for name in ("rows", "ids", "labels", "vectors")]
        return cls(*flat[:3], flat[3].reshape(len(flat[0]), row["width"]))

    @classmethod
    def joined(cls, several: list["Rows"]) -> "Rows":
        width = max(x.values.shape[1] for x in several)
        return cls(
            *(np.concatenate([getattr(x, name) for x in several]) for name in ("rows", "ids", "labels")),
            np.concatenate([x.padded(width) for x in several]),
        )

    def padded(self, width: int) -> np.ndarray:
        return np.pad(self.values, ((0, 0), (0, width - self.values.shape[1])))

    def part(self, where) -> "Rows":
        return Rows(self.rows[where], self.ids[where], self.labels[where], self.values[where])

    def __len__(self) -> int:
        return len(self.rows)


def _packed(several: Iterator[Rows]) -> Iterator[pa.RecordBatch]:
    """Blocks of bounded size of the rows of a task."""
    arrow = to_arrow_schema(BLOCK)
    task, number = TaskContext.get().partitionId(), 0
    held: list[Rows] = []

    def block(rows: Rows) -> pa.RecordBatch:
        nonlocal number
        made = {"block": (task << 33) + number, "width": rows.values.shape[1]}
        made |= {name: getattr(rows, name).tobytes() for name in ("rows", "ids", "labels")}
        made["vectors"] = rows.values.tobytes()
        number += 1
        return pa.RecordBatch.from_pylist([made], schema=arrow)

    def full(rows: Rows) -> int:
        return max(1, BLOCK_BYTES // (8 * max(rows.values.shape[1], 1)))

    for some in several:
        held.append(some)
        if sum(map(len, held)) >= full(some):
            rows = Rows.joined(held)
            size = full(rows)
            while len(rows) >= size:
                yield block(rows.part(slice(0, size)))
                rows = rows.part(slice(size, None))
            held = [rows] if len(rows) else []
    if held:
        rows = Rows.joined(held)
        size = full(rows)
        for start in range(0, len(rows), size):
            yield block(rows.part(slice(start, start + size)))


def _blocks(frame: DataFrame) -> DataFrame:
    """(id, label, whole) as blocks of rows, written."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def several() -> Iterator[Rows]:
            count = TaskContext.get().partitionId() << 33
            for batch in batches:
                width = int(max(batch.column("whole").value_lengths().to_pylist(), default=0))
                values = vectors(batch.column("whole"), width)
                if (np.square(values, dtype=float).sum(axis=1) >= 2.0**SELF_BITS).any():
                    raise ValueError("a vector whose product with itself is beyond 62 bits")
                ids = batch.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
                labels = batch.column("label").to_numpy(zero_copy_only=False)
                yield Rows(np.arange(count, count + len(values)), ids, labels, values)
                count += len(values)

        yield from _packed(several())

    return written(frame.mapInArrow(pack, BLOCK), "candidate-blocks")


def _anchors(blocks: DataFrame, every: int) -> DataFrame:
    """The anchors among the rows of blocks, as blocks of their own, written."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def several() -> Iterator[Rows]:
            for batch in batches:
                for row in batch.to_pylist():
                    rows = Rows.read(row)
                    picked = rows.part((rows.ids % every == 0) & (rows.ids != NO_ID))
                    if len(picked):
                        yield picked

        yield from _packed(several())

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed(Rows.read(row) for batch in batches for row in batch.to_pylist())

    few = written(blocks.mapInArrow(pick, BLOCK), "anchors")
    bytes_held = few.agg(F.sum(F.length("vectors"))).first()[0] or 0
    return written(
        few.repartition(max(1, -(-bytes_held // BLOCK_BYTES))).mapInArrow(join, BLOCK),
        "anchor-blocks",
    )


def _tiles(
    anchors: DataFrame,
    blocks: DataFrame,
    heaps: Callable[[dict, Rows, Rows], tuple[np.ndarray, np.ndarray]],
) -> tuple[DataFrame, int]:
    """The heaps that each tile leaves, a row for each anchor block and slot, and the number of
    slots. ``heaps`` gets the row of an anchor block, its anchors, and candidates.

    A slot holds the few candidate blocks, mostly one, that their hash sends there.
    """
    sides = max(1, anchors.count()), max(1, blocks.count())

    def placed(frame: DataFrame, own: int, name: str, other: str) -> DataFrame:
        place = F.pmod(F.xxhash64("block"), F.lit(sides[own]))
        every = F.explode(F.sequence(F.lit(0), F.lit(sides[1 - own] - 1)).cast("array<bigint>"))
        return frame.select("*", place.alias(name), every.alias(other)).repartition(
            min(sides[0] * sides[1], MAX_TASKS), "side", "slot"
        )

    arrow = to_arrow_schema(HEAPS)

    def multiply(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        candidates = right.to_pylist()
        for row in left.to_pylist() if candidates else []:
            held = None
            for other in candidates:
                found = heaps(row, Rows.read(row), Rows.read(other))
                if held is not None:
                    size = found[0].shape[-1]
                    both = [np.concatenate(pair, axis=-1) for pair in zip(held, found)]
                    found = merge(*both, size)
                held = found
            made.append(
                {"block": row["block"], "slot": key[1].as_py(), "scores": held[0].tobytes(),
                 "ids": held[1].tobytes()}
            )
        return pa.Table.from_pylist(made, schema=arrow)

    left = placed(anchors, 0, "side", "slot").groupBy("side", "slot")
    right = placed(blocks, 1, "slot", "side").groupBy("side", "slot")
    return left.cogroup(right).applyInArrow(multiply, HEAPS), sides[1]


def _merged(heaps: DataFrame, slots: int, size: int) -> DataFrame:
    """One row of heaps for each anchor block."""
    arrow = to_arrow_schema(HEAPS)

    def join(key: tuple, table: pa.Table) -> pa.Table:
        several = table.to_pylist()
        both = [
            np.stack([np.frombuffer(row[name], np.int64).reshape(-1, size) for row in several], 1)
            for name in ("scores", "ids")
        ]
        # Anchors (and their windows), then the heaps beside each other.
        flat = [x.reshape(len(x), -1) for x in both]
        scores, ids = merge(*flat, size)
        return pa.Table.from_pylist(
            [{"block": key[0].as_py(), "slot": key[1].as_py(), "scores": scores.tobytes(),
              "ids": ids.tobytes()}],
            schema=arrow,
        )

    while slots > 1:
        slots = -(-slots // HEAPS_AT_ONCE)
        heaps = (
            heaps.withColumn("slot", F.floor(F.col("slot") / HEAPS_AT_ONCE))
            .groupBy("block", "slot")
            .applyInArrow(join, HEAPS)
        )
    return heaps


def mine(
    frame: DataFrame,
    every: int,
    id: str = "vec_id",
    label: str | Column = "label",
    vector: str = "embedding",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``, against all rows.

    Returns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for
    each anchor and each of its ``positives`` best rows of the same label, the ``negatives``
    best rows of other labels whose score is within ``window`` hundredths of the positive's.
    Labels and ids are whole numbers. The module's docstring states the cases.
    """
    label = F.col(label) if isinstance(label, str) else label
    low, high = window
    usable_rows = frame.where(usable(vector)).select(
        F.col(id).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"),
        whole(vector, scale).alias("whole"),
    )
    blocks = _blocks(usable_rows.where(F.col("label").isNotNull()))
    anchors = _anchors(blocks, every)

    def scored(anchor: Rows, other: Rows) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        width = max(anchor.values.shape[1], other.values.shape[1])
        a, b = anchor.padded(width), other.padded(width)
        for start in range(0, len(anchor), ANCHORS_AT_ONCE):
            some = slice(start, start + ANCHORS_AT_ONCE)
            yield some, product(a[some], b), anchor.labels[some, None] == other.labels

    def positive_heaps(row: dict, anchor: Rows, other: Rows):
        found = []
        for some, scores, same in scored(anchor, other):
            itself = anchor.rows[some, None] == other.rows
            found.append(best(np.where(same & ~itself, scores, NOTHING), other.ids, positives))
        return tuple(np.concatenate(x) for x in zip(*found))

    def window_heaps(row: dict, anchor: Rows, other: Rows):
        centre = np.frombuffer(row["scores"], np.int64).reshape(-1, positives)
        there = centre != NOTHING
        # In Python's own integers, which do not overflow; empty where there is no positive.
        least = [[-(-low * x // 100) for x in heap] for heap in centre.tolist()]
        most = [[high * x // 100 for x in heap] for heap in centre.tolist()]
        limit = np.iinfo(np.int64).max
        least = np.array([[min(max(x, -limit), limit) for x in heap] for heap in least], np.int64)
        most = np.array([[min(max(x, -limit), limit) for x in heap] for heap in most], np.int64)
        found = []
        for some, scores, same in scored(anchor, other):
            scores[same] = NOTHING
            heaps = []
            for place in range(positives):
                within = (
                    there[some, place, None]
                    & (scores >= least[some, place, None])
                    & (scores <= most[some, place, None])
                )
                heaps.append(best(np.where(within, scores, NOTHING), other.ids, negatives))
            found.append(tuple(np.stack(x, axis=1) for x in zip(*heaps)))
        return tuple(np.concatenate(x) for x in zip(*found))

    heaps, slots = _tiles(anchors, blocks, positive_heaps)
    best_rows = _merged(heaps, slots, positives).select("block", "scores", F.col("ids").alias("best"))
    known = written(anchors.join(best_rows, "block"), "positives")
    # A window's heaps are rows of their own when heaps merge.
    heaps, slots = _tiles(known, blocks, window_heaps)
    mined = _merged(heaps, slots, negatives).select(
        "block", F.col("scores").alias("negative_scores"), F.col("ids").alias("negative_ids")
    )
    schema = T.StructType(
        [
            T.StructField("anchor_id", T.LongType()),
            T.StructField("positive_id", T.LongType()),
            T.StructField("rank", T.IntegerType()),
            T.StructField("negative_id", T.LongType()),
            T.StructField("positive_score", T.LongType()),
            T.StructField("negative_score", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ids(values: np.ndarray) -> pa.Array:
            return pa.array(values, mask=values == NO_ID)

        for batch in batches:
            for row in batch.to_pylist():
                anchor = Rows.read(row)
                shape = len(anchor), positives, negatives
                flat = {
                    name: np.frombuffer(row[name], np.int64)
                    for name in ("scores", "best", "negative_scores", "negative_ids")
                }
                scores = flat["negative_scores"].reshape(shape)
                a, p, r = np.nonzero(scores != NOTHING)
                centre = flat["scores"].reshape(shape[:2])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.ids[a]),
                        ids(flat["best"].reshape(shape[:2])[a, p]),
                        pa.array((r + 1).astype(np.int32)),
                        ids(flat["negative_ids"].reshape(shape)[a, p, r]),
                        pa.array(centre[a, p]),
                        pa.array(scores[a, p, r]),
                    ],
                    schema=arrow,
                )

    return known.join(mined, "block").mapInArrow(listed, schema)


def mine_sql(every: int = 50) -> str:
    """The query in SQL, with all anchors joined to all rows."""
    return f"""
WITH rows AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.rid <> b.rid
    WHERE a.vec_id % {every} = 0
), positive AS (
    SELECT anchor, anchor_id, other_id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) AS place
    FROM scored WHERE same QUALIFY place <= {POSITIVES}
), negative AS (
    SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id,
        s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.other_id) AS r
    FROM positive p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
    WHERE {WINDOW[0]} * p.positive_score <= 100 * s.score
        AND 100 * s.score <= {WINDOW[1]} * p.positive_score
    QUALIFY r <= {NEGATIVES}
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negative"""
