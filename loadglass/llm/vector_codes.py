"""Vector code compression: product codes, with nearest entries found through grid cells.

Vectors become integers and are cut into parts, and each part position has a codebook. The
entry nearest to a part is found in two steps. The part lies in a cell of a coarse grid. Over
the box of that cell, each entry has a least and a greatest distance; an entry whose least
distance is above the smallest greatest one is never the nearest there and is left out. The
entries that are left are kept for the cell, found by the hash of its coordinates, so parts
in the same cell share that work. Only these entries are compared with the part itself,
exactly, in whole numbers.

Codebooks are fitted by rounds over all rows: tasks add up the parts that each entry got, and
only those sums, one number for each entry, position and task, are shuffled. The driver holds
the codebooks, ``entries`` vectors, and sends them to the tasks; their size does not depend on
the rows. Kept vectors are written once, so that no round reads or converts the source again.

Cases: rows without a vector, or with a null or non-finite component, are dropped. Vectors of
different lengths, or of one that the parts do not divide, are filled with zeros to the next
multiple of the longest. Rows that repeat an id are rows of their own; among those with equal
ids the lesser vector is the earlier entry. Rows without an id come last. With fewer rows than
entries the codebooks are smaller. An empty table gives codebooks without entries and no rows.
Columns of an input stay, but those that have the name of a new column are replaced by it.
Components so large that a squared distance could pass 64 bits raise a ``ValueError``.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loadglass.llm.common import match, written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024

# Cells that a task remembers for a part, numbers that it works on at once, and rows. They
# bound memory, and change no result.
MAX_CELLS = 1 << 15
NUMBERS_AT_ONCE = 1 << 21
ROWS_AT_ONCE = 2048

# Bits of the largest squared distance.
DISTANCE_BITS = 62

WHOLE = "__whole"

# Codebooks: for each part an array of entries by positions.
Codebooks = list[np.ndarray]


def usable(vector: str) -> Column:
    """Whether a vector has values in all its components."""
    good = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")),
    )
    return F.coalesce(F.col(vector).isNotNull() & good, F.lit(False))


def whole(vector: str, scale: int) -> Column:
    """Components times ``scale``, as the next lower whole number."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def vectors(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists as rows of ``width``, filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    rows = np.zeros((len(lengths), width), np.int64)
    rows[np.arange(width) < lengths[:, None]] = flat
    return rows


class Cells:
    """The entries of one codebook that can be the nearest, by cell of a grid."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        spread = entries.std(axis=0).mean() if entries.size else 0
        # The side of a cell changes no result. Cells much smaller than the distances
        # between entries leave few of them.
        self.side = max(1, int(spread / 2))
        self.known: dict[bytes, np.ndarray] = {}

    def _left(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell the entries that none beats all over its box, ascending."""
        least = np.zeros((len(cells), len(self.entries)), np.int64)
        greatest = np.zeros_like(least)
        for position in range(cells.shape[1]):
            lines, of = np.unique(cells[:, position], return_inverse=True)
            low = (lines * self.side)[:, None]
            high = low + (self.side - 1)
            entry = self.entries[:, position]
            below, above = low - entry, entry - high
            near = np.maximum(np.maximum(below, above), 0)
            far = np.maximum(np.abs(below), np.abs(above))
            least += (near * near)[of]
            greatest += (far * far)[of]
        best = greatest.min(axis=1, keepdims=True)
        return [np.flatnonzero(row) for row in least <= best]

    def _of(self, parts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The entries left for each distinct cell, and each part's cell among them."""
        cells = np.ascontiguousarray(parts // self.side)
        names = cells.view(np.dtype((np.void, cells.shape[1] * 8))).ravel()
        _, first, of = np.unique(names, return_index=True, return_inverse=True)
        keys = [names[at].tobytes() for at in first]
        new = [number for number, key in enumerate(keys) if key not in self.known]
        if len(self.known) + len(new) > MAX_CELLS:
            self.known.clear()
            new = list(range(len(keys)))
        at_once = max(1, NUMBERS_AT_ONCE // (4 * len(self.entries)))
        for start in range(0, len(new), at_once):
            some = new[start : start + at_once]
            for number, left in zip(some, self._left(cells[first[some]])):
                self.known[keys[number]] = left
        return [self.known[key] for key in keys], of

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part, the first of equally near ones, and how far."""
        if not parts.shape[1]:
            return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        left, of = self._of(parts)
        sizes = np.array([len(entries) for entries in left])[of]
        entry, distance = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        pairs_at_once = max(1, NUMBERS_AT_ONCE // parts.shape[1])
        start = 0
        until = np.cumsum(sizes)
        while start < len(parts):
            done = until[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(until, done + pairs_at_once, "right")))
            row = np.repeat(np.arange(start, end), sizes[start:end])
            other = np.concatenate([left[cell] for cell in of[start:end]])
            apart = parts[row] - self.entries[other]
            far = np.einsum("ij,ij->i", apart, apart)
            starts = until[start:end] - sizes[start:end] - done
            best = np.minimum.reduceat(far, starts)
            hits = np.flatnonzero(far == np.repeat(best, sizes[start:end]))
            # From the last hit to the first, so that the first one stays.
            entry[row[hits[::-1]]] = other[hits[::-1]]
            distance[start:end] = best
            start = end
        return entry, distance


def _cut(rows: np.ndarray, parts: int) -> list[np.ndarray]:
    return [np.ascontiguousarray(part) for part in np.split(rows, parts, axis=1)]


def _batches(
    batches: Iterator[pa.RecordBatch], width: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            some = batch.slice(start, ROWS_AT_ONCE)
            yield some, vectors(some.column(WHOLE), width)


def prepare(frame: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The rows with a usable vector, written, with ``WHOLE``, the whole numbers, beside their
    columns."""
    rows = frame.where(usable(vector)).withColumn(WHOLE, whole(vector, scale))
    return written(rows, "vectors")


def _moved(prepared: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round over all rows."""
    width = sum(book.shape[1] for book in books)
    schema = T.StructType(
        [T.StructField(name, T.LongType()) for name in ("part", "entry", "position", "n", "total")]
    )
    arrow = to_arrow_schema(schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book) for book in books]
        sums = [np.zeros(book.shape, np.int64) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        for _, rows in _batches(batches, width):
            for number, part in enumerate(_cut(rows, len(books))):
                entry, _ = cells[number].nearest(part)
                order = np.argsort(entry, kind="stable")
                used, starts, n = np.unique(entry[order], return_index=True, return_counts=True)
                sums[number][used] += np.add.reduceat(part[order], starts)
                counts[number][used] += n
        for number, (total, n) in enumerate(zip(sums, counts)):
            used = np.flatnonzero(n)
            if len(used) and total.shape[1]:
                position = np.tile(np.arange(total.shape[1]), len(used))
                entry = np.repeat(used, total.shape[1])
                columns = [np.full(len(entry), number), entry, position, n[entry]]
                columns.append(total[used].ravel())
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow)

    found = (
        prepared.select(WHOLE)
        .mapInArrow(add, schema)
        .groupBy("part", "entry", "position")
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()
    )
    moved = [book.copy() for book in books]
    for row in found:
        mean = int(row["total"]) // row["n"]
        moved[row["part"]][row["entry"], row["position"]] = mean
    return moved


def fit(
    prepared: DataFrame,
    id: str = "vec_id",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks of what ``prepare`` returned: first the parts of the rows with the smallest
    ids, then in each round the mean of the parts that are nearest, rounded down. An entry
    that got none stays."""
    size = F.array_max(F.transform(WHOLE, lambda x: F.abs(x.cast("decimal(20,0)"))))
    most = prepared.agg(F.max(F.size(WHOLE)), F.max(size)).first()
    width = -(-(most[0] or 0) // parts) * parts
    if 4 * width * int(most[1] or 0) ** 2 >= 1 << DISTANCE_BITS:
        raise ValueError(f"components of up to {most[1]} give distances beyond 64 bits")
    order = F.col(id).asc_nulls_last(), F.col(WHOLE)
    first = prepared.select(id, WHOLE).orderBy(*order).limit(entries).collect()
    rows = np.zeros((len(first), width), np.int64)
    for number, row in enumerate(first):
        rows[number, : len(row[WHOLE])] = row[WHOLE]
    books = _cut(rows, parts)
    if len(rows):
        for _ in range(rounds):
            books = _moved(prepared, books)
    return books


def encode(
    prepared: DataFrame, books: Codebooks, codes: str = "codes", error: str = "error"
) -> DataFrame:
    """The rows of ``prepare`` with the nearest entry of each part, an array of int, and the
    squared distances to them, summed."""
    width = sum(book.shape[1] for book in books)
    kept = [f for f in prepared.schema.fields if f.name not in (WHOLE, codes, error)]
    schema = T.StructType(
        [
            *kept,
            T.StructField(codes, T.ArrayType(T.IntegerType())),
            T.StructField(error, T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book) for book in books]
        for batch, rows in _batches(batches, width):
            found = [c.nearest(part) for c, part in zip(cells, _cut(rows, len(books)))]
            entries = np.stack([entry for entry, _ in found], axis=1).astype(np.int32)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(books)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(f.name).cast(arrow.field(f.name).type) for f in kept),
                    pa.ListArray.from_arrays(offsets, entries.ravel()),
                    pa.array(sum(distance for _, distance in found)),
                ],
                schema=arrow,
            )

    return prepared.mapInArrow(assign, schema)


def decode(
    coded: DataFrame, books: Codebooks, codes: str = "codes", into: str = "decoded"
) -> DataFrame:
    """The rows of ``encode`` with the whole numbers that their codes stand for."""
    width = sum(book.shape[1] for book in books)
    kept = [f for f in coded.schema.fields if f.name != into]
    schema = T.StructType([*kept, T.StructField(into, T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = vectors(batch.column(codes), len(books))
            rows = np.concatenate([b[entries[:, n]] for n, b in enumerate(books)], axis=1)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(f.name).cast(arrow.field(f.name).type) for f in kept),
                    pa.ListArray.from_arrays(offsets, np.ascontiguousarray(rows).ravel()),
                ],
                schema=arrow,
            )

    return coded.mapInArrow(restore, schema)


def digest(books: Codebooks) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    numbers = [str(x) for book in books for entry in book for x in entry.tolist()]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def with_label_error(
    coded: DataFrame, label: str = "label", error: str = "error", into: str = "label_error"
) -> DataFrame:
    """The rows with the errors of their label added up, rows without a label together; null
    where the sum does not fit into 64 bits.

    Errors are added up map-side, and a label with many rows is split by the join.
    """
    total = F.sum(F.col(error).cast("decimal(38,0)")).try_cast("bigint")
    sums = coded.groupBy(label).agg(total.alias(into))
    return match(coded.drop(into), sums, [label])


def compress_sql(
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> str:
    """The query in SQL, comparing each part with all entries."""
    steps = [
        f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
        list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pieces AS (
    SELECT rid, vec_id, label, p,
        v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x
    FROM kept, range({parts}) AS t(p)
), book0 AS (
    SELECT p, rid - 1 AS e, x AS y FROM pieces WHERE rid <= {entries}
)"""
    ]
    apart = "list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for number in range(rounds + 1):
        steps.append(
            f""", near{number} AS (
    SELECT rid, p, min(CAST({apart} AS HUGEINT) * {entries} + e) AS best
    FROM pieces JOIN book{number} USING (p) GROUP BY rid, p
)"""
        )
        if number < rounds:
            steps.append(
                f""", mean{number} AS (
    SELECT p, best % {entries} AS e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS c
    FROM near{number} JOIN pieces USING (rid, p), unnest(range(1, len(x) + 1)) AS t(i)
    GROUP BY ALL
), book{number + 1} AS (
    SELECT p, e, coalesce(m.y, b.y) AS y
    FROM book{number} b
    LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS y FROM mean{number} GROUP BY p, e) m USING (p, e)
)"""
            )
    steps.append(
        f""", codes AS (
    SELECT rid, string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY p) AS code,
        CAST(sum(best // {entries}) AS BIGINT) AS error
    FROM near{rounds} GROUP BY rid
)
SELECT vec_id, code, error,
    CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM book{rounds})
        AS codebooks_sha256
FROM codes JOIN kept USING (rid)"""
    )
    return "".join(steps)
