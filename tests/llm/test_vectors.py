"""Vector codes and hard negatives against plain numpy, on given and on awkward rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadglass.llm import hard_negatives, queries, vector_codes

COLUMNS = "vec_id long, embedding array<float>, label int, error string, block int, whole int, code int"


@pytest.fixture(scope="module")
def rows():
    """Null and empty vectors, null and non-finite components, several lengths, ties, repeated
    rows and ids, ids and labels that are missing."""
    random = np.random.default_rng(5)
    made = []
    for n in range(400):
        width = 10 if n % 9 else 7
        vector = [float(np.float32(x)) for x in random.normal(0, 0.2, width)]
        made.append((n, vector, None if n % 23 == 0 else int(n % 4)))
    made += made[40:60] + [(50, made[3][1], 2), (50, made[3][1], 2), (50, made[3][1], 3)]
    made += [(None, made[5][1], 1), (None, made[5][1], 1), (1000, None, 1), (1001, [], 1), (1050, [], 2)]
    made += [(1100, [0.1, None, 0.2], 1), (1150, [math.nan] * 10, 1), (1200, [math.inf] * 10, 2)]
    made += [(2000 + n, [0.25] * 10, n % 3) for n in range(60)]
    return made


@pytest.fixture(scope="module")
def frame(spark, rows):
    made = spark.createDataFrame([(*row, "x", 1, 2, 3) for row in rows], COLUMNS)
    return made.repartition(5)


def usable(rows, scale):
    return [
        (id, [math.floor(scale * x) for x in vector], label)
        for id, vector, label in rows
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]


def codes(rows, parts=4, entries=256, rounds=4):
    kept = usable(rows, 1024)
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    kept.sort(key=lambda row: (row[0] is None, row[0] or 0, row[1]))
    x = np.array([v + [0] * (width - len(v)) for _, v, _ in kept], np.int64).reshape(len(kept), width)
    cut = np.split(x, parts, axis=1)
    books = [part[:entries].copy() for part in cut]

    def nearest(part, book):
        far = ((part[:, None] - book[None]) ** 2).sum(axis=2)
        return far.argmin(axis=1), far.min(axis=1)

    for _ in range(rounds):
        for part, book in zip(cut, books):
            of, _ = nearest(part, book)
            for entry in set(of.tolist()):
                book[entry] = part[of == entry].sum(axis=0) // (of == entry).sum()
    found = [nearest(part, book) for part, book in zip(cut, books)]
    names = ["".join(f"{of[n]:02x}" for of, _ in found) for n in range(len(kept))]
    error = sum(far for _, far in found)
    total = {}
    for (_, _, label), e in zip(kept, error):
        total[label] = total.get(label, 0) + int(e)
    text = ",".join(str(n) for book in books for n in book.ravel().tolist())
    digest = hashlib.sha256(text.encode()).hexdigest()
    return [
        (id, name, int(e), total[label], digest) for (id, _, label), name, e in zip(kept, names, error)
    ]


def written_tables(frame, tmp_path):
    frame.write.parquet(str(tmp_path / "embeddings.parquet"))
    return str(tmp_path)


def same(found, expected):
    assert sorted(repr(tuple(row)) for row in found.collect()) == sorted(map(repr, expected))


def test_codes(spark, frame, rows, tmp_path):
    same(queries.op11_vector_codes(spark, written_tables(frame, tmp_path)), codes(rows))


@pytest.mark.parametrize("cells", [1, 1 << 15])
@pytest.mark.parametrize("spread", [1, 60, 4000])
def test_cells_leave_the_nearest_entry(monkeypatch, cells, spread):
    monkeypatch.setattr(vector_codes, "MAX_CELLS", cells)
    monkeypatch.setattr(vector_codes, "NUMBERS_AT_ONCE", 1 << 12)
    random = np.random.default_rng(spread)
    entries = random.integers(-spread, spread + 1, (50, 3))
    parts = random.integers(-2 * spread, 2 * spread + 1, (700, 3))
    far = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    grid = vector_codes.Cells(entries)
    for _ in range(2):
        entry, distance = grid.nearest(parts)
        assert (entry == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def test_few_rows_and_decoding(spark, rows):
    frame = spark.createDataFrame(rows[:30], "vec_id long, embedding array<float>, label int")
    prepared = vector_codes.prepare(frame)
    books = vector_codes.fit(prepared)
    assert {len(book) for book in books} == {30}
    coded = vector_codes.encode(prepared, books)
    assert coded.columns == ["vec_id", "embedding", "label", "codes", "error"]
    for row in vector_codes.decode(coded, books).collect():
        vector = [math.floor(1024 * x) for x in row["embedding"]]
        vector += [0] * (len(row["decoded"]) - len(vector))
        assert sum((a - b) ** 2 for a, b in zip(vector, row["decoded"])) == row["error"]


def test_no_rows(spark, frame, tmp_path):
    folder = written_tables(frame.limit(0), tmp_path)
    assert queries.op11_vector_codes(spark, folder).collect() == []
    assert queries.op12_hard_negatives(spark, folder).collect() == []


def test_components_beyond_64_bits(spark):
    frame = spark.createDataFrame([(50, [1e30], 1), (1, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError):
        vector_codes.fit(vector_codes.prepare(frame))
    with pytest.raises(Exception, match="62 bits"):
        hard_negatives.mine(frame, 50).collect()


def negatives(rows, every=50, relabel=True):
    kept = []
    for id, vector, label in usable(rows, 256):
        if label is not None:
            moved = relabel and id is not None and id % 7 == 0
            kept.append((id, vector, (label + 1) % 10 if moved else label))
    found = []
    for at, (id, vector, label) in enumerate(kept):
        if id is None or id % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(vector, v)), other is None, other or 0, other, kind == label)
            for n, (other, v, kind) in enumerate(kept)
            if n != at
        ]
        scored.sort(key=lambda s: s[:3])
        for score, _, _, positive, _ in [s for s in scored if s[4]][:5]:
            fits = [s for s in scored if not s[4] and 50 * -score <= 100 * -s[0] <= 95 * -score]
            found += [(id, positive, r, s[3], -score, -s[0]) for r, s in enumerate(fits[:3], 1)]
    return found


@pytest.mark.parametrize("block", [1 << 10, 1 << 21])
def test_negatives(spark, frame, rows, tmp_path, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", block)
    monkeypatch.setattr(hard_negatives, "HEAPS_AT_ONCE", 3 if block < 1 << 20 else 32)
    found = queries.op12_hard_negatives(spark, written_tables(frame, tmp_path))
    expected = negatives(rows)
    assert len(expected) > 50
    same(found, expected)


def test_no_anchor_and_no_other_label(spark, rows):
    frame = spark.createDataFrame(rows[1:40], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(frame, 50).collect() == []
    assert hard_negatives.mine(frame.withColumn("label", F.lit(1)), 2).collect() == []


@pytest.mark.parametrize("shape", [(1, 1, 1), (0, 5, 3), (3, 0, 4), (33, 65, 129), (70, 64, 200), (100, 37, 99)])
def test_products_are_exact(shape):
    m, k, n = shape
    random = np.random.default_rng(m)
    a, b = random.integers(-(1 << 25), 1 << 25, (m, k)), random.integers(-(1 << 25), 1 << 25, (n, k))
    assert (hard_negatives.product(a, b) == a @ b.T).all()


def test_products_that_wrap_on_the_way_come_back():
    a = np.zeros((64, 64), np.int64)
    a[:, 0], a[:, 40] = 1 << 30, -(1 << 30)
    assert (hard_negatives.product(a, a) == 1 << 61).all()
