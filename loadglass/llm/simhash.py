"""Near duplicates by SimHash, found with Golay-code keys.

Fingerprints have 64 bits and are cut into three segments of 21, 21 and 22. If two of
them differ in at most four bits, one of these holds:

- two segments differ in one bit or none each;
- one segment is equal, and the others differ in two bits each. Then of three parts of
  the next segment one is equal too.

The second case needs plain equal keys: a segment and a part, 28 or 29 bits. For the first
case a segment is read as a word of the (23, 12) Golay code, whose spheres of radius 3 fill
the space. One side of the join gives the index of the codeword that a segment decodes to;
the other side gives the indices of all codewords within distance 4, which are one or six.
If the segments differ in at most one bit, the first index is among the second ones. A key
is the indices of two segments. So each fingerprint has 12 keys on one side and at most
117 on the other, and no link is lost.

Only distinct fingerprints are joined. A key is first compared with up to three of its
holders, which joins large groups of near copies in as many rows as they have keys.
Keys with more holders are gone through again, but pairs that are in one class by now are
not made: members of the largest class of a key meet only what is outside of it.
"""

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadglass.llm.common import ROWS, TEXT_HASH, chosen, text_hash, written
from loadglass.llm.components import components

# ---- Fixed values: the published fingerprint and code --------------------------
SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
GOLAY_BITS = 23
GOLAY_GENERATOR = 0b101011100011
# --------------------------------------------------------------------------------

HASHES_AT_ONCE = 1 << 16
# First bit and width of the segments, and in a segment of its three parts.
SEGMENTS = [(0, 21), (21, 21), (42, 22)]
PARTS = [(0, 7), (7, 7), (14, 8)]
GOLAY_PAIRS = [(0, 1), (0, 2), (1, 2)]
EQUAL_PAIRS = [(0, 1), (1, 2), (2, 0)]


def fingerprint(text: str | None) -> int:
    """The SimHash of one text; 0 if it has no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(SHINGLE_WORDS, len(words))
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first = starts[: len(words) - width + 1].tolist()
    last = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(first), HASHES_AT_ONCE):
        hashes = np.array(
            [
                digest(joined[a:b], SEED)
                for a, b in zip(
                    first[at : at + HASHES_AT_ONCE], last[at : at + HASHES_AT_ONCE]
                )
            ],
            np.uint64,
        )
        bits = np.unpackbits(
            hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * counts > len(first)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view(np.int64)[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(text) for text in texts], dtype="int64")


def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Of each segment its syndrome; of each syndrome up to six error patterns of weight 4
    or less, the lightest first and filled up with repeats of it."""
    unit = []
    for bit in range(GOLAY_BITS):
        rest = 1 << bit
        for high in range(GOLAY_BITS - 1, 10, -1):
            if rest >> high & 1:
                rest ^= GOLAY_GENERATOR << (high - 11)
        unit.append(rest)
    widest = max(width for _, width in SEGMENTS)
    syndromes = np.zeros(1 << widest, np.int16)
    for bit in range(widest):
        syndromes[1 << bit : 2 << bit] = syndromes[: 1 << bit] ^ unit[bit]
    found: dict[int, list[int]] = {}
    for weight in range(5):
        for bits in combinations(range(GOLAY_BITS), weight):
            syndrome = 0
            for bit in bits:
                syndrome ^= unit[bit]
            found.setdefault(syndrome, []).append(sum(1 << bit for bit in bits))
    errors = np.array(
        [(found[s] + found[s][:1] * 6)[:6] for s in range(1 << 11)], np.int64
    )
    return syndromes, errors


def _bits(values: np.ndarray, first: int, width: int) -> np.ndarray:
    return (values >> first) & ((1 << width) - 1)


def _indices(segment: np.ndarray, near: bool, code: tuple) -> np.ndarray:
    """Codeword indices of segments: the nearest one, or all within distance 4."""
    syndromes, errors = code
    patterns = errors[syndromes[segment]][:, : 6 if near else 1]
    return (segment[:, None] ^ patterns) >> 11


def keys_of(
    values: np.ndarray, near: bool, code: tuple
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, key) of 64-bit fingerprints, without repeats; ``code`` is ``_golay()``."""
    segments = [_bits(values, first, width) for first, width in SEGMENTS]
    indices = [_indices(segment, near, code) for segment in segments]
    rows, keys = [], []
    for kind, (a, b) in enumerate(GOLAY_PAIRS):
        both = indices[a][:, :, None] << 12 | indices[b][:, None, :]
        both = both.reshape(len(values), -1)
        both.sort(axis=1)
        fresh = np.ones(both.shape, bool)
        fresh[:, 1:] = both[:, 1:] != both[:, :-1]
        row, column = np.nonzero(fresh)
        rows.append(row)
        keys.append(both[row, column] | kind << 40)
    for kind, ((a, b), part) in enumerate(product(EQUAL_PAIRS, PARTS), len(GOLAY_PAIRS)):
        rows.append(np.arange(len(values)))
        keys.append(segments[a] << 8 | _bits(segments[b], *part) | kind << 40)
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(prints: DataFrame, near: bool) -> DataFrame:
    """A row (key, and the columns of ``prints``) for each key of each ``fp``."""
    schema = T.StructType([T.StructField("key", T.LongType()), *prints.schema.fields])

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = _golay()
        for frame in frames:
            rows, keys = keys_of(frame["fp"].to_numpy(np.int64), near, code)
            yield frame.iloc[rows].assign(key=keys)[schema.names]

    return prints.mapInPandas(emit, schema)


def _close(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that join the distinct fingerprints ``fp`` into their classes.

    Every pair within four bits ends in one class; pairs inside a class that other
    edges join already are left out.
    """
    holders = written(_keyed(prints, near=False), "simhash-holders")
    hubs = holders.groupBy("key").agg(
        F.array_distinct(
            F.array(F.min("fp"), F.max("fp"), F.min_by("fp", F.xxhash64("fp")))
        ).alias("hubs"),
        F.count("*").alias("n"),
    )
    near = F.filter("hubs", lambda hub: (hub != F.col("fp")) & _close(hub, F.col("fp")))
    # The least and the greatest of two holders are both hubs. The keys count to Spark as a
    # row for each fingerprint, and must not be broadcast for that.
    met = written(
        _keyed(prints, near=True)
        .hint("merge")
        .join(hubs, "key")
        .where((F.col("n") > 2) | (F.size(near) > 0))
        .select("key", "fp", near.alias("near"), (F.col("n") > 2).alias("crowded")),
        "simhash-met",
    )
    edges = written(
        met.select("fp", F.explode("near").alias("hub"))
        .select(F.greatest("fp", "hub").alias("a"), F.least("fp", "hub").alias("b"))
        .distinct(),
        "simhash-hub-edges",
    )

    # What the hubs do not join: pairs of different classes at keys with other holders.
    classes = components(edges)

    def classed(frame: DataFrame) -> DataFrame:
        return frame.join(classes, frame["fp"] == classes["node"], "left").select(
            "key", "fp", F.coalesce("component", "fp").alias("class")
        )

    probes = met.where("crowded").select("key", "fp")
    keys = probes.select("key").distinct()
    right = written(classed(holders.join(keys, "key", "left_semi")), "simhash-crowded")
    largest = (
        right.groupBy("key", "class")
        .agg(F.count("*").alias("n"))
        .groupBy("key")
        .agg(
            F.max_by("class", F.struct("n", "class")).alias("largest"),
            (F.count("*") > 1).alias("mixed"),
        )
    )
    outside = F.col("class") != F.col("largest")
    right = right.join(largest, "key").select(
        "key", F.col("fp").alias("b"), F.col("class").alias("class_b"),
        outside.alias("outside"),
    )
    left = (
        classed(probes)
        .join(largest, "key")
        .where(F.col("mixed") | outside)
        .select(
            "key", F.col("fp").alias("a"), F.col("class").alias("class_a"),
            # Members of the largest class meet the others only.
            F.explode(
                F.when(outside, F.array(F.lit(True), F.lit(False))).otherwise(
                    F.array(F.lit(True))
                )
            ).alias("outside"),
        )
    )
    rest = (
        left.join(right, ["key", "outside"])
        .where((F.col("class_a") != F.col("class_b")) & _close(F.col("a"), F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    )
    return edges.unionByName(rest).distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): ``doc_id``, the hash of its text,
    ``fingerprint`` as 16 hex digits, ``component_id``, the smallest doc_id that links
    reach, and ``component``, a number that all rows of a component share.

    Texts without words have fingerprint zero and link like any other. Repeated rows
    stay rows of their own. A null doc_id is never the smallest unless a component has no
    other; then component_id is null. Very long texts are read whole. Only doc_id and text
    are read, so other columns may have any name. No documents give no rows.
    """
    prints = written(
        documents.select(
            "doc_id", text_hash().alias(TEXT_HASH), fingerprints("text").alias("fp")
        ),
        "simhash-prints",
    )
    firsts = written(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct"
    )
    classes = components(links(firsts.select("fp")))
    classed = firsts.join(classes, firsts["fp"] == classes["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    least = classed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = classed.join(least, "component").select("fp", "component_id", "component")
    return prints.join(named, "fp").select(
        "doc_id",
        TEXT_HASH,
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "component",
    )


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """One row of each component of ``documents``, with all its columns: the one with the
    smallest doc_id. Of several rows with this id one stays, whichever text it has.

    The cases of :func:`near_duplicates` apply. Columns that begin with two underscores are
    the operator's; others may have any name.
    """
    key = ["doc_id", TEXT_HASH]
    picked = (
        near_duplicates(documents)
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component", *key)
        .agg(F.count("*").alias(ROWS))
        .groupBy("component")
        .agg(F.min(F.struct(*key, ROWS)).alias("picked"))
        .select("picked.*")
    )
    rows = documents.withColumn(TEXT_HASH, text_hash())
    return chosen(rows, written(picked, "simhash-kept"), key).select(*documents.columns)
