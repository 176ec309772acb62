"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of 13 words (a shorter item is one window), a window into
shingles of three words (fewer if it has fewer). A document holds a window only if it
holds all of its shingles, so for full containment the necessary prefix of a window is
one shingle: of those in it, the rarest in the corpus. Steps:

1. count each benchmark shingle in all documents;
2. keep of each window the rarest shingle. Neighbouring windows mostly share it, so the
   index has one row for a shingle, its place in an item and the windows around it;
3. find prefix shingles in documents and join them with the index. The length bound
   drops windows longer than the document, the positional bound those that would begin
   before it or end after it;
4. compare the words of the document and the window, one by one.

Which shingles to look for reaches the tasks as a bitmap of one bit per hash slot. Its
size is fixed, whatever the number of items; slots that collide cost candidates, which
the join drops, and no matches.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loadglass.llm.common import (
    TEXT_HASH,
    greatest_before,
    let,
    match,
    slices,
    text_hash,
    written,
)

# ---- Fixed values: what the published rule counts as a word and as contaminated --
WINDOW_WORDS = 13
HIT_SHARE = 20
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
# ----------------------------------------------------------------------------------

SHINGLE_WORDS = 3
# Bits of the bitmap, 2 MB. Spark's bitmap functions fill pieces of 32,768 bits.
BITMAP_BITS = 1 << 24
PIECE_BITS = 1 << 15

# Of each byte what it counts as: A-Z as a-z, other ASCII that is no word as a space.
_TO_WORDS = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or byte in _KEPT else 32
    for byte in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


def _digests(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(word) for word in words], np.uint64)


def shingles(digests: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, from the hashes of the words."""
    size = max(0, len(digests) - width + 1)
    mixed = np.full(size, width, np.uint64)
    for offset in range(width):
        mixed = (mixed ^ digests[offset : offset + size]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return mixed.view(np.int64)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, at, shingle, width, length): the shingles of each item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for item, text in zip(
                batch.column("item_id"), batch.column("text").to_pylist()
            ):
                words = words_of(text)
                if not words:
                    continue
                length = min(WINDOW_WORDS, len(words))
                width = min(SHINGLE_WORDS, length)
                rows.append(
                    {
                        "item_id": item.as_py(),
                        "words": [word.decode("utf-8", "replace") for word in words],
                        "shingles": shingles(_digests(words), width).tolist(),
                        "width": width,
                        "length": length,
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    schema = T.StructType(
        [
            benchmark.schema["item_id"],
            T.StructField("words", T.ArrayType(T.StringType())),
            T.StructField("shingles", T.ArrayType(T.LongType())),
            T.StructField("width", T.IntegerType()),
            T.StructField("length", T.IntegerType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    return benchmark.select("item_id", "text").mapInArrow(cut, schema)


def _bitmap(spark: SparkSession, hashes: DataFrame) -> bytes:
    """One bit per slot of the hashes ``shingle``: BITMAP_BITS in all, at most
    BITMAP_BITS / PIECE_BITS rows to the driver."""
    slot = F.expr(f"pmod(shingle, {BITMAP_BITS})")
    pieces = (
        hashes.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()
    )
    whole = np.zeros(BITMAP_BITS + PIECE_BITS, np.uint8)
    for row in pieces:
        # Pieces are numbered from 1; 0 holds the slot 0 alone.
        start = (row["piece"] - 1) * PIECE_BITS + 1 if row["piece"] else 0
        bits = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")
        size = len(bits) if row["piece"] else 1
        whole[start : start + size] |= bits[:size]
    return np.packbits(whole[:BITMAP_BITS], bitorder="little").tobytes()


def _probe(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Positions of the hashes whose bit is set."""
    slot = hashes & (BITMAP_BITS - 1)
    return np.nonzero(bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)[0]


def _counts(documents: DataFrame, bitmap, widths: list[int]) -> DataFrame:
    """(shingle, n): how often looked-for shingles occur in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        for batch in slices(batches):
            found = []
            for text in batch.column("text").to_pylist():
                digests = _digests(words_of(text))
                for width in widths:
                    hashes = shingles(digests, width)
                    found.append(hashes[_probe(bits, hashes)])
            values, counts = np.unique(
                np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(values), pa.array(counts.astype(np.int64))], ["shingle", "n"]
            )

    return (
        documents.select("text")
        .mapInArrow(count, "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
    )


def _index(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(anchor, shingle, before, starts, length, words, item_ids): the windows of which
    ``shingle`` is the prefix.

    ``words`` are those the windows cover, ``before`` of them stand before the shingle,
    and ``starts`` tells how many windows there are, one word apart. Equal rows of
    several items are one row with an ``anchor`` of its own.
    """
    placed = items.select(
        "item_id", "words", "width", "length", F.posexplode("shingles").alias("at", "shingle")
    )
    ranked = (
        placed.join(counts, "shingle", "left")
        .select(
            "item_id", "words", "width", "length",
            F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "at").alias("rank"),
        )
        .groupBy("item_id", "words", "width", "length")
        .agg(F.array_sort(F.collect_list(F.struct("rank.at", "rank"))).alias("all"))
    )
    prefixes = (
        ranked.select(
            "item_id", "words", "length",
            F.explode(F.expr("sequence(1, size(words) - length + 1)")).alias("start"),
            F.expr(
                "array_min(transform(slice(all, start, length - width + 1), x -> x.rank))"
            ).alias("least"),
        )
        .groupBy("item_id", "words", "length", "least")
        .agg(F.min("start").alias("first"), F.max("start").alias("last"))
    )
    anchors = prefixes.groupBy(
        F.col("least.shingle").alias("shingle"),
        F.expr("least.at + 1 - first").alias("before"),
        F.expr("last - first + 1").alias("starts"),
        "length",
        F.expr("slice(words, first, last - first + length)").alias("words"),
    ).agg(F.collect_set("item_id").alias("item_ids"))
    return anchors.withColumn(
        "anchor", F.xxhash64("shingle", "before", "starts", "length", "words")
    )


def _scan(documents: DataFrame, bitmap, widths: list[int]) -> DataFrame:
    """Per row its key, ``n_words``, and the places of looked-for shingles with the
    words around them."""
    place = T.StructType(
        [
            T.StructField("shingle", T.LongType()),
            T.StructField("at", T.LongType()),
            T.StructField("left", T.LongType()),
            T.StructField("around", T.ArrayType(T.StringType())),
        ]
    )
    schema = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField(TEXT_HASH, T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("places", T.ArrayType(place)),
        ]
    )
    arrow = to_arrow_schema(schema)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        for batch in slices(batches):
            lengths, places = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                digests = _digests(words)
                lengths.append(len(words))
                found = []
                for width in widths:
                    hashes = shingles(digests, width)
                    for at in _probe(bits, hashes).tolist():
                        left = max(0, at - WINDOW_WORDS)
                        found.append(
                            {
                                "shingle": int(hashes[at]),
                                "at": at,
                                "left": left,
                                "around": [
                                    word.decode("utf-8", "replace")
                                    for word in words[left : at + WINDOW_WORDS]
                                ],
                            }
                        )
                places.append(found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(arrow.field("doc_id").type),
                    batch.column(TEXT_HASH),
                    pa.array(lengths, pa.int64()),
                    pa.array(places, arrow.field("places").type),
                ],
                schema=arrow,
            )

    return documents.select(
        "doc_id", "text", text_hash().alias(TEXT_HASH)
    ).mapInArrow(find, schema)


def _in_tasks(spark: SparkSession, hashes: DataFrame):
    return spark.sparkContext.broadcast(_bitmap(spark, hashes))


def find_windows(documents: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Where documents hold windows of benchmark items.

    Returns the scanned rows (doc_id, text hash, n_words), the occurrences (doc_id, text
    hash, anchor, spans; a span covers the words from ``first`` up to but not including
    ``last``), and the index, which tells the items of an anchor.
    """
    spark = documents.sparkSession
    items = written(item_windows(benchmark).distinct(), "decontamination-items")
    widths = [row["width"] for row in items.select("width").distinct().collect()]
    shingle = items.select(F.explode("shingles").alias("shingle"))
    counts = _counts(documents, _in_tasks(spark, shingle), widths)
    index = written(_index(items, counts), "decontamination-index")
    scanned = written(
        _scan(documents, _in_tasks(spark, index), widths), "decontamination-places"
    )
    # Window k of an anchor begins at word k of its words, and at word at - before + k
    # of the document, which is place at - before + k - left of the words around.
    fits = F.filter(
        F.sequence(F.lit(0), F.col("starts") - 1),
        lambda k: (F.col("at") - F.col("before") + k >= 0)
        & (F.col("at") - F.col("before") + k + F.col("length") <= F.col("n_words"))
        & (
            F.slice(
                "around",
                F.greatest(
                    F.col("at") - F.col("before") + k - F.col("left") + 1, F.lit(1)
                ).cast("int"),
                F.col("length"),
            )
            == F.slice("words", k + 1, F.col("length"))
        ),
    )
    hits = (
        scanned.select("doc_id", TEXT_HASH, "n_words", F.inline("places"))
        .join(index, "shingle")
        .where("at >= before - starts + 1 AND length <= n_words")
        .withColumn("fits", fits)
        .where(F.size("fits") > 0)
        .select(
            "doc_id", TEXT_HASH, "anchor",
            F.transform(
                "fits",
                lambda k: F.struct(
                    (F.col("at") - F.col("before") + k).alias("first"),
                    (F.col("at") - F.col("before") + k + F.col("length")).alias("last"),
                ),
            ).alias("spans"),
        )
    )
    return scanned.drop("places"), hits, index


def merge_spans(spans: Column) -> Column:
    """Spans in order (first, last), joined where they touch.

    A span is the first of a joined one if it begins beyond all spans before it; what those
    reach is where the joined one before it ends.
    """
    lasts = F.transform(spans, lambda span: span["last"])
    heads = F.filter(
        F.arrays_zip(spans.alias("span"), let(lasts, greatest_before).alias("reach")),
        lambda x: x["span"]["first"] > x["reach"],
    )

    def closed(heads: Column) -> Column:
        return F.transform(
            heads,
            lambda head, at: F.struct(
                head["span"]["first"].alias("first"),
                F.coalesce(F.get(heads, at + 1)["reach"], F.array_max(lasts)).alias("last"),
            ),
        )

    return let(heads, closed)


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text), against ``benchmark`` (item_id, text):
    doc_id, the hash of its text, n_words, n_hit, n_items, item_ids (sorted as strings), spans (merged, word
    places, end exclusive), items_sha256 and contaminated.

    Null and wordless texts have no words and no hits. Items without words never match;
    null item ids match but are not listed or counted. Repeated rows get equal results
    each, copies of an item all count. Very long texts are read whole, word by word. Only the
    ids and texts of both tables are read, so other columns may have any name. Without
    documents there are no rows, without items no hits.
    """
    rows, hits, index = find_windows(documents, benchmark)
    hits = written(hits, "decontamination-hits")
    key = ["doc_id", TEXT_HASH]
    merged = let(F.array_sort(F.flatten(F.collect_set("spans"))), merge_spans)
    covered = hits.groupBy(*key).agg(merged.alias("spans"))
    items = (
        hits.select(*key, "anchor")
        .distinct()
        .join(index.select("anchor", F.explode("item_ids").alias("item_id")), "anchor")
        .groupBy(*key)
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    joined = match(rows, match(covered, items, key), key)
    item_ids = F.coalesce("item_ids", F.expr("cast(array() as array<string>)"))
    n_hit = F.coalesce(
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"]),
        F.lit(0).cast("long"),
    )
    return joined.select(
        *key,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(item_ids).cast("long").alias("n_items"),
        item_ids.alias("item_ids"),
        "spans",
        F.sha2(F.concat_ws(",", item_ids), 256).alias("items_sha256"),
        ((n_hit > 0) & (HIT_SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the benchmark does not contaminate, with all their
    columns. The cases of :func:`decontaminate` apply."""
    key = ["doc_id", TEXT_HASH]
    bad = decontaminate(documents, benchmark).where("contaminated").select(*key).distinct()
    rows = documents.withColumn(TEXT_HASH, text_hash())
    return match(rows, written(bad, "contaminated"), key, "left_anti").select(*documents.columns)


def decontaminate_sql(documents: str = "documents", benchmark: str = "benchmark") -> str:
    """What :func:`decontaminate` counts, in DuckDB's SQL, by all windows of all documents."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = (
        f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS rn, doc_id, {words} AS words FROM {documents}
), items AS (
    SELECT item_id, words, least({WINDOW_WORDS}, len(words)) AS size
    FROM (SELECT item_id, {words} AS words FROM {benchmark}) WHERE len(words) > 0
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[s:s + size - 1], ' ') AS win
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS s FROM items)
), places AS (
    SELECT rn, s, size, array_to_string(words[s:s + size - 1], ' ') AS win
    FROM (SELECT rn, words, size, unnest(range(1, len(words) - size + 2)) AS s
          FROM docs, (SELECT DISTINCT size FROM windows))
), hits AS (
    SELECT rn, s, size, item_id FROM places JOIN windows USING (size, win)
), covered AS (
    SELECT rn, count(DISTINCT p) AS n_hit
    FROM (SELECT rn, unnest(range(s, s + size)) AS p FROM hits) GROUP BY rn
), found AS (
    SELECT rn, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM hits GROUP BY rn
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND {HIT_SHARE} * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (rn) LEFT JOIN found USING (rn)"""
