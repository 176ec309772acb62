"""Quality rules from the frequency of lines across the documents of a host.

Lines are normalised (lower case, digits as 0, white space collapsed) and hashed, and
for each host the distinct documents that hold a line are counted. A line in more of
them than the limit is boilerplate: it is removed. A document that keeps too few of its
words is rejected, as is one that fails the base rules (too short, or made of repeats).

Exact copies of a text are one document here, told by the hash of the whole text. So a
text that was copied often does not look like boilerplate; dropping copies is left to
de-duplication. Texts that differ anywhere are different documents, whatever they share.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loadglass.llm.common import TEXT_HASH, match, slices, text_hash, written

# ---- Fixed values: the base rules ------------------------------------------------
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
REPEAT_WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# ----------------------------------------------------------------------------------

# A line is boilerplate in more than this many documents of a host, however large the host.
MAX_DOCUMENTS = 20
# A document is depleted with a smaller share of its words left. How many words it needs
# is judged by the base rules, before lines go: a short text is not worse for a menu line.
MIN_SHARE_LEFT = 0.3

_DIGITS = bytes(48 if 48 <= byte <= 57 else byte for byte in range(256))


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more."""
    size = len(words) - REPEAT_WINDOW + 1
    if size < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    windows = ids[:size]
    for offset in range(1, REPEAT_WINDOW):
        # Numbered anew at each step, so that products stay small in any text.
        windows = windows * len(numbers) + ids[offset : offset + size]
        windows = np.unique(windows, return_inverse=True)[1]
    twice = np.bincount(windows)[windows] > 1
    covered = np.zeros(len(words), bool)
    for offset in range(REPEAT_WINDOW):
        covered[offset : offset + size] |= twice
    return int(covered.sum())


def normalised(line: bytes) -> bytes:
    """Lower case (A-Z), digits as 0, white space collapsed."""
    return b" ".join(line.lower().translate(_DIGITS).split())


def line_hash(normal: bytes) -> int:
    """As Spark's ``xxhash64`` of a normalised line."""
    return int(np.uint64(xxhash.xxh64_intdigest(normal, 42)).view(np.int64))


def measures(text: str | None) -> tuple:
    """The base counts of a text, and of each distinct line with a word its hash and the
    words in all its repeats."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    lines: dict[int, int] = {}
    seen: set[bytes] = set()
    repeats = 0
    for line in data.split(b"\n"):
        size = len(line.split())
        if not size:
            continue
        repeats += line in seen
        seen.add(line)
        digest = line_hash(normalised(line))
        lines[digest] = lines.get(digest, 0) + size
    return (
        len(words),
        len(text or "") - (len(data) - len(data.translate(None, SPACES))),
        len(data) - len(data.translate(None, SYMBOLS)),
        repeats,
        repeated_words(words),
        [{"line": line, "words": size} for line, size in lines.items()],
    )


def _scan(documents: DataFrame, host: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    lines = "array<struct<line: bigint, words: bigint>>"
    schema = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField("host", documents.schema[host].dataType),
            T.StructField(TEXT_HASH, T.LongType()),
            *(T.StructField(name, T.LongType()) for name in counts),
            T.StructField("lines", T.DataType.fromDDL(lines)),
        ]
    )
    arrow = to_arrow_schema(schema)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [measures(text) for text in batch.column("text").to_pylist()]
            columns = list(zip(*found)) if found else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    *(
                        batch.column(name).cast(arrow.field(name).type)
                        for name in ["doc_id", "host", TEXT_HASH]
                    ),
                    *(
                        pa.array(values, field.type)
                        for values, field in zip(columns, list(arrow)[3:])
                    ),
                ],
                schema=arrow,
            )

    return documents.select(
        "doc_id", F.col(host).alias("host"), "text", text_hash().alias(TEXT_HASH)
    ).mapInArrow(measure, schema)


def _boilerplate(
    scanned: DataFrame, max_documents: int, max_share: float | None
) -> DataFrame:
    """(host, line) of the lines above the limits of their host."""
    # First each line once per text, spread by both: a line that all documents share
    # reaches its counter as one number from each task.
    held = (
        scanned.select("host", TEXT_HASH, F.inline("lines"))
        .groupBy("host", "line", TEXT_HASH)
        .agg(F.lit(1).alias("one"))
        .groupBy("host", "line")
        .agg(F.sum("one").alias("n"))
        .where(F.col("n") > max_documents)
    )
    if max_share is None:
        return held.select("host", "line")
    hosts = (
        scanned.groupBy("host", TEXT_HASH)
        .agg(F.lit(1).alias("one"))
        .groupBy("host")
        .agg(F.sum("one").alias("documents"))
    )
    return (
        match(held, hosts, ["host"], "inner")
        .where(F.col("n") > max_share * F.col("documents"))
        .select("host", "line")
    )


def judge(
    documents: DataFrame,
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    max_share: float | None = None,
) -> DataFrame:
    """Per row of ``documents`` (doc_id, text, and the host column): the key, the base
    counts, ``base_failed``, ``words_left``, ``removed_lines`` (hashes of the lines to
    remove, null if none) and ``kept``.

    A line in more than ``max_documents`` documents of its host is removed; ``max_share``,
    where it is given, spares those that are in no larger share of them.
    Null and empty texts have no words and fail. A null host is a host of its own.
    Repeated rows get the same result each and count as one document. Very long texts and
    lines are read whole. Only doc_id, text and the host are read, so other columns may have
    any name. Without documents there are no rows.
    """
    scanned = written(_scan(documents, host), "line-frequency")
    limits = written(_boilerplate(scanned, max_documents, max_share), "boilerplate")
    key = ["doc_id", "host", TEXT_HASH]
    removed = (
        match(
            scanned.select(*key, F.inline("lines")).distinct(),
            limits,
            ["host", "line"],
            "left_semi",
        )
        .groupBy(*key)
        .agg(F.collect_set("line").alias("removed_lines"), F.sum("words").alias("removed"))
    )
    words_left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    return (
        match(scanned.drop("lines"), removed, key)
        .withColumn("words_left", words_left)
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .withColumn(
            "kept",
            ~F.col("base_failed")
            & (F.col("words_left") >= MIN_SHARE_LEFT * F.col("n_words")),
        )
        .drop("removed")
    )


def _line_hash(line: Column) -> Column:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.translate(line, letters + "123456789", letters.lower() + "0" * 9)
    return F.xxhash64(F.trim(F.regexp_replace(plain, r"[\x20\x09-\x0D]+", " ")))


def cleaned(
    documents: DataFrame,
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    max_share: float | None = None,
) -> DataFrame:
    """The kept rows of ``documents`` with all their columns, without the lines that are
    above the limits; ``n_chars``, where it is a column, follows the text.

    The cases of :func:`judge` apply; equal rows are kept or rejected together. Columns that
    begin with two underscores are the operator's; others may have any name.
    """
    gone = "__removed_lines"
    verdicts = (
        judge(documents, host, max_documents, max_share)
        .where("kept")
        .select("doc_id", F.col("host").alias(host), TEXT_HASH, F.col("removed_lines").alias(gone))
        .distinct()
    )
    rows = documents.withColumn(TEXT_HASH, text_hash())
    kept = match(rows, verdicts, ["doc_id", host, TEXT_HASH], "inner")
    left = F.array_join(
        F.filter(
            F.split("text", "\n", -1),
            lambda line: ~F.array_contains(gone, _line_hash(line)),
        ),
        "\n",
    )
    touched = F.col(gone).isNotNull()
    kept = kept.withColumn("text", F.when(touched, left).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        n_chars = F.length("text").cast(documents.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(touched, n_chars).otherwise(F.col("n_chars")))
    return kept.select(*documents.columns)


def judge_sql(documents: str = "documents", max_documents: int = MAX_DOCUMENTS) -> str:
    """:func:`judge` by source in DuckDB's SQL, with lines themselves in place of their
    hashes."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    space = r"[\x20\x09-\x0D]"
    normal = (
        f"trim(regexp_replace(translate(line, '{upper}123456789', '{upper.lower()}000000000'), "
        f"'{space}+', ' ', 'g'))"
    )
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS rn, doc_id, source AS host, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
    FROM {documents}
), windows AS (
    SELECT rn, s, array_to_string(words[s:s + {REPEAT_WINDOW - 1}], ' ') AS win
    FROM (SELECT rn, words, unnest(range(1, len(words) - {REPEAT_WINDOW - 2})) AS s FROM docs)
), repeated AS (
    SELECT rn, count(DISTINCT p) AS n FROM (
        SELECT rn, unnest(range(s, s + {REPEAT_WINDOW})) AS p FROM (
            SELECT rn, s, count(*) OVER (PARTITION BY rn, win) AS n FROM windows)
        WHERE n > 1)
    GROUP BY rn
), lines AS (
    SELECT rn, host, line, {normal} AS normal,
        len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n
    FROM (SELECT rn, host, unnest(string_split(body, chr(10))) AS line FROM docs)
), counted AS (
    SELECT rn, count(*) - count(DISTINCT line) AS repeats
    FROM lines WHERE n > 0 GROUP BY rn
), boilerplate AS (
    SELECT l.host, l.normal FROM lines l JOIN docs d USING (rn)
    WHERE l.n > 0 GROUP BY l.host, l.normal
    HAVING count(DISTINCT md5(d.body)) > {max_documents}
), removed AS (
    SELECT rn, sum(n) AS n FROM lines l
    JOIN boilerplate b ON b.host IS NOT DISTINCT FROM l.host AND b.normal = l.normal
    GROUP BY rn
), judged AS (
    SELECT doc_id, len(words) AS n_words,
        length(body) - length(regexp_replace(body, '[^\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(repeats, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
        len(words) - coalesce(removed.n, 0) AS words_left
    FROM docs LEFT JOIN counted USING (rn) LEFT JOIN repeated USING (rn)
    LEFT JOIN removed USING (rn)
), failed AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
        AS base_failed
    FROM judged
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(words_left AS BIGINT) AS words_left,
    base_failed,
    NOT base_failed AND words_left >= {MIN_SHARE_LEFT}::DOUBLE * n_words AS kept
FROM failed"""
