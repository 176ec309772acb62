"""Byte-pair encoding and decoding with the vocabulary of a public tokenizer.

A word is a row of symbols. Each two neighbours have the rank of their merge, if the
vocabulary has one, and a segment tree holds the ranks with their places: its root is the
leftmost merge of lowest rank. A merge changes at most three leaves, so a word of n
symbols takes n log n steps, also one of a million symbols. The trees of many short words
are the rows of one array and take their steps together; a long word has a tree of its own.

The file of the tokenizer says how a text is normalised and cut into words; both are done
by the library that the file belongs to. White space that no word can hold cuts a text into
pieces whose tokens do not depend on their neighbours; tokens of pieces are remembered,
so that a piece that is met often is encoded once in a task. With the published
pattern for words, characters up to U+024F are normalised and cut here: they have one form
only, and what is a letter, a digit or white space among them does not change any more.

The driver reads the file and sends it to the tasks; its size is that of the vocabulary.
Each text is encoded by itself, without a shuffle. A Python worker holds the vocabulary and what
it remembers, and steps in Python that follow each other have a worker each for every core. So
``encode`` also makes the packed tokens and the decoded texts, in the same worker.

Cases: a null text is an empty one and has no tokens, and a null row of tokens decodes to the
empty text. Texts of any length are encoded whole. Rows that repeat each get their own
result, equal to that of the others. An empty table gives an empty one. Columns of the input
that have the name of a new column are replaced by it; all others stay.
"""

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from loadglass.llm.common import slices

TOKENS = "token_ids"
DECODED = "decoded"
PACKED = "packed"

# Pieces that a task remembers before it begins again, and bytes of texts that it works on at
# once. They bound memory, and change no result.
MAX_REMEMBERED = 1 << 18
BYTES_AT_ONCE = 1 << 25
# Words of at most so many symbols are merged together, so many at a time.
MAX_TOGETHER = 64
WORDS_AT_ONCE = 1 << 14

# Ranks are smaller than 2 to this.
RANK_BITS = 32

# ---- Fixed values: a published normaliser, and a pattern for words without white space ---
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
SPACELESS_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# -------------------------------------------------------------------------------------

# The same for characters up to U+024F.
BEYOND = re.compile("[^\x00-\u024f]").search
SPACES = re.compile("[\t-\r \x85\xa0]+").split
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
OTHERS = "\x00-/:-@\\[-`{-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf\xd7\xf7"
NEAR_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[^{OTHERS}{NUMBERS}]+|[{NUMBERS}]|(?:(?![{NUMBERS}])[{OTHERS}])+"
).findall


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it can be seen, else one from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    unseen = iter(range(256, 512))
    return [chr(byte) if byte in seen else chr(next(unseen)) for byte in range(256)]


class MergeTree:
    """The merges that two neighbours in a row of symbols can have, as a segment tree.

    A leaf holds the rank of the merge of the symbol at its place with the next one, then
    the place, in one number. Inner nodes hold the least number below them.
    """

    def __init__(self, leaves: list[int], none: int):
        """``none``, above all ranks, is what a place without a merge holds."""
        size = 1
        while size < len(leaves):
            size *= 2
        self.size = size
        self.nodes = [none] * size + leaves + [none] * (size - len(leaves))
        for node in range(size - 1, 0, -1):
            self.nodes[node] = min(self.nodes[2 * node], self.nodes[2 * node + 1])

    @property
    def root(self) -> int:
        return self.nodes[1]

    def put(self, place: int, value: int) -> None:
        nodes, node = self.nodes, self.size + place
        nodes[node] = value
        while node > 1:
            least = min(nodes[node], nodes[node ^ 1])
            node >>= 1
            if nodes[node] == least:
                return
            nodes[node] = least


def merged(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The symbols after all merges: always the one of lowest rank, the leftmost of those,
    until no two neighbours can merge. ``merges`` has the rank and the result of a pair."""
    if len(symbols) < 2:
        return symbols
    symbols = list(symbols)
    bits = len(symbols).bit_length()
    places = (1 << bits) - 1
    none = 1 << RANK_BITS + bits

    def leaf(place: int, following: int) -> int:
        found = merges.get((symbols[place], symbols[following]))
        return none if found is None else found[0] << bits | place

    tree = MergeTree([leaf(at, at + 1) for at in range(len(symbols) - 1)] + [none], none)
    after = [*range(1, len(symbols)), -1]
    before = [*range(-1, len(symbols) - 1)]
    while (first := tree.root) < none:
        place = first & places
        gone = after[place]
        symbols[place] = merges[symbols[place], symbols[gone]][1]
        symbols[gone] = -1
        following, previous = after[gone], before[place]
        after[place] = following
        tree.put(gone, none)
        if following >= 0:
            before[following] = place
            tree.put(place, leaf(place, following))
        else:
            tree.put(place, none)
        if previous >= 0:
            tree.put(previous, leaf(previous, place))
    return [symbol for symbol in symbols if symbol >= 0]


class Pairs:
    """The merges of a vocabulary for many pairs at once."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]]):
        found = sorted((a << 32 | b, rank, result) for (a, b), (rank, result) in merges.items())
        table = np.array(found, np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.results = (np.ascontiguousarray(x) for x in table.T)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of pairs, both -1 without a merge."""
        if not len(self.keys):
            return np.full(len(a), -1), np.full(len(a), -1)
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = self.keys[at] == keys
        return np.where(there, self.ranks[at], -1), np.where(there, self.results[at], -1)


class Rows:
    """Rows of numbers of any length, one after the other in one array."""

    def __init__(self):
        self.flat = np.zeros(1 << 16, np.int64)
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.count = self.used = 0

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        count, used = self.count + len(lengths), self.used + len(flat)
        if used > len(self.flat):
            self.flat = np.resize(self.flat, 2 * used)
        if count > len(self.starts):
            self.starts = np.resize(self.starts, 2 * count)
            self.lengths = np.resize(self.lengths, 2 * count)
        self.flat[self.used : used] = flat
        self.starts[self.count : count] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.count : count] = lengths
        self.count, self.used = count, used

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of these numbers, one after the other, and their lengths."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        skipped = np.repeat(self.starts[numbers] - ends + lengths, lengths)
        return self.flat[skipped + np.arange(len(skipped))], lengths


def in_groups(lengths: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """The summed lengths of groups of so many neighbours."""
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(groups)]
    return np.diff(ends, prepend=0)


def merged_together(
    flat: np.ndarray, lengths: np.ndarray, pairs: Pairs
) -> tuple[np.ndarray, np.ndarray]:
    """What ``merged`` returns for each of some words of about one length.

    Words are given and returned one after the other, with their lengths. Row ``w`` of each
    array in here belongs to word ``w``; ``nodes[:, 1]`` are the roots.
    """
    size = 2
    while size < lengths.max():
        size *= 2
    every = np.arange(size)
    symbols = np.full((len(lengths), size), -1, np.int64)
    symbols[every < lengths[:, None]] = flat
    none = 1 << RANK_BITS + size.bit_length()
    nodes = np.full((len(lengths), 2 * size), none, np.int64)
    results = np.full((len(lengths), size), -1, np.int64)
    row, place = np.nonzero(symbols[:, 1:] >= 0)
    rank, results[row, place] = pairs.find(symbols[row, place], symbols[row, place + 1])
    nodes[row, size + place] = np.where(rank < 0, none, rank * size + place)
    for node in range(size - 1, 0, -1):
        nodes[:, node] = np.minimum(nodes[:, 2 * node], nodes[:, 2 * node + 1])
    after = np.where(every + 1 < lengths[:, None], every + 1, -1)
    before = np.broadcast_to(every - 1, after.shape).copy()

    row = np.flatnonzero(nodes[:, 1] < none)
    while len(row):
        place = nodes[row, 1] % size
        gone = after[row, place]
        following, previous = after[row, gone], before[row, place]
        symbols[row, place] = results[row, place]
        symbols[row, gone] = -1
        after[row, place] = following
        has, had = following >= 0, previous >= 0
        before[row[has], following[has]] = place[has]
        # The leaves that change: those of the merged symbol, the one before, the lost one.
        for at, right, there in ((place, following, has), (previous, place, had)):
            r, p = row[there], at[there]
            rank, results[r, p] = pairs.find(symbols[r, p], symbols[r, right[there]])
            nodes[r, size + p] = np.where(rank < 0, none, rank * size + p)
        nodes[row[~has], size + place[~has]] = none
        nodes[row, size + gone] = none
        # Where there is none before, the path of the merged symbol is gone over again.
        paths = np.concatenate([place, gone, np.where(had, previous, place)]) + size
        rows = np.tile(row, 3)
        for _ in range(size.bit_length() - 1):
            paths >>= 1
            nodes[rows, paths] = np.minimum(nodes[rows, 2 * paths], nodes[rows, 2 * paths + 1])
        row = row[nodes[row, 1] < none]
    left = symbols >= 0
    return symbols[left], left.sum(axis=1)


def contents_of(settings: dict) -> dict[int, str]:
    """What each token stands for."""
    found = {number: content for content, number in settings["model"]["vocab"].items()}
    found.update({token["id"]: token["content"] for token in settings["added_tokens"]})
    return found


class Encoder:
    """What the text of a tokenizer's file says, ready to encode.

    Files whose settings would change the merges (dropout, unknown tokens, byte fallback,
    prefixes of continued words, whole words first), or whose words are not of bytes, raise a
    ``ValueError``.
    """

    def __init__(self, content: str):
        settings = json.loads(content)
        model = settings["model"]
        unknown = [
            name
            for name in ("dropout", "unk_token", "byte_fallback", "ignore_merges",
                         "continuing_subword_prefix")
            if model.get(name)
        ]
        if model.get("type") != "BPE" or unknown or '"ByteLevel"' not in json.dumps(
            settings["pre_tokenizer"]
        ):
            raise ValueError(f"not a plain BPE of bytes: {model.get('type')} {unknown}")
        added = settings["added_tokens"]
        if any(token["normalized"] or token["single_word"] or token["lstrip"] or token["rstrip"]
               for token in added):
            raise ValueError("added tokens are only found as they are")
        # Padding and truncation are not used, and special tokens are not added.
        self.library = Tokenizer.from_str(content)
        ids = model["vocab"]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        self.pairs = Pairs(self.merges)
        self.added = {token["content"]: token["id"] for token in added}
        # The longest of those that begin at a place is found.
        names = sorted(self.added, key=lambda name: (-len(name), name))
        self.split = re.compile(f"({'|'.join(map(re.escape, names))})").split if names else None
        self.by_spaces = _cuts_at_spaces(settings)
        self.plain = self.by_spaces and settings.get("normalizer") == NORMALIZER
        letters, suffix = byte_letters(), model.get("end_of_word_suffix") or ""
        self.bytes = {letter: byte for byte, letter in enumerate(letters)}
        # Symbols of the bytes of a word, and of its last one; -1 without any.
        self.symbols = np.array([ids.get(letter, -1) for letter in letters])
        self.last_symbols = np.array([ids.get(letter + suffix, -1) for letter in letters])
        self._forget()

    def _forget(self) -> None:
        self.tokens = Rows()
        # Added tokens are kept under a tuple, which no piece of a text is.
        self.numbers = {(name,): number for number, name in enumerate(self.added)}
        ids = np.array(list(self.added.values()), np.int64)
        self.tokens.add(ids, np.ones(len(ids), np.int64))

    def pieces(self, part: str) -> list[str]:
        """The normalised pieces of a text without added tokens."""
        if self.plain and not BEYOND(part):
            return SPACES(part.lower())
        normalise = self.library.normalizer
        part = normalise.normalize_str(part) if normalise else part
        return part.split(" ") if self.by_spaces else [part]

    def words(self, piece: str) -> list[bytes]:
        if self.plain and not BEYOND(piece):
            return [word.encode() for word in NEAR_WORDS(piece)]
        cut = self.library.pre_tokenizer.pre_tokenize_str(piece)
        return [bytes([self.bytes[letter] for letter in word]) for word, _ in cut if word]

    def merge_all(self, words: list[bytes]) -> Rows:
        """Tokens of the words, in their order."""
        flat = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.array([len(word) for word in words], np.int64)
        ends = np.cumsum(lengths)
        symbols = self.symbols[flat]
        symbols[ends - 1] = self.last_symbols[flat[ends - 1]]
        if (symbols < 0).any():
            # Symbols that the vocabulary lacks are left out.
            has = symbols >= 0
            lengths = in_groups(has.astype(np.int64), lengths)
            symbols, ends = symbols[has], np.cumsum(lengths)
        given = Rows()
        given.add(symbols, lengths)
        kind = np.where(lengths < 2, 0, np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        kind[lengths > MAX_TOGETHER] = -1
        made, order = Rows(), []
        for value in np.unique(kind).tolist():
            some = np.flatnonzero(kind == value)
            for start in range(0, len(some), WORDS_AT_ONCE):
                now = some[start : start + WORDS_AT_ONCE]
                order.append(now)
                if value > 0:
                    made.add(*merged_together(*given.take(now), self.pairs))
                elif value == 0:
                    made.add(*given.take(now))
                else:
                    for word in now:
                        row, _ = given.take(np.array([word]))
                        found = merged(row.tolist(), self.merges)
                        made.add(np.array(found, np.int64), np.array([len(found)]))
        # Back into the order of the words.
        back = np.empty(len(words), np.int64)
        back[np.concatenate(order) if order else []] = np.arange(len(words))
        made.starts, made.lengths = made.starts[back], made.lengths[back]
        return made

    def learn(self, pieces: list[str]) -> None:
        """Remember the tokens of pieces."""
        cut = [self.words(piece) for piece in pieces]
        known: dict[bytes, int] = {}
        used = [known.setdefault(word, len(known)) for words in cut for word in words]
        tokens, lengths = self.merge_all(list(known)).take(np.array(used, np.int64))
        first = self.tokens.count
        self.tokens.add(tokens, in_groups(lengths, np.array([len(words) for words in cut])))
        self.numbers.update(zip(pieces, range(first, first + len(pieces))))

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the texts, one after the other, and how many each text has."""
        flat: list = []
        sizes = []
        for text in texts:
            before = len(flat)
            parts = self.split(text or "") if self.split else [text or ""]
            for number, part in enumerate(parts):
                if number % 2:
                    flat.append((part,))
                elif part:
                    flat += filter(None, self.pieces(part))
            sizes.append(len(flat) - before)
        numbers = list(map(self.numbers.get, flat))
        if None in numbers:
            new = list({piece for piece, number in zip(flat, numbers) if number is None})
            if len(self.numbers) + len(new) > MAX_REMEMBERED:
                self._forget()
                new = list({piece for piece in flat if isinstance(piece, str)})
            self.learn(new)
            numbers = list(map(self.numbers.get, flat))
        tokens, lengths = self.tokens.take(np.array(numbers, np.int64))
        return tokens, in_groups(lengths, np.array(sizes, np.int64))

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0].tolist()


def _cuts_at_spaces(settings: dict) -> bool:
    """Whether words come from the pattern that no white space matches, with the rest gone,
    and bytes stand as letters in them."""
    cut = settings.get("pre_tokenizer") or {}
    steps = cut["pretokenizers"] if cut.get("type") == "Sequence" else [cut]
    first, others = steps[0], steps[1:]
    return (
        first.get("type") == "Split"
        and first["pattern"] == {"Regex": SPACELESS_WORDS}
        and first["behavior"] == "Removed"
        and first["invert"]
        and [step.get("type") for step in others] == ["ByteLevel"]
        and not others[0]["add_prefix_space"]
        and not others[0]["use_regex"]
    )


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices with few rows, and with one row where texts are long."""
    for batch in slices(batches):
        if batch.column(column).nbytes <= BYTES_AT_ONCE:
            yield batch
        else:
            for row in range(batch.num_rows):
                yield batch.slice(row, 1)


def _with_columns(
    frame: DataFrame,
    vocabulary: str,
    column: str,
    made: dict[str, T.DataType],
    convert: Callable[[str], Callable[[pa.Array], list[pa.Array]]],
) -> DataFrame:
    """The frame with columns that are made of another one, some rows at a time."""
    kept = [field for field in frame.schema.fields if field.name not in made]
    schema = T.StructType([*kept, *(T.StructField(name, kind) for name, kind in made.items())])
    arrow = to_arrow_schema(schema)
    content = frame.sparkSession.sparkContext.broadcast(_read(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = convert(content.value)
        for batch in _parts(batches, column):
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(f.name).cast(arrow.field(f.name).type) for f in kept),
                    *(
                        values.cast(arrow.field(name).type)
                        for name, values in zip(made, function(batch.column(column)))
                    ),
                ],
                schema=arrow,
            )

    return frame.mapInArrow(run, schema)


def _encoding(content: str) -> Callable[[pa.Array], pa.Array]:
    encoder = Encoder(content)

    def encoded(texts: pa.Array) -> pa.Array:
        tokens, sizes = encoder.encode_all(texts.to_pylist())
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, tokens.astype(np.int32))

    return encoded


def _packed(rows: pa.Array) -> pa.Array:
    """Tokens of each row as little-endian unsigned 32-bit integers."""
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype("<u4")
    sizes = rows.value_lengths().to_numpy(zero_copy_only=False)
    ends = 4 * np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(flat)]
    )


def _decoding(content: str) -> Callable[[pa.Array], pa.Array]:
    settings = json.loads(content)
    contents = contents_of(settings)
    decoder = Tokenizer.from_str(content).decoder if settings.get("decoder") else None
    # Contents by token, null where a number is no token.
    table = pa.array([contents.get(number) for number in range(max(contents, default=-1) + 1)])

    def decoded(rows: pa.Array) -> pa.Array:
        rows = rows.fill_null([]) if rows.null_count else rows
        flat = rows.flatten()
        sizes = rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        numbers = flat.to_numpy(zero_copy_only=False)
        known = np.isin(numbers, list(contents)) if len(contents) < len(table) else (
            (numbers >= 0) & (numbers < len(table))
        )
        if not known.all():
            sizes, numbers = in_groups(known.astype(np.int64), sizes), numbers[known]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        words = pa.LargeListArray.from_arrays(
            offsets, table.take(pa.array(numbers.astype(np.int64))).cast(pa.large_string())
        )
        if decoder is None:
            return pc.binary_join(words, pa.scalar(" ", pa.large_string()))
        return pa.array([decoder.decode(row) for row in words.to_pylist()], pa.large_string())

    return decoded


def encode(
    frame: DataFrame,
    vocabulary: str,
    text: str = "text",
    into: str = TOKENS,
    packed: str | None = None,
    decoded: str | None = None,
) -> DataFrame:
    """``frame`` with the tokens of its texts, an array of int.

    ``vocabulary`` is the path of a tokenizer's file, which the driver can open. The
    module's docstring states the cases. ``packed`` and ``decoded`` name further columns: the
    tokens as little-endian unsigned 32-bit integers, a binary, and what ``decode`` makes of them.
    """
    made = {into: T.ArrayType(T.IntegerType())}
    if packed:
        made[packed] = T.BinaryType()
    if decoded:
        made[decoded] = T.StringType()

    def convert(content: str) -> Callable[[pa.Array], list[pa.Array]]:
        steps = [_packed] if packed else []
        if decoded:
            steps.append(_decoding(content))
        encoded = _encoding(content)

        def values(texts: pa.Array) -> list[pa.Array]:
            tokens = encoded(texts)
            return [tokens, *(step(tokens) for step in steps)]

        return values

    return _with_columns(frame, vocabulary, text, made, convert)


def decode(
    frame: DataFrame, vocabulary: str, tokens: str = TOKENS, into: str = DECODED
) -> DataFrame:
    """``frame`` with the texts that its tokens stand for, special ones too. Numbers that are no
    token have no text."""

    def convert(content: str) -> Callable[[pa.Array], list[pa.Array]]:
        decoded = _decoding(content)
        return lambda rows: [decoded(rows)]

    return _with_columns(frame, vocabulary, tokens, {into: T.StringType()}, convert)
