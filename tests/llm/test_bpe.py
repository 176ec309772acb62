"""Tokens against the library that the vocabulary belongs to."""

import hashlib
import json
import random
import re
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

from loadglass.llm import bpe, queries

WORDS = "/opt/tokenizers/word_bpe_49k.json"
BYTES = "/opt/tokenizers/byte_bpe_50k.json"
HARD = [
    "<|endoftext|><|startoftext|> a<|endoftext|>b <|endoftext| >",
    "It's we'll THEY'RE i'M 3.14159 Ⅻ ½ x²",
    "é İstanbul ΣΣΣ straße ﬁ Å ẛ̣",
    "  　\x1c\x1d\x85​ zero‍width﻿",
    "你好 مرحبا हिन्दी \U0001f468‍\U0001f469 \U00010400",
    "a" * 5000 + "!" * 3000 + "é" * 999,
    "\x00\x01\x7f�￿",
    "aaaa bbbbbbb abababababab aabbaabb",
]


def in_library(path, texts):
    library = Tokenizer.from_file(path)
    ids = [library.encode(text or "", add_special_tokens=False).ids for text in texts]
    return ids, [library.decode(row, skip_special_tokens=False) for row in ids]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_hard_texts(spark, path):
    random.seed(7)
    alphabet = "abcdefghij ABC 0123 \n\t'!?-éßΣ́你\U0001f600"
    texts = [None, "", " ", *HARD]
    texts += ["".join(random.choices(alphabet, k=random.randint(1, 60))) for _ in range(500)]
    frame = spark.createDataFrame([(n, t, "x") for n, t in enumerate(texts)], "n int, text string, decoded string")
    rows = bpe.decode(bpe.encode(frame, path), path).orderBy("n").collect()
    ids, decoded = in_library(path, texts)
    assert [row["token_ids"] for row in rows] == ids
    assert [row["decoded"] for row in rows] == decoded


def test_query(spark, documents, edge_documents, folder, tmp_path):
    path = str(tmp_path / "documents.parquet")
    both = documents.unionByName(edge_documents.select(documents.columns))
    both.write.parquet(path)
    given = both.select("doc_id", "text").collect()
    ids, decoded = in_library(WORDS, [row["text"] for row in given])
    sha = lambda data: hashlib.sha256(data).hexdigest()
    expected = sorted(
        repr((row["doc_id"], len(x), sha(np.array(x, "<u4").tobytes()), sha(text.encode())))
        for row, x, text in zip(given, ids, decoded)
    )
    found = queries.op13_bpe(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(repr(tuple(row)) for row in found.collect()) == expected


def test_query_has_one_python_worker_a_task(spark, documents, tmp_path):
    path = str(tmp_path / "documents.parquet")
    documents.limit(5).write.parquet(path)
    plan = queries.op13_bpe(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("MapInArrow|Python|Pandas", plan)) == 1


def test_columns_made_with_the_tokens(spark):
    texts = [None, "", *HARD, "one two"]
    frame = spark.createDataFrame([(n, t, 1) for n, t in enumerate(texts)], "n int, text string, packed int")
    rows = bpe.encode(frame, WORDS, packed="packed", decoded="text").orderBy("n").collect()
    ids, decoded = in_library(WORDS, texts)
    assert [row["token_ids"] for row in rows] == ids and [row["text"] for row in rows] == decoded
    assert [bytes(row["packed"]) for row in rows] == [np.array(x, "<u4").tobytes() for x in ids]


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame([], "text string, token_ids string")
    made = bpe.encode(frame, WORDS)
    assert made.columns == ["text", "token_ids"] and made.collect() == []
    frame = spark.createDataFrame([("one", "old", 1)], "body string, token_ids string, text int")
    row = bpe.encode(frame, WORDS, text="body").first()
    assert (row["body"], row["text"], len(row["token_ids"])) == ("one", 1, 1)


def test_tokens_without_a_text(spark):
    frame = spark.createDataFrame([(None,), ([],), ([1 << 30],)], "token_ids array<int>")
    assert [row["decoded"] for row in bpe.decode(frame, WORDS).collect()] == ["", "", ""]


def naive(symbols, merges):
    symbols = list(symbols)
    while True:
        places = [(merges[pair][0], at) for at, pair in enumerate(zip(symbols, symbols[1:])) if pair in merges]
        if not places:
            return symbols
        _, at = min(places)
        symbols[at : at + 2] = [merges[symbols[at], symbols[at + 1]][1]]


def test_merges_are_the_leftmost_of_lowest_rank():
    random.seed(3)
    for _ in range(300):
        merges, symbols = {}, list(range(4))
        for rank in range(random.randint(0, 12)):
            merges.setdefault((random.choice(symbols), random.choice(symbols)), (rank, 100 + rank))
            symbols.append(100 + rank)
        word = [random.randrange(4) for _ in range(random.randint(0, 40))]
        assert bpe.merged(word, merges) == naive(word, merges)
        if len(word) > 1:
            both = np.array([*word, *word[::-1]], np.int64), np.array([len(word)] * 2)
            flat, lengths = bpe.merged_together(*both, bpe.Pairs(merges))
            assert flat.tolist() == naive(word, merges) + naive(word[::-1], merges)
            assert lengths[0] == len(naive(word, merges))


def test_long_words_do_not_take_quadratic_time():
    with open(WORDS, encoding="utf-8") as file:
        vocabulary = bpe.Encoder(file.read())
    took = []
    for size in (20_000, 80_000):
        word = "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=size))
        started = time.process_time()
        vocabulary.merge_all([word.encode()])
        took.append(time.process_time() - started)
    assert took[1] < 10 * took[0]


@pytest.mark.parametrize("change", [{"dropout": 0.1}, {"unk_token": "!"}, {"byte_fallback": True}, {"type": "WordPiece"}])
def test_other_vocabularies_are_refused(change):
    with open(WORDS, encoding="utf-8") as file:
        settings = json.load(file)
    settings["model"].update(change)
    with pytest.raises(ValueError):
        bpe.Encoder(json.dumps(settings))


def test_memory_of_pieces_changes_nothing(monkeypatch):
    with open(WORDS, encoding="utf-8") as file:
        content = file.read()
    text = "one two three one two four " * 20
    expected = bpe.Encoder(content).encode(text)
    monkeypatch.setattr(bpe, "MAX_REMEMBERED", 2)
    small = bpe.Encoder(content)
    assert small.encode(text) == expected and small.encode(text + " five") [:-1] == expected


def test_near_characters_are_cut_as_the_library_cuts_them():
    with open(WORDS, encoding="utf-8") as file:
        vocabulary = bpe.Encoder(file.read())
    library = Tokenizer.from_file(WORDS)
    near = [chr(code) for code in range(0x250)]
    texts = [form.format(c) for c in near for form in ("{0}", "a{0}b", "1{0}2", "'{0}!", "{0}{0}", " {0} x'{0}s")]
    random.seed(11)
    texts += ["".join(random.choices(near, k=40)) for _ in range(2000)]
    assert vocabulary.plain and not any(bpe.BEYOND(text) for text in texts)
    expected = [row.ids for row in library.encode_batch(texts, add_special_tokens=False)]
    tokens, sizes = vocabulary.encode_all(texts)
    assert tokens.tolist() == [token for row in expected for token in row]
    assert sizes.tolist() == [len(row) for row in expected]
