import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from awkward import TEXTS  # noqa: E402

@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): null and empty texts, a very long one, repeated rows and ids."""
    rows = [(number, text) for number, text in enumerate(TEXTS)]
    return [*rows, (3, "one"), (3, "one"), (4, "other text of an id"), (None, "no id"), (None, None)]


@pytest.fixture(scope="session")
def edge_documents(spark, edge_rows):
    """The same with columns that operators use as names of their own."""
    rows = [
        (doc_id, text, "en", None if number % 5 == 4 else f"s{number % 3}",
         None if text is None else len(text), "x", 1, 2.0, True)
        for number, (doc_id, text) in enumerate(edge_rows)
    ]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, "
        "key string, n int, size double, kept boolean",
    )


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
