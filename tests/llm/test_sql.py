"""Corpus queries that SQL can express, values, names and types."""

import glob
import os
import textwrap

import duckdb
import pyarrow as pa
import pytest

from loadglass.llm import licenses, line_frequency, queries, sharding

SPARK_TO_SQL = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def tables(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def given(tables, name, columns):
    """A table of the test's own."""
    tables.register(name, pa.table(columns))
    return name


def same(result, expected):
    columns = sorted(result.columns)
    types = {f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in result.schema}
    assert types == dict(zip(expected.columns, map(str, expected.types)))
    order = [expected.columns.index(column) for column in columns]
    got = sorted(repr(tuple(row[c] for c in columns)) for row in result.collect())
    assert got == sorted(repr(tuple(row[i] for i in order)) for row in expected.fetchall())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, folder, tables, name):
    same(queries.QUERIES[name](spark, folder), tables.sql(queries.ORACLES[name]))


def test_small_shards_match_sql(spark, documents, tables):
    same(sharding.assign(documents, 5000), tables.sql(sharding.assign_sql(5000)))


def test_lower_line_limits_match_sql(spark, documents, tables):
    judged = line_frequency.judge(documents, max_documents=2)
    assert judged.where("removed_lines IS NOT NULL").count()
    assert judged.where("NOT kept AND NOT base_failed").count() >= 0
    columns = queries.op9_line_frequency(spark, "/root/testdata/sf0.001").columns
    same(
        judged.select(*columns),
        tables.sql(line_frequency.judge_sql(max_documents=2)),
    )


def test_removed_lines_and_depleted_documents_match_sql(spark, tables):
    menu = "Home | News | Contact us now please"
    rows = [(n, f"Page {n} text {'w%d ' % n * 3}\n{menu}\n" + f"own line {n} " * 14, "a") for n in range(30)]
    rows += [(100 + n, f"{menu}\n" * 12 + f"few words {n}", "a") for n in range(4)]
    rows += [(200 + n, rows[0][1], "b") for n in range(30)] + [(300, menu, None), (301, None, "a"), (302, "", None)]
    doc_id, text, source = map(list, zip(*rows))
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    name = given(tables, "pages_with_menus", {"doc_id": doc_id, "text": text, "source": source})
    judged = line_frequency.judge(documents)
    assert judged.where("size(removed_lines) > 0 AND host = 'a'").count() == 34
    assert judged.where("removed_lines IS NOT NULL AND host = 'b'").count() == 0
    columns = queries.op9_line_frequency(spark, "/root/testdata/sf0.001").columns
    same(judged.select(*columns), tables.sql(line_frequency.judge_sql(name)))


def test_full_licence_texts_match_sql(spark, tables, edge_documents):
    rows = [(r["doc_id"], r["text"]) for r in edge_documents.collect()]
    mit = licenses.LICENSES["MIT"]
    for name, text, terms in licenses.full_texts():
        words = " ".join(text.split())
        wrapped = "\n".join(f"# {line}" for line in textwrap.wrap(words, 50))
        rows += [(len(rows), text), (len(rows), f"import os\n#\n{wrapped}\n#\n\ncode()")]
        rows += [(len(rows), text[: len(text) // 2]), (len(rows), text + "\n" + mit)]
    rows += [
        (900, f"MIT License\n\nCopyright (c) 2020 Me\nAll rights reserved.\n\n{mit}"),
        (901, f"Some words\n\n{mit}\n\nMore words"),
        (902, mit.replace("FITNESS", "USE")),
        (903, "Released under the MIT licence\nsoftware"),
    ]
    doc_id, text = map(list, zip(*rows))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    name = given(tables, "licensed", {"doc_id": pa.array(doc_id, pa.int64()), "text": text})
    found = licenses.scan_licenses(documents).selectExpr("* EXCEPT (licenses)", "array_join(licenses, ',') AS licenses")
    assert found.where("n_licenses > 0").count() > 80
    same(found, tables.sql(licenses.scan_sql(name)))
