"""The pipeline's stages, each on what its predecessor kept, against plain Python."""

from collections import Counter

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from loadglass.llm import sharding


@pytest.fixture(scope="module")
def states(spark, folder, documents, tmp_path_factory):
    """The documents before and after each stage."""
    found = [documents]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, found[-1], folder).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def rows(frame):
    return [tuple(row) for row in frame.collect()]


def test_columns_stay(states, documents):
    for state in states[:-1]:
        assert state.columns == documents.columns


def test_quality_rules(states):
    kept = {row[0] for row in rows(states[1])}
    assert kept == {row[0] for row in rows(states[0]) if not brute.quality(row[1])[-1]}


def test_one_of_each_group_stays(states):
    before = rows(states[1])
    prints = {row[0]: brute.fingerprint(row[1]) for row in before}
    roots = brute.components(prints.values())
    least = {}
    for doc_id, fp in prints.items():
        least[roots[fp]] = min(doc_id, least.get(roots[fp], doc_id))
    assert sorted(row[0] for row in rows(states[2])) == sorted(least.values())


def test_contaminated_documents_go(spark, folder, states):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    windows = brute.windows_of(items)
    clean = [row for row in rows(states[2]) if not brute.contamination(row[1], windows)[-1]]
    assert Counter(rows(states[3])) == Counter(clean)


def test_mix_repeats_whole_documents(states):
    before, after = set(rows(states[3])), Counter(rows(states[4]))
    assert set(after) <= before and max(after.values()) <= 3
    size = lambda row: len(brute.SPACED.findall(row[1]))
    total = sum(map(size, before))
    assert sum(size(row) * n for row, n in after.items()) == pytest.approx(total, rel=0.02)


def test_every_row_has_a_shard(states):
    assert Counter(r["doc_id"] for r in states[5].collect()) == Counter(
        row[0] for row in rows(states[4])
    )
    assert set(states[5].columns) == {"doc_id", "bytes", "depth", "shard", "page"}


def test_run_is_the_stages(spark, folder, states):
    run = corpus_pipeline.run(spark, folder)
    assert Counter(rows(run)) == Counter(rows(states[5]))
    assert sharding.MAX_BYTES == 64 << 20


def test_awkward_documents_pass_all_stages(spark, folder, edge_documents, tmp_path):
    """Each stage works on null and empty texts, repeated rows and other columns, and on none."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = [c for c in edge_documents.columns]
    extra = [F.lit(None).cast(edge_documents.schema[c].dataType).alias(c) for c in columns if c not in docs.columns]
    for name, given in [("edge", edge_documents), ("none", edge_documents.limit(0)),
                        ("both", docs.select("*", *extra).select(columns).unionByName(edge_documents))]:
        state = given
        for stage, function in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{stage}")
            function(spark, state, folder).write.parquet(path)
            state = spark.read.parquet(path)
            if stage != "shards":
                assert state.columns == columns
        assert (state.count() > 0) == (name != "none")


def test_stages_without_benchmark_items(spark, folder, documents, tmp_path):
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = corpus_pipeline.benchmark_decontamination(spark, documents, str(tmp_path))
    assert Counter(rows(kept)) == Counter(rows(documents))


def test_stages_take_null_and_repeated_rows(spark, folder, edge_documents):
    once = corpus_pipeline.near_duplicates(spark, edge_documents, folder)
    assert once.where("text IS NULL OR text = ''").count() <= 1
    clean = corpus_pipeline.benchmark_decontamination(spark, edge_documents, folder)
    assert clean.where("text IS NULL").count() == edge_documents.where("text IS NULL").count()
