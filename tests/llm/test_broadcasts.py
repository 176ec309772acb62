"""Rows that Spark counts too low, as after an explode, are not broadcast."""

import re

import corpus_pipeline
import pytest

from loadglass.llm import components, sharding, simhash


@pytest.fixture
def plans(monkeypatch):
    """The plans of what a module writes between steps, as it was planned, by purpose."""

    def noted(module):
        found, written = {}, module.written

        def note(frame, purpose):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            found.setdefault(purpose, []).append(plan)
            return written(frame, purpose)

        monkeypatch.setattr(module, "written", note)
        return found

    return noted


def test_keys_of_fingerprints_are_not_broadcast(spark, plans):
    found = plans(simhash)
    prints = spark.createDataFrame([(0,), (1,), (-1,), (1 << 40,)], "fp long")
    edges = {tuple(row) for row in simhash.links(prints).collect()}
    assert edges == {(1, 0), (1 << 40, 0), (1 << 40, 1)}
    (plan,) = found["simhash-met"]
    assert "MapInPandas" in plan and "Broadcast" not in plan


def test_prefixes_of_keys_are_not_broadcast(spark, plans):
    found = plans(sharding)
    keys = [(n << 54, 10) for n in range(64)] + [(n, 10) for n in range(8)]
    table = sharding.directory(spark.createDataFrame(keys, "key long, bytes long"), 40)
    depths = {row["fine"]: row["depth"] for row in table[0][1].collect()}
    # Four keys fit, so four bits name a shard but where eight more keys are.
    crowded = {1 << 3: 6, 2 << 3: 5, 3 << 3: 5}
    assert depths == crowded | {n << 3: 4 for n in range(4, 64)} and len(table) > 1
    for plan in found["sharding-directory"]:
        assert "Generate" in plan and "Broadcast" not in plan


def made_rows_broadcast(plan):
    """What makes several rows of one, and is broadcast as it comes out."""
    names = [re.sub(r"^[^A-Za-z]+(\(\d+\) )?", "", line).split(" ")[0] for line in plan.split("\n")]
    found = []
    for at, name in enumerate(names):
        if name == "BroadcastExchange":
            below = (x for x in names[at + 1 :] if x not in ("Project", "Filter"))
            found += [x for x in [next(below)] if x.startswith(("Generate", "MapIn"))]
    return found


def test_pipeline_broadcasts_no_rows_that_it_makes(spark, folder, plans):
    found = [plans(module) for module in (components, sharding, simhash)]
    texts = [f"the {n} words of a text {n * n} that is {n} of its own" for n in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts + texts[:3])), "doc_id long, text string")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near_duplicates"](spark, docs, folder)
    shards = stages["shards"](spark, kept, folder)
    assert shards.count() == kept.count() > 0
    written = [plan for plans in found for of in plans.values() for plan in of]
    assert any("MapInPandas" in plan for plan in written)
    assert any("Generate" in plan for plan in written)
    assert [name for plan in written for name in made_rows_broadcast(plan)] == []
