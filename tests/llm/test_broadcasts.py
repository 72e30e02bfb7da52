"""Joins whose rows Spark sizes too low must not be broadcast through the driver."""

import pytest

from tallyhouse.llm import components, decontamination, simhash
from tallyhouse.session import StagingArea


class PlannedArea(StagingArea):
    """Keeps the plan of each staged frame, as Spark would run it."""

    def __init__(self, spark):
        super().__init__(spark)
        self.plans = {}

    def stage(self, df, name="frame"):
        self.plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return super().stage(df, name)


@pytest.fixture
def planned(spark):
    area = PlannedArea(spark)
    yield area
    area.clear()


def test_neighbours_of_prints_are_not_broadcast(spark, planned):
    prints = spark.createDataFrame([(p,) for p in (0, 1, 3, 1 << 40, 7 << 50)], "print bigint")
    found = simhash.linked_prints(planned.stage(prints, "prints"), planned).collect()
    assert {tuple(r) for r in found} == {(0, 0), (1, 0), (3, 0), (1 << 40, 0)}
    for name in ("near", "edges"):
        assert "SortMergeJoin" in planned.plans[name] and "Broadcast" not in planned.plans[name]


@pytest.mark.parametrize(("rows", "broadcast"), [(3, False), (1000, True)])
def test_many_edges_are_not_broadcast(spark, planned, monkeypatch, rows, broadcast):
    monkeypatch.setattr(components, "BROADCAST_ROWS", rows, raising=False)
    edges = spark.createDataFrame([(i, 1) for i in range(2, 40)], "a bigint, b bigint")
    found = components.connected_components(planned.stage(edges, "given"), planned)
    assert {tuple(r) for r in found.collect()} == {(i, 1) for i in range(1, 40)}
    assert ("Broadcast" in planned.plans["stars"]) == broadcast


def test_places_of_shingles_are_not_broadcast(spark, planned):
    passage = " ".join(f"word{i}" for i in range(20))
    docs = planned.stage(spark.createDataFrame([(1, "start " + passage), (2, "none of it")], "doc_id bigint, text string"), "docs")
    benchmark = planned.stage(spark.createDataFrame([("a", passage)], "item_id string, text string"), "benchmark")
    found = decontamination.contamination(docs, benchmark, planned).select("doc_id", "n_hit").orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == [(1, 20), (2, 0)]
    join = planned.plans["occurring"]
    assert "SortMergeJoin [key" in join
