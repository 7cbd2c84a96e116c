import random

from netscope.llm import components as C
from netscope.llm.components import components


def test_random_graphs_and_chains(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, x) for x in range(201, 230)] + [(5, 5)]
    edges += [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(120)]
    rng.shuffle(edges)
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(C, "TASK_LINKS", 20)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7 * i % 90, 7 * (i + 1) % 90) for i in range(80)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 90) if i * 13 % 90 <= 80}, **{i: 100 for i in range(101, 141)}}


def test_a_round_has_no_more_tasks_than_its_links_need(spark):
    """The driver keeps something of every task: few links must not cost a task per shuffle partition and stage."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", "few links")
    try:
        got = components(spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long"))
        assert got.count() == 60
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    stages = {s for j in tracker.getJobIdsForGroup("few links") for s in tracker.getJobInfo(j).stageIds}
    done = [i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i]
    assert len(done) > 10 and sum(done) < 4 * 40


def test_links_of_one_task_need_one_round(spark):
    """Each round is a dozen of the driver's plans, and each plan was larger than the round's before."""
    rng = random.Random(9)
    nodes = rng.sample(range(1000), 300)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", "one round")
    try:
        got = {r["node"]: r["root"] for r in components(
            spark.createDataFrame(list(zip(nodes, nodes[1:])), "a long, b long")).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {x: min(nodes) for x in nodes if x != min(nodes)}
    assert len(tracker.getJobIdsForGroup("one round")) < 20


def test_a_forest_for_every_so_many_links(spark, monkeypatch):
    """Text nodes, links that come twice and both ways, more links in a task than it holds at once."""
    monkeypatch.setattr(C, "TASK_LINKS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        pairs = [(f"k{i}", f"k{i + 2}") for i in range(30)] * 2 + [("k9", "k7"), ("x", "x"), (None, "k1"), ("é", "z")]
        got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    even, odd = (sorted(f"k{i}" for i in range(s, 32, 2)) for s in (0, 1))
    assert got == {**{x: even[0] for x in even[1:]}, **{x: odd[0] for x in odd[1:]}, "é": "z"}


def test_estimated_sizes_stay_small(spark, monkeypatch):
    """A join's estimated size is a product: handed on from round to round it soon had thousands of bits."""
    monkeypatch.setattr(C, "TASK_LINKS", 12)
    rng = random.Random(9)
    nodes = rng.sample(range(1000), 60)
    got = components(spark.createDataFrame(list(zip(nodes, nodes[1:])), "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == {x: min(nodes) for x in nodes if x != min(nodes)}
    assert got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 100
