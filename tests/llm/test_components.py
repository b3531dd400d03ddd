import random

from strataforge.llm import components


def roots(pairs):
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in pairs:
        a, b = sorted((top(u), top(v)))
        root[b] = a
    return {x: top(x) for x in root}


def test_components_equal_union_find(spark):
    rnd = random.Random(7)
    pairs = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1200)] + [(-5, 5000)]
    pairs = [(u, v) for u, v in pairs if u != v]
    df = spark.createDataFrame([*pairs, (3, 3), (None, 4), (4, None)], "u long, v long")
    assert {r.node: r.root for r in components.connected_components(df).collect()} == roots(pairs)
    assert components.connected_components(df.limit(0)).count() == 0


def test_a_node_with_very_many_links(spark, monkeypatch):
    """One hub; and no aggregation stands between a shuffle and a join, which would keep Spark from splitting the hub's partition."""
    plans, real = [], components.written
    monkeypatch.setattr(components, "written", lambda df, label: plans.append((label, df._jdf.queryExecution().executedPlan().toString())) or real(df, label))
    n = 200_000
    hub = spark.range(1, n + 1).selectExpr("0L AS u", "id AS v").unionByName(spark.range(n + 10, n + 20).selectExpr("id AS u", "id + 1 AS v"))
    out = components.connected_components(hub)
    assert out.filter("root = 0").count() == n + 1 and out.filter(f"root = {n + 10}").count() == 11
    joins = [text[text.index("Join") :] for label, text in plans if label == "stars" and "Join" in text]
    assert joins and not any("HashAggregate" in x for x in joins)
