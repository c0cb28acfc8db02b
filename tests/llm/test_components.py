import random

from corpusloom.llm.components import connected_components


def test_equal_to_union_find(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(1_000 + i, 1_001 + i) for i in range(70)] + [(5, 5)]
    name = {}
    for u, v in edges:
        a, b = name.setdefault(u, u), name.setdefault(v, v)
        low, high = min(a, b), max(a, b)
        name = {k: low if c == high else c for k, c in name.items()}
    table = spark.createDataFrame(edges, "u long, v long")
    assert {r.node: r.component for r in connected_components(table).collect()} == name


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
