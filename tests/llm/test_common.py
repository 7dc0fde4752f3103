from tonality.llm import common as C


def test_caches_of_other_operators_are_emptied(monkeypatch):
    monkeypatch.setattr(C, "_HELD", {})
    gone = []
    C.hold("a", lambda: gone.append("a"))
    C.hold("a", lambda: gone.append("a"))
    assert gone == []
    C.hold("b", lambda: gone.append("b"))
    assert gone == ["a"]
    C.hold("a", lambda: gone.append("a"))
    assert gone == ["a", "b"]


def test_components_of_random_graphs(spark):
    import random

    from tonality.llm.common import connected_components

    r = random.Random(6)
    n = 400
    edges = [(r.randrange(n), r.randrange(n)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, 2000 + k) for k in range(1, 50)] + [(5, 5)]
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {row.node: row.component for row in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
