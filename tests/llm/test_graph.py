"""Connected components against union-find, with chains, hubs, loops and null ends."""
import random

from pasture.llm.graph import components


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(500, 500)]
    edges += [(200 + rnd.randrange(50), 200 + rnd.randrange(50)) for _ in range(30)]
    group = {}

    def find(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        group[max(x, y)] = min(x, y)
    want = {n: find(n) for e in edges for n in e if e[0] != e[1]}
    rnd.shuffle(edges)
    got = components(spark.createDataFrame([*edges, (None, 3), (4, None)], "u long, v long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "u string, v string")).collect() == []
