import random

import pytest

from userflow.llm.graph import components


def smallest(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    draw = random.Random(1)
    links = {
        "chain": [(i, i + 1) for i in range(200)] + [(i + 1, i) for i in range(300, 310)],
        "star": [(500, i) for i in range(300)] + [(-1, 250), (7, 8), (7, 7)],
        "random": [(draw.randrange(400), draw.randrange(400)) for _ in range(260)],
        "none": [],
    }[shape]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == smallest([x for x in links if x[0] != x[1]])
