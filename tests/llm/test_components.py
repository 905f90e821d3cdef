import random

from tidemark.llm.components import connected_components


def test_chains_stars_and_noise(spark):
    random.seed(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(1000 + random.randrange(80), 1000 + random.randrange(80)) for _ in range(50)]
    links += [(3, None), (None, 4), (9, 9)]
    random.shuffle(links)
    component = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            component.update({x: x for x in (a, b) if x not in component})
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a in component and b in component and component[a] != component[b]:
                component[a] = component[b] = min(component[a], component[b])
                changed = True
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {row.id: row.component for row in got.collect()} == component


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
