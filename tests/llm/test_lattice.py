import itertools

import numpy as np

from tidemark.llm import lattice


def test_decoding_finds_the_nearest_point():
    random = np.random.default_rng(1)
    points = [p for p in itertools.product((-2, -1, 0, 1, 2), repeat=8) if len({x % 2 for x in p}) == 1 and sum(p) % 4 == 0]
    points = np.array(points) / 2
    x = random.uniform(-0.6, 0.6, (300, 8))
    best = np.square(x[:, None] - points[None]).sum(axis=2).min(axis=1)
    got = np.square(x - lattice.nearest_e8(x) / 2).sum(axis=1)
    assert np.allclose(best, got)
    assert len(lattice.minimal_vectors()) == len(set(map(tuple, lattice.minimal_vectors()))) == 240


def unit(vector):
    vector = vector / np.abs(vector).max()
    return vector / np.linalg.norm(vector)


def brute(rows, least=0.93):
    links = {i: set() for i, _ in enumerate(rows)}
    units = []
    for _, vector, label in rows:
        good = vector is not None and label is not None and len(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector)
        units.append(unit(np.array(vector, dtype=float)) if good else None)
    for i, j in itertools.combinations(range(len(rows)), 2):
        if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least:
            links[i].add(j)
            links[j].add(i)
    component = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        component[i] = min(rows[j][0] for j in seen)
    return {rows[i][0]: (len(links[i]), component[i], component[i] == rows[i][0]) for i in links}


def planted(seed, n=250, dimensions=64):
    random = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and random.random() < 0.6:
            _, base, label = rows[random.integers(len(rows))]
            step = random.standard_normal(dimensions)
            vector = np.array(base) / np.linalg.norm(base) + random.choice([0, 0.1, 0.3, 0.45]) * step / np.linalg.norm(step)
        else:
            vector, label = random.standard_normal(dimensions), int(random.integers(3))
        rows.append((i, [float(x) for x in vector], label))
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int"


def found(df):
    return {row.vec_id: (row.n_links, row.component_id, row.kept) for row in df.collect()}


def test_recall_and_precision(spark):
    total = lost = 0
    for seed in (1, 2):
        rows = planted(seed)
        expected = brute(rows)
        got = found(lattice.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)))
        assert all(got[i][0] <= expected[i][0] for i in expected)
        total += sum(n for n, _, _ in expected.values())
        lost += sum(expected[i][0] - got[i][0] for i in expected)
    assert total > 300 and lost <= 0.02 * total


def test_cells_in_chunks(spark):
    random = np.random.default_rng(5)
    base = random.standard_normal(16)
    rows = [(i, [float(x) for x in base + 0.02 * random.standard_normal(16)], 1) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA).select("vec_id", "label", "embedding")
    links = {tuple(row) for row in lattice.vector_links(df, 0.93, cell_rows=7).collect()}
    assert links == {(i, j) for i in range(90) for j in range(i + 1, 90)}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [1.0, None], 1),
        (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [], 1), (11, [1.0, 0.0], 1), (12, [1.0, 0.0, 0.0], 1), (13, [1e-300, 0.0], 1), (14, [1e300, 1e300], 1),
        (15, [-1.0, 0.0], 1), (16, [-1.0, -0.0], 1),
    ]
    df = spark.createDataFrame([(*row, "x") for row in rows], SCHEMA + ", component string")
    assert found(lattice.near_duplicate_vectors(df)) == brute(rows)
    assert lattice.near_duplicate_vectors(df.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)], SCHEMA)
    assert sorted(map(str, map(tuple, lattice.near_duplicate_vectors(nameless).collect()))) == ["(1, 1, 1, True)"] * 2 + ["(None, 0, None, False)"]
