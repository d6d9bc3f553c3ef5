import math
import random

import numpy as np
import pytest

from newstide.llm import queries, vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, cell string, home string, links string"


def table(spark, rows):
    """Vectors with columns of clashing names."""
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_force(rows):
    """(n_links, component) by comparing all with all."""
    n, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a, label) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if label is None or rows[j][2] != label or not usable(a) or not usable(b) or len(a) != len(b):
                continue
            x, y = (np.array(v, dtype=np.float32).astype(float) for v in (a, b))
            if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                n[i], n[j] = n[i] + 1, n[j] + 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least[root(i)] = min(vec_id, least.get(root(i), vec_id))
    return [(n[i], least.get(root(i))) for i in range(len(rows))]


def sampled(number, seed=4, dim=8):
    draw, rows = np.random.default_rng(seed), []
    for i in range(number):
        if rows and draw.random() < 0.6:
            v = np.array(rows[draw.integers(len(rows))][1]) * draw.choice([1.0, 1.0, 3.0]) + draw.normal(0, draw.choice([0, 0.03, 0.08]), dim)
        else:
            v = draw.normal(size=dim)
        rows.append((number - i, v.astype(np.float32).tolist(), int(draw.integers(3))))
    return rows


@pytest.mark.parametrize("margin", [vectors.MARGIN, math.sqrt(2 - 2 * 0.98)])
def test_links_equal_brute_force(spark, margin):
    rows = sampled(700)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(table(spark, rows), margin=margin).collect()}
    want = {r[0]: (n, c, c == r[0]) for r, (n, c) in zip(rows, brute_force(rows))}
    links = sum(n for n, _, _ in want.values())
    if margin > vectors.MARGIN:  # exact
        assert found == want
    # few dimensions are the hard case for the default margin
    assert sum(n for n, _, _ in found.values()) >= 0.97 * links > 500


def test_default_finds_every_link_in_few_dimensions(spark):
    rows = sampled(1500, seed=5, dim=4)
    found = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(table(spark, rows)).collect()}
    assert found == {r[0]: b for r, b in zip(rows, brute_force(rows))}


def test_crowded_cells_and_copies(spark):
    draw = np.random.default_rng(8)
    base = draw.normal(size=16)
    rows = [(i, (base + draw.normal(0, 0.02, 16)).astype(np.float32).tolist(), 1) for i in range(600)]
    rows += [(600 + i, rows[0][1], 1) for i in range(300)] + [(900, rows[0][1], 2), (901, (-base).tolist(), 1)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(table(spark, rows)).collect()}
    assert [found[r[0]] for r in rows] == brute_force(rows)


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.0, 0.0]
    rows = [
        (1, one, 1), (2, one, None), (3, None, 1), (4, [0.0, 0.0, 0.0], 1), (5, [nan, 1.0, 0.0], 1), (6, [inf, 0.0, 0.0], 1),
        (7, [None, 1.0, 0.0], 1), (8, [1.0, 0.0], 1), (9, one, 1), (9, one, 1), (None, one, 1), (None, [0.0, 5.0, 0.0], 2), (10, [], 1),
        (11, [1e30, 0.0, 0.0], 1), (12, [-0.0, 1.0, 0.0], 3), (13, [0.0, 1.0, 0.0], 3), (14, [1e-30, 0.0, 0.0], 1),
    ]
    found = vectors.near_duplicates(table(spark, rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = [(r[0], n, c if c is not None else r[0]) for r, (n, c) in zip(rows, brute_force(rows))]
    assert sorted([tuple(r)[:3] for r in found], key=key) == sorted(want, key=key)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert vectors.near_duplicates(table(spark, [])).collect() == []


def test_cells_hold_every_pair_at_the_exact_margin():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 5))
    y = x + draw.normal(0, 0.05, x.shape)
    centers = vectors.centroids(np.concatenate([x, y]), 25)
    assert np.allclose(np.linalg.norm(centers, axis=1), 1)
    home, _ = vectors.cells_of(x, centers, 0)
    _, inside = vectors.cells_of(y, centers, math.sqrt(2 - 2 * 0.98))
    near = (vectors._unit(x) * vectors._unit(y)).sum(1) >= 0.98
    assert near.sum() > 100 and inside[np.arange(400), home][near].all()


def test_parts_of_a_block():
    draw = random.Random(2)
    for _ in range(40):
        homes, others = [draw.sample(range(100), draw.randint(0, 7)) for _ in range(2)]
        linked = np.array([[draw.random() < 0.2 for _ in others] for _ in homes], dtype=bool).reshape(len(homes), len(others))
        linked |= np.array(homes, dtype=int)[:, None] == np.array(others, dtype=int)[None, :]
        parent = {i: i for i in [*homes, *others]}

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i, j in np.argwhere(linked):
            a, b = root(homes[i]), root(others[j])
            parent[max(a, b)] = min(a, b)
        ids = np.array([*homes, *others], dtype=np.int64)
        assert vectors._parts(linked, ids).tolist() == [root(i) for i in ids.tolist()]


def test_query_on_the_table(spark, sf_dir):
    rows = queries.op5_vectors(spark, sf_dir).collect()
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = {g[0]: b for g, b in zip(given, brute_force(given))}
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == want
