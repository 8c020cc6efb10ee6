"""Near copies of vectors against all pairs."""

import numpy as np
import pytest

from claimtide.llm import queries, tiled_dedup
from .duck import assert_same_as_duckdb

FOLDER = "/root/testdata/sf0.01"


def all_pairs(rows, threshold):
    """vec_id -> (n_links, component_id) of valid rows of one length, one row per id."""
    ids = np.array([i for i, _ in rows])
    unit = np.array([v for _, v in rows], float)
    unit = unit / np.abs(unit).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    group = ids.copy()
    while True:
        least = np.array([min([group[k], *group[near[k]]]) for k in range(len(ids))])
        if (least == group).all():
            break
        group = least
    return {int(i): (int(n), int(g)) for i, n, g in zip(ids, near.sum(axis=1), group)}


def found(frame):
    rows = frame.collect()
    assert len({r.vec_id for r in rows}) == len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return {r.vec_id: (r.n_links, r.component_id) for r in rows}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "k") for i, v in rows], "vec_id long, embedding array<double>, cls string, n int, key string")


@pytest.fixture
def clustered():
    """Noise, chains of vectors one step apart, near copies and a vector of a third of all rows."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 24))
    rows = [v.tolist() for v in rng.standard_normal((200, 24))]
    rows += [(centres[k % 12] + 0.22 * rng.standard_normal(24)).tolist() for k in range(300)]
    rows += [(3.0 * centres[0]).tolist()] * 250
    angle = np.arange(60) * 0.4  # neighbours on a circle link, others don't
    rows += [[float(np.cos(a)), float(np.sin(a)), *[0.0] * 22] for a in angle[:7]]
    order = rng.permutation(len(rows))
    return [(int(order[k]), v) for k, v in enumerate(rows)]


@pytest.mark.parametrize("threshold", [0.9, 0.6, 0.99])
def test_links_equal_all_pairs(spark, monkeypatch, clustered, threshold):
    monkeypatch.setattr(tiled_dedup, "BLOCK_BYTES", 24 * 8 * 60)
    monkeypatch.setattr(tiled_dedup, "STRIP", 16)
    monkeypatch.setattr(tiled_dedup, "STEPS", (6, 12))
    want = all_pairs(clustered, threshold)
    assert found(tiled_dedup.group_vectors(frame(spark, clustered), threshold)) == want
    assert max(n for n, _ in want.values()) >= 249 and min(n for n, _ in want.values()) == 0


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [2.0, 0.1]), (7, [2.0, 0.1]), (8, [0.0, -1e300]), (9, [-1e-300, -1e-299]), (None, [1.0, 0.0]), (50, [1.0, 0.0, 0.0]),
            (51, [5.0, 0.0, 0.0]), (52, [-1.0, 0.0]), (-3, [9.0, 0.0]), (60, None), (60, [9.0, 0.0])]
    got = found(tiled_dedup.group_vectors(frame(spark, rows)))
    own = {i: (0, i) for i in (1, 2, 3, 4, 5, 6, 52)}
    assert got == own | {i: (3, -3) for i in (0, 7, -3, 60)} | {8: (1, 8), 9: (1, 8), 50: (1, 50), 51: (1, 50)}
    assert found(tiled_dedup.group_vectors(frame(spark, []))) == {}
    assert found(tiled_dedup.group_vectors(frame(spark, [(4, None)]))) == {4: (0, 4)}


def test_bounds_lose_no_pair():
    rng = np.random.default_rng(7)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    rows = rng.standard_normal((300, 40)) * np.linspace(3, 0.1, 40)
    rows = (rows / np.linalg.norm(rows, axis=1, keepdims=True))
    for threshold in (0.3, 0.7, 0.9):
        a, b = tiled_dedup.linked_places(rows, rows, threshold)
        want = (rows @ turn) @ (rows @ turn).T >= threshold
        assert {*zip(a.tolist(), b.tolist())} == {*zip(*(x.tolist() for x in np.nonzero(want)))}


def test_whole_table(spark):
    name = "op11_embedding_dedup"
    assert_same_as_duckdb(queries.queries()[name](spark, FOLDER), queries.oracle_sql()[name], FOLDER)
