"""Nearest neighbours against brute force."""

import numpy as np

from claimtide.llm import neighbours, queries

SMALL = "/root/testdata/sf0.01"


def exact(rows, every, count):
    ids = np.array([i for i, _ in rows])
    unit = np.array([v for _, v in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    out = {}
    for k in np.flatnonzero(ids % every == 0):
        score = unit @ unit[k]
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if j != k][:count]
        out[int(ids[k])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        own = out.setdefault(r.query_id, [])
        own.append((r.vec_id, r.score))
        assert r.rank == len(own)
    return out


def test_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect() if r.embedding]
    want, got = exact(rows, 50, 5), found(queries.queries()["op5_neighbours"](spark, SMALL))
    assert want.keys() == got.keys()
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    vectors = {i: np.array(v, float) for i, v in rows}
    for query, best in got.items():
        assert len(best) == 5 and best == sorted(best, key=lambda b: (-b[1], b[0]))
        for other, score in best:
            a, b = vectors[query], vectors[other]
            assert abs(score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cls string, ids int")


def test_copies_ties_and_hot_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE_ROWS", 64)
    monkeypatch.setattr(neighbours, "TILE_QUERIES", 4)
    rng = np.random.default_rng(1)
    rows = [(k, [1.0, 2.0, 3.0] if k % 3 else rng.standard_normal(3).tolist()) for k in range(900)]
    got = found(neighbours.nearest(frame(spark, rows), 10, 5))
    want = exact(rows, 10, 5)
    assert got.keys() == want.keys()
    for query in want:
        if query % 3:  # equal vectors: the smallest ids but its own
            assert [i for i, _ in got[query]] == [i for i, _ in want[query]]
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [2.0, 1.0]), (7, [2.0, 1.0]), (8, [0.0, -1e300]), (9, [1e-300, 1e-300]), (None, [1.0, 1.0]), (50, [1.0, 1.0, 1.0]),
            (100, [0.0, 0.0]), (-50, [-1.0, 0.0])]
    got = found(neighbours.nearest(frame(spark, rows), 50, 5))
    assert [i for i, _ in got[0]] == [7, 9, 8, -50] and 50 not in got and 100 not in got
    assert [i for i, _ in got[-50]] == [8, 9, 7, 0]
    assert abs(got[0][1][1] - 0.5 ** 0.5) < 1e-12
    assert found(neighbours.nearest(frame(spark, []), 50, 5)) == {}
    assert found(neighbours.nearest(frame(spark, [(50, [1.0])]), 50, 5)) == {}
