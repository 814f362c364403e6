import numpy as np
import pytest

from tallyfold.llm import hnsw


def plain(rows, k, every):
    usable = sorted({(i, tuple(float(x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = {}
    for i, v in usable:
        if i % every == 0:
            near = [(-float(np.dot(v, w)), j) for j, w in usable if j != i and len(w) == len(v)]
            out.setdefault(i, []).extend(near)
    return {i: sorted(near)[:k] for i, near in out.items()}


def recall(found, expected):
    hits = total = 0
    for query, near in expected.items():
        got = found.get(query, [])
        assert len(got) == len(near)
        assert [(r.rank) for r in got] == list(range(1, len(got) + 1))
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        worst = near[-1][0] + 1e-9 if near else 0
        hits += sum(-r.score <= worst for r in got)
        total += len(near)
    return hits / max(1, total)


def by_query(frame):
    found = {}
    for r in frame.collect():
        found.setdefault(r.query_id, []).append(r)
    return {q: sorted(rows, key=lambda r: r.rank) for q, rows in found.items()}


def test_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(60)]
    same = rows[7][1]
    rows += [(100 + i, same) for i in range(40)]
    rows += [(200, None), (220, [0.0] * 6), (240, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (260, [float("nan")] + [1.0] * 5), (280, [float("inf")] + [1.0] * 5)]
    rows += [(None, same), (20, rows[20][1]), (300, [1.0, 2.0]), (301, [2.0, 1.0]), (320, []), (0, [5.0] * 6)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, score string").repartition(3)
    rounded = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    expected = plain(rounded, 20, 20)
    expected = {q: near[:20] for q, near in expected.items()}
    found = by_query(hnsw.nearest(frame, k=20, every=20, shard_rows=32, query_block=3))
    assert set(found) == {q for q, near in expected.items() if near}
    for query in set(found) - {0}:
        assert [r.vec_id for r in found[query]] == [j for _, j in expected[query]]
        assert np.allclose([-r.score for r in found[query]], [s for s, _ in expected[query]], rtol=0, atol=1e-12)


@pytest.mark.parametrize("norms", ["one", "many"])
def test_recall_against_brute_force(spark, norms):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 24))
    vectors = centres[rng.integers(0, 30, 3000)] + 0.4 * rng.normal(size=(3000, 24))
    if norms == "one":
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = by_query(hnsw.nearest(frame, k=20, every=20, shard_rows=1000))
    assert recall(found, plain(rows, 20, 20)) >= 0.95


def test_fewer_candidates_than_wanted(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in hnsw.nearest(frame, k=20, every=20).orderBy("rank").collect()] == [
        (0, 1, 1, 0.5),
        (0, 2, 2, 0.0),
    ]
    assert hnsw.nearest(frame.where("vec_id = 0")).collect() == []
    assert hnsw.nearest(frame.where("false")).collect() == []


def test_recall_beside_very_long_vectors(spark):
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(1000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[::250] *= np.array([1e2, 1e3, 1e4, 1e5])[:, None]
    rows = [(i + 1, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = by_query(hnsw.nearest(frame, k=20, every=20, shard_rows=1000))
    assert recall(found, plain(rows, 20, 20)) >= 0.95


def test_no_length_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "BROADCAST_SIZES", 1, raising=False)
    rows = [(i, i, [1.0] * (1 + i % 5)) for i in range(20)]
    index = hnsw.build_index(spark.createDataFrame(rows, "class_id long, class_hash long, vector array<double>"))
    assert "Limit" not in index._jdf.queryExecution().toString()
    assert sorted((r.dim, len(r.ids) // 8) for r in index.collect()) == [(n, 4) for n in range(1, 6)]
