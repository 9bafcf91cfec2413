"""Centroid clustering: bounds against plain Lloyd rounds, in whole numbers of any size."""

import hashlib
import math

import numpy as np
import pytest

from tallyloom.llm import ns_clusters as ns


def whole(x):
    return math.floor(64 * x) if abs(x) < 1e15 else int(x) * 64


def plain(rows, k=16, rounds=3):
    """(vec_id, cluster, distance, cluster_inertia, inertia, hash) by comparing everything with everything."""
    kept = [(i, [float(x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [[whole(x) for x in v] for _, v in first]
    vectors = [(i, [whole(x) for x in v]) for i, v in kept]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in vectors]

    for _ in range(rounds):
        groups = {}
        for (_, v), (_, n) in zip(vectors, assigned()):
            groups.setdefault(n, []).append(v)
        centroids = [[sum(x) // len(x) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    best = assigned() if vectors else []
    fits = lambda x: x if x < 2**63 else None
    part = {n: sum(d for d, m in best if m == n) for _, n in best}
    total = sum(part.values())
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, n, fits(d), fits(part[n]), fits(total), hashes[n]) for (i, _), (d, n) in zip(vectors, best)], key=repr)


def told(df):
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def vectors_of(spark):
    schema = "vec_id long, embedding array<double>, label int, cluster int, big string, low int, key string"
    return lambda rows: spark.createDataFrame([(i, v, 1, 2, "x", 3, "k") for i, v in rows], schema)


def test_whole_table_equals_plain_rounds(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert told(ns.report(table)) == plain(rows)


def test_odd_vectors(vectors_of):
    rng = np.random.default_rng(1)
    good = [(k, rng.normal(size=64).tolist()) for k in range(60)]
    ties = [(100 + k, [0.5 * (k % 2)] * 64) for k in range(20)]
    odd = [(1, None), (2, []), (3, [1.0] * 63), (4, [1.0] * 65), (5, [None] + [1.0] * 63), (6, [math.nan] * 64), (7, [math.inf] * 64), (None, [0.25] * 64)]
    rows = [*good, *good[:5], *ties, *odd, (3, good[4][1])]
    assert told(ns.report(vectors_of(rows))) == plain(rows)
    assert told(ns.report(vectors_of(odd[:-1]))) == [] == told(ns.report(vectors_of([])))
    assert told(ns.report(vectors_of(good[:3]))) == plain(good[:3])


def test_very_large_components(vectors_of):
    rows = [(k, [float(k * 10**e)] * 64) for k in range(1, 6) for e in (0, 3, 5, 6, 9, 20, 300)] + [(99, [-1.5e300] * 64), (98, [2.0**52 + 0.5] * 64)]
    assert told(ns.report(vectors_of(rows))) == plain(rows)


@pytest.mark.parametrize("scale", [1, 50, 1 << 19, 1 << 22])
def test_bounds_never_change_an_assignment_and_save_work(scale):
    rng = np.random.default_rng(scale)
    centres = rng.integers(-scale, scale + 1, (8, 64))
    vectors = (centres[rng.integers(0, 8, 800)] + rng.integers(-scale // 8 - 1, scale // 8 + 2, (800, 64))).astype(np.int64)
    history = [vectors[:8].tolist()]
    first = ns.Rounds(history)
    squares = first.squares(vectors)
    cluster, low, seen = squares.argmin(1), ns._below(squares), np.zeros((800, 8), np.uint8)
    evaluated = 0
    for _ in range(6):
        history.append([vectors[cluster == n].sum(0).__floordiv__(max(1, (cluster == n).sum())).tolist() if (cluster == n).any() else c for n, c in enumerate(history[-1])])
        rounds = ns.Rounds(history)
        evaluated += ns.assign(vectors, cluster, low, seen, rounds)
        truth = rounds.squares(vectors)
        assert (cluster == truth.argmin(1)).all()
        true = np.sqrt(truth.astype(float))
        assert (low - rounds.moved[seen, np.arange(8)[None, :]] <= true * (1 + 1e-9)).all()
    assert scale == 1 or evaluated < 0.5 * 6 * 800 * 8


def test_displacement_is_total_and_not_summed():
    there_and_back = [[[0] * 64], [[100] * 64], [[0] * 64]]
    rounds = ns.Rounds(there_and_back)
    assert rounds.moved[0, 0] == 0 and rounds.moved[1, 0] >= 800
