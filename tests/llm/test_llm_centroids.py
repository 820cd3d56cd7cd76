"""Centroid clustering against plain integer loops."""

import hashlib
import math

import numpy as np
import pytest

from marketflow.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, distance int, v int"


def plain(rows, k, rounds, dimensions, scale=64):
    kept = []
    for id, e, *_ in rows:
        if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e):
            kept.append((id, [math.floor(scale * float(np.float32(x))) for x in e]))
    name = lambda r: ((1, ""), r[1]) if r[0] is None else ((0, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()), r[1])
    c = [v for _, v in sorted(kept, key=name)[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min((square(v, m), j) for j, m in enumerate(c)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for j in range(len(c)):
            mine = [v for (_, v), (_, i) in zip(kept, own) if i == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    inertia = {j: sum(d for d, i in own if i == j) for _, j in own}
    return sorted(((id, j, d, inertia[j], sum(inertia.values()), c[j]) for (id, _), (d, j) in zip(kept, own)), key=repr)


def run(spark, rows, **how):
    got = centroids.cluster(spark.createDataFrame(rows, SCHEMA), **how)
    return sorted(((r[0], r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid)) for r in got.collect()), key=repr)


@pytest.mark.parametrize("leading", [1, 3, 8])
def test_equals_plain_loops(spark, leading):
    rng = np.random.default_rng(leading)
    rows = [(i, [float(x) for x in rng.normal(i % 5, 0.6, 8)], "c", 1, 2) for i in range(300)]
    rows += [(i % 7, rows[3][1], "c", 1, 2) for i in range(40)] + [(None, rows[4][1], None, None, None)]
    rows += [(900, None, "c", 1, 2), (901, [1.0] * 7, "c", 1, 2), (902, [1.0] * 7 + [None], "c", 1, 2), (903, [math.nan] * 8, "c", 1, 2), (904, [math.inf] + [0.0] * 7, "c", 1, 2)]
    how = dict(k=6, rounds=3, dimensions=8)
    assert run(spark, rows, leading=leading, **how) == plain(rows, **how)


def test_ties_equal_rows_and_few_vectors(spark):
    same = [(i, [0.5, -0.5], "c", 1, 2) for i in range(5)]
    assert run(spark, same, k=3, rounds=2, dimensions=2) == plain(same, 3, 2, 2)
    few = [(1, [0.0, 0.0], "c", 1, 2), (2, [1.0, 0.0], "c", 1, 2), (3, [0.5, 0.0], "c", 1, 2)]
    assert run(spark, few, k=16, rounds=3, dimensions=2) == plain(few, 16, 3, 2)
    assert run(spark, [(1, [1.0], "c", 1, 2)], dimensions=2) == []


def test_large_components_stay_exact_and_larger_ones_stop(spark):
    big = float(2**20)
    rows = [(i, [big - i, -big + i, i * 1.5], "c", 1, 2) for i in range(50)]
    assert run(spark, rows, k=4, rounds=3, dimensions=3) == plain(rows, 4, 3, 3)
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1e30, 0.0], "c", 1, 2)], dimensions=2)


def test_bounds_rule_out_far_centroids_only():
    rng = np.random.default_rng(1)
    means = rng.normal(0, 400, (16, 64))
    x = np.floor(means[rng.integers(0, 16, 4000)] + rng.normal(0, 40, (4000, 64))).astype(np.int64)
    c = np.floor(means).astype(np.int64)
    spread = np.cov(x.T.astype(float))
    rotated = centroids.Rotated(x.mean(0), np.linalg.eigh(spread)[1][:, ::-1], 16)
    lead, rest = rotated.of(x.astype(float))
    best, distance, measured = centroids.nearest(x, lead, rest, c, rotated)
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (best == d.argmin(1)).all() and (distance == d.min(1)).all()
    assert measured < 2 * len(x)
