import math

import numpy as np
import pytest

from tidemark.llm import nra_topk

SCHEMA = "vec_id long, embedding array<float>, vec string"


def brute(rows, k=5, every=50):
    kept = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        kept[i] = min(kept.get(i, q), q)
    out = {}
    for q in kept:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(kept[q], v)), i) for i, v in kept.items() if i != q)[:k]
            out |= {(q, n): (i, -s) for n, (s, i) in enumerate(best, 1)}
    return out


def run(spark, rows, **kw):
    got = nra_topk.top_k(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    assert len(got) == len({(r.query_id, r["rank"]) for r in got})
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got}


@pytest.mark.parametrize("block", [16, 1024])
def test_against_brute_force(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 12))
    rows = [(i, (centres[i % 5] + 0.2 * rng.normal(size=12)).tolist(), "x") for i in range(400)]
    assert run(spark, rows, block=block, query_block=4) == brute(rows)


def test_ties_repeats_and_bad_vectors(spark):
    same = [(i, [0.5, -0.5], "a") for i in range(120)]
    odd = [(50, [0.1, 0.1], "a"), (200, None, "a"), (201, [None, 1.0], "a"), (202, [float("nan"), 1.0], "a"),
           (203, [float("inf"), 1.0], "a"), (None, [9.0, 9.0], "a"), (204, [], "a"), (250, [1.0, 2.0, 3.0], "a"),
           (0, [0.5, -0.5], "a"), (-50, [0.25], "a")]
    assert run(spark, same + odd, block=32) == brute(same + odd)


def test_small_and_empty(spark):
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0], "x")]) == {}
    assert run(spark, [(0, [1.0], "x"), (1, [2.0], "x")]) == {(0, 1): (1, 256 * 512)}
    assert run(spark, [(1, [1.0], "x"), (2, [1.0], "x")]) == {}


def test_large_components_are_exact():
    v, ids = np.array([[2 ** 40, 1], [2 ** 40, 2], [-(2 ** 40), 5]]), np.array([1, 2, 3])
    got = nra_topk.nra_block(v, ids, np.array([[2 ** 40, 1]]), np.array([50]), 2)
    assert got == [(50, 2, 2 ** 80 + 2), (50, 1, 2 ** 80 + 1)]


def test_reading_stops_early_without_losing_ties():
    rng = np.random.default_rng(0)
    v = rng.integers(-3, 4, size=(300, 6))
    ids, q = np.arange(300), rng.integers(-3, 4, size=(40, 6))
    got = nra_topk.nra_block(v, ids, q, np.full(40, -1) - np.arange(40), 5)
    for j in range(40):
        want = sorted((-int(s), i) for i, s in enumerate(v @ q[j]))[:5]
        assert [(i, s) for k, i, s in got if k == -1 - j] == [(i, -s) for s, i in want]
