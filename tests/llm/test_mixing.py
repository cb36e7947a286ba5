import collections

import pytest

from tidemark.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, taken string"


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    """Clamp and reshare until nobody is above: the definition, step by step."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed |= {s: float(cap * sizes[s]) for s in above}


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(7)).collect()
    assert collections.Counter(map(str, out)) == collections.Counter(map(str, again))
    assert len(out) == len(rows)
    words = lambda t: len((t or "").encode().split())
    sizes = collections.Counter()
    for _, t, s, *_ in rows:
        sizes[s] += words(t)
    want, taken = brute_targets(sizes), collections.Counter()
    for r in out:
        assert r["size"] == words(r.text) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    return out


def test_caps_and_repetitions(spark):
    rows = [(i, "a b c", "tiny", "", "") for i in range(2)] + [(10 + i, "w " * (i % 17), "big", "", "") for i in range(400)]
    rows += [(1000 + i, "x y", "Älter", "", "") for i in range(50)] + [(2000 + i, "x y z", None, "", "") for i in range(30)]
    out = check(spark, rows)
    assert all(r.taken == 9 for r in out if r.source == "tiny")


def test_edges(spark):
    rows = [(1, None, "a", "", ""), (2, "", "a", "", ""), (None, "one two", "b", "", ""), (None, "one two", "b", "", ""),
            (3, "one two\x0bthree", "b", "", ""), (4, " \n", None, "", ""), (5, "w " * 50_000, "c", "", "")]
    check(spark, rows)
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    blank = mixing.mix(spark.createDataFrame([(1, "", "a", "", ""), (2, None, None, "", "")], SCHEMA)).collect()
    assert [(r.target, r.taken) for r in blank] == [(0.0, 0)] * 2


def test_columns_pass_through(spark):
    out = mixing.mix(spark.createDataFrame([(1, "a b", "s", "clash", "clash")], SCHEMA))
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"]
