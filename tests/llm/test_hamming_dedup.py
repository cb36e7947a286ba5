import collections

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import hamming_dedup as hd
from tidemark.llm.components import connected_components

SCHEMA = "doc_id long, text string, component string, kept string"


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Component of each row's position, by comparing every pair."""
    sets, up = [shingles(t) for _, t, *_ in rows], list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                up[max(root(a), root(b))] = min(root(a), root(b))
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(rows[k][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(rows[k][0], len(sets[k]), least[root(k)]) for k in range(len(rows))]


def edited(rng, words, share):
    w = list(words)
    for at in rng.choice(len(w), max(1, int(share * len(w))), replace=False):
        w[at] = f"new{rng.integers(10 ** 6)}"
    return " ".join(w)


def corpus():
    rng = np.random.default_rng(11)
    word = lambda n: [f"w{k}" for k in rng.integers(0, 5000, n)]
    texts = []
    for _ in range(40):
        base = word(int(rng.integers(30, 400)))
        texts += [" ".join(base)] * int(rng.integers(1, 4))
        texts += [edited(rng, base, s) for s in rng.uniform(0.002, 0.06, 3)]
    chain = word(300)
    for _ in range(12):  # each is near its neighbour, the ends are far apart
        texts.append(" ".join(chain))
        chain = chain[20:] + word(20)
    passage = " ".join(word(60))
    texts += [passage + " " + " ".join(word(40)) for _ in range(30)]
    order = rng.permutation(len(texts))
    return [(int(i), texts[k], "x", "y") for i, k in enumerate(order)]


def check(spark, rows):
    got = hd.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=key) == sorted(brute(rows), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return got


def test_against_every_pair(spark):
    check(spark, corpus())


def test_edges(spark):
    rows = [(10, None, "x", "y"), (11, "", "x", "y"), (12, " \n ", "x", "y"), (3, "a b", "x", "y"), (4, "A  B", "x", "y"),
            (5, "b a", "x", "y"), (6, "one two three four five", "x", "y"), (7, "one two three four five", "x", "y"),
            (8, "word " * 30_000, "x", "y"), (9, "word " * 200, "x", "y"), (None, "One Two three four five", "x", "y"),
            (2, "a b", "x", "y"), (7, "one two three four five", "x", "y")]
    got = hd.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len(got) == 13
    assert [(by[i][0].n_shingles, by[i][0].component_id) for i in (10, 11, 12, 2)] == [(0, 10), (0, 11), (0, 12), (1, 2)]
    assert by[4][0].component_id == 3 and by[5][0].component_id == 5 and by[9][0].component_id == 8
    assert [r.component_id for r in by[7]] == [6, 6] and by[None][0].component_id == 6 and not by[None][0].kept


def test_filter_keeps_one_row_of_each_group(spark):
    rows = [(1, "a b c d e", "x", "y"), (1, "a b c d e", "x", "y"), (2, "a b c d e", "x", "y"), (None, "q r s t u", "x", "y"),
            (None, "q r s t u", "x", "y"), (3, None, "x", "y"), (4, "", "x", "y"), (5, "q r", "x", "y"), (5, "other text", "x", "y")]
    out = hd.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "component", "kept"]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(1, "a b c d e"), (None, "q r s t u"), (3, None), (4, ""), (5, "q r"), (5, "other text")], key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert hd.near_duplicates(empty).collect() == [] == hd.drop_near_duplicates(empty).collect()


def test_every_pair_within_the_radius_shares_a_key(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(150):
        a = rng.integers(0, 2 ** 16, hd.HASHES)
        b = a.copy()
        at = rng.choice(hd.HASHES, hd.RADIUS, replace=False)
        if k % 3 == 0:  # the worst case spreads the errors evenly over the chunks
            at = np.array([lo + j for j in (0, 1) for lo, _ in hd.chunk_bounds()])[:hd.RADIUS]
        b[at] += 1
        rows.append((a.tolist(), b.tolist()))
    d = spark.createDataFrame(rows, "a array<int>, b array<int>")
    shared = F.size(F.array_intersect(hd.key_array(F.col("a")), hd.key_array(F.col("b"))))
    assert d.where(shared == 0).count() == 0
    assert hd.RADIUS // hd.CHUNKS == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 300), (250, 300), (250, 299)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100
    assert {got[x] for x in (200, 300, 250, 299)} == {200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_keys_and_signatures_are_not_broadcast(spark, monkeypatch):
    """Their size is estimated far too low: whatever the threshold, they must not pass through the driver."""
    plans = []

    def written(df):
        plans.append((set(df.columns), df._jdf.queryExecution().executedPlan().toString()))
        return kept(df)

    kept = hd.materialise
    monkeypatch.setattr(hd, "materialise", written)
    hd.near_duplicates(spark.createDataFrame(corpus()[:60], SCHEMA))
    for columns in ({"key", "rep", "hub"}, {"a", "b", "far"}, {"key", "rep", "cluster", "size", "sig"}):
        plan = next(p for c, p in plans if c == columns)
        sent = [line for line in plan.splitlines() if "BroadcastExchange" in line]
        assert "SortMergeJoin" in plan and not any("key#" in line or "rep#" in line for line in sent), plan
