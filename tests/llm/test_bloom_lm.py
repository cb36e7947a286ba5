import collections
import math
import zlib

import numpy as np
import pytest

from tidemark.llm import bloom_lm as lm

SCHEMA = "doc_id long, text string, score double, n long"


def texts(n, seed=0):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(300)]
    weight = 1 / np.arange(1, 301)
    return [(i, " ".join(rng.choice(vocab, int(rng.integers(1, 60)), p=weight / weight.sum())), 0.0, 1) for i in range(n)]


def brute(rows):
    tok = lambda t: [w for w in (t or "").encode().lower().split()] + [None]
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7
    c = collections.Counter(w for i, t, *_ in rows if fold(i) != 2 for w in tok(t))
    n, v = sum(c.values()), len(c)
    return [(i, fold(i) == 2, len(tok(t)), sum(c[w] > 0 for w in tok(t)), n,
             sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tok(t))) for i, t, *_ in rows]


@pytest.mark.parametrize("max_words", [1 << 22, 20])
def test_base_score_is_exact(spark, max_words):
    """With few broadcast words the others go through the join; both give the exact score."""
    rows = texts(200) + [(900, None, 0.0, 1), (901, "", 0.0, 1), (902, "W1 w1\tW2\x0bunseen\u00a0word", 0.0, 1),
                         (None, "w1 w2", 0.0, 1), (903, "w3 w3", 0.0, 1), (903, "w3 w3", 0.0, 1), (904, "w5 " * 30_000, 0.0, 1)]
    got = lm.score_texts(spark.createDataFrame(rows, SCHEMA), max_words=max_words).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    for g, w in zip(sorted(got, key=key), sorted(brute(rows), key=key), strict=True):
        assert (g.doc_id, g.held_out, g.n_tokens, g.n_known, g.train_tokens) == w[:5]
        assert g.base_score == pytest.approx(w[5], rel=1e-9)
        assert g.score < 0 and math.isfinite(g.score)


def test_no_training_documents(spark):
    only = [(i, "a b", 0.0, 1) for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = lm.score_texts(spark.createDataFrame(only, SCHEMA)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0.0 for r in got) and len(got) == len(only)
    assert lm.score_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def build(keys, counts, lowest, bits=4):
    parts = {}
    import pyarrow as pa
    region = (keys >> np.uint64(64 - bits)).astype(int)
    batches = [pa.RecordBatch.from_arrays([pa.array([1]), pa.array([r]), pa.array([keys[region == r].tobytes()]),
                                           pa.array([counts[region == r].tobytes()])], names=list("abcd")) for r in range(1 << bits)]
    for b in lm.bitmaps({1: lowest})(iter(batches)):
        parts[b.column(1)[0].as_py()] = b.column(2)[0].as_py()
    return lm.LogFrequencyFilter(parts, bits, lowest)


def test_filter_never_underestimates_and_rarely_errs():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 2 ** 63, 20_000).astype(np.uint64) * np.uint64(2))
    counts = (rng.pareto(1.0, len(keys)) + 1).astype(np.int64)
    true = np.frexp(counts.astype(float))[1] - 1
    for lowest in (0, 2):
        f = build(keys, counts, lowest)
        got = f.levels(keys)
        held = true >= lowest
        assert (got[held] >= true[held]).all()
        assert (got[held] > true[held]).mean() < 0.03
        absent = f.levels(rng.integers(0, 2 ** 63, 20_000).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        assert (absent >= lowest).mean() < 0.03


def test_lowest_level_bounds_the_insertions():
    hist = np.zeros(lm.LEVELS, np.int64)
    hist[:4] = [1000, 300, 50, 7]
    for most in (0, 7, 64, 400, 1800, 10_000):
        t = lm.lowest_level(hist, most, True)
        assert sum(int(hist[e]) * (e - t + 1) for e in range(t, lm.LEVELS)) <= most
        assert t == 0 or sum(int(hist[e]) * (e - t + 2) for e in range(t - 1, lm.LEVELS)) > most


def test_repeated_text_scores_better_than_shuffled(spark):
    phrase = "one two three four five six seven eight nine ten"
    rows = texts(150) + [(1000 + i, phrase, 0.0, 1) for i in range(40)]
    rows += [(5000, phrase, 0.0, 1), (5001, " ".join(reversed(phrase.split())), 0.0, 1)]
    got = {r.doc_id: r for r in lm.score_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[5000].base_score == pytest.approx(got[5001].base_score)
    assert got[5000].score > got[5001].score + 3


def exact_scores(rows, spark):
    """The scores with levels of exact counts of all training documents, and the weights the operator fitted."""
    model = {}
    fit = lm.fit_weights
    lm.fit_weights = lambda r: model.setdefault("w", fit(r))
    try:
        got = {r.doc_id: r.score for r in lm.score_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    finally:
        lm.fit_weights = fit
    tok = lambda t: [w for w in t.encode().lower().split()] + [None]
    train = [tok(t) for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 7 != lm.HELD]
    c = collections.Counter(w for t in train for w in t)
    pairs = collections.Counter(p for t in train for p in zip([0, *t[:-1]], t, strict=True))
    n, v = sum(c.values()), len(c)
    mean = lambda k: float(lm.mean_count(np.array([k.bit_length() - 1]), 0)[0])
    want = {}
    for i, t, *_ in rows:
        want[i] = 0.0
        for h, w in zip([0, *tok(t)[:-1]], tok(t), strict=True):
            k = c[None] if h == 0 else c[h]
            lam = model["w"][max(k.bit_length() - 1, 0)]
            p = min(1.0, mean(pairs[h, w]) / mean(k)) if k else 0.0
            want[i] += math.log10(lam * p + (1 - lam) * (mean(c[w]) + 1) / (n + v + 1))
    return got, want


def test_pairs_of_the_tuning_fold_are_in_the_model(spark):
    """A phrase that only documents of the tuning fold hold; levels of the filter are exact but for false positives."""
    fold = lambda i: zlib.crc32(str(i).encode()) % 7
    only = [i for i in range(1000, 1400) if fold(i) == lm.TUNING][:20]
    rows = texts(300) + [(i, "w1 w250 w3 w260 w5 w270", 0.0, 1) for i in only]
    got, want = exact_scores(rows, spark)
    off = np.array([abs(got[i] - want[i]) / max(1, abs(want[i])) for i in want])
    assert np.median(off) < 0.005 and max(off[-20:]) < 0.05


def test_pairs_seen_once_stay(spark):
    """Nearly every pair occurs once; all of them are in the filter."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"u{k}" for k in rng.integers(0, 40_000, 150)), 0.0, 1) for i in range(400)]
    got, want = exact_scores(rows, spark)
    assert np.median([abs(got[i] - want[i]) / abs(want[i]) for i in want]) < 0.01


def test_a_region_keeps_every_counted_ngram():
    import pyarrow as pa
    keys = np.arange(1, 50_001, dtype=np.uint64) * np.uint64(2 ** 40)
    ones = np.ones(len(keys))
    t = lm.merger(pa.Table.from_batches([lm.region_runs(2, 7, keys, ones, ones * 0, 1)]))
    assert (lm.unpacked(t.column("levels")[0].as_py(), np.uint8) >= 1).all() and t.column("items")[1].as_py() == len(keys)
