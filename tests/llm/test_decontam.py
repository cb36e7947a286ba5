import numpy as np

from tidemark.llm import decontam as dc

DOCS = "doc_id long, text string, item_id long, score string"
ITEMS = "item_id long, text string, doc_id long"


def smith_waterman(item, text):
    h = [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (dc.MATCH if a == b else dc.MISMATCH), h[i - 1][j] + dc.GAP, h[i][j - 1] + dc.GAP)
    return max(max(r) for r in h)


def test_alignment_against_the_full_table():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = rng.integers(1, 5, rng.integers(1, 15)), rng.integers(0, 5, rng.integers(1, 25))
        score, lo, hi = dc.align(a, b)
        assert score == smith_waterman(a.tolist(), b.tolist())
        if score:
            assert smith_waterman(a.tolist(), b[lo:hi].tolist()) == score


def find(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS)
    return dc.find_leaks(d, b, **kw)


def corpus(seed=9):
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{k}" for k in rng.zipf(1.3, n) % 2000]
    items = [(i, " ".join(word(int(rng.integers(15, 60))))) for i in range(30)]
    docs, want = [(i, " ".join(word(int(rng.integers(20, 400))))) for i in range(200)], set()
    for i in range(200, 300):
        k = int(rng.integers(30))
        w = items[k][1].split()
        if i % 2:  # an edited copy: a tenth of the words replaced, one dropped, one added
            for at in rng.choice(len(w), len(w) // 10, replace=False):
                w[at] = "edited"
            del w[int(rng.integers(len(w)))]
            w.insert(int(rng.integers(len(w))), "added")
        docs.append((i, " ".join(word(30) + [x.upper() if i % 3 else x for x in w] + word(50))))
        want.add((i, k))
    docs += [(1000 + j, items[0][1]) for j in range(300)]  # a very common item stays a leak
    return docs, items, want | {(1000 + j, 0) for j in range(300)}


def test_planted_copies_are_found_and_clean_documents_left_alone(spark):
    docs, items, want = corpus()
    got = {(r.doc_id, r.item_id) for r in find(spark, docs, items).collect()}
    assert want <= got
    brute = set()
    for i, t in docs[:200]:
        for k, item in items:
            a, b = item.lower().split(), t.lower().split()
            if smith_waterman(a, b) >= 0.5 * dc.MATCH * len(a):
                brute.add((i, k))
    assert {x for x in got if x[0] < 200} <= brute


def test_copies_with_every_fourth_to_sixth_word_changed(spark):
    """Against the full table; the broken n-grams occur in one document each, the intact ones in many or in one."""
    rng = np.random.default_rng(12)
    items = [(i, " ".join(f"v{k}" for k in rng.integers(0, 5000, int(rng.integers(16, 60))))) for i in range(30)]
    docs = []
    for i, (k, text) in enumerate(items):
        step, w = 4 + i % 3, text.split()
        edited = [f"other{i}" if at % step == step - 1 else x for at, x in enumerate(w)]
        for _ in range(1 + 5 * (i % 2)):
            docs.append((len(docs), " ".join(["before"] * 9 + edited + ["after"] * 9)))
        for at in range(step - 1, len(w), step):  # the n-grams around the edits, rarer than the intact ones when i is odd
            docs.append((len(docs), " ".join(["x"] * 20 + w[max(0, at - 2):at + 3] + ["y"] * 40)))
    want = {(i, k) for i, t in docs for k, item in items
            if smith_waterman(item.split(), t.split()) >= 0.5 * dc.MATCH * len(item.split())}
    assert {k for _, k in want} == set(range(30))
    assert {(r.doc_id, r.item_id) for r in find(spark, docs, items).collect()} == want


def test_a_repeated_ngram_does_not_cut_the_passage():
    """The second place of an n-gram names a diagonal to the left, whose window holds a part of the copy only."""
    item = np.array([1, 2, 3] + list(range(10, 40)) + [1, 2, 3] + list(range(50, 54)))
    doc = np.concatenate([np.full(60, 99), item, np.full(60, 99)])
    assert dc.passages(item, doc, {27, 60, 93}, 0.5) == [(1.0, 60, 60 + len(item))]


def test_chunks_give_the_same(spark):
    docs, items, _ = corpus(5)
    one = {(r.doc_id, r.item_id, r.word_start, r.word_end) for r in find(spark, docs[150:], items).collect()}
    many = {(r.doc_id, r.item_id, r.word_start, r.word_end) for r in find(spark, docs[150:], items, chunk_bytes=2000).collect()}
    assert one == many and one


def test_edges(spark):
    items = [(1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (4, "Solo pair"), (None, "uno dos tres cuatro cinco"),
             (5, "alpha beta gamma delta epsilon zeta")]
    text = "Alpha beta\ngamma delta epsilon zeta"
    docs = [(1, None), (2, ""), (3, text), (3, text), (None, "x uno dos tres cuatro cinco"), (4, "see solo pair here"), (5, "solo"),
            (6, "solo pair"), (7, "nothing at all to see"), (8, f"{text} " * 3000)]
    got = find(spark, docs, items).collect()
    seen = [(r.doc_id, r.item_id) for r in got]
    assert seen.count((3, 1)) == 2 and seen.count((3, 5)) == 2 and (None, None) in seen
    assert (4, 4) in seen and (6, 4) in seen and not {1, 2, 5, 7} & {i for i, _ in seen}
    assert seen.count((8, 1)) == 3000
    assert all(r.score == 1.0 and r.word_end - r.word_start >= 2 for r in got)
    assert find(spark, docs, []).collect() == [] == find(spark, [], items).collect()


def test_filter_keeps_columns_and_clean_rows(spark):
    d = spark.createDataFrame([(1, "q alpha beta gamma delta epsilon zeta", 0, "x"), (2, "clean", 0, "x"), (None, None, 0, "x"),
                               (None, "alpha beta gamma delta epsilon zeta", 0, "x")], DOCS)
    b = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta", 0)], ITEMS)
    out = dc.drop_leaks(d, b)
    assert out.columns == d.columns and sorted(str(r.text) for r in out.collect()) == ["None", "clean"]
