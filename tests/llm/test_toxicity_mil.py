import zlib

import numpy as np

from tidemark.llm import toxicity_mil as mil


def docs_df(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score string, label int")


def labels_df(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def made(n):
    """Documents of neutral sentences; every third has one offending sentence."""
    rng = np.random.default_rng(1)
    neutral = ["river", "stone", "morning", "table", "garden", "letter", "window", "music"]
    docs, labels = [], []
    for i in range(n):
        sents = [" ".join(rng.choice(neutral, 8)).capitalize() + "." for _ in range(12)]
        if i % 3 == 0:
            sents[int(rng.integers(12))] = f"You {rng.choice(['moron', 'scum'])} are here."
        docs.append((i, "\n".join(sents[:6]) + "\n" + " ".join(sents[6:]), "x", 1))
        labels.append((i, 1, int(i % 3 == 0)))
    return docs, labels


def test_held_out_accuracy_and_located_sentences(spark):
    docs, labels = made(600)
    got = {r.doc_id: r for r in mil.score_toxicity(docs_df(spark, docs), labels_df(spark, labels)).collect()}
    assert len(got) == 600
    for i, text, *_ in docs:
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert r.predicted == int(i % 3 == 0) and 0 <= r.score <= 1
        found = [text[int(a):int(b)] for a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert all("moron" in s or "scum" in s for s in found) and bool(found) == (i % 3 == 0)


def test_edges(spark):
    docs, labels = made(60)
    odd = [(1000, None, "x", 1), (1001, "", "x", 1), (1002, " \n\t ", "x", 1), (1003, "...\n.\n", "x", 1),
           (None, "you scum are here.", "x", 1), (1004, "you scum are here.", "x", 1), (1004, "you scum are here.", "x", 1),
           (1005, "garden music. " * 40_000, "x", 1)]
    bad_labels = [(5, None, None), (3, 1, 1), (None, 1, 1), (9999, 0, 1)]
    rows = mil.score_toxicity(docs_df(spark, docs + odd), labels_df(spark, labels + bad_labels)).collect()
    assert len(rows) == 68
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [by[i][0].score for i in (1000, 1001, 1002, 1003)] == [0.0] * 4
    assert len(by[1004]) == 2 and by[1004][0].score == by[1004][1].score
    assert by[None][0].score == by[1004][0].score
    assert by[1005][0].predicted == 0


def test_nothing_to_learn_from(spark):
    docs, labels = made(10)
    none = mil.score_toxicity(docs_df(spark, docs), labels_df(spark, [])).collect()
    assert all(r.score < 0.5 for r in none) and len(none) == 10
    assert mil.score_toxicity(docs_df(spark, []), labels_df(spark, labels)).collect() == []
    assert mil.drop_toxic(docs_df(spark, docs), labels_df(spark, [])).columns == ["doc_id", "text", "score", "label"]


def test_noisy_or_gradient():
    """The gradient that training uses is that of the leaky noisy-or likelihood."""
    z = np.array([-1.0, 0.5, -2.0])
    loss = lambda v: -np.log(-np.expm1(-mil.LEAK - mil.evidence(v).sum()))
    none = mil.LEAK + mil.evidence(z).sum()
    grad = np.exp(-none) / np.expm1(-none) / (1 + np.exp(-z))
    for k in range(3):
        d = np.zeros(3)
        d[k] = 1e-6
        assert abs((loss(z + d) - loss(z - d)) / 2e-6 - grad[k]) < 1e-6
    assert mil.evidence(np.array([mil.BASE, mil.BASE - 5])).tolist() == [0.0, 0.0]


def test_foreign_labels_and_repeated_ids_take_no_place_in_the_sample(spark):
    docs, labels = made(90)
    again = next(i for i, *_ in docs if i % 3 and zlib.crc32(str(i).encode()) % 5)
    many = docs + [docs[again]] * 3000
    foreign = [(10_000 + i, 1, i % 2) for i in range(4000)]
    want = mil.fit(docs_df(spark, docs), labels_df(spark, labels), 100)
    assert want and mil.fit(docs_df(spark, many), labels_df(spark, labels + foreign), 100) == want
