import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import piecewise_hash as ph
from tidemark.llm.common import mix64

SCHEMA = "h string, doc_id long, text string, part int, row string, role string"


def plain_fingerprint(data: bytes) -> str:
    """The definition, byte by byte."""
    m = (1 << 32) - 1
    hashes = []
    for i in range(len(data)):
        h = 0
        for j in range(i - ph.WINDOW + 1, i + 1):
            h = (h * ph.BASE + (data[j] + 1 if j >= 0 else 0)) & m
        h ^= h >> 15
        h = h * 0x2C1B3C6D & m
        h ^= h >> 12
        h = h * 0x297A2D39 & m
        hashes.append(h ^ (h >> 15))

    def pieces(level):
        out, run = [], []
        for h in hashes:
            run.append(h)
            if h % (1 << level) == 0:
                out.append(run)
                run = []
        return out + ([run] if run else []), sum(h % (1 << level) == 0 for h in hashes)

    level = 0
    while pieces(level)[1] >= ph.MAX_PIECES:
        level += 1

    def written(level):
        sums = np.array([sum(p) for p in pieces(level)[0]], np.uint64)
        return ph.written_symbols((mix64(sums) >> np.uint64(64 - ph.SYMBOL_BITS)).astype(np.int64))

    return f"{1 << level}:{written(level)}:{written(level + 1)}"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000))
def test_fingerprint_by_definition(data):
    assert str(ph.fingerprint(data)) == plain_fingerprint(data)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12)), min_size=1, max_size=8))
def test_edit_distances_by_definition(pairs):
    got = ph.edit_distances([np.array(a, np.int64) for a, _ in pairs], [np.array(b, np.int64) for _, b in pairs])
    assert got.tolist() == [plain_distance(a, b) for a, b in pairs]


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


def test_segments_do_not_change_a_fingerprint(monkeypatch):
    text = words(1, 5000).encode()
    whole = str(ph.fingerprint(text))
    monkeypatch.setattr(ph, "SEGMENT", 1000)
    assert str(ph.fingerprint(text)) == whole


@pytest.mark.parametrize("text", [b"a" * 300_000, b"ab" * 150_000, bytes(range(256)) * 1000, words(2, 200_000).encode()])
def test_fingerprints_stay_short(text):
    f = ph.fingerprint(text)
    assert 1 <= len(f.fine) <= ph.MAX_PIECES and len(f.coarse) <= len(f.fine)


def test_edits_are_told_from_other_texts():
    near, far = [], []
    for k in range(40):
        t, u = words(k, 400 + 10 * k), words(1000 + k, 400 + 10 * k)
        e = t[:1000] + "XYZ" + t[1003:]
        a, b, c = (ph.fingerprint(x.encode()) for x in (t, e, u))
        near.append(ph.likenesses([(a, b)])[0])
        far.append(ph.likenesses([(a, c)])[0])
    assert min(near) > 0.85 and max(far) < 0.2


def expected(rows):
    """Plain version over the whole table: rows in the order of doc_id (unique here), next one cyclic."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0]))
    out = {}
    for i, (d, t) in enumerate(rows):
        u = rows[(i + 1) % len(rows)][1]
        q = len(t) // 4
        e = t[:len(t) - q] + u[:q]
        a, b, c = (ph.fingerprint(x.encode()) for x in (t, e, u))
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), plain_fingerprint(t.encode()), plain_fingerprint(e.encode()),
                  plain_likeness(a, b), plain_likeness(a, c))
    return out


def plain_likeness(a, b):
    best = 0.0
    for s, k in ((a.fine, a.level), (a.coarse, a.level + 1)):
        for t, j in ((b.fine, b.level), (b.coarse, b.level + 1)):
            if j == k:
                best = max(best, 1 - plain_distance(s.tolist(), t.tolist()) / max(len(s), len(t), 1))
    return best


def test_table_against_plain_version(spark):
    texts = [words(k, 3 + 7 * k) for k in range(30)] + [None, "", "é", "日本語のテキスト" * 30, words(5, 38), "x" * 5000]
    rows = [(3 * i - 7, t) for i, t in enumerate(texts)] + [(None, words(99, 20))]
    df = spark.createDataFrame([("a", d, t, 1, "b", "c") for d, t in rows], SCHEMA).repartition(5)
    want = expected(rows)
    got = ph.edited_likeness(df).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == w[:4]
        assert r.near_edited == pytest.approx(w[4]) and r.near_next == pytest.approx(w[5])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_repeated_rows_single_row_empty_table(spark):
    same = words(7, 300)
    got = ph.edited_likeness(spark.createDataFrame([("a", 5, same, 1, "b", "c")] * 200, SCHEMA).repartition(7)).collect()
    assert len(got) == 200 and len({r.fingerprint for r in got}) == 1 and {r.near_next for r in got} == {1.0}
    one = ph.edited_likeness(spark.createDataFrame([("a", 5, "abcd", 1, "b", "c")], SCHEMA)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abca").hexdigest() and one[0].near_next == 1.0
    assert ph.edited_likeness(spark.createDataFrame([], SCHEMA)).collect() == []


def test_given_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in ph.edited_likeness(d).collect()}
    want = expected([(r.doc_id, r.text) for r in d.collect()]) if len(got) <= 400 else {}
    assert {k: (v.n_chars, v.edited_sha256, v.fingerprint) for k, v in got.items()} == {k: v[:3] for k, v in want.items()}
    assert sum(r.near_edited for r in got.values()) / len(got) > 0.6
