import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import spelling_variants as sv

SCHEMA = "word string, doc_id long, text string, n int, side string, root string"


def is_near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, t = sorted((a, b), key=len)
    return any(t[:i] + t[i + 1:] == s for i in range(len(t)))


def plain_counts(rows):
    c = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 6 and n >= 5}


def plain_groups(counts):
    near = {w: [] for w in counts}
    wild = {}
    for w in counts:  # words that meet in a pattern of one hole are compared by the definition
        for i in range(len(w) + 1):
            for p in {w[:i] + "?" + w[i:], w[:i] + "?" + w[i + 1:]}:
                wild.setdefault(p, set()).add(w)
    for ws in wild.values():
        for a in ws:
            near[a] += [b for b in ws if is_near(a, b)]
    form = {}
    for w, vs in near.items():
        best = min(set(vs), key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        r = w
        while form[r]:
            r = form[r]
        out.append((w, form[w], r, counts[w], len(set(near[w])), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def got_groups(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("abé", min_size=6, max_size=9), min_size=1, max_size=40, unique=True))
def test_index_against_definition(words):
    got = {q: (c, b) for q, c, b in sv.near_words(words, words, False)}
    for k, w in enumerate(words):
        near = [i for i, v in enumerate(words) if is_near(w, v)]
        assert got.get(k) == ((len(near), near[0]) if near else None)
    got = {q: c for q, c, _ in sv.near_words(words, words, True)}
    for k, w in enumerate(words):
        assert got.get(k, 0) == sum(is_near(w, v) and w[:3] != v[:3] for v in words)


def test_every_near_pair_shares_an_end():
    rng = random.Random(1)
    for _ in range(3000):
        w = "".join(rng.choices("abc", k=rng.randint(6, 9)))
        i = rng.randrange(len(w) + 1)
        for v in (w[:i] + "a" + w[i:], w[:i] + w[i + 1:], w[:i] + "b" + w[i + 1:]):
            if len(v) >= 6:
                assert w[:3] == v[:3] or w[-3:] == v[-3:]


def typo_rows(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeé", k=rng.randint(6, 10))) for _ in range(60)]
    rows = []
    for d in range(n):
        text = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.08)), 59)]
            while rng.random() < 0.3:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + "a" + w[i:], w[:i] + "b" + w[i + 1:]])
            text.append(rng.choice([w, w.upper(), w.capitalize()]))
        rows.append((d, " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [8192, 60])
def test_table_against_definition(spark, block):
    rows = typo_rows(3, 300) + [(None, "Straße größer ×÷×÷×÷× " * 9), (900, None), (901, ""), (902, "Zürichs " * 5000), (903, "same same-same"),
                                (904, "abcdefé ABCDEFÉ abcdefÉ " * 5), (904, "abcdefé ABCDEFÉ abcdefÉ " * 5),
                                (905, "quentoa " * 6 + "quentob " * 40 + "quentub " * 300)]
    df = spark.createDataFrame([("q", d, t, 1, "s", "r") for d, t in rows], SCHEMA).repartition(4)
    want = plain_groups(plain_counts(rows))
    assert got_groups(sv.group_variants(df, block)) == want
    assert sum(w[1] is not None for w in want) > 20 and any(w[1] != w[2] for w in want if w[1])


def test_ties_chains_and_empty(spark):
    words = [("aaaaaa", 5), ("aaaaab", 30), ("aaaaac", 30), ("aaaabb", 200), ("zzzzzzz", 9)]
    df = sv.with_roots(sv.forms(spark.createDataFrame(words, "word string, n long")))
    got = {r.word: r for r in df.collect()}
    assert (got["aaaaaa"].form, got["aaaaaa"].form_n, got["aaaaaa"].n_near) == ("aaaaab", 30, 2)
    assert got["aaaaaa"].root == "aaaabb" and got["aaaaab"].form == "aaaabb" and got["aaaabb"].root == "aaaabb"
    assert (got["zzzzzzz"].form, got["zzzzzzz"].n_near, got["zzzzzzz"].root) == (None, 0, "zzzzzzz")
    assert got_groups(sv.group_variants(spark.createDataFrame([], SCHEMA))) == []
    assert got_groups(sv.group_variants(spark.createDataFrame([("q", 1, "a b c", 1, "s", "r")], SCHEMA))) == []


def test_given_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
    assert got_groups(sv.group_variants(d)) == plain_groups(plain_counts(rows))
