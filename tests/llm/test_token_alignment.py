import bisect
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import token_alignment as ta

SCHEMA = "pair long, doc_id long, text string, links int, n string"


@pytest.fixture(scope="module")
def tok():
    return ta.load(ta.TOKENIZER_DIR)


def plain_tokens(t, text):
    """Whole text at once, no cutting, no cache: ids and byte ends, or None."""
    if not text:
        return None
    want = (" " + text).encode()
    a, b = t.a.encode(" " + text, add_special_tokens=False).ids, t.b.encode(text)
    if b"".join(t.a_bytes[k] for k in a) != want or b"".join(t.b_bytes[k] for k in b) != want:
        return None
    return a, b


def plain_table(t, rows):
    """Groups, links and counts by the definition, from sets of byte ends."""
    docs, counts = [], Counter()
    for d, text in rows:
        got = plain_tokens(t, text)
        if got is None:
            docs.append((d, 0, 0, [], ""))
            continue
        a, b = got
        end_a, end_b = np.cumsum([len(t.a_bytes[k]) for k in a]), np.cumsum([len(t.b_bytes[k]) for k in b])
        both = sorted(set(end_a) & set(end_b))
        groups = [([], []) for _ in both]
        ended_a, ended_b = defaultdict(list), defaultdict(list)
        for side, (ids, ends, ended) in enumerate(((a, end_a, ended_a), (b, end_b, ended_b))):
            for k, e in zip(ids, ends):
                groups[bisect.bisect_left(both, e)][side].append(str(k))
                ended[e].append(k)
        groups = [",".join(ga) + "|" + ",".join(gb) for ga, gb in groups]
        links = [(k, m) for e in both for k in ended_a[e] for m in ended_b[e]]
        counts.update(links)
        docs.append((d, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, m), n in counts.items():
        best[m] = max(best[m], n)
    return sorted((d, na, nb, len(ln), len(ln), sum(counts[x] == best[x[1]] for x in ln), sum(counts[x] for x in ln), sha)
                  for d, na, nb, ln, sha in docs)


def got_table(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


TEXTS = [
    "The quick brown fox isn't <s> jumping</s> <|endoftext|> over the lazy dog.", None, "", " ", "  two  spaces  ", "tab\there\n\nline \n x",
    "naïve café Straße größer", "日本語 の テキスト", "emoji 🎉🎉 and ﬁ ligature", "▁ literal", "nbsp here x", "a", "123456789 1,000.50 $%&",
    "same words same words same words", "same words same words same words", "​ zero width", "x" * 500, "\x00 nul", "end space ",
    "<0x41> <unk> [UNK]", "Привет мир", "é combining",
]


def test_against_definition(spark, tok):
    rows = [(k, x) for k, x in enumerate(TEXTS)]
    df = spark.createDataFrame([(1, d, x, 2, "q") for d, x in rows], SCHEMA).repartition(3)
    want = plain_table(tok, rows)
    assert got_table(ta.compare_tokenizers(df)) == want
    assert got_table(ta.compare_tokenizers(df, max_broadcast_pairs=0)) == want
    assert sum(w[1] > 0 for w in want) >= 10


def test_empty_table_and_null_ids(spark, tok):
    assert got_table(ta.compare_tokenizers(spark.createDataFrame([], SCHEMA))) == []
    got = ta.compare_tokenizers(spark.createDataFrame([(1, None, "some text", 2, "q")] * 2, SCHEMA)).collect()
    assert len(got) == 2 and got[0] == got[1] and got[0].doc_id is None and got[0].count_sum == 2 * got[0].n_links


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \t\nabcsétion'., ▁\x1c"), st.characters(exclude_categories=["Cs"])), max_size=60), min_size=1, max_size=5))
def test_cut_and_cached_encoding_equals_whole_encoding(texts):
    t = ta.load(ta.TOKENIZER_DIR)
    for x in texts:
        want = plain_tokens(t, x)
        got = None
        if x:
            k = t.encode(list(dict.fromkeys(ta.CUT.split(x))))
            number = dict(zip(dict.fromkeys(ta.CUT.split(x)), k))
            ks = [number[p] for p in ta.CUT.split(x)]
            if t.valid[ks].all():
                got = tuple([int(i) for k in ks for i in t.ids[s][t.at[s][k]:t.at[s][k + 1]]] for s in (0, 1))
        assert got == want


def test_long_text_in_stretches_and_lanes(spark, tok, monkeypatch):
    text = " ".join(f"word{k} größer,tion" for k in range(3000)) + "  end"
    want = plain_table(tok, [(1, text), (2, "short one")])
    for stretch, lane, batch in ((1 << 18, 2048, 1 << 21), (700, 64, 1000), (100, 1, 1)):
        monkeypatch.setattr(ta, "STRETCH", stretch)
        monkeypatch.setattr(ta, "LANE_BYTES", lane)
        monkeypatch.setattr(ta, "BATCH_CHARS", batch)
        docs = {0: ta.Document(), 1: ta.Document()}
        held = []
        for s in ta.stretches([text, "short one"]):
            held.append(s)
            if sum(len(p) for x in held for p in x.pieces) > batch:
                ta.align(tok, held, docs)
                held = []
        if held:
            ta.align(tok, held, docs)
        for d, w in zip((docs[0], docs[1]), want):
            assert (d.n_a, d.n_b, sum(map(len, d.links)), d.sha.hexdigest()) == (w[1], w[2], w[3], w[7])


def test_merge_by_sets():
    rng = np.random.default_rng(0)
    lanes = []
    for _ in range(200):
        n = int(rng.integers(1, 60))
        lanes.append([np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, n)), n)) for _ in range(2)])
    a, b = (ta.Tokens(np.zeros(sum(map(len, x)), np.int32), np.concatenate(x), np.concatenate([[0], np.cumsum([len(y) for y in x])]))
            for x in zip(*lanes))
    partner = ta.merge(a, b)
    for k, (x, y) in enumerate(lanes):
        want = {e: np.searchsorted(y, e) + b.starts[k] for e in set(x) & set(y)}
        assert [want.get(e, -1) for e in x] == partner[a.starts[k]:a.starts[k + 1]].tolist()


def test_possible_pairs_bound(spark, tok):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    aligned = ta.encode_and_align(d)
    seen = ta.link_counts(aligned).collect()
    assert 0 < len(seen) <= tok.possible_pairs() <= ta.MAX_BROADCAST_PAIRS
    for r in seen:
        a, b = divmod(r.pair, len(tok.b_bytes))
        x, y = tok.a_bytes[a], tok.b_bytes[b]
        assert x.endswith(y) or y.endswith(x)


def test_given_table(spark, tok):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id % 4 = 0 OR length(text) < 400")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    assert got_table(ta.compare_tokenizers(d)) == plain_table(tok, rows)
