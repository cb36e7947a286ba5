import collections

import corpus_pipeline
from tidemark.llm import mixing
from tidemark.llm.common import materialise
from tidemark.llm.queries import QUERIES, SQL
from tidemark.plans.compare import compare
from test_decontam import smith_waterman
from test_hamming_dedup import brute
from test_secret_scan import brute as brute_spans

import pytest

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_every_stage_against_its_definition(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    before = rows_of(docs)

    kept = materialise(STAGES["toxicity"](spark, docs, SF))
    toxic = set(before) - set(rows_of(kept))
    score = {r.doc_id: r.predicted for r in QUERIES["op3_toxicity_mil"](spark, SF).collect()}
    assert kept.columns == docs.columns and toxic == {i for i, p in score.items() if p}

    before = rows_of(kept)
    kept2 = materialise(STAGES["near duplicates"](spark, kept, SF))
    least = {i for i, _, c in brute([(i, r.text) for i, r in before.items()]) if i == c}
    assert kept2.columns == docs.columns and set(rows_of(kept2)) == least

    before = rows_of(kept2)
    kept3 = materialise(STAGES["decontamination"](spark, kept2, SF))
    leaks = set()
    for i, r in before.items():
        text = (r.text or "").lower().split()
        for item in benchmark:
            w = item.text.lower().split()
            if len(set(w) & set(text)) >= 0.4 * len(set(w)) and smith_waterman(w, text) >= len(w):
                leaks.add(i)
    assert kept3.columns == docs.columns and set(before) - set(rows_of(kept3)) == leaks

    before = rows_of(kept3)
    kept4 = materialise(STAGES["secrets"](spark, kept3, SF))
    after = rows_of(kept4)
    assert kept4.columns == docs.columns and set(after) == set(before)
    for i, r in before.items():
        spans = brute_spans(r.text)
        assert (after[i].text == r.text) or spans
        assert after[i].n_chars == len(after[i].text)

    last = STAGES["mixing"](spark, kept4, SF).collect()
    whole = collections.Counter()
    for r in last:
        assert r.taken > 0
        whole[r.source] += r.taken
    assert all(abs(whole[r.source] - r.target) <= 1 for r in last)


def test_run_is_the_chain_and_empty_documents_pass(spark, tmp_path):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", *mixing.ADDED]
    ids = [r.doc_id for r in got.collect()]
    assert len(ids) == len(set(ids)) > 100
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracles(spark, duck_small, name):
    got = compare(QUERIES[name](spark, SF), duck_small, SQL[name])
    assert got["match"], got
