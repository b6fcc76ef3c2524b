"""The corpus pipeline against the operators' brute-force versions, stage by stage."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
import __spark_entry__ as entry
from aerocast.llm import op2_decontamination as op2
from aerocast.llm import op8_toxicity as op8
from conftest import SF_MID, SF_SMALL
from llm.fixtures import edge_pairs, odd_columns, rows, table, with_ties
from llm.test_pairs import brute_near, greedy, words
from llm.test_simple_ops import brute_bpe, brute_groups


def test_registered():
    q, sql = entry.queries(), entry.oracle_sql()
    assert [n for n in range(1, 11) if any(k.startswith(f"op{n}_") for k in q)] == list(range(1, 11))
    assert "pipeline" in q and set(sql) <= set(q)


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    bench = [(r.item_id, r.text) for r in op2.benchmark_of(spark, SF_MID).collect()]
    seeds = {}
    for i, t in bench:
        w = words(t)
        for k in range(len(w) - op2.MIN_TILE + 1):
            seeds.setdefault(tuple(w[k:k + op2.MIN_TILE]), set()).add(i)
    items = {i: words(t) for i, t in bench}

    def leaked(text):
        w, hits = words(text), {}
        for k in range(len(w) - op2.MIN_TILE + 1):
            for i in seeds.get(tuple(w[k:k + op2.MIN_TILE]), ()):
                hits.setdefault(i, set()).update(range(k, k + op2.MIN_TILE))
        # tiles lie in shared runs only; others become a break
        return any(greedy(items[i], [w[k] if k in at else k for k in range(len(w)) if k in at or k - 1 in at]) >= op2.COVERAGE
                   for i, at in hits.items())

    def among(pairs, judged):
        kept = {g[0] for g in judged if g[3]}
        return [x for x in pairs if x[0] in kept]

    score = op8.scorer(spark, op8.train(docs, op8.labels_of(spark, SF_MID)))
    predicted = {r.doc_id: r.s for r in docs.select("doc_id", score("text").alias("s")).collect()}
    want = [(r.doc_id, r.text) for r in docs.collect()]
    brute = [
        lambda p: [x for x in p if predicted[x[0]] < 0.5],
        lambda p: among(p, brute_groups(p)),
        lambda p: among(p, brute_near(p)),
        lambda p: [x for x in p if not leaked(x[1])],
    ]
    now = docs
    for (name, stage), rule in zip(cp.STAGES, brute):
        now = cp.common.written(stage(spark, now, SF_MID), name)
        before, want = len(want), rule(want)
        assert len(want) < before and now.columns == docs.columns
        assert sorted((r.doc_id, r.text) for r in now.collect()) == sorted(want), name
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert rows(cp.STAGES[-1][1](spark, now, SF_MID)) == brute_bpe(tok, want)


@pytest.mark.parametrize("pairs", [[], [(1, None)], with_ties(edge_pairs())], ids=["empty", "null", "ties"])
def test_stages_on_odd_tables(spark, pairs):
    docs = odd_columns(table(spark, pairs))
    for name, stage in cp.STAGES[:-1]:
        out = cp.common.written(stage(spark, docs, SF_SMALL), name)
        assert out.columns == docs.columns and out.count() <= docs.count()
        assert out.exceptAll(docs).count() == 0  # rows unchanged
        docs = out
    assert cp.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()


def test_run(spark):
    got = cp.run(spark, SF_SMALL)
    assert 0 < got.count() < spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
