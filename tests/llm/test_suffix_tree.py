"""Operator 11 against a brute-force suffix tree on words."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from aerocast.llm import chunks as ch
from aerocast.llm import op11_suffix_tree as op11
from conftest import SF_SMALL
from llm.fixtures import edge_pairs, odd_columns, small, table, with_ties


def symbols(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def brute(pairs, depth, least, penalty):
    streams = [["^^", *symbols(t)] for _, t in pairs]
    train = [s for (i, _), s in zip(pairs, streams) if not held(i)]
    c = [Counter() for _ in range(depth + 1)]
    for s in train:
        for k in range(depth + 1):
            for i in range(max(k, 1), len(s)):
                c[k][tuple(s[i - k:i + 1])] += 1
    n, v = sum(c[0].values()), len(c[0])
    follow = [defaultdict(Counter) for _ in range(depth + 1)]
    for k in range(depth + 1):
        for g, x in c[k].items():
            follow[k][g[:-1]][g[-1]] = x
    states = {}
    for k in range(1, depth + 1):
        for s, f in follow[k].items():
            total, up = sum(f.values()), follow[k - 1][s[1:]]
            above = sum(up.values())
            gain = sum(round(1024 * x * (math.log(x / total) - math.log(up[w] / above))) for w, x in f.items())
            if total >= least and gain >= penalty * 1024 * len(f):
                states[s] = (total, len(f), f)
    out = []
    for (i, _), s in zip(pairs, streams):
        base = score = known = 0.0
        for j in range(1, len(s)):
            p = (c[0][(s[j],)] + 0.5) / (n + 0.5 * (v + 1))
            known += c[0][(s[j],)] > 0
            base += math.log10(p)
            for k in range(1, depth + 1):
                state = states.get(tuple(s[max(j - k, 0):j])) if j >= k else None
                if state:
                    p = (state[2][s[j]] + state[1] * p) / (state[0] + state[1])
            score += math.log10(p)
        out.append((i, held(i), len(s) - 1, int(known), n, base, score))
    return out, states


def same(df, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5], r[6])
    got = sorted((tuple(r) for r in df.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=key)
    assert [g[:5] for g in got] == [e[:5] for e in sorted(expected, key=key)]
    for g, e in zip(got, sorted(expected, key=key)):
        assert g[5:] == pytest.approx(e[5:], rel=1e-9)


@pytest.mark.parametrize("depth,least,penalty,most", [(2, 8, 6.0, 12 << 20), (3, 3, 1.0, 4000), (1, 2, 0.5, 900)])
def test_brute_force(spark, monkeypatch, depth, least, penalty, most):
    from pyspark.sql import functions as F
    pairs = with_ties(edge_pairs(words=["a", "b", "the", "The", "of", "é", "x,y", "on"] + [f"w{i}" for i in range(30)]))
    expected, states = brute(pairs, depth, least, penalty)
    assert states and (depth == 1 or any(len(s) > 1 for s in states))
    docs = odd_columns(table(spark, pairs)).repartition(5, F.length("text"))
    whole = op11.chunked
    # chunks of a few documents each
    monkeypatch.setattr(op11, "chunked", lambda d: _small_chunks(whole, d, most))
    same(op11.tree_scores(docs, depth, least, penalty), expected)


def _small_chunks(form, docs, most):
    """The chunk size is read inside tasks, so it is sent along."""
    def run(batches):
        for b in batches:
            step = max(1, int(b.num_rows * most / max(1, sum(len(x or "") for x in b.column("text").to_pylist()))))
            for i in range(0, b.num_rows, step):
                yield b.slice(i, step)
    return form(docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string").repartition(9)) if most < 1 << 20 else form(docs)


def test_held_out_documents_don_t_teach(spark):
    pairs = [(i, "a b c a b c a b d" if not held(i) else "a q a q") for i in range(40)]
    expected, _ = brute(pairs, 2, 8, 6.0)
    same(op11.tree_scores(table(spark, pairs)), expected)
    assert {r[3] for r in expected if r[1]} == {3}


def test_only_held_out_and_nothing(spark):
    pairs = [(i, "a b") for i in range(60) if held(i)]
    assert all(r.score == 0 == r.base_score and r.n_known == 0 for r in op11.tree_scores(table(spark, pairs)).collect())
    assert op11.tree_scores(table(spark, [])).collect() == []


def test_given_tables(spark):
    docs = small(spark)
    pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    same(op11.op11_suffix_tree_scores(spark, SF_SMALL), brute(pairs, op11.DEPTH, op11.LEAST, op11.PENALTY)[0])


def test_very_long_text_is_cut_into_blocks(spark):
    pairs = [(1, "a long text of words " * 60_000), (2, "x" * 1_400_000), (3, "a long text"), (4, "of words")]
    same(op11.tree_scores(table(spark, pairs)), brute(pairs, 2, 8, 6.0)[0])


def test_numbers_round_trip():
    import numpy as np
    for v in ([], [0], [255, 3], [65536, 1], [1 << 40, 0]):
        assert ch.to_numbers(ch.numbers(np.array(v, np.int64))).tolist() == v
    h = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    assert (ch.unpacked_sorted(ch.packed_sorted(h), np.uint64) == h).all()
