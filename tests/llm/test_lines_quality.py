"""Operators 5 and 7 against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from aerocast.llm import op5_line_dedup as op5
from aerocast.llm import op6_exact_dedup as op6
from aerocast.llm import op7_quality as op7
from conftest import SF_MID, SF_SMALL
from llm.fixtures import edge_pairs, odd_columns, rows, small, table, with_ties


def brute_lines(pairs, run):
    texts = [None if t is None else t.split("\n") for _, t in pairs]
    order = sorted(range(len(pairs)), key=lambda k: (pairs[k][0] is None, pairs[k][0] or 0))
    seen, gone = set(), {k: set() for k in order}
    for k in order:
        w = texts[k] or []
        for i in range(len(w) - run + 1):
            key = tuple(w[i:i + run])
            if key in seen:
                gone[k] |= set(range(i, i + run))
            seen.add(key)
    out = []
    for k, (d, _) in enumerate(pairs):
        w = texts[k]
        spans = sum(1 for i in gone[k] if i - 1 not in gone[k])
        sha = None if w is None else hashlib.sha256("\n".join(x for i, x in enumerate(w) if i not in gone[k]).encode()).hexdigest()
        out.append((d, len(w or []), len(gone[k]), spans, sha))
    return sorted(out, key=repr)


def line_pairs(seed=1):
    rng = random.Random(seed)
    source = [f"line {rng.randrange(40)}" for _ in range(300)]
    out = [(0, None), (1, ""), (2, "\n"), (3, "\n\n\n\n\n\n"), (4, "a\nb"), (5, "a\nb\n"), (6, "same\n" * 40)]
    for i in range(50):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(len(source))
            parts += source[a:a + rng.randrange(1, 25)] + [f"own {rng.randrange(10**6)}"]
        out.append((10 + i, "\n".join(parts)))
    return out


@pytest.mark.parametrize("run", [1, 2, 3, 7])
def test_line_runs(spark, run):
    assert rows(op5.drop_repeated_runs(odd_columns(table(spark, line_pairs())), run)) == brute_lines(line_pairs(), run)


def test_lines_ties_and_nothing(spark):
    pairs = line_pairs()
    pairs = [*pairs, pairs[12], pairs[12], (None, pairs[20][1]), (None, None)]
    assert rows(op5.drop_repeated_runs(table(spark, pairs))) == brute_lines(pairs, op5.RUN)
    assert op5.drop_repeated_runs(table(spark, [])).count() == 0


@pytest.mark.parametrize("name,fn,sql", [("op5", op5.op5_line_dedup, op5.SQL), ("op6", op6.op6_exact_dedup, op6.SQL)])
def test_oracle(spark, name, fn, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_MID}/documents.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    df = fn(spark, SF_MID)
    assert sorted(df.columns) == sorted(names)
    want = cur.fetchall()
    assert any(r[2] for r in want)
    assert rows(df.select(*names)) == sorted(want, key=repr)


def fold(text):
    t = re.sub(r"[\s\x00-\x1f]+", " ", text or "").strip(" ")
    return "".join("0" if c.isdigit() else "￿" if ord(c) > 0xFFFF else c for c in t)


def brute_perplexity(pairs, trusted, order=op7.ORDER):
    seqs = [["\1"] * (order - 1) + list(fold(t)) for _, t in pairs]
    counts = {k: Counter() for k in range(1, order + 1)}
    for (d, _), s in zip(pairs, seqs):
        if d in trusted:
            counts[order].update(tuple(s[i - order + 1:i + 1]) for i in range(order - 1, len(s)))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    disc, total, spare = {}, {}, {}
    for k, c in counts.items():
        n = [0] + [sum(v == x for v in c.values()) for x in (1, 2, 3, 4)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
        disc[k] = [0] + [min(max(x - (x + 1) * y * n[x + 1] / n[x], 0), x) if n[x] else min(y, 1) for x in (1, 2, 3)]
        total[k], spare[k] = defaultdict(float), defaultdict(float)
        for g, v in c.items():
            total[k][g[:-1]] += v
            spare[k][g[:-1]] += disc[k][min(v, 3)]
    size = len(counts[1]) + 1

    def prob(g):
        if not g:
            return 1 / size
        k, low = len(g), prob(g[1:])
        if not total[k][g[:-1]]:
            return low
        v = counts[k][g]
        return (max(v - disc[k][min(v, 3)], 0) + spare[k][g[:-1]] * low) / total[k][g[:-1]]

    out = []
    for (d, _), s in zip(pairs, seqs):
        lp = [math.log(prob(tuple(s[i - order + 1:i + 1]))) for i in range(order - 1, len(s))]
        out.append((d, len(lp), math.exp(-sum(lp) / len(lp)) if lp else None))
    return out, prob, counts


@pytest.mark.parametrize("bucket", [32 << 20, 30_000])
def test_perplexity_matches_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(op7, "BUCKET_BYTES", bucket)
    pairs = with_ties(edge_pairs()) + [(500, "9 8\t7\n\n🙂 x "), (501, " 🙂")]
    trusted = {i for i in range(0, 60, 2)}
    marks = spark.createDataFrame([(i,) for i in [*trusted, 4, 99999]] + [(None,)], "doc_id long")
    got = sorted(((r.doc_id, r.n_tokens, r.perplexity) for r in op7.perplexities(odd_columns(table(spark, pairs)), marks).collect()), key=lambda r: repr(r[:2]))
    want, prob, counts = brute_perplexity(pairs, trusted)
    for g, w in zip(got, sorted(want, key=lambda r: repr(r[:2])), strict=True):
        assert g[:2] == w[:2] and (g[2] is None) == (w[2] is None)
        assert w[2] is None or g[2] == pytest.approx(w[2], rel=1e-9)
    ctx = next(iter(counts[4]))[:-1]  # the distribution after a context sums to one
    known = [c[0] for c in counts[1]]
    assert sum(prob((*ctx, c)) for c in known) + prob((*ctx, "never")) == pytest.approx(1)


def test_quality_separates_labels(spark):
    got = {r.doc_id: r for r in op7.op7_quality_classifier(spark, "/root/testdata/sf0.1").collect()}
    lab = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    kept = {q: np.mean([got[i].kept for i in lab if lab[i] == q]) for q in (0, 1)}
    print(kept)
    assert kept[1] > 0.98 and kept[0] < 0.5


def test_quality_without_trust_and_rows(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert op7.judged(table(spark, []), none).count() == 0
    got = op7.judged(odd_columns(table(spark, edge_pairs())), none).collect()
    assert len(got) == len(edge_pairs()) and all(r.kept == (r.n_tokens > 0) for r in got)
