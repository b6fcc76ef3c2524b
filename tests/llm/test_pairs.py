"""Operators 2 and 3 against brute force."""

import random
import re

import numpy as np
import pytest

from aerocast.llm import components as cc
from aerocast.llm import op2_decontamination as op2
from aerocast.llm import op3_minhash as op3
from conftest import SF_SMALL
from llm.fixtures import edge_pairs, odd_columns, rows, small, table, with_ties


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < 4 else {tuple(w[i:i + 4]) for i in range(len(w) - 3)}


def brute_near(pairs):
    sets = [shingles(t) for _, t in pairs]
    label = {i: i for i, _ in pairs if i is not None}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for x in range(len(pairs)):
        for y in range(x):
            if pairs[x][0] is None or pairs[y][0] is None or not sets[x] or not sets[y]:
                continue
            if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                a, b = sorted((root(pairs[x][0]), root(pairs[y][0])))
                label[b] = a
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for (i, _), s in zip(pairs, sets)), key=repr)


@pytest.mark.parametrize("ties", [False, True])
def test_near_components_edges(spark, ties):
    pairs = with_ties(edge_pairs()) if ties else edge_pairs()
    assert rows(op3.near_components(odd_columns(table(spark, pairs)))) == brute_near(pairs)


def test_near_components_table(spark):
    pairs = [(r.doc_id, r.text) for r in small(spark).collect()]
    assert rows(op3.op3_minhash_near_dedup(spark, SF_SMALL)) == brute_near(pairs)


def test_near_components_empty(spark):
    assert op3.near_components(table(spark, [])).count() == 0
    assert rows(op3.near_components(table(spark, [(4, None), (5, " ")]))) == [(4, 0, 4, True), (5, 0, 5, True)]


def chain(n=60, seed=5):
    """Copies that drift: far ones are linked only through those between; and
    a family that shares a template without being near."""
    rng = random.Random(seed)
    w = [f"v{rng.randrange(9999)}" for _ in range(120)]
    out = []
    for _ in range(n):
        out.append(" ".join(w))
        at = rng.randrange(len(w))
        w = [*w[:at], f"v{rng.randrange(9999)}", *w[at + 1:]]
    half = [f"t{i}" for i in range(60)]
    out += [" ".join(half + [f"u{rng.randrange(9999)}" for _ in range(25)]) for _ in range(25)]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("wide", [2000, 5])
def test_drifting_copies_are_one_component(spark, monkeypatch, wide):
    monkeypatch.setattr(op3, "WIDE", wide)
    pairs = chain()
    assert rows(op3.near_components(table(spark, pairs))) == brute_near(pairs)


def family(n=60, seed=6):
    """A component of near copies, and texts of other components that are near one of its members only or none."""
    rng = random.Random(seed)
    base = [f"f{i}" for i in range(100)]
    out = [" ".join([*base, *(f"g{rng.randrange(99)}" for _ in range(3))]) for _ in range(n)]
    return list(enumerate(out + [" ".join([*base[:80], *(f"h{rng.randrange(9999)}" for _ in range(22))]) for _ in range(6)]))


@pytest.mark.parametrize("pairs", [chain(), family()], ids=["chain", "family"])
def test_small_blocks_find_the_same(spark, monkeypatch, pairs):
    monkeypatch.setattr(op3, "BLOCK", 4)
    assert rows(op3.near_components(table(spark, pairs))) == brute_near(pairs)


def test_versions_of_an_id_link_each(spark):
    pairs = chain(20)
    several = [*pairs, (pairs[0][0], pairs[30][1]), (pairs[0][0], None), (pairs[0][0], " "), (pairs[5][0], pairs[40][1]), (pairs[7][0], None), (pairs[9][0], None)]
    assert rows(op3.near_components(table(spark, several))) == brute_near(several)


def test_packed_keeps_versions_apart(spark):
    packed = op3._packed(table(spark, [(1, "a b c d"), (1, None), (1, "x y z w"), (None, "e")]))
    assert len({r.doc_id for r in packed.collect()}) == 3


def test_no_task_holds_a_group(spark):
    # part 1: a component of 400 and two of 1; part 2: one component alone; part 3: singletons
    members = [(1, i, 0) for i in range(400)] + [(1, 400, 400), (1, 401, 401)] + [(2, 500 + i, 500) for i in range(50)] + [(3, 1000 + i, 1000 + i) for i in range(90)]
    groups = spark.createDataFrame([(p, 0, -1, d, c) for p, d, c in members], "part long, band int, third int, doc_id long, comp long")
    tasks, met = {}, set()
    for r in op3.block_pairs(groups, 20).collect():
        tasks.setdefault((r.part, r.x, r.y), []).append((r.doc_id, r.comp, r.side))
    for key, held in tasks.items():
        assert len(held) <= 80
        for d, c, s in held:
            for e, f, t in held:
                if d < e and c != f and (s == 0 or s != t):
                    assert (key[0], d, e) not in met  # once only
                    met.add((key[0], d, e))
    want = {(p, d, e) for p, d, c in members for q, e, f in members if p == q and d < e and c != f}
    assert met == want
    assert sum(len(held) for (p, _, _), held in tasks.items() if p == 1) < 2 * 400  # the large component meets foreign ones only


def test_drop_near_copies_keeps_columns(spark):
    docs = odd_columns(table(spark, edge_pairs()))
    kept = op3.drop_near_copies(docs)
    want = {i for i, _, _, k in brute_near(edge_pairs()) if k}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    label = {}

    def root(i):
        label.setdefault(i, i)
        while label[i] != i:
            i = label[i]
        return i
    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            label[y] = x
    df = spark.createDataFrame([*edges, (None, 3), (7, 7)], "a long, b long")
    assert rows(cc.components(df, "a", "b")) == sorted(((i, root(i)) for i in label), key=repr)
    assert cc.components(df.limit(0), "a", "b").count() == 0


def greedy(pattern, text, least=op2.MIN_TILE):
    """Greedy string tiling by exhaustive search."""
    mp, mt = [False] * len(pattern), [False] * len(text)
    while True:
        best = 0
        for i in range(len(pattern)):
            for j in range(len(text)):
                k = 0
                while i + k < len(pattern) and j + k < len(text) and pattern[i + k] == text[j + k] and not mp[i + k] and not mt[j + k]:
                    k += 1
                if k > best:
                    best, at = k, (i, j)
        if best < least:
            return sum(mp) / len(pattern)
        for k in range(best):
            mp[at[0] + k] = mt[at[1] + k] = True


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def test_tiling_matches_exhaustive_search(spark):
    rng = random.Random(4)
    vocab = [f"b{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(12, 50)))) for i in range(12)]
    docs = [(0, None), (1, ""), (None, items[2][1])]
    for k in range(40):
        i = rng.randrange(len(items))
        w = items[i][1].split()
        cut = rng.randrange(4, len(w))
        mid = " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 30)))
        docs.append((10 + k, [items[i][1].upper(), " ".join(w[cut:] + w[:cut]), f"{mid} {' '.join(w[:cut])}, {mid}",
                              f"{' '.join(w[cut:])} {mid} {' '.join(w[:cut])}", mid][k % 5]))
    bench = spark.createDataFrame([*items, (99, None), (98, "too short"), (None, items[0][1])], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in op2.contamination(odd_columns(table(spark, docs)), bench).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        shares = {j: greedy(words(s), words(t)) for j, s in items}
        best = max(shares.values())
        r = next(r for r in got.values() if r.doc_id == i)
        assert r.coverage == pytest.approx(best) and r.contaminated == (best >= op2.COVERAGE)
        assert r.n_items == sum(s >= op2.COVERAGE for s in shares.values())
        assert r.item_id == (min(j for j, s in shares.items() if s == best) if best else None)


def test_decontamination_blocks_and_empty(spark, monkeypatch):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    whole = rows(op2.op2_benchmark_decontamination(spark, SF_SMALL))
    assert any(r[4] for r in whole) and not all(r[4] for r in whole)
    monkeypatch.setattr(op2, "BLOCK_BYTES", 2000)
    assert rows(op2.contamination(small(spark), bench)) == whole
    assert {r.contaminated for r in op2.contamination(small(spark), bench.limit(0)).collect()} == {False}
    assert op2.contamination(table(spark, []), bench).count() == 0


def test_minhash_estimates():
    a = np.arange(1000, dtype=np.uint64)
    d = np.repeat([0, 1], 1000)
    sig = op3.minhashes(d, op3.ta.mix(np.concatenate([a, a + np.uint64(111)])))
    assert 0.65 < (sig[0] == sig[1]).mean() < 0.97
