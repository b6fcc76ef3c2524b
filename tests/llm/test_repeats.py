"""Operators 1 and 9 against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from aerocast.llm import common
from aerocast.llm import op1_suffix_array as op1
from aerocast.llm import op9_substring_dedup as op9
from conftest import SF_SMALL
from llm.fixtures import edge_pairs, odd_columns, rows, small, table, with_ties

sha = lambda b: hashlib.sha256(b).hexdigest()


def brute_bytes(pairs, k=200):
    texts = [(t or "").encode() for _, t in pairs]
    seen = Counter(t[i:i + k] for t in texts for i in range(len(t) - k + 1))
    out = []
    for (d, _), t in zip(pairs, texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - k + 1):
            if seen[t[i:i + k]] > 1:
                gone[i:i + k] = True
        spans = int((gone & ~np.append([False], gone[:-1])).sum()) if len(t) else 0
        out.append((d, len(t), int(gone.sum()), spans, sha(np.frombuffer(t, np.uint8)[~gone].tobytes())))
    return sorted(out, key=repr)


def brute_words(pairs, k=50):
    texts = [(t or "").encode().split() for _, t in pairs]
    least = {}
    for (d, _), w in zip(pairs, texts):
        for i in range(len(w) - k + 1) if d is not None else ():
            key = b" ".join(w[i:i + k])
            least[key] = min(d, least.get(key, d))
    out = []
    for (d, _), w in zip(pairs, texts):
        gone = [False] * len(w)
        for i in range(len(w) - k + 1) if d is not None else ():
            if least[b" ".join(w[i:i + k])] < d:
                gone[i:i + k] = [True] * k
        out.append((d, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=repr)


@pytest.fixture(params=[8 << 20, 20_000], ids=["one bucket", "many buckets"])
def buckets(request, monkeypatch):
    monkeypatch.setattr(common, "BUCKET_BYTES", request.param)


def overlaps(seed=7, n=60, alphabet="abcd ", drop=False):
    """Texts cut from one string at random places, so repeats of every length overlap."""
    rng = random.Random(seed)
    source = "".join(rng.choice(alphabet) for _ in range(4000))
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(len(source))
            parts.append(source[a:a + rng.randrange(20, 700)])
            parts.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 9))))
        out.append((i * 3, "".join(parts)))
    return out


@pytest.mark.parametrize("ties", [False, True])
def test_bytes_edges(spark, buckets, ties):
    pairs = with_ties(edge_pairs()) if ties else edge_pairs()
    assert rows(op1.remove_repeats(odd_columns(table(spark, pairs)))) == brute_bytes(pairs)


@pytest.mark.parametrize("hot_above", [op1.HOT, 2, 0])
def test_bytes_overlaps(spark, buckets, monkeypatch, hot_above):
    monkeypatch.setattr(op1, "CHUNK_ROWS", 50)
    pairs = overlaps() + overlaps(8, 20, "ab") + [(1000 + i, t) for i, t in overlaps(9, 20, "é日x")]
    assert rows(op1.remove_repeats(table(spark, pairs), hot_above)) == brute_bytes(pairs)


def frequent_line(n=40, seed=11):
    """A short line in every text, between words of its own; a few texts share more."""
    rng = random.Random(seed)
    own = lambda: " ".join(str(rng.randrange(10**6)) for _ in range(60))
    line = "All rights reserved; this line is in a great many of the documents, whatever they say otherwise, and it is shorter than the strings that count as repeats but long enough.\n"
    out = [f"{own()}\n{line}{own()}" for _ in range(n)]
    return list(enumerate(out + [out[0][200:], out[1][:700] + own()]))


def test_hot_counts_runs_not_buckets():
    texts = [t.encode() for _, t in frequent_line()]
    docs = op1.pa.table({"doc_id": op1.pa.array(range(len(texts)), op1.pa.int64()), "z": op1.ta.pack(texts)})
    key = (op1.pa.scalar(0),)
    asked = op1.gram_questions(1)(key, docs)
    for limit, most in ((10, 10), (10**6, 10**6)):
        told = op1.gram_answers(limit)(asked)
        sent = op1.suffix_rows(1, np.zeros(0, np.int64))(key, docs, told).to_pylist()
        assert max(Counter(r["k3"] for r in sent if r["before"] >= 0).values()) <= most
        assert any(r["before"] < 0 for r in sent) == (limit == 10)


def test_leading_bytes_tie_across_anchors():
    same = b"the same sixteen"
    def rows_of(anchors):
        data = [same + bytes([97 + a]) * 184 for a in anchors]
        return op1.pa.table({"k1": [1] * len(data), "k2": [2] * len(data), "k3": anchors, "bucket": op1.pa.array([0] * len(data), op1.pa.int32()),
                             "rep": op1.pa.array(range(len(data)), op1.pa.int32()), "before": op1.pa.array([0] * len(data), op1.pa.int32()),
                             "many": [False] * len(data), "content": op1.pa.array(data, op1.pa.binary())})
    t = rows_of([0] * 9000 + [1] * 9000 + [2])
    out = list(op1.compared(t.to_batches(max_chunksize=5000)))
    assert len(out) > 1  # anchors that tie in their leading bytes are compared apart
    assert sorted(i for b in out for r in b.column(2).to_pylist() for i in np.frombuffer(r, np.int32)) == list(range(18000))


def test_frequent_line(spark, buckets):
    for limit in (10, op1.HOT):
        assert rows(op1.remove_repeats(table(spark, frequent_line()), limit)) == brute_bytes(frequent_line())


def test_bytes_table(spark, buckets):
    pairs = [(r.doc_id, r.text) for r in small(spark).collect()]
    want = brute_bytes(pairs)
    assert any(r[2] for r in want)
    assert rows(op1.op1_suffix_array_dedup(spark, SF_SMALL)) == want


def test_words_table(spark, buckets):
    pairs = [(r.doc_id, r.text) for r in small(spark).collect()]
    want = brute_words(pairs)
    assert any(r[2] for r in want)
    assert rows(op9.op9_substring_dedup(spark, SF_SMALL)) == want


@pytest.mark.parametrize("ties", [False, True])
def test_words_edges(spark, buckets, ties):
    pairs = with_ties(edge_pairs()) if ties else edge_pairs()
    assert rows(op9.remove_repeats(odd_columns(table(spark, pairs)))) == brute_words(pairs)


def test_words_overlaps(spark, buckets):
    rng = random.Random(3)
    source = [f"w{rng.randrange(30)}" for _ in range(1500)]
    pairs = []
    for i in range(70):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(len(source))
            parts += source[a:a + rng.randrange(20, 160)] + [f"x{rng.randrange(99)}"]
        pairs.append((rng.randrange(-500, 500), " ".join(parts)))
    assert rows(op9.remove_repeats(table(spark, pairs))) == brute_words(pairs)


def test_nothing(spark):
    for op in (op1, op9):
        assert op.remove_repeats(table(spark, [])).count() == 0
        assert all(r[2] == 0 for r in rows(op.remove_repeats(table(spark, [(1, None), (2, ""), (None, "x")]))))


def test_multikey_sort_orders_bytes():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, (500, 24), dtype=np.uint8)
    group = rng.integers(0, 3, 500)
    order = op1.multikey_sort(group, data.view(">u8"))
    got = [(group[i], data[i].tobytes()) for i in order]
    assert got == sorted(got)
    lcp = op1.common_prefix(group, data, order)
    for at in range(1, 500):
        a, b = got[at - 1], got[at]
        same = next((k for k in range(24) if a[1][k] != b[1][k]), 24)
        assert lcp[at] == (same if a[0] == b[0] else -1)
