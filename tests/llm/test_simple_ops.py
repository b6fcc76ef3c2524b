"""Operators 4, 6, 8 and 10 against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aerocast.llm import op4_sharding as op4
from aerocast.llm import op6_exact_dedup as op6
from aerocast.llm import op8_toxicity as op8
from aerocast.llm import op10_bpe as op10
from conftest import SF_SMALL
from llm.fixtures import edge_pairs, odd_columns, rows, small, table, with_ties


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_matches_reference_loop(spark):
    from pyspark.sql import functions as F
    ids = [0, 1, 2, 7, -1, -5, 2**40 + 3, 2**62, -2**63, 2**63 - 1, *range(1000, 1100)]
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    got = df.select("k", op4.jump_hash(F.col("k"), 24).alias("a"), op4.jump_hash(F.col("k"), 25).alias("b"),
                    op4.jump_hash(F.col("k"), 1).alias("c")).collect()
    assert all((r.a, r.b, r.c) == (jump(r.k, 24), jump(r.k, 25), 0) for r in got)


@pytest.mark.parametrize("ties", [False, True])
def test_shards(spark, ties):
    pairs = with_ties(edge_pairs()) if ties else edge_pairs()
    got = op4.shard_documents(odd_columns(table(spark, pairs))).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in pairs)
    slots = defaultdict(list)
    for r in got:
        assert (r.shard, r.grown_shard) == (jump(r.doc_id or 0, 24), jump(r.doc_id or 0, 25))
        assert r.law == "key" and r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert op4.shard_documents(table(spark, [])).count() == 0


def brute_groups(pairs):
    norm = [re.sub(rb"[\x20\x09-\x0D]+", b" ", (t or "").encode()) for _, t in pairs]
    ids, out, seen = defaultdict(list), [], set()
    for (i, _), n in zip(pairs, norm):
        ids[n].append(i)
    for (i, _), n in zip(pairs, norm):
        keep = min((x for x in ids[n] if x is not None), default=None)
        kept = i == keep and (n, i) not in seen
        seen.add((n, i))
        out.append((i, keep, len(ids[n]), kept, sha(n)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ties", [False, True])
def test_exact_dedup(spark, ties):
    pairs = with_ties(edge_pairs()) if ties else edge_pairs()
    assert rows(op6.exact_groups(odd_columns(table(spark, pairs)))) == brute_groups(pairs)


def test_exact_dedup_empty_and_null_only(spark):
    assert op6.exact_groups(table(spark, [])).count() == 0
    got = op6.exact_groups(table(spark, [(None, None), (None, "")])).collect()
    assert sorted(r.kept for r in got) == [False, True] and {r.group_size for r in got} == {2}


def test_colliding_fingerprints_are_divided(spark, monkeypatch):
    pairs = [(i, f"text {i % 3} " * 9) for i in range(12)]
    texts = op6.fingerprints(table(spark, pairs)).selectExpr("doc_id", "0L fp", "n", "text_sha256", "norm")
    monkeypatch.setattr(op6, "fingerprints", lambda docs: texts)
    assert rows(op6.exact_groups(None)) == brute_groups(pairs)


def test_fingerprints_compose():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3 * op6.CHUNK + 77, dtype=np.uint8).tobytes()
    whole = op6.fingerprint(data)
    for cut in (1, op6.CHUNK - 1, op6.CHUNK, 2 * op6.CHUNK + 5):
        a, b = (op6.fingerprint(x) for x in (data[:cut], data[cut:]))
        split = lambda h: (h >> 31, h & (2**31 - 1))
        assert split(whole) == op6.combine(split(a), split(b), len(data) - cut)
    assert op6.fingerprint(b"") != op6.fingerprint(b"\0") != op6.fingerprint(b"\0\0")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def brute_bpe(tok, pairs):
    out = []
    for i, t in pairs:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        out.append((i, len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=repr)


def test_bpe_edges(spark, tok):
    odd = ["ΣΑΣ ΣΑΣ " * 200, "é ́x " * 200, "İstanbul x y " * 100, "<|endoftext|> <|startoftext|>a " * 80,
           "don't we'll I'D " * 100, "x" * 5000, "1234 !!! ?? " * 90, "🙂👍🏽 " * 90]
    pairs = with_ties(edge_pairs()) + [(1000 + i, t) for i, t in enumerate(odd)]
    assert rows(op10.encode_documents(odd_columns(table(spark, pairs)), public_tokenizers.path("word_bpe_49k.json"))) == brute_bpe(tok, pairs)
    assert op10.encode_documents(table(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_bpe_table(spark, tok):
    pairs = [(r.doc_id, r.text) for r in small(spark).collect()]
    assert rows(op10.op10_bpe(spark, SF_SMALL)) == brute_bpe(tok, pairs)


def test_bpe_reuses_and_repairs(tok):
    spec = tok.to_str()
    text = " ".join(f"word{i % 97} it's" for i in range(900)).encode()
    enc = op10.Encoder(spec, chunk_words=8)
    buf = np.frombuffer(text * 3, np.uint8)
    off = np.array([0, len(text), 2 * len(text), 3 * len(text)])
    for _ in range(2):
        got = enc.encode(buf, off)
    want = tok.encode(text.decode(), add_special_tokens=False).ids
    assert all(g.tolist() == want for g in got) and enc.reused > 5 * enc.encoded
    enc._agree = lambda *a: False  # every join disagrees: still exact
    assert [g.tolist() for g in enc.encode(buf, off)] == [want] * 3 and enc.repaired


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score)); rank[order] = np.arange(1, len(score) + 1)
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in op8.op8_toxicity(spark, d).collect()}
    lab = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    ids = [i for i in lab if got[i].held_out]
    s, y = np.array([got[i].score for i in ids]), np.array([lab[i] for i in ids])
    p = s >= 0.5
    print("auc", auc(s, y), "precision", y[p].mean(), "recall", p[y == 1].mean())
    assert auc(s, y) > 0.9 and y[p].mean() > 0.9 and p[y == 1].mean() > 0.75


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(None, 1), (1, None), (6, 1), (6, 0), (7, 0)], "doc_id long, toxic int")
    docs = odd_columns(table(spark, with_ties(edge_pairs())))
    score = op8.scorer(spark, op8.train(docs, labels))
    got = docs.select("doc_id", score("text").alias("s")).collect()
    assert len(got) == docs.count() and all(0 <= r.s <= 1 for r in got)
    empty = op8.train(table(spark, []), labels)
    assert len(empty["index"]) == 0
    assert {r.s < 0.5 for r in docs.select(op8.scorer(spark, empty)("text").alias("s")).collect()} == {True}
