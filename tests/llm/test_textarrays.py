"""Hashes of words and windows: equal where the words are, and told apart on
words that collide under polynomials modulo a power of two."""

import numpy as np
import pytest

from aerocast.llm import op3_minhash as op3
from aerocast.llm import op9_substring_dedup as op9
from aerocast.llm import op10_bpe as op10
from aerocast.llm import textarrays as ta
from llm.fixtures import table


def thue_morse(n, a="a", b="b"):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


def codes(text):
    buf, offsets = ta.raw(__import__("pyarrow").array([text]))
    start, end, _ = ta.word_spans(buf, offsets)
    return ta.word_codes(buf, start, end)


@pytest.mark.parametrize("n", [1024, 4096])
def test_thue_morse_words_differ(n):
    c = codes(f"{thue_morse(n)} {thue_morse(n, 'b', 'a')} {thue_morse(n)}")
    assert c[0] == c[2] != c[1]


def test_equal_stretches_and_no_random_collisions():
    rng = np.random.default_rng(5)
    seq = rng.integers(0, 7, 5000).astype(np.uint64) * np.uint64(0x123456789ABCDEF)
    p = ta.Prefix(seq)
    a, k = rng.integers(0, 4000, 3000), rng.integers(1, 900, 3000)
    h = p.spans(a, a + k)
    byhash = {}
    for i, j, x in zip(a, k, h):
        byhash.setdefault(int(x), set()).add(seq[i:i + j].tobytes())
    assert all(len(v) == 1 for v in byhash.values())
    moved = ta.Prefix(np.concatenate([seq[100:200], seq]))
    assert moved.spans(np.array([0]), np.array([100]))[0] == p.spans(np.array([100]), np.array([200]))[0]
    assert (p.rolling(30)[:200] == ta.Prefix(seq[:400]).rolling(30)[:200]).all()
    assert len(p.rolling(6000)) == 0 == len(ta.Prefix(seq[:0]).rolling(1))


def test_sums_of_long_sequences_stay_exact():
    n = 300_000
    seq = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
    p = ta.Prefix(seq)
    f = ta.FIELDS[1]
    slow = 0
    for i in range(2000):
        slow = (slow + (0xFFFFFFFFFFFFFFFF >> 33) * pow(f.base, i, f.p)) % f.p
    assert int(p.c[1][2000]) % f.p == slow
    h = p.rolling(1000)
    assert (h == h[0]).all()


def test_operators_tell_such_words_apart(spark):
    t, u = thue_morse(1024), thue_morse(1024, "b", "a")
    got = {r.doc_id: r.n_removed for r in op9.remove_repeats(table(spark, [(1, " ".join([t] * 50)), (2, " ".join([u] * 50))])).collect()}
    assert got == {1: 0, 2: 0}
    near = op3.near_components(table(spark, [(1, t + " x y z w"), (2, u + " x y z w")]))
    assert {r.doc_id: r.component_id for r in near.collect()} == {1: 1, 2: 2}
    import public_tokenizers
    enc = op10.Encoder(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    buf, offsets = ta.raw(__import__("pyarrow").array([f"{t} {u}"]))
    assert enc.encode(buf, offsets)[0].tolist() == enc._raw([f"{t} {u}"])[0]
