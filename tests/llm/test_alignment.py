"""Operator 13 against brute force over byte ranges, with the libraries' own encoders."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from aerocast.llm import op13_alignment as op13
from conftest import SF_SMALL
from llm.fixtures import edge_pairs, odd_columns, small, table, with_ties

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def brute(pairs):
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    chars = op13.byte_level()
    links, rows = Counter(), []
    for i, text in pairs:
        want = (" " + (text or "")).encode()
        ta = [(x, bytes(chars[c] for c in tok.id_to_token(x))) for x in tok.encode(" " + (text or ""), add_special_tokens=False).ids]
        tb = [(x, bytes([int(p[3:5], 16)]) if sp.is_byte(x) else p.replace("▁", " ").encode()) for x in sp.encode(text or "") for p in [sp.id_to_piece(x)]]
        if not text or b"".join(s for _, s in ta) != want or b"".join(s for _, s in tb) != want:
            rows.append((i, 0, 0, [], ""))
            continue
        spans = []
        for side in (ta, tb):
            at, out = 0, []
            for x, s in side:
                out.append((x, at, at + len(s)))
                at += len(s)
            spans.append(out)
        own, j = [], 0
        for x, s, e in spans[0]:
            while j and spans[1][j - 1][2] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][1] < e:
                if spans[1][j][2] > s:
                    own.append((x, spans[1][j][0]))
                j += 1
        links.update(own)
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, lo = [], 0
        for hi in common:
            groups.append("|".join(",".join(str(x) for x, s, e in side if lo < e <= hi) for side in spans))
            lo = hi
        rows.append((i, len(ta), len(tb), own, ";".join(groups)))
    best = Counter()
    for (_, b), n in links.items():
        best[b] = max(best[b], n)
    return sorted(((i, a, b, g.count("|") and len(g.split(";")), len(own), sum(links[x] == best[x[1]] for x in own), sum(links[x] for x in own),
                    hashlib.sha256(g.encode()).hexdigest() if g else "") for i, a, b, own, g in rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = ["<|endoftext|> and <s> </s> <unk>", " lead", "  two", "tail  ", "a\n\nb\t", "日本語 テキスト", "▁x", "é ﬁ ½", "\U0001F600\U0001F601", "​", "　", "<0x41>", "'s 't's", "12345 67", "\0nul", " "]


@pytest.mark.parametrize("slice_bytes", [1 << 20, 500])
def test_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(op13, "SLICE_BYTES", slice_bytes)
    pairs = with_ties([(i, None if t is None else t[:4000]) for i, t in edge_pairs()]) + [(1000 + i, t) for i, t in enumerate(ODD)]
    docs = odd_columns(table(spark, pairs)).repartition(5)
    result = op13.alignments(docs, A, B)
    assert result.columns == [c.split()[0] for c in op13.RESULT.split(", ")]
    assert got(result) == brute(pairs)


def test_given_tables(spark):
    pairs = [(r.doc_id, r.text) for r in small(spark).select("doc_id", "text").collect()]
    rows = got(op13.op13_token_alignment(spark, SF_SMALL))
    assert rows == brute(pairs) and sum(r[4] for r in rows) > 10_000


def test_nothing(spark):
    assert op13.alignments(table(spark, []), A, B).collect() == []
    assert got(op13.alignments(table(spark, [(1, None), (None, "")]), A, B)) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def test_side_a_equals_its_library():
    import random
    side = op13.SideA(open(A, encoding="utf-8").read())
    assert side.fast is not None
    rng = random.Random(4)
    pick = lambda: chr(rng.choice([rng.randrange(1, 0x300), rng.randrange(1, 0x3100), rng.randrange(0x10000, 0x1FFFF), *b" \n\t's1", 0x85, 0xA0, 0x2028]))
    texts = ["".join(pick() for _ in range(40)) for _ in range(1500)]
    assert side.encode(texts) == [e.ids for e in side.tok.encode_batch(texts, add_special_tokens=False)]


def test_very_long_blanks_and_words(spark):
    pairs = [(1, " " * 300_000 + "a"), (2, "x" * 300_000), (3, "word " * 50_000)]
    side, tok = op13.SideA(open(A, encoding="utf-8").read()), Tokenizer.from_file(A)
    for _, t in pairs:
        assert side.encode([t])[0] == tok.encode(t, add_special_tokens=False).ids
    rows = got(op13.alignments(table(spark, pairs), A, B))
    assert [r[0] for r in rows] == [1, 2, 3] and all(r[1] and r[4] >= r[3] for r in rows if r[1])
