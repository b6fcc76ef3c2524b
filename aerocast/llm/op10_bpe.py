"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over words cuts every text at places that depend only on the
words around them, so passages shared by documents give equal chunks wherever
they stand. A chunk is encoded once in a task and its ids are reused (a bounded
cache of digests). A new chunk is put together from its words, which no token of
this kind of vocabulary crosses: the ids of recent words are kept too, and the
library encodes those that are new. Each join of two chunks is then checked: the words on both
sides are encoded together, and the result must be the tail of the left ids
followed by the head of the right ids. Where it isn't, the two chunks become
one, are encoded anew, and the next join is checked, until all joins agree.

No shuffle: texts stay in the partition that read them. Memory is bounded by a
slice of texts (``textarrays.SLICE_BYTES``, or one longer document) and the cache.

Edge cases: null and empty texts and texts of white space only have no ids and
decode to the empty string; repeated rows and null ids give a row each; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from array import array

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aerocast.llm import textarrays as ta
from aerocast.llm.common import documents
from aerocast.llm.registry import query

CHUNK_WORDS = 64       # mean words of a chunk
CUT_WORDS = 3          # words that the rolling hash of a cut looks at
CACHE_CHUNKS = 60_000
CACHE_WORDS = 800_000
SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

_loaded: dict[str, object] = {}


def load(spec: str):
    """The tokenizer of a JSON description, once per worker, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _loaded:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(spec)
        tok.no_truncation()
        tok.no_padding()
        _loaded[key] = tok
    return _loaded[key]


def cuts_after(codes: np.ndarray, doc: np.ndarray, chunk_words: int) -> np.ndarray:
    """Numbers of the words after which a chunk ends, documents' ends aside."""
    if len(codes) <= CUT_WORDS:
        return np.zeros(0, np.int64)
    seen = ta.Prefix(codes).rolling(CUT_WORDS)
    i = np.flatnonzero(seen % np.uint64(chunk_words) == 0) + CUT_WORDS - 1
    i = i[i + 1 < len(doc)]
    return i[(doc[i] == doc[i - CUT_WORDS + 1]) & (doc[i] == doc[i + 1])]


class Recent(dict):
    """A dict that forgets: above half its size it becomes the old half, whose
    entries live on only if they are asked for before the next change."""

    def __init__(self, most: int):
        super().__init__()
        self.half, self.old = most // 2, {}

    def lacking(self, keys: set) -> list:
        """The keys that aren't known; those that are can be looked up until ``trim``."""
        again = (keys - self.keys()) & self.old.keys()
        self.update((k, self.old[k]) for k in again)
        return list(keys - self.keys())

    def trim(self) -> None:
        if len(self) > self.half:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Encodes documents by chunks; keeps the ids of recent chunks and words."""

    def __init__(self, spec: str, chunk_words: int = CHUNK_WORDS, cache_chunks: int = CACHE_CHUNKS, cache_words: int = CACHE_WORDS):
        self.tok, self.chunk_words = load(spec), chunk_words
        self.chunks, self.words = Recent(cache_chunks), Recent(cache_words)
        self.encoded = self.reused = self.repaired = 0

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_words(self, data: bytes, start: np.ndarray, end: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the words in a row and the n + 1 offsets into them."""
        _, first, inverse = np.unique(codes, return_index=True, return_inverse=True)
        words = [data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        unknown = self.words.lacking(set(words))
        fresh = self._raw([w.decode() for w in unknown])
        self.words.update(zip(unknown, [array("I", x).tobytes() for x in fresh], strict=True))
        found = [self.words[w] for w in words]
        self.words.trim()
        pool = np.frombuffer(b"".join(found), np.uint32)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(size) - size
        offsets = np.concatenate([[0], np.cumsum(size[inverse])])
        return pool[np.repeat(begin[inverse] - offsets[:-1], size[inverse]) + np.arange(offsets[-1])], offsets

    def _of_chunks(self, data: bytes, bounds: np.ndarray, start: np.ndarray, end: np.ndarray, codes: np.ndarray) -> list[np.ndarray]:
        """Ids of the chunks between ``bounds``; a chunk not seen lately is encoded once."""
        keys = [hashlib.md5(data[a:b]).digest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        number = dict(zip(reversed(keys), range(len(keys) - 1, -1, -1), strict=True))  # first place of each
        new = np.sort(np.array([number[k] for k in self.chunks.lacking(set(keys))], np.int64))
        self.encoded += len(new)
        self.reused += len(keys) - len(new)
        chunk = np.searchsorted(bounds, start, side="right") - 1
        wanted = np.zeros(len(keys), bool)
        wanted[new] = True
        at = np.flatnonzero(wanted[chunk])
        ids, offsets = self._of_words(data, start[at], end[at], codes[at])
        cuts = offsets[np.searchsorted(chunk[at], np.append(new, len(keys)))]
        self.chunks.update((keys[n], ids[a:b].copy()) for n, a, b in zip(new.tolist(), cuts[:-1], cuts[1:], strict=True))
        out = [self.chunks[k] for k in keys]
        self.chunks.trim()
        return out

    @staticmethod
    def _agree(joint: list[int], left: np.ndarray, right: np.ndarray) -> bool:
        for k in range(len(joint) + 1):
            a, b = joint[:k], joint[k:]
            if len(a) <= len(left) and len(b) <= len(right) and (bool(a) or not len(left)) and (bool(b) or not len(right)) \
                    and left[len(left) - len(a):].tolist() == a and right[:len(b)].tolist() == b:
                return True
        return False

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each document of a slice."""
        data = buf.tobytes()
        start, end, doc = ta.word_spans(buf, offsets)
        codes = ta.word_codes(buf, start, end)
        i = cuts_after(codes, doc, self.chunk_words)
        cuts = end[i]
        bounds = np.unique(np.concatenate([offsets, cuts]))
        chunks = self._of_chunks(data, bounds, start, end, codes)
        joints = self._raw([data[a:b].decode() for a, b in zip(start[i].tolist(), end[i + 1].tolist(), strict=True)])
        at = dict(zip(cuts.tolist(), joints, strict=True))
        first = np.searchsorted(bounds, offsets)
        out = []
        for d in range(len(offsets) - 1):
            if offsets[d] == offsets[d + 1]:
                out.append(np.zeros(0, np.uint32))
                continue
            parts = [chunks[first[d]]]
            begin = int(bounds[first[d]])
            for c in range(first[d] + 1, first[d + 1]):
                if self._agree(at[int(bounds[c])], parts[-1], chunks[c]):
                    begin = int(bounds[c])
                    parts.append(chunks[c])
                else:  # the chunk before and this one become one
                    self.repaired += 1
                    parts[-1] = np.array(self._raw([data[begin:int(bounds[c + 1])].decode()])[0], np.uint32)
            out.append(np.concatenate(parts))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tok.decode_batch(ids, skip_special_tokens=False)


def encode_documents(docs: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text of each document;
    ``with_ids`` adds ``ids array<int>`` and ``decoded string``.

    The tokenizer's file (a fixed vocabulary of a few MB) is read by the driver
    and sent to the executors."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def run(batches):
        enc = Encoder(spec.value)
        names = [str(i) for i in range(enc.tok.get_vocab_size())]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            buf, offsets = ta.raw(b.column(1))
            for lo, hi in ta.slices(offsets):
                ids = [x.tolist() for x in enc.encode(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])]
                texts = enc.decode(ids)
                cols = [b.column(0).slice(lo, hi - lo), pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([sha(" ".join([names[i] for i in x])) for x in ids]),
                        pa.array([sha(t) for t in texts])]
                if with_ids:
                    cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][:len(cols)])

    schema = SCHEMA + (", ids array<int>, decoded string" if with_ids else "")
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, schema)


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
