"""Substring deduplication with fixed-block anchors.

Every document is a reference and a query. As a reference it is indexed by its
non-overlapping blocks of BLOCK words (words 0 to 24, 25 to 49, ...). As a
query it probes the index with every rolling window of BLOCK words. Since any
WINDOW = 2 * BLOCK consecutive words contain a whole block of the reference at
some offset, every repeat of WINDOW words or more has a hit. Hits are extended:
all windows of WINDOW words that hold a hit are compared by their 64-bit hashes
with all other such windows, and a window repeats when the same words start in
a document with a smaller id. Unions of such windows are the maximal repeats;
their words are removed. Windows are judged on the input.

Three passes over the documents, dealt to buckets once (see ``common``):
probes and blocks ask shards whether their hash occurs in a block and twice at
all; windows that hold a hit ask shards for the least document; the answers,
bits, go back and words are removed. A hash is sent once per bucket, and the
largest group a shard sees of one hash is one entry per bucket.

Edge cases: null texts and texts without words have no words (SHA-256 of the
empty string); documents below WINDOW words lose nothing; equal ids aren't
smaller than each other, so repeated rows lose nothing to each other; a null id
is neither smaller nor larger than any; other columns are ignored; no rows give
no rows.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import common
from aerocast.llm import textarrays as ta
from aerocast.llm.registry import query

BLOCK = 25
WINDOW = 2 * BLOCK
NO_ID = np.iinfo(np.int64).max
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


class Bucket:
    """The words of a bucket of documents, with the hashes of its windows."""

    def __init__(self, table: pa.Table):
        table = common.ordered(table)
        self.ids = table.column("doc_id")
        self.id = self.ids.fill_null(int(NO_ID)).to_numpy()
        self.buf, self.offsets = ta.unpack(table.column("z"))
        doc, block, block_ok, window, window_ok, aligned = [], [], [], [], [], []
        for lo, hi in ta.slices(self.offsets):
            base = self.offsets[lo]
            buf, rel = self.buf[base:self.offsets[hi]], self.offsets[lo:hi + 1] - base
            start, end, d = ta.word_spans(buf, rel)
            first = np.searchsorted(d, np.arange(hi - lo))
            seq = ta.Prefix(ta.word_codes(buf, start, end))
            doc.append(d + lo)
            aligned.append((np.arange(len(d)) - first[d]) % BLOCK == 0)
            for k, to, ok in ((BLOCK, block, block_ok), (WINDOW, window, window_ok)):
                h, inside = np.zeros(len(d), np.uint64), np.zeros(len(d), bool)
                r = seq.rolling(k)
                h[:len(r)] = r
                inside[:len(r)] = d[:len(r)] == d[k - 1:k - 1 + len(r)]
                to.append(h)
                ok.append(inside)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.doc, self.aligned = join(doc, np.int64), join(aligned, bool)
        self.block, self.block_ok = join(block, np.uint64), join(block_ok, bool)
        self.window, self.window_ok = join(window, np.uint64), join(window_ok, bool)

    def probes(self):
        """Sorted distinct block-length hashes, the position of each probe's among
        them, how often each occurs and whether one of them is a block."""
        distinct, inverse, count = np.unique(self.block[self.block_ok], return_inverse=True, return_counts=True)
        return distinct, inverse, count, np.bincount(inverse, self.aligned[self.block_ok], len(distinct)) > 0

    def extended(self, hit: np.ndarray):
        """Starts of the windows that hold a hit, their distinct hashes, each
        one's position among those and the least id of each hash in this bucket."""
        _, inverse, _, _ = self.probes()
        at = np.zeros(len(self.doc), np.int64)
        at[np.flatnonzero(self.block_ok)[hit[inverse]]] = 1
        sums = np.concatenate([[0], np.cumsum(at), np.full(WINDOW, at.sum())])
        n = len(self.doc)
        start = np.flatnonzero(self.window_ok & (sums[BLOCK + 1:BLOCK + 1 + n] > sums[:n]))
        distinct, first, inverse = np.unique(self.window[start], return_index=True, return_inverse=True)
        return start, distinct, inverse, self.id[self.doc[start[first]]]  # rows are in order of ids


def block_questions(n_shards: int):
    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        distinct, _, count, indexed = Bucket(table).probes()
        payload = ((distinct & np.uint64((1 << 30) - 1)) << np.uint64(2)) | (count > 1).astype(np.uint64) | (indexed.astype(np.uint64) << np.uint64(1))
        return common.ask(key[0].as_py(), distinct, payload.astype(np.uint32), n_shards)
    return ask


def block_answers(table: pa.Table) -> pa.Table:
    """A hash is a hit if it occurs in a block and at two places or more. The
    shards see 30 bits of a hash besides those that chose the shard; a false
    hit costs a comparison in the next pass, no more."""
    buf, offsets = ta.raw(table.column("q"))
    asked = buf.view(np.uint32)
    distinct, inverse, count = np.unique(asked >> np.uint32(2), return_inverse=True, return_counts=True)
    twice = (count + np.bincount(inverse, asked & np.uint32(1), len(distinct))) > 1
    indexed = np.bincount(inverse, asked & np.uint32(2), len(distinct)) > 0
    return common.reply(table, np.split((twice & indexed)[inverse], offsets[1:-1] // 4))


def window_questions(n_shards: int):
    def ask(key: tuple[pa.Scalar, ...], docs: pa.Table, told: pa.Table) -> pa.Table:
        b = Bucket(docs)
        _, distinct, _, least = b.extended(common.answers(told, b.probes()[0], n_shards))
        asked = common.ask(key[0].as_py(), distinct, distinct, n_shards)
        _, offsets = ta.raw(asked.column("q"))
        ids = ta.pack([least[a:z].tobytes() for a, z in zip(offsets[:-1] // 8, offsets[1:] // 8, strict=True)])
        return asked.append_column("ids", ids)
    return ask


def window_answers(table: pa.Table) -> pa.Table:
    """Whether the same words start in a document with an id below the asking bucket's least."""
    buf, offsets = ta.raw(table.column("q"))
    ids = ta.unpack(table.column("ids"))[0].view(np.int64)
    order = np.lexsort((ids, buf.view(np.uint64)))
    h = buf.view(np.uint64)[order]
    group = np.cumsum(np.diff(h, prepend=h[:1]) != 0)
    least = ids[order][np.searchsorted(group, group)]
    smaller = np.zeros(len(ids), bool)
    smaller[order] = least < ids[order]
    return common.reply(table, np.split(smaller, offsets[1:-1] // 8))


def removal(n_shards: int):
    def remove(key: tuple[pa.Scalar, ...], docs: pa.Table, told: pa.Table) -> pa.Table:
        b = Bucket(docs)
        step = told.column("step").to_numpy()
        hit = common.answers(told.filter(pa.array(step == 1)), b.probes()[0], n_shards)
        start, distinct, inverse, least = b.extended(hit)
        smaller = common.answers(told.filter(pa.array(step == 2)), distinct, n_shards)
        own = b.id[b.doc[start]]
        gone = start[(smaller[inverse] | (least[inverse] < own)) & (own != NO_ID)]
        depth = np.zeros(len(b.doc) + WINDOW + 1, np.int64)
        np.add.at(depth, gone, 1)
        np.add.at(depth, gone + WINDOW, -1)
        removed = np.cumsum(depth)[:len(b.doc)] > 0
        n_docs = len(b.ids)
        first = np.searchsorted(b.doc, np.arange(n_docs + 1))
        n_removed = np.bincount(b.doc, removed, n_docs).astype(np.int64)
        data, sha = b.buf.tobytes(), []
        for d in range(n_docs):
            words = data[b.offsets[d]:b.offsets[d + 1]].split()
            if n_removed[d]:
                words = compress(words, (~removed[first[d]:first[d + 1]]).tolist())
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        return pa.table({"doc_id": b.ids, "n_words": np.diff(first), "n_removed": n_removed, "kept_sha256": pa.array(sha, pa.string())})
    return remove


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``."""
    spark = docs.sparkSession
    n_shards = 4 * common.shuffle_width(spark)
    packed = common.packed_buckets(docs.withColumn("doc_id", F.col("doc_id").cast("long")), common.bucket_count(docs))
    by_bucket = lambda df: df.groupBy("bucket")
    hits = (by_bucket(packed).applyInArrow(block_questions(n_shards), common.ASK)
            .groupBy("shard").applyInArrow(block_answers, common.ANSWER))
    least = (by_bucket(packed).cogroup(by_bucket(hits)).applyInArrow(window_questions(n_shards), common.ASK + ", ids binary")
             .groupBy("shard").applyInArrow(window_answers, common.ANSWER))
    told = hits.withColumn("step", F.lit(1)).unionByName(least.withColumn("step", F.lit(2)))
    return by_bucket(packed).cogroup(by_bucket(told)).applyInArrow(removal(n_shards), RESULT)


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM w),
r AS (SELECT doc_id, pos, string_agg(word, ' ') OVER s AS run, count(*) OVER s AS n FROM p
      WINDOW s AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
f AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY run) AS first FROM r WHERE n = 50),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM f WHERE first < doc_id),
k AS (SELECT p.doc_id, count(*) AS n_words, count(g.pos) AS n_removed,
             sha256(coalesce(string_agg(word, ' ' ORDER BY p.pos) FILTER (g.pos IS NULL), '')) AS kept_sha256
      FROM p LEFT JOIN g ON p.doc_id = g.doc_id AND p.pos = g.pos GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""


@query("op9_substring_dedup", SQL)
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(common.documents(spark, sf_dir))
