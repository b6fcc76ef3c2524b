"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and
skip-grams.

A document's features are the distinct hashes (BUCKET_BITS bits) of its words,
of pairs of neighbouring words and of pairs with one word between them; words
are runs of letters and digits, lower-cased, so that attached marks don't hide
one. Training passes over a bounded sample of the labelled rows, TRAIN_ROWS of
them at most, chosen by the hash of the id: this is the documented bound on
what the fit sees, the same at every size. Per-coordinate rates follow from
each coordinate's sum of squared gradients, and L1 leaves few weights, which
are sent to the executors (at most 2**BUCKET_BITS of them). All rows are scored
where they are read.

Edge cases: null and empty texts have no features and get the bias's score;
labels that are null, or ids that are null or unlabelled, train nothing;
repeated label rows of an id count once (its largest label); a table without
usable labels gives every document 0.5 less a hair, predicted 0; no rows give
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import textarrays as ta
from aerocast.llm.common import documents
from aerocast.llm.registry import query

BUCKET_BITS = 20
TRAIN_ROWS = 16_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.0
FOLDS = 5

NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: crc32 of the id as text divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hashed feature), distinct and in order of documents."""
    low = LOWER[buf]
    start, end, doc = ta.word_spans(low, offsets, NOT_WORD)
    h = ta.word_codes(low, start, end)
    found = [(doc, h)]
    for gap, salt in ((1, 0x51ED270B), (2, 0xC2B2AE35)):
        if len(h) > gap:
            inside = doc[gap:] == doc[:-gap]
            found.append((doc[gap:][inside], ta.mix(h[:-gap][inside] * np.uint64(ta.R) + h[gap:][inside] + np.uint64(salt))))
    docs = np.concatenate([d for d, _ in found]).astype(np.int64)
    slot = (np.concatenate([x for _, x in found]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    both = np.unique((docs << BUCKET_BITS) | slot)
    return both >> BUCKET_BITS, both & ((1 << BUCKET_BITS) - 1)


class Ftrl:
    """FTRL-proximal with logistic loss; a row is its set of present features."""

    def __init__(self):
        self.z = np.zeros((1 << BUCKET_BITS) + 1)
        self.n = np.zeros((1 << BUCKET_BITS) + 1)

    def weights(self, i: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, present: np.ndarray, label: float) -> None:
        i = np.append(present, 1 << BUCKET_BITS)  # the last is the bias
        w = self.weights(i)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[i] = n + g * g


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """Nonzero weights {"index", "weight", "bias"} learned from a bounded sample."""
    sample = (labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))

    def hashed(batches):
        for b in batches:
            buf, offsets = ta.raw(b.column(1))
            for lo, hi in ta.slices(offsets):
                doc, slot = features(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                cuts = np.searchsorted(doc, np.arange(hi - lo + 1)) * 4
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), ta.binary_array(slot.astype(np.int32), cuts)],
                    names=["doc_id", "toxic", "f"])

    def fit(table: pa.Table) -> pa.Table:
        model = Ftrl()
        ids, ys = table.column("doc_id").to_numpy(), table.column("toxic").to_numpy()
        sets = [np.frombuffer(f, np.int32) for f in table.column("f").to_pylist()]
        key = ta.mix(ids.astype(np.int64).view(np.uint64))
        for epoch in range(EPOCHS):
            for r in np.lexsort((ids, ta.mix(key + np.uint64(epoch)))):
                model.learn(sets[r], float(ys[r]))
        w = model.weights(slice(None))
        keep = np.flatnonzero(w[:-1])
        return pa.table({"index": pa.array([keep.astype(np.int32).tobytes()], pa.binary()),
                         "weight": pa.array([w[keep].tobytes()], pa.binary()), "bias": pa.array([w[-1]])})

    # the sample is at most TRAIN_ROWS ids, so it may be broadcast and fitted in one task
    rows_of_sample = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").join(F.broadcast(sample), "doc_id")
    got = (rows_of_sample.select("doc_id", "text", "toxic").mapInArrow(hashed, "doc_id bigint, toxic int, f binary")
           .groupBy(F.lit(0).alias("all")).applyInArrow(fit, "index binary, weight binary, bias double").collect())
    if not got:
        return {"index": np.zeros(0, np.int32), "weight": np.zeros(0), "bias": -1e-6}
    return {"index": np.frombuffer(bytes(got[0]["index"]), np.int32), "weight": np.frombuffer(bytes(got[0]["weight"])), "bias": got[0]["bias"]}


def scorer(spark: SparkSession, model: dict):
    """A column function: text -> score between 0 and 1."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        m = sent.value
        table = np.zeros(1 << BUCKET_BITS)
        table[m["index"]] = m["weight"]
        buf, offsets = ta.raw(text)
        out = np.full(len(offsets) - 1, m["bias"])
        for lo, hi in ta.slices(offsets):
            doc, slot = features(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            out[lo:hi] += np.bincount(doc, table[slot], hi - lo)
        return pa.array(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return score


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("cast(doc_id as bigint) doc_id", "toxic")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    score = scorer(spark, train(docs, labels_of(spark, sf_dir)))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
