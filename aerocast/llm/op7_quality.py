"""Quality classifier: an interpolated modified Kneser-Ney n-gram model.

Tokens are characters (white space is one blank, digits are one digit), which
judges all languages alike and shows marks, capitals and repeated junk. The
model of ORDER characters is trained on trusted text: all documents labelled
quality 1. Counts, continuation counts, discounts and back-off weights of every
order come from joins and aggregates over tables sharded by n-gram; each
distinct n-gram of the corpus gets its probability by joins of its own count,
its context's totals and the next lower order's probability. A document's
perplexity is exp of the mean negative log probability of its characters. It is
kept if that is at most the KEEP_SHARE quantile of the trusted documents of its
language (of all trusted ones for languages without trusted documents).

N-grams are counted inside buckets of documents before they are shuffled, and
the buckets meet the probabilities of their own n-grams again. A training
document is scored by the model it helped to train; one document's share of a
count that reaches over the whole trusted text is small.

Edge cases: null, empty and blank texts have no tokens, null perplexity and are
not kept; a null language is a language of its own; without trusted text all
characters are equally likely and, there being no threshold, every text with
tokens is kept; null ids are never trusted; repeated rows are scored each;
other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import common
from aerocast.llm import textarrays as ta
from aerocast.llm.registry import query

ORDER = 4
KEEP_SHARE = 0.99
BUCKET_BYTES = 32 << 20
PAD, OTHER = 1, 0xFFFF
FOLD = np.array([32 if chr(c).isspace() or c < 32 else 48 if chr(c).isdigit() else c for c in range(0x10000)], np.uint16)


def grams(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document index, n-gram) of every character of a slice; four characters
    of 16 bits make a number, ORDER - 1 pads stand before each document."""
    cp = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[offsets]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(starts))
    c = FOLD[np.minimum(cp, OTHER)]
    blank = c == 32
    first = np.ones(len(c), bool)
    first[1:] = doc[1:] != doc[:-1]
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1] & ~first[1:]  # one blank for a run, none at the start
    c, doc = c[keep], doc[keep]
    last = np.ones(len(c), bool)
    last[:-1] = doc[1:] != doc[:-1]
    keep = ~(last & (c == 32))  # none at the end
    c, doc = c[keep], doc[keep]
    out = np.full(len(c) + (ORDER - 1) * (len(offsets) - 1), PAD, np.uint64)
    at = np.arange(len(c)) + (ORDER - 1) * (doc + 1)
    out[at] = c
    code = np.zeros(len(c), np.uint64)
    for k in range(ORDER):
        code |= out[at - k] << np.uint64(16 * k)
    return doc, code


def counted(key: tuple[pa.Scalar, ...], docs: pa.Table, trusted: pa.Table) -> pa.Table:
    """Distinct n-grams of a bucket with their counts in trusted documents."""
    ids = docs.column("doc_id").fill_null(0).to_numpy()
    good = np.isin(ids, trusted.column("doc_id").to_numpy()) & ~docs.column("doc_id").is_null().to_numpy()
    buf, offsets = ta.unpack(docs.column("z"))
    codes, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for lo, hi in ta.slices(offsets):
        doc, code = grams(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        new, inverse = np.unique(code, return_inverse=True)
        n = np.bincount(inverse, good[lo:hi][doc], len(new)).astype(np.int64)
        both, inverse = np.unique(np.concatenate([codes, new]), return_inverse=True)
        codes, times = both, np.bincount(inverse, np.concatenate([times, n]), len(both)).astype(np.int64)
    return pa.table({"bucket": np.full(len(codes), key[0].as_py(), np.int32), "gram": codes.view(np.int64), "c": times})


def scored(key: tuple[pa.Scalar, ...], docs: pa.Table, known: pa.Table) -> pa.Table:
    """Tokens and negative log likelihood of each document of a bucket."""
    gram, lp = known.column("gram").to_numpy().view(np.uint64), known.column("lp").to_numpy()
    order = np.argsort(gram)
    gram, lp = gram[order], lp[order]
    buf, offsets = ta.unpack(docs.column("z"))
    n, nll = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1)
    for lo, hi in ta.slices(offsets):
        doc, code = grams(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        distinct, inverse = np.unique(code, return_inverse=True)
        n[lo:hi] = np.bincount(doc, minlength=hi - lo)
        nll[lo:hi] = np.bincount(doc, -lp[np.searchsorted(gram, distinct)][inverse], hi - lo)
    return pa.table({"doc_id": docs.column("doc_id"), "lang": docs.column("lang"), "n_tokens": n, "nll": nll})


def below(gram: Column, order: int) -> Column:
    """The n-gram without its first character."""
    return gram.bitwiseAND((1 << 16 * (order - 1)) - 1)


def context(gram: Column) -> Column:
    """The n-gram without its last character."""
    return F.shiftrightunsigned(gram, 16)


def discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ of one order by Chen and Goodman's estimates, from four sums."""
    n = counts.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n = [0, *n]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.0
    return [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.0), float(k)) if n[k] else min(y, 1.0) for k in (1, 2, 3)]


def probabilities(grams_of_corpus: DataFrame) -> DataFrame:
    """(gram, lp) for each distinct n-gram; ``c`` is its count in trusted text."""
    wanted = [grams_of_corpus.select("gram")]
    counts = [grams_of_corpus.filter("c > 0").select("gram", "c")]
    for order in range(ORDER, 1, -1):
        wanted.append(wanted[-1].select(below(F.col("gram"), order).alias("gram")).distinct())
        counts.append(common.written(counts[-1].groupBy(below(F.col("gram"), order).alias("gram")).agg(F.count("*").alias("c")), "counts"))
    wanted, counts = wanted[::-1], counts[::-1]
    vocabulary = counts[0].count() + 1
    known = None
    for order in range(1, ORDER + 1):
        d1, d2, d3 = discounts(counts[order - 1])
        c = F.col("c")
        taken = F.when(c == 1, d1).when(c == 2, d2).when(c > 2, d3).otherwise(0.0)
        totals = counts[order - 1].groupBy(context(F.col("gram")).alias("ctx")).agg(F.sum("c").alias("total"), F.sum(taken).alias("spare"))
        table = (wanted[order - 1].join(counts[order - 1], "gram", "left").withColumn("ctx", context(F.col("gram")))
                 .join(totals, "ctx", "left"))
        if known is None:
            table = table.withColumn("lower", F.lit(1.0 / vocabulary))
        else:
            table = table.withColumn("tail", below(F.col("gram"), order)).join(known.select(F.col("gram").alias("tail"), F.col("p").alias("lower")), "tail")
        seen = (F.greatest(F.coalesce(c, F.lit(0)) - taken, F.lit(0.0)) + F.col("spare") * F.col("lower")) / F.col("total")
        known = common.written(table.select("gram", F.coalesce(seen, F.col("lower")).alias("p")), f"order{order}")
    return known.select("gram", F.log("p").alias("lp"))


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, lang, n_tokens and perplexity of every row of ``docs`` under the
    model of the documents whose ids are in ``trusted``."""
    n_buckets = common.bucket_count(docs, BUCKET_BYTES)
    packed = common.packed_buckets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")), n_buckets, ("lang",))
    marked = trusted.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("bucket", common.bucket_of(n_buckets))
    by_bucket = lambda df: df.groupBy("bucket")
    # marks in buckets without documents concern no row
    in_buckets = common.written(by_bucket(packed).cogroup(by_bucket(marked)).applyInArrow(counted, "bucket int, gram bigint, c bigint"), "grams")
    corpus = common.written(in_buckets.groupBy("gram").agg(F.sum("c").alias("c")), "corpus")
    known = in_buckets.select("bucket", "gram").join(probabilities(corpus), "gram")
    return (by_bucket(packed).cogroup(by_bucket(known)).applyInArrow(scored, "doc_id bigint, lang string, n_tokens bigint, nll double")
            .select("doc_id", "lang", "n_tokens", F.when(F.col("n_tokens") > 0, F.exp(F.col("nll") / F.col("n_tokens"))).alias("perplexity")))


def judged(docs: DataFrame, trusted: DataFrame, share: float = KEEP_SHARE) -> DataFrame:
    """doc_id, lang, n_tokens, perplexity, threshold and kept of every row of ``docs``."""
    found = common.written(perplexities(docs, trusted), "perplexity")
    good = found.join(trusted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi").filter("perplexity is not null")
    per_lang = good.groupBy("lang").agg(F.percentile_approx("perplexity", share, 10_000).alias("own"))
    overall = good.agg(F.percentile_approx("perplexity", share, 10_000).alias("q")).first()["q"]
    limit = F.coalesce("own", F.lit(overall).cast("double"))
    per_lang = per_lang.select(F.coalesce("lang", F.lit("")).alias("l"), F.isnull("lang").alias("none"), "own")
    return (found.withColumns({"l": F.coalesce("lang", F.lit("")), "none": F.isnull("lang")}).join(per_lang, ["l", "none"], "left")
            .select("doc_id", "lang", "n_tokens", "perplexity", limit.alias("threshold"),
                    (F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= limit, F.lit(True))).alias("kept")))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")


@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(common.documents(spark, sf_dir), trusted_ids(spark, sf_dir))
