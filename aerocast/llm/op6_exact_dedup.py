"""Exact deduplication by composable polynomial fingerprints.

A text, each run of white space replaced by one space, is cut into chunks. Each
chunk has two polynomial hashes modulo primes near 2^31; the document's hash
follows from its chunks alone, ``H(ab) = H(a) * r**len(b) + H(b)``, so chunks of
a huge document can be hashed apart and combined. Documents with equal
fingerprint and length are candidates. Candidates are then compared: their
texts are dealt chunk by chunk and every chunk of a group must be the same in
all its members (least = greatest chunk, an aggregate that combines before the
shuffle, so a group of any size sends one row per chunk and task). A group
that fails is divided by the texts' SHA-256.

Edge cases: null counts as the empty text; a null doc_id is never the id that
stays unless its group has no other; of repeated rows (same id, same text)
exactly one is kept; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerocast.llm import textarrays as ta
from aerocast.llm.common import documents
from aerocast.llm.registry import query

CHUNK = 1 << 16
MODULI = ((2147483647, 1103515245), (2147483629, 742938285))  # prime, base
BLANKS = re.compile(rb"[\x20\x09-\x0D]+")


def _power_table(p: int, r: int) -> np.ndarray:
    out = np.ones(CHUNK + 1, np.uint64)
    for i in range(1, CHUNK + 1):
        out[i] = int(out[i - 1]) * r % p
    return out


_tables: list[np.ndarray] = []


def chunk_hash(chunk: np.ndarray) -> tuple[int, int]:
    """Both hashes of at most CHUNK bytes (codes 1 to 256, so zero bytes count)."""
    if not _tables:
        _tables.extend(_power_table(*m) for m in MODULI)
    codes = chunk.astype(np.uint64) + np.uint64(1)
    return tuple(int((codes * t[len(chunk) - 1::-1][:len(chunk)]).sum() % np.uint64(p)) if len(chunk) else 0
                 for t, (p, _) in zip(_tables, MODULI, strict=True))


def combine(a: tuple[int, int], b: tuple[int, int], len_b: int) -> tuple[int, int]:
    """The hash of two adjoining stretches from theirs."""
    return tuple((x * pow(r, len_b, p) + y) % p for x, y, (p, r) in zip(a, b, MODULI, strict=True))


def fingerprint(text: bytes) -> int:
    view, total = np.frombuffer(text, np.uint8), (0, 0)
    for at in range(0, len(view), CHUNK):
        part = view[at:at + CHUNK]
        total = combine(total, chunk_hash(part), len(part))
    return (total[0] << 31) | total[1]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp, n (bytes), text_sha256 and the normalised text of each row."""
    def run(batches):
        for b in batches:
            buf, offsets = ta.raw(b.column(1))
            for lo, hi in ta.slices(offsets):
                data = buf[offsets[lo]:offsets[hi]].tobytes()
                rel = offsets[lo:hi + 1] - offsets[lo]
                texts = [BLANKS.sub(b" ", data[x:y]) for x, y in zip(rel[:-1], rel[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), pa.array([fingerprint(t) for t in texts], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                    pa.array(texts, pa.binary())], names=["doc_id", "fp", "n", "text_sha256", "norm"])

    return (docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
            .mapInArrow(run, "doc_id bigint, fp bigint, n bigint, text_sha256 string, norm binary"))


def unequal_groups(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """(fp, n) of the groups in which some chunk of some member differs."""
    members = texts.select("fp", "n", "norm").join(groups.filter("size > 1").select("fp", "n"), ["fp", "n"])
    chunks = members.select("fp", "n", "norm", F.explode(F.sequence(F.lit(0), F.expr("cast(greatest(n - 1, 0) as bigint)"), F.lit(CHUNK))).alias("at"))
    chunks = chunks.select("fp", "n", "at", F.expr(f"substring(norm, cast(at as int) + 1, {CHUNK})").alias("chunk"))
    return (chunks.groupBy("fp", "n", "at").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
            .filter("least != most").select("fp", "n").distinct())


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    texts = fingerprints(docs)
    rows = texts.select("doc_id", "fp", "n", "text_sha256")
    unequal = unequal_groups(texts, rows.groupBy("fp", "n").agg(F.count("*").alias("size")))
    keyed = (rows.join(unequal.withColumn("apart", F.lit(True)), ["fp", "n"], "left")
             .select("doc_id", "fp", "n", "text_sha256", F.when(F.col("apart"), F.col("text_sha256")).otherwise("").alias("part")))
    groups = keyed.groupBy("fp", "n", "part").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    same = Window.partitionBy("fp", "n", "part", "doc_id").orderBy("text_sha256")
    joined = keyed.withColumn("nth", F.row_number().over(same)).join(groups, ["fp", "n", "part"])
    return joined.select("doc_id", "keep_id", "group_size",
                         (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256")



def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged; of repeated rows one."""
    kept = exact_groups(docs).filter("kept").select(
        F.coalesce("doc_id", F.lit(0)).alias("__id"), F.isnull("doc_id").alias("__none"), F.col("text_sha256").alias("__sha"))
    norm = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    rows = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "__none": F.isnull("doc_id"), "__sha": F.sha2(norm, 256)})
    one = Window.partitionBy("__id", "__none", "__sha").orderBy(F.lit(0))
    return (rows.withColumn("__nth", F.row_number().over(one)).filter("__nth = 1")
            .join(kept, ["__id", "__none", "__sha"], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns]))


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
"""


@query("op6_exact_dedup", SQL)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))
