"""Shared steps of the operators: the documents they read, work buckets of
documents, and questions about hashes answered by shards.

**Buckets.** An operator that needs the texts again after a shuffle deals the
documents to buckets by id once (``packed_buckets``; the texts cross the
shuffle compressed) and meets them there in each later step; Spark reuses that
one exchange within a job.

**Asking shards.** A bucket asks about the sorted distinct 64-bit hashes that
it holds. ``ask`` cuts them by value into shards, each shard answers with one
bit or more per hash in the same order, and the bucket, which computes its
hashes anew, reads the answers off by position. So neither positions nor hash
values travel back, and a hash that fills a bucket is sent once.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import textarrays as ta
from aerocast.session import shared_root

BUCKET_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back (lineage is cut)."""
    spark = df.sparkSession
    path = f"{shared_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    # the shuffle files of this job serve no later one
    switch = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(switch, "false")
    spark.conf.set(switch, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(switch, before)
    return spark.read.schema(df.schema).parquet(path)


def bucket_count(docs: DataFrame, most: int | None = None) -> int:
    """Buckets of about ``most`` (BUCKET_BYTES) bytes of text; grows with the table."""
    total = docs.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return max(1, round(total / (most or BUCKET_BYTES)))


def bucket_of(n_buckets: int, spread: Column | int = 0) -> Column:
    """The bucket of ``doc_id``; rows with a null id are spread by another value."""
    salt = F.when(F.isnull("doc_id"), spread if isinstance(spread, Column) else F.lit(spread)).otherwise(F.lit(0)).cast("long")
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long"), salt), F.lit(n_buckets)).cast("int")


def packed_buckets(docs: DataFrame, n_buckets: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """(bucket, doc_id, extra columns, z): texts compressed, dealt by id."""
    keep = ["doc_id", "text", *extra]
    src = docs.select(*keep)
    kinds = ", ".join(f"{c} {src.schema[c].dataType.simpleString()}" for c in ("doc_id", *extra))

    def squeeze(batches):
        for b in batches:
            texts = [t.encode() if t is not None else b"" for t in b.column(1).to_pylist()]
            names = ["doc_id", *extra]
            cols = [b.column(0), *(b.column(2 + i) for i in range(len(extra)))]
            yield pa.RecordBatch.from_arrays([*cols, ta.pack(texts)], [*names, "z"])

    return (src.mapInArrow(squeeze, f"{kinds}, z binary")
            .withColumn("bucket", bucket_of(n_buckets, F.crc32("z")))
            .select("bucket", "doc_id", *extra, "z"))


def ordered(table: pa.Table) -> pa.Table:
    """The rows of a bucket in one fixed order (by id, then by text)."""
    return table.sort_by([("doc_id", "ascending"), ("z", "ascending")])


def shard_of(hashes: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard by value range, so sorted hashes have sorted shards."""
    return ((hashes >> np.uint64(32)) * np.uint64(n_shards)) >> np.uint64(32)


ASK = "shard int, bucket int, q binary"
ANSWER = "bucket int, shard int, a binary"


def ask(bucket: int, hashes: np.ndarray, payload: np.ndarray, n_shards: int) -> pa.Table:
    """One row for each shard that holds some of the sorted distinct ``hashes``;
    ``payload`` has one item for each hash."""
    shard = shard_of(hashes, n_shards).astype(np.int64)
    ids, first = np.unique(shard, return_index=True)
    cuts = np.append(first, len(hashes)) * payload.dtype.itemsize
    return pa.table({"shard": pa.array(ids.astype(np.int32)), "bucket": pa.array(np.full(len(ids), bucket, np.int32)),
                     "q": ta.binary_array(payload, cuts)})


def answers(table: pa.Table, hashes: np.ndarray, n_shards: int, name: str = "a") -> np.ndarray:
    """One bit for each of the sorted distinct ``hashes``, put together from the shards' rows."""
    shard = shard_of(hashes, n_shards).astype(np.int64)
    out = np.zeros(len(hashes), bool)
    ids, first, count = np.unique(shard, return_index=True, return_counts=True)
    at = {int(s): (int(f), int(c)) for s, f, c in zip(ids, first, count, strict=True)}
    for s, bits in zip(table.column("shard").to_pylist(), table.column(name).to_pylist(), strict=True):
        f, c = at[s]
        out[f:f + c] = np.unpackbits(np.frombuffer(bits, np.uint8), count=c).astype(bool)
    return out


def reply(table: pa.Table, flags: list[np.ndarray]) -> pa.Table:
    """The answers of one shard: a row of bits for each row that asked."""
    return pa.table({"bucket": table.column("bucket"), "shard": table.column("shard"),
                     "a": pa.array([np.packbits(f).tobytes() for f in flags], pa.binary())})
