"""Sharding by jump consistent hashing (law ``key``), in SQL expressions only.

The shard of a row follows from its id and the number of shards: a 64-bit
linear congruential generator seeded with the id jumps forward through shard
numbers until it passes the last one. With one shard more, a row stays or goes
to the new shard. There is no ring table; each shard holds near 1/n of the ids.

The 64-bit products are put together from 22-bit limbs, since SQL's long
multiplication raises on overflow. Expected steps are ln(n); the unrolled loop
allows n + 1 of them, the most there can be.

Slots number the rows of a shard from 0 without gaps. They are counted within
(shard, bucket) groups, buckets taken from the id's MD5, and moved up by the
rows of the buckets before; so no task holds a shard, and the running sums go
over shards x buckets rows only.

Edge cases: a null id is keyed as 0; null text has no bytes (size 8) and the
CRC-32 of the empty string; repeated rows take consecutive slots; other columns
are ignored; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerocast.llm.common import documents
from aerocast.llm.registry import query

SHARDS = 24
BUCKET_HEX = 3  # hex digits of the MD5: 4,096 buckets
# Fixed value: the multiplier of the published jump hash.
MULTIPLIER = 2862933555777941757
LIMB = (1 << 22) - 1


def _times_plus_one(a0: Column, a1: Column, a2: Column) -> tuple[Column, Column, Column]:
    """Limbs (22, 22 and 20 bits) of key * MULTIPLIER + 1 modulo 2^64."""
    c0, c1, c2 = MULTIPLIER & LIMB, (MULTIPLIER >> 22) & LIMB, MULTIPLIER >> 44
    r0 = a0 * F.lit(c0) + F.lit(1)
    r1 = a0 * F.lit(c1) + a1 * F.lit(c0) + F.shiftright(r0, 22)
    r2 = a0 * F.lit(c2) + a1 * F.lit(c1) + a2 * F.lit(c0) + F.shiftright(r1, 22)
    return r0.bitwiseAND(LIMB), r1.bitwiseAND(LIMB), r2.bitwiseAND((1 << 20) - 1)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard of a long key among ``shards``."""
    start = F.struct(
        key.bitwiseAND(LIMB).alias("k0"), F.shiftright(key, 22).bitwiseAND(LIMB).alias("k1"),
        F.shiftright(key, 44).bitwiseAND((1 << 20) - 1).alias("k2"),
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(s: Column, _: Column) -> Column:
        k0, k1, k2 = _times_plus_one(s["k0"], s["k1"], s["k2"])
        high = k2 * F.lit(1 << 11) + F.shiftright(k1, 11)  # key >> 33
        jump = F.floor((s["j"] + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / (high + F.lit(1)).cast("double")))
        moved = F.struct(k0.alias("k0"), k1.alias("k1"), k2.alias("k2"), s["j"].alias("b"), jump.cast("long").alias("j"))
        return F.when(s["j"] < shards, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), start, step, lambda s: s["b"]).cast("int")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row of ``docs`` with its size, checksum, shard and slot."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        jump_hash(key, shards).alias("shard"), jump_hash(key, shards + 1).alias("grown_shard"),
        F.substring(F.md5(key.cast("string")), 1, BUCKET_HEX).alias("bucket"))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    return (rows.withColumn("nth", F.row_number().over(inside)).join(starts, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("base") + F.col("nth") - 1).alias("slot"), "grown_shard"))


SQL = r"""
WITH RECURSIVE t0 AS (SELECT range AS i, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM t0 WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM t0 WHERE k = 8),
x AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
y AS (SELECT doc_id, len(h) // 2 + 8 AS size,
        xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
            lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]))) AS text_crc32 FROM x, tab),
j AS (SELECT doc_id, n, (doc_id::HUGEINT + 18446744073709551616) % 18446744073709551616 AS k, -1::BIGINT AS b, 0::BIGINT AS j
      FROM documents, (VALUES (24), (25)) s(n)
  UNION ALL
  SELECT doc_id, n, k2, j, floor((j + 1) * (2147483648.0::DOUBLE / ((k2 >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT doc_id, n, j, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM j WHERE j < n)),
s AS (SELECT doc_id, max(b) FILTER (n = 24) AS shard, max(b) FILTER (n = 25) AS grown_shard FROM j GROUP BY doc_id)
SELECT y.doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5(y.doc_id::VARCHAR), 1, 3), y.doc_id) - 1 AS slot,
       grown_shard::INTEGER AS grown_shard
FROM y JOIN s ON y.doc_id = s.doc_id
"""


@query("op4_sharding", SQL)
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))
