"""Positional windows over one key without putting a whole key in one task.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task; with one key holding a third of the data that task is the job. So a
table is counted first. Up to ``chunk_rows`` rows no key can be larger, and the
plain window is the plan. Above that, the narrow columns (keys, order value) are
range partitioned once into parts of about ``chunk_rows`` rows; where a part
ends inside a key, its last row is a cut of that key's time line. Windows then
run per ``(key, chunk)``, the chunk being the number of cuts before a row, and
the few rows that need neighbours from another chunk get them from a small
per-chunk summary:

* lags: the last ``max_lag`` rows of every chunk, ordered per key, give each
  chunk the ``max_lag`` rows that precede it (its halo);
* leads: the same with the first ``max_lead`` rows of every chunk;
* as-of carry: the latest row of every chunk, carried forward per key.

The summaries hold a handful of rows per chunk, so their per-key windows stay
small however skewed the keys are. The wide rows are shuffled once, by (key,
chunk). Results equal the plain per-key window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocast.session import scratch_path

CHUNK = "_chunk"
DEFAULT_CHUNK_ROWS = 1_000_000
# Session setting for the chunk size, used when a call passes none.
CHUNK_ROWS_CONF = "aerocast.chunkRows"

_RN, _CNT, _ORD, _HALO, _CUTS = "__ck_rn", "__ck_cnt", "__ck_ord", "__ck_halo", "__ck_cuts"


def _order_number(df: DataFrame, order: str) -> Column:
    dtype = df.schema[order].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(order).cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(F.col(order)).cast("long")
    return F.col(order).cast("double")


def resolve_chunk_rows(df: DataFrame, chunk_rows: int | None) -> int:
    """The explicit value, else the session's ``aerocast.chunkRows``, else 1M."""
    if chunk_rows is not None:
        return int(chunk_rows)
    value = df.sparkSession.conf.get(CHUNK_ROWS_CONF, None)
    return int(value) if value else DEFAULT_CHUNK_ROWS


def part_count(df: DataFrame, keys: Sequence[str], order: str, chunk_rows: int | None = None,
               rows: int | None = None) -> int:
    """Parts of ``chunk_rows`` rows; ``rows`` saves the count where a bound is known."""
    if rows is None:
        rows = df.select(*keys, order).count()
    return max(1, -(-rows // resolve_chunk_rows(df, chunk_rows)))


def range_cuts(df: DataFrame, keys: Sequence[str], order: str, parts: int) -> DataFrame:
    """(keys, cuts): for each key that a boundary of ``parts`` equal ranges of
    (keys, order) falls into, the sorted order values at those boundaries.

    Spark samples the boundaries; only the key and order columns are shuffled,
    and one row per part is left. The table (at most one value per part) is
    written once, so every reader sees the same cuts.
    """
    spark = df.sparkSession
    narrow = df.select(*keys, _order_number(df, order).alias(_ORD)).where(F.col(_ORD).isNotNull())
    edges = (narrow.repartitionByRange(parts, *keys, _ORD).groupBy(F.spark_partition_id().alias("part"))
             .agg(F.min(F.struct(*keys, _ORD)).alias("lo"), F.max(F.struct(*keys, _ORD)).alias("hi")))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"hi.{k}").eqNullSafe(F.col(f"next.{k}"))
    cuts = (edges.withColumn("next", F.lead("lo").over(Window.orderBy("part"))).where(F.col("next").isNotNull() & same)
            .groupBy(*[F.col(f"hi.{k}").alias(k) for k in keys]).agg(F.sort_array(F.collect_set(f"hi.{_ORD}")).alias(_CUTS)))
    path = scratch_path(spark, "cuts")
    cuts.write.parquet(path)
    return spark.read.schema(cuts.schema).parquet(path)


def cuts_before(cuts: Column, value: Column, most: int) -> Column:
    """How many of at most ``most`` sorted ``cuts`` lie before ``value``: binary search by falling steps."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, most.bit_length())))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(cuts)) & (F.try_element_at(cuts, at + step) < value), at + step).otherwise(at))


def with_chunks(df: DataFrame, keys: Sequence[str], order: str, chunk_rows: int | None = None,
                rows: int | None = None) -> DataFrame:
    """Add ``_chunk``: slices of about ``chunk_rows`` rows per key, in order.

    Tables of at most ``chunk_rows`` rows get chunk 0 everywhere and nothing is
    joined. Otherwise a row's chunk is the number of its key's cuts before it
    (see ``range_cuts``); keys without a cut, the small ones, are chunk 0. The
    cut keys are at most one per part; adaptive execution broadcasts them where
    their measured size allows. Rows of equal order value stay together. NULL
    keys are a key like any other.
    """
    parts = part_count(df, keys, order, chunk_rows, rows)
    if parts == 1:
        return df.withColumn(CHUNK, F.lit(0).cast("long"))
    cuts = range_cuts(df, keys, order, parts)
    names = [f"__ck_key{i}" for i in range(len(keys))]
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & df[k].eqNullSafe(F.col(n))
    side = cuts.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], _CUTS)
    joined = df.join(side, same, "left").withColumn(_ORD, _order_number(df, order))
    chunk = F.when(F.col(_CUTS).isNull() | F.col(_ORD).isNull(), 0).otherwise(cuts_before(F.col(_CUTS), F.col(_ORD), parts))
    return joined.withColumn(CHUNK, chunk.cast("long")).drop(*names, _CUTS, _ORD)


def _shift_name(col: str, kind: str, j: int) -> str:
    return f"{col}__{kind}{j}"


def shifted(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str],
            max_lag: int = 3, max_lead: int = 0, chunk_rows: int | None = None,
            rows: int | None = None) -> DataFrame:
    """Add ``<col>__lag<j>`` (j=1..max_lag) and ``<col>__lead<j>`` per key.

    Same values as ``lag(col, j)`` / ``lead(col, j)`` over
    ``Window.partitionBy(*keys).orderBy(order)``; ``order`` must be unique
    within a key.

    Plan: a table of one part gets one window per key. Else (1) chunks by
    range cuts of (key, order); (2) on a narrow projection (key, chunk, order,
    columns) the first ``max_lead`` and last ``max_lag`` rows of every chunk,
    windowed per key (a few rows per chunk), give each chunk its halo: the rows
    just before and just after it; (3) the full rows and the halo rows go
    through ONE window per ``(key, chunk)``, and the halo rows are dropped. The
    wide rows are shuffled once.
    """
    K, L = max_lag, max_lead
    base_cols = df.columns
    carried = [order, *columns]

    def shifts(w):
        return [*[F.lag(c, j).over(w).alias(_shift_name(c, "lag", j)) for c in columns for j in range(1, K + 1)],
                *[F.lead(c, j).over(w).alias(_shift_name(c, "lead", j)) for c in columns for j in range(1, L + 1)]]

    if rows is None:
        rows = df.select(*keys, order).count()
    if part_count(df, keys, order, chunk_rows, rows) == 1:
        return df.select(*base_cols, *shifts(Window.partitionBy(*keys).orderBy(order)))
    cdf = with_chunks(df, keys, order, chunk_rows, rows)
    part = [*keys, CHUNK]
    w = Window.partitionBy(*part).orderBy(order)
    ranked = cdf.select(*part, *carried).withColumn(_RN, F.row_number().over(w)).withColumn(
        _CNT, F.count(F.lit(1)).over(Window.partitionBy(*part)))
    sw = Window.partitionBy(*keys).orderBy(order)
    halos = []
    if K:
        # lags: among the chunk tails, the K rows before each chunk's first tail row
        tails = ranked.where(F.col(_RN) > F.col(_CNT) - K)
        prev = tails.select(
            *part, _RN, _CNT,
            F.array(*[F.lag(F.struct(*carried), j).over(sw) for j in range(1, K + 1)]).alias("_nb"),
        ).where(F.col(_RN) == F.greatest(F.col(_CNT) - K + 1, F.lit(1)))
        halos.append(prev.select(*part, F.explode("_nb").alias("_r")).where(F.col("_r").isNotNull()))
    if L:
        # leads: among the chunk heads, the L rows after each chunk's last head row
        heads = ranked.where(F.col(_RN) <= L)
        nxt = heads.select(
            *part, _RN, _CNT,
            F.array(*[F.lead(F.struct(*carried), j).over(sw) for j in range(1, L + 1)]).alias("_nb"),
        ).where(F.col(_RN) == F.least(F.col(_CNT), F.lit(L)))
        halos.append(nxt.select(*part, F.explode("_nb").alias("_r")).where(F.col("_r").isNotNull()))

    mixed = cdf.withColumn(_HALO, F.lit(False))
    for h in halos:
        mixed = mixed.unionByName(
            h.select(*part, *[F.col(f"_r.{c}").alias(c) for c in carried], F.lit(True).alias(_HALO)),
            allowMissingColumns=True)
    return mixed.select(*base_cols, _HALO, *shifts(w)).where(~F.col(_HALO)).drop(_HALO)


def last_n_per_key(df: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    """The ``n`` latest rows of every key (by ``order``), with ``_rank`` 1..n.

    The rank filter becomes a window group limit before the exchange: each
    task sends at most ``n`` rows of a key, so a hot key is cut before it is
    shuffled.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in ``order``; one row per key and task crosses the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the greatest ``order_cols`` (lexicographic), ties kept out."""
    return one_per_key(df, keys, [F.col(c).desc() for c in order_cols])
