"""Documents as chunks of numbered symbols, and sums over all chunks of what
each chunk holds.

A **chunk** is one row that stands for about CHUNK_BYTES of text: the distinct
symbols of its documents (hashes) and the text as numbers of symbols. Chunks
are formed where the table is scanned, so no text is shuffled, a repeated id or
text is only one more entry of some chunk, and nothing is dealt by a key of the
documents. ``written`` chunk tables are read by all later steps, so a lost
executor costs a chunk again, not the tokenisation.

**Sums.** A chunk sends its sorted distinct 64-bit hashes, each with a number,
cut by value range into shards; a shard adds up the numbers of equal hashes and
sends the totals back in the order asked. Totals are read off by position, so
no hash travels back, and the most frequent hash of the corpus is one entry per
chunk. ``first`` marks one chunk (the one with the least number, of those that
sent a number above zero) for each hash, which lets a chunk act for all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.llm import common

CHUNK_BYTES = 8 << 20
ASK = "step int, shard int, chunk bigint, hashes binary, numbers binary"
TOLD = "chunk bigint, step int, shard int, totals binary, first binary"


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    v = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(level=1).compress(v.view(np.uint8).reshape(-1, v.itemsize).T.tobytes() if len(v) else b"")


def unpacked(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def packed_sorted(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def unpacked_sorted(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpacked(data, kind), dtype=kind)


def narrow(values: np.ndarray) -> np.ndarray:
    """Non-negative integers in the fewest bytes that hold them."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def numbers(values: np.ndarray) -> bytes:
    """Non-negative integers with a leading byte that tells their width."""
    v = narrow(values)
    return bytes([v.itemsize]) + packed(v)


def to_numbers(data: bytes) -> np.ndarray:
    return unpacked(data[1:], {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[data[0]]).astype(np.int64)


def batches_of(batches: Iterator[pa.RecordBatch], text: str = "text", most: int | None = None) -> Iterator[tuple[int, pa.Table]]:
    """(chunk number, rows) of about ``most`` bytes of text each, in order of the task."""
    most = most or CHUNK_BYTES
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 32
    held, size = [], 0
    for b in batches:
        col = b.column(b.schema.names.index(text))
        for lo, hi, n in _cuts(col, most):
            if size and size + n > most:
                yield number, pa.Table.from_batches(held)
                number, held, size = number + 1, [], 0
            held.append(b.slice(lo, hi - lo))
            size += n
    if held:
        yield number, pa.Table.from_batches(held)


def _cuts(col: pa.Array, most: int) -> Iterator[tuple[int, int, int]]:
    """Ranges of rows of at most a quarter of ``most`` bytes, one row at least, with their bytes."""
    total = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo, before = 0, 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(total, before + most // 4, side="right")))
        yield lo, hi, int(total[hi - 1]) - before
        lo, before = hi, int(total[hi - 1])


def questions(chunk: int, step: int, hashes: np.ndarray, values: list[np.ndarray], n_shards: int) -> pa.Table:
    """ASK rows, one for each shard that holds some of the sorted distinct ``hashes``."""
    shard = common.shard_of(hashes, n_shards).astype(np.int64)
    ids, first = np.unique(shard, return_index=True)
    cuts = list(zip(first.tolist(), np.append(first, len(hashes))[1:].tolist(), strict=True))
    return pa.table({"step": pa.array([step] * len(ids), pa.int32()), "shard": pa.array(ids.astype(np.int32)),
                     "chunk": pa.array([chunk] * len(ids), pa.int64()),
                     "hashes": pa.array([packed_sorted(hashes[a:z]) for a, z in cuts], pa.binary()),
                     "numbers": pa.array([_several([v[a:z] for v in values]) for a, z in cuts], pa.binary())})


def _several(values: list[np.ndarray]) -> bytes:
    """Integer columns as ``numbers``, float columns as they are."""
    parts = [b"f" + packed(v) if v.dtype.kind == "f" else b"i" + numbers(v) for v in values]
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _each(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 4], "little")
        part = data[at + 4:at + 4 + n]
        out.append(unpacked(part[1:], np.float64) if part[:1] == b"f" else to_numbers(part[1:]))
        at += 4 + n
    return out


def summed(asked: DataFrame, extra: Callable | None = None, extra_schema: str = "") -> DataFrame:
    """TOLD rows: the totals of each asked hash, and whether the asking chunk is the first that holds it.

    ``extra(hashes, totals)`` may add columns per shard, the same on each of its rows."""

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        hashes = [unpacked_sorted(x, np.uint64) for x in table.column("hashes").to_pylist()]
        values = [_each(x) for x in table.column("numbers").to_pylist()]
        cuts = np.cumsum([len(h) for h in hashes])
        distinct, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        columns = [np.concatenate(v) for v in zip(*values, strict=True)]
        sums = []
        for v in columns:
            t = np.zeros(len(distinct), v.dtype)
            np.add.at(t, inverse, v)  # whole numbers, so the order doesn't matter
            sums.append(t)
        place = np.flatnonzero(columns[0] > 0)
        owner = np.full(len(distinct), -1, np.int64)
        owner[inverse[place[::-1]]] = place[::-1]  # the first place of each hash is written last
        mine = np.zeros(len(inverse), bool)
        mine[owner[owner >= 0]] = True
        back = [s[inverse] for s in sums]
        split = [np.split(b, cuts[:-1]) for b in back]
        out = {"chunk": table.column("chunk"), "step": table.column("step"), "shard": table.column("shard"),
               "totals": pa.array([_several(list(x)) for x in zip(*split, strict=True)], pa.binary()),
               "first": pa.array([np.packbits(m).tobytes() for m in np.split(mine, cuts[:-1])], pa.binary())}
        if extra:
            out |= {k: pa.array([v] * len(table)) for k, v in extra(distinct, sums).items()}
        return pa.table(out)

    return asked.groupBy("step", "shard").applyInArrow(add, TOLD + extra_schema)


def totals(told: pa.Table, step: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The totals of a chunk's question of one step, in the order of its sorted hashes, and the marks of the first."""
    rows = told.filter(pc.equal(told.column("step"), step)).sort_by("shard")
    values = [_each(x) for x in rows.column("totals").to_pylist()]
    if not values:
        return [], np.zeros(0, bool)
    columns = [np.concatenate(v) for v in zip(*values, strict=True)]
    lengths = [len(v[0]) for v in values]
    marks = [np.unpackbits(np.frombuffer(m, np.uint8), count=n).astype(bool) for m, n in zip(rows.column("first").to_pylist(), lengths, strict=True)]
    return columns, np.concatenate(marks)


def shard_count(table: DataFrame, per_chunk: int = 1) -> int:
    """Shards in step with the chunks of a written table."""
    return max(4, table.agg(F.count("*").alias("n")).first()["n"] * per_chunk)
