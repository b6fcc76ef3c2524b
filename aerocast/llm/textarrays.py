"""Array views of text columns inside Arrow tasks: bytes, words and rolling
hashes, each over many documents at once.

Hashes are pairs of polynomials modulo two primes near 2^31 over mixed byte
codes, 62 bits together (modulo a power of two, words of a Thue-Morse pattern
would have equal hashes whatever the codes). A prefix sum ``c`` of
``code[i] * R**i`` gives the hash of any stretch ``[a, b)`` as
``(c[b] - c[a]) * R**-a``: equal stretches have equal hashes wherever they
stand, at a constant number of array operations for any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

SLICE_BYTES = 1 << 19  # bytes of text handled at once inside a task
R = 0x9E3779B97F4A7C15  # odd multiplier that spreads bits
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(R))
BLOCK = 1 << 15
LOW, BITS = np.uint64((1 << 31) - 1), np.uint64(31)


class Field:
    """Arithmetic modulo the prime 2^31 - tail on arrays of uint64 below 2^63."""

    def __init__(self, tail: int, base: int):
        self.p, self.tail = (1 << 31) - tail, np.uint64(tail)
        self.base, self.inverse = base, pow(base, -1, self.p)
        self.kept: dict[int, np.ndarray] = {}

    def fold(self, x: np.ndarray) -> np.ndarray:
        """The same residues, below 2^31 + 2^11."""
        for _ in range(2):
            high = x >> BITS
            high *= self.tail
            high += x & LOW
            x = high
        return x

    def exact(self, x: np.ndarray) -> np.ndarray:
        """The least residue of folded values."""
        return np.where(x >= np.uint64(self.p), x - np.uint64(self.p), x)

    def powers(self, base: int, n: int) -> np.ndarray:
        """base**0 .. base**(n-1), kept between calls up to a few slices."""
        have = self.kept.get(base, np.ones(1, np.uint64))
        if len(have) < n:
            size = max(n, 1 << 16)
            while len(have) < size:
                step = np.uint64(pow(base, len(have), self.p))
                have = np.concatenate([have, self.exact(self.fold(have[:size - len(have)] * step))])
            if size <= 4 * SLICE_BYTES:
                self.kept[base] = have
        return have[:n]


FIELDS = (Field(1, 0x3C6EF372), Field(19, 0x5BE0CD19))


class Prefix:
    """Hashes of any stretch of a sequence of 64-bit codes."""

    def __init__(self, codes: np.ndarray):
        self.c, self.inv = [], []
        for field, residues in zip(FIELDS, (lambda x: x & LOW, lambda x: x >> np.uint64(33)), strict=True):
            c, power = np.zeros(len(codes) + 1, np.uint64), field.powers(field.base, len(codes))
            for lo in range(0, len(codes), BLOCK):  # blocks stay in the processor's cache
                hi = min(lo + BLOCK, len(codes))
                np.cumsum(field.fold(residues(codes[lo:hi]) * power[lo:hi]), out=c[lo + 1:hi + 1])
                c[lo + 1:hi + 1] += c[lo]
            self.c.append(c)
            self.inv.append(field.powers(field.inverse, len(codes) + 1))

    def _joined(self, high, low, inverse) -> np.ndarray:
        a, b = (f.exact(f.fold(f.fold(c[high] - c[low]) * i[inverse]))
                for f, c, i in zip(FIELDS, self.c, self.inv, strict=True))
        return mix((a << BITS) | b)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self._joined(end, start, start) + (end - start).astype(np.uint64))

    def rolling(self, k: int) -> np.ndarray:
        """The hash of every window of k codes."""
        n = len(self.c[0]) - k
        return self._joined(slice(k, None), slice(n), slice(n)) if n > 0 else np.zeros(0, np.uint64)


def raw(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the n + 1 offsets; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = col.chunk(0) if col.num_chunks else pa.array([], pa.binary())
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = col.type in (pa.large_string(), pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of documents of about ``most`` bytes, one document at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_spans(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
    """Start, end and document index of each word; no word crosses documents."""
    w = ~space[buf]
    before = np.zeros(len(w), bool)
    before[1:] = w[:-1]
    after = np.zeros(len(w), bool)
    after[:-1] = w[1:]
    inner = offsets[(offsets > 0) & (offsets < len(w))]
    before[inner] = False
    after[inner - 1] = False
    start = np.flatnonzero(w & ~before)
    end = np.flatnonzero(w & ~after) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_codes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A code of 62 bits, spread over 64, for each word; equal words have equal codes."""
    return Prefix(CODE[buf]).spans(start, end)


def word_blocks(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE,
                most: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Start, end, document index and code of the words, in blocks of about
    ``most`` bytes; blocks end at a separator or at a document's end, so long
    documents are cut as well."""
    lo, n = 0, len(buf)
    while lo < n:
        hi = min(lo + most, n)
        edge = int(offsets[np.searchsorted(offsets, hi)])
        while hi < edge:
            at = np.flatnonzero(space[buf[hi:min(hi + (1 << 14), edge)]])
            if len(at):
                hi += int(at[0])
                break
            hi = min(hi + (1 << 14), edge)
        d = int(np.searchsorted(offsets, lo, side="right")) - 1
        rel = np.clip(offsets[d:int(np.searchsorted(offsets, hi)) + 1], lo, hi) - lo
        start, end, doc = word_spans(buf[lo:hi], rel, space)
        yield start + lo, end + lo, doc + d, word_codes(buf[lo:hi], start, end)
        lo = hi


def binary_array(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary values ``data[cuts[i]:cuts[i + 1]]`` without copying them one by one."""
    data = np.ascontiguousarray(data).view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1,
                                 [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)])


def pack(values: list[bytes]) -> pa.Array:
    squeeze = zstandard.ZstdCompressor(level=1)
    return pa.array([squeeze.compress(v) for v in values], pa.binary())


def unpack(col) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``pack`` as bytes and offsets."""
    grow = zstandard.ZstdDecompressor()
    parts = [grow.decompress(v) if v else b"" for v in col.to_pylist()]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return np.frombuffer(b"".join(parts), np.uint8), offsets
