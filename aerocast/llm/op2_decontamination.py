"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters and digits. Seeds are runs of MIN_TILE
words that a document shares with a benchmark item; they are found by looking
up every such run of the document in the sorted seed table of a block of the
benchmark. For each (document, item) with a seed, tiles are marked greedily:
running Karp-Rabin hashes find the longest length at which the two have a
common run without marked words, all its non-overlapping occurrences are
marked, and so on down to MIN_TILE. An item's coverage is the share of its
words under tiles, whatever their order, so a passage cut into pieces and put
together in another order is still found. A document is contaminated when some
item's coverage reaches COVERAGE.

The benchmark is a stated set held against all documents in blocks of about
BLOCK_BYTES, which bounds what is broadcast; documents stay where they are read.

Edge cases: null and empty texts match nothing; items with null text or fewer
than MIN_TILE words can't be judged and match nothing; of items with equal
coverage the smallest item_id is named; repeated rows and null ids are judged
row by row; an empty benchmark leaves all documents clean; no rows give no
rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import textarrays as ta
from aerocast.llm.common import documents
from aerocast.llm.registry import query

MIN_TILE = 5
COVERAGE = 0.5
BLOCK_BYTES = 16 << 20
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
JUDGED = "coverage double, item_id bigint, n_items int"


def codes_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word codes of all texts and the n + 1 offsets into them."""
    data = [(t or "").lower().encode() for t in texts]
    offsets = np.zeros(len(data) + 1, np.int64)
    np.cumsum([len(d) for d in data], out=offsets[1:])
    buf = np.frombuffer(b"".join(data), np.uint8)
    start, end, doc = ta.word_spans(buf, offsets, NOT_WORD)
    return ta.word_codes(buf, start, end), np.searchsorted(doc, np.arange(len(data) + 1))


def runs_of(codes: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of k words within a text and their starts."""
    at = np.arange(max(0, len(codes) - k + 1))
    text = np.searchsorted(offsets, at, side="right") - 1
    inside = at + k <= offsets[text + 1] if len(at) else np.zeros(0, bool)
    return ta.Prefix(codes).rolling(k)[inside], at[inside]


class Block:
    """Seed table of some benchmark items."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = np.array(ids, np.int64)
        self.codes, self.offsets = codes_of(texts)
        seeds, at = runs_of(self.codes, self.offsets, MIN_TILE)
        order = np.argsort(seeds, kind="stable")
        self.seeds = seeds[order]
        self.item = (np.searchsorted(self.offsets, at, side="right") - 1)[order]

    def judge(self, texts: list[str | None]) -> list[tuple[float, int | None, int]]:
        """Best coverage, its item and the number of items that reach COVERAGE, for each text."""
        codes, offsets = codes_of(texts)
        out: list[tuple[float, int | None, int]] = [(0.0, None, 0)] * len(texts)
        if not len(self.seeds):
            return out
        runs, at = runs_of(codes, offsets, MIN_TILE)
        lo = np.searchsorted(self.seeds, runs)
        hit = self.seeds[np.minimum(lo, len(self.seeds) - 1)] == runs
        if not hit.any():
            return out
        runs, at, lo = runs[hit], at[hit], lo[hit]
        n = np.searchsorted(self.seeds, runs, side="right") - lo
        where = np.repeat(at, n)
        item = self.item[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        doc = np.searchsorted(offsets, where, side="right") - 1
        order = np.lexsort((where, item, doc))
        doc, item, where = doc[order], item[order], where[order]
        cuts = np.flatnonzero(np.diff(doc, prepend=-1) | np.diff(item, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(doc)], strict=True):
            d, i = int(doc[a]), int(item[a])
            words = np.unique((where[a:b, None] + np.arange(MIN_TILE)).ravel())
            words = words[words < offsets[d + 1]]
            part = self.codes[self.offsets[i]:self.offsets[i + 1]]
            share = tiled(part, codes[words], np.diff(words, prepend=words[0]) > 1).mean()
            best, name, count = out[d]
            if share > best or (share == best and (name is None or self.ids[i] < name)):
                best, name = float(share), int(self.ids[i])
            out[d] = (best, name, count + (share >= COVERAGE))
        return out


def tiled(pattern: np.ndarray, text: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Which words of ``pattern`` lie under tiles; no tile crosses a break of ``text``."""
    marked_p, marked_t = np.zeros(len(pattern), bool), np.zeros(len(text), bool)
    hash_p, hash_t = ta.Prefix(pattern), ta.Prefix(text)
    crossing = np.concatenate([[0], np.cumsum(breaks)])

    def free(marked: np.ndarray, k: int) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marked)])
        return sums[k:] == sums[:-k]

    def common(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        p, t = np.flatnonzero(free(marked_p, k)), free(marked_t, k)
        t = np.flatnonzero(t & (crossing[k:] == crossing[1:len(crossing) - k + 1]))
        hp, ht = hash_p.rolling(k)[p], hash_t.rolling(k)[t]
        both = np.intersect1d(hp, ht)
        return p[np.isin(hp, both)], hp[np.isin(hp, both)], t[np.isin(ht, both)], ht[np.isin(ht, both)]

    most = min(len(pattern), len(text))
    while most >= MIN_TILE:
        least, top = MIN_TILE - 1, most  # the longest length with a common free run
        while least < top:
            mid = (least + top + 1) // 2
            least, top = (mid, top) if len(common(mid)[0]) else (least, mid - 1)
        if least < MIN_TILE:
            break
        p, hp, t, ht = common(least)
        places: dict[int, list[int]] = {}
        for at, h in zip(t.tolist(), ht.tolist(), strict=True):
            places.setdefault(h, []).append(at)
        for at, h in zip(p.tolist(), hp.tolist(), strict=True):
            if marked_p[at:at + least].any():
                continue
            for to in places[h]:
                if not marked_t[to:to + least].any():
                    marked_p[at:at + least] = marked_t[to:to + least] = True
                    break
        most = least
    return marked_p


def judge_column(docs: DataFrame, benchmark: DataFrame) -> Column:
    """struct<coverage, item_id, n_items> of column ``text``, over all blocks of the benchmark."""
    spark = docs.sparkSession
    items = benchmark.selectExpr("cast(item_id as bigint) item_id", "text").filter("item_id is not null and text is not null")
    total = items.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    parts = []
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()  # about BLOCK_BYTES
        sent = spark.sparkContext.broadcast(([r.item_id for r in rows], [r.text for r in rows]))
        parts.append(_judge_block(sent)(F.col("text")))
    best = F.array_max(F.array(*[F.struct(p["coverage"].alias("coverage"), (-p["item_id"]).alias("less")) for p in parts]))
    return F.struct(best["coverage"].alias("coverage"), (-best["less"]).alias("item_id"), sum((p["n_items"] for p in parts), F.lit(0)).alias("n_items"))


def _judge_block(sent):
    made: list[Block] = []

    @F.arrow_udf(JUDGED)
    def judge(text: pa.Array) -> pa.Array:
        if not made:
            made.append(Block(*sent.value))
        _, offsets = ta.raw(text)
        out = [x for lo, hi in ta.slices(offsets) for x in made[0].judge(text.slice(lo, hi - lo).to_pylist())]
        return pa.array([{"coverage": c, "item_id": i, "n_items": int(n)} for c, i, n in out],
                        pa.struct([("coverage", pa.float64()), ("item_id", pa.int64()), ("n_items", pa.int32())]))

    return judge


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id (best covered, null without seeds), coverage, n_items, contaminated."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), judge_column(docs, benchmark).alias("j"))
            .select("doc_id", "j.item_id", "j.coverage", "j.n_items", (F.col("j.coverage") >= COVERAGE).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The clean rows of ``docs``, all columns unchanged."""
    return docs.filter(judge_column(docs, benchmark)["coverage"] < COVERAGE)


def benchmark_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


@query("op2_benchmark_decontamination")
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), benchmark_of(spark, sf_dir))
