"""Suffix-array deduplication of byte strings.

A byte goes if a string of LENGTH bytes over it also starts anywhere else.

**Sparse suffix array.** Sorting a suffix for every byte would cost many times
the input, so suffixes start at anchors only: in every string of LENGTH bytes
the GRAM-byte gram with the least hash (the leftmost of equals) is its anchor.
The choice depends on the string's bytes alone, so equal strings have equal
anchors at equal offsets and nothing is lost. Consecutive starts with one
anchor form a run; its text, from the first start to the end of the last
string, holds all that any of its strings needs.

**Steps.** 1. Buckets of documents ask shards which anchors' grams occur twice
(see ``common``). 2. The runs of those anchors, equal ones of a bucket once,
are range-partitioned by the leading bytes of the anchor's suffix; the splitters
are quantiles of a sample of anchors. Each range sorts its suffixes locally by
multikey quicksort: words of eight bytes are the characters, and only ties go
on to the next. The same is done with the reversed bytes before the anchor.
Both arrays with their longest common prefixes give exact classes: two strings
with i bytes before the anchor are equal if the suffixes share LENGTH - i bytes
and the reversed bytes share i. Neighbours are compared across the batches in
which a range arrives; equal leading bytes never lie in two ranges, and among them
the runs of one anchor lie together. 3. Bits for
each start of a run go back to the buckets, which remove what they cover.

Anchors with more than HOT runs, each bucket's distinct ones added up, don't share
one range: each of their strings is sent by its hash, dealt by that, and compared
there. So no more than HOT runs are ever compared at once.

Edge cases: null and short texts lose nothing; repeated rows are documents of
their own, so equal ones lose everything; null ids are allowed; other columns
are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import common
from aerocast.llm import textarrays as ta
from aerocast.llm.registry import query

LENGTH = 200
GRAM = 64
SPREAD = LENGTH - GRAM + 1  # starts of grams in a string; bits of a run
HOT = 20_000                # runs of an anchor that one task compares, about 1 KB each
SAMPLE = 16                 # one document in so many gives anchors for the splitters
CHUNK_ROWS = 16_000         # suffixes compared at once, more if the runs of one anchor fill more
BITS = -(-SPREAD // 8)
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
RUN = "part int, k1 bigint, k2 bigint, k3 bigint, bucket int, rep int, before int, many boolean, content binary"


def leading(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as a number whose order is that of the bytes."""
    word = np.zeros(len(at), np.uint64)
    for j in range(8):
        word = (word << np.uint64(8)) | buf[at + j].astype(np.uint64)
    return (word ^ np.uint64(1 << 63)).view(np.int64)


def find_runs(buf: np.ndarray, offsets: np.ndarray):
    """Runs of a slice: first start, last start, anchor, hash of the anchor's gram and the
    prefix hashes of the slice."""
    seq = ta.Prefix(ta.CODE[buf])
    none = np.zeros(0, np.int64)
    if len(buf) < LENGTH:
        return none, none, none, np.zeros(0, np.uint64), seq
    gram = seq.rolling(GRAM)
    bits = np.uint64(max(24, int(len(buf)).bit_length()))
    least = ((gram >> bits) << bits) | np.arange(len(gram), dtype=np.uint64)
    width = 1
    while 2 * width <= SPREAD:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPREAD:
        least = np.minimum(least[:width - SPREAD], least[SPREAD - width:])
    anchor = (least & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    last = np.repeat(offsets[1:], np.diff(offsets))[:len(anchor)] - LENGTH  # the last start in each byte's document
    start = np.flatnonzero(np.arange(len(anchor)) <= last)
    anchor = anchor[start]
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
    low = start[new]
    high = start[np.append(new[1:], len(start)) - 1] if len(new) else none
    return low, high, anchor[new], gram[anchor[new]], seq


class Bucket:
    """The runs of a bucket of documents, positions counted in all its bytes."""

    def __init__(self, table: pa.Table):
        table = common.ordered(table)
        self.ids = table.column("doc_id")
        self.buf, self.offsets = ta.unpack(table.column("z"))
        parts = []
        for lo, hi in ta.slices(self.offsets):
            base = self.offsets[lo]
            low, high, anchor, gram, seq = find_runs(self.buf[base:self.offsets[hi]], self.offsets[lo:hi + 1] - base)
            content = ta.mix(seq.spans(low, high + LENGTH) + (anchor - low).astype(np.uint64))
            parts.append((low + base, high + base, anchor + base, gram, content))
        kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64)
        self.low, self.high, self.anchor, self.gram, self.content = (
            np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, k) for i, k in enumerate(kinds))
        self.grams, self.which, self.count = np.unique(self.gram, return_inverse=True, return_counts=True)

    def runs(self) -> np.ndarray:
        """How many distinct runs each gram has."""
        _, first = np.unique(self.content, return_index=True)
        return np.bincount(self.which[first], minlength=len(self.grams))

    def representatives(self, chosen: np.ndarray):
        """Of the chosen runs: their numbers, one run for each content, each run's content and how often that occurs."""
        run = np.flatnonzero(chosen[self.which])
        _, first, inverse, count = np.unique(self.content[run], return_index=True, return_inverse=True, return_counts=True)
        return run, run[first], inverse, count

    def windows(self, hot: np.ndarray):
        """Starts of the strings of hot anchors, their distinct hashes, each one's position among those and how often each occurs."""
        run = np.flatnonzero(hot[self.which])
        n = self.high[run] - self.low[run] + 1
        start = np.repeat(self.low[run], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        h = np.zeros(len(start), np.uint64)
        for lo, hi in ta.slices(self.offsets):  # starts ascend, and none crosses a document
            a, z = self.offsets[lo], self.offsets[hi]
            i, j = np.searchsorted(start, (a, z))
            if i < j:
                h[i:j] = ta.Prefix(ta.CODE[self.buf[a:z]]).spans(start[i:j] - a, start[i:j] - a + LENGTH)
        distinct, first, inverse, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        return start, distinct, start[first], inverse, count


def gram_questions(n_shards: int):
    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        b = Bucket(table)
        payload = ((b.grams & np.uint64((1 << 31) - 1)) << np.uint64(1)) | (b.count > 1).astype(np.uint64)
        number = key[0].as_py()
        runs = common.ask(number, b.grams, np.minimum(b.runs(), (1 << 16) - 1).astype(np.uint16), n_shards)
        return common.ask(number, b.grams, payload.astype(np.uint32), n_shards).append_column("n", runs.column("q"))
    return ask


def gram_answers(hot_above: int):
    """Bits for grams that occur twice and bits for those that have many runs."""
    def answer(table: pa.Table) -> pa.Table:
        buf, offsets = ta.raw(table.column("q"))
        asked = buf.view(np.uint32)
        distinct, inverse, count = np.unique(asked >> np.uint32(1), return_inverse=True, return_counts=True)
        twice = (count + np.bincount(inverse, asked & np.uint32(1), len(distinct))) > 1
        runs = np.bincount(inverse, ta.raw(table.column("n"))[0].view(np.uint16), len(distinct))
        cuts = offsets[1:-1] // 4
        hot = common.reply(table, np.split((runs > hot_above)[inverse], cuts))
        return common.reply(table, np.split(twice[inverse], cuts)).append_column("hot", hot.column("a"))
    return answer


def told_of(b: Bucket, told: pa.Table, n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Which grams are compared as suffixes and which are hot."""
    hot = common.answers(told, b.grams, n_shards, "hot")
    return common.answers(told, b.grams, n_shards) & ~hot, hot


def suffix_rows(n_shards: int, splitters: np.ndarray):
    def emit(key: tuple[pa.Scalar, ...], docs: pa.Table, told: pa.Table) -> pa.Table:
        b = Bucket(docs)
        cold, hot = told_of(b, told, n_shards)
        _, rep, _, count = b.representatives(cold)
        k1, k2 = leading(b.buf, b.anchor[rep]), leading(b.buf, b.anchor[rep] + 8)
        size = b.high[rep] + LENGTH - b.low[rep]
        cuts = np.concatenate([[0], np.cumsum(size)])
        data = b.buf[np.repeat(b.low[rep] - cuts[:-1], size) + np.arange(cuts[-1])]
        number = key[0].as_py()
        normal = pa.table({"part": np.searchsorted(splitters, k1, side="right").astype(np.int32), "k1": k1, "k2": k2, "k3": b.gram[rep].view(np.int64),
                           "bucket": np.full(len(rep), number, np.int32), "rep": np.arange(len(rep), dtype=np.int32),
                           "before": (b.anchor[rep] - b.low[rep]).astype(np.int32), "many": pa.array(count > 1), "content": ta.binary_array(data, cuts)})
        _, distinct, first, _, count = b.windows(hot)
        n = len(distinct)
        strings = pa.table({"part": (distinct % np.uint64(len(splitters) + 1)).astype(np.int32), "k1": distinct.view(np.int64), "k2": leading(b.buf, first), "k3": np.zeros(n, np.int64),
                            "bucket": np.full(n, number, np.int32), "rep": np.arange(n, dtype=np.int32), "before": np.full(n, -1, np.int32),
                            "many": pa.array(count > 1), "content": ta.binary_array(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64))})
        return pa.concat_tables([normal, strings])
    return emit


def multikey_sort(group: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Order of the rows by group and then by their words, one word at a time;
    only rows that tie so far are sorted by the next."""
    order = np.argsort(group, kind="stable")
    rank = np.searchsorted(group[order], group[order])  # first place of each tied group
    for w in range(words.shape[1]):
        tied = np.zeros(len(order), bool)
        equal = rank[1:] == rank[:-1]
        tied[1:] |= equal
        tied[:-1] |= equal
        at = np.flatnonzero(tied)
        if not len(at):
            break
        value = words[order[at], w]
        by = np.lexsort((value, rank[at]))
        order[at], value, before = order[at][by], value[by], rank[at][by]
        new = np.ones(len(at), bool)
        new[1:] = (before[1:] != before[:-1]) | (value[1:] != value[:-1])
        rank[at] = at[np.flatnonzero(new)][np.cumsum(new) - 1]
    return order


def common_prefix(group: np.ndarray, rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row in order shares with the one before; -1 across groups."""
    out = np.full(len(order), -1, np.int32)
    for at in range(1, len(order), 4096):
        a, b = order[at - 1:at + 4095][:len(order) - at], order[at:at + 4096]
        differ = rows[a] != rows[b]
        shared = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
        out[at:at + 4096] = np.where(group[a] == group[b], shared, -1)
    return out


def classes(lcp: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """A number for each row, equal for rows that share ``depth`` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(lcp < depth)
    return out


def compare(group: np.ndarray, before: np.ndarray, many: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each run a bit for every count i of bytes before the anchor: whether
    that string occurs in another run, or the run itself occurs more than once."""
    n = len(group)
    size = np.diff(offsets)
    data = np.append(data, np.uint8(0))
    def window(first, step, width, length):
        at = first[:, None] + step * np.arange(width)
        return np.where(np.arange(width) < length[:, None], data[np.clip(at, 0, len(data) - 1)], 0).astype(np.uint8)
    right = window(offsets[:-1] + before, 1, LENGTH, size - before)
    left = window(offsets[:-1] + before - 1, -1, (SPREAD + 7) // 8 * 8, before)
    r_order = multikey_sort(group, right.view(">u8"))
    l_order = multikey_sort(group, left.view(">u8"))
    r_lcp, l_lcp = common_prefix(group, right, r_order), common_prefix(group, left, l_order)
    # equal runs are compared once
    whole = np.stack([classes(r_lcp, r_order, LENGTH), classes(l_lcp, l_order, left.shape[1]), before, size])
    _, first, inverse, count = np.unique(whole, axis=1, return_index=True, return_inverse=True, return_counts=True)
    inverse = inverse.ravel()
    again = (count > 1) | (np.bincount(inverse, many, len(first)) > 0)
    bits = np.zeros((len(first), SPREAD), bool)
    b0, r0 = before[first], (size - before)[first]
    crowd = np.bincount(classes(r_lcp, r_order, GRAM)[first], minlength=n + 2)
    alone = crowd[classes(r_lcp, r_order, GRAM)[first]] < 2
    for i in range(SPREAD):
        valid = (i <= b0) & (LENGTH - i <= r0)
        bits[valid & again, i] = True
        at = np.flatnonzero(valid & ~alone)
        if len(at) < 2:
            continue
        key = classes(r_lcp, r_order, LENGTH - i)[first[at]] * (n + 2) + classes(l_lcp, l_order, i)[first[at]]
        by = np.argsort(key)
        same = key[by][1:] == key[by][:-1]
        bits[at[by[1:][same]], i] = True
        bits[at[by[:-1][same]], i] = True
    return bits[inverse]


def compared(batches):
    """Answers (bucket, numbers of runs, bits) of one range, which arrives sorted
    by leading bytes and anchor; whole groups of equal ones are compared together."""
    held = None

    def edges(t: pa.Table) -> np.ndarray:
        return np.any([np.diff(t.column(k).to_numpy()) != 0 for k in ("k1", "k2", "k3")], axis=0)

    def answer(t: pa.Table):
        group = np.cumsum(np.concatenate([[False], edges(t)]))
        before, many = t.column("before").to_numpy(), t.column("many").to_numpy()
        bits = np.zeros((t.num_rows, SPREAD), bool)
        for strings in (False, True):
            at = np.flatnonzero((before < 0) == strings)
            if not len(at):
                continue
            if strings:
                times = np.bincount(group[at])
                bits[at, 0] = (times[group[at]] > 1) | many[at]
            else:
                data, offsets = ta.raw(t.column("content").take(pa.array(at)))
                bits[at] = compare(group[at], before[at].astype(np.int64), many[at], data, offsets)
        some = np.flatnonzero(bits.any(1))
        kind, bucket, rep = (before < 0)[some], t.column("bucket").to_numpy()[some], t.column("rep").to_numpy()[some]
        order = np.lexsort((rep, kind, bucket))
        some, kind, bucket, rep = some[order], kind[order], bucket[order], rep[order]
        new = np.flatnonzero((np.diff(bucket, prepend=-1) != 0) | (np.diff(kind.astype(int), prepend=-1) != 0))
        cuts = [*new.tolist(), len(some)]
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[new]), pa.array(kind[new]), pa.array([rep[a:z].tobytes() for a, z in spans], pa.binary()),
             ta.pack([np.packbits(bits[some[a:z]], axis=1).tobytes() for a, z in spans])], names=["bucket", "strings", "reps", "bits"])

    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows < CHUNK_ROWS:
            continue
        edge = np.flatnonzero(edges(held)) + 1
        done = 0
        while done < held.num_rows:  # up to the last edge; its group may go on in the next batch
            to = edge[(edge > done) & (edge <= done + CHUNK_ROWS)]
            to = to[-1:] if len(to) else edge[edge > done][:1]
            if not len(to):
                break
            yield answer(held.slice(done, int(to[0]) - done).combine_chunks())
            done = int(to[0])
        held = held.slice(done)
    if held is not None and held.num_rows:
        yield answer(held.combine_chunks())


def removal(n_shards: int):
    def remove(key: tuple[pa.Scalar, ...], docs: pa.Table, told: pa.Table, found: pa.Table) -> pa.Table:
        b = Bucket(docs)
        cold, hot = told_of(b, told, n_shards)
        run, rep, inverse, _ = b.representatives(cold)
        bits = np.zeros((len(rep), SPREAD), bool)
        start, distinct, _, which, _ = b.windows(hot)
        again = np.zeros(len(distinct), bool)
        for strings, reps, packed in zip(found.column("strings").to_pylist(), found.column("reps").to_pylist(), found.column("bits"), strict=True):
            reps = np.frombuffer(reps, np.int32)
            got = np.unpackbits(ta.unpack(pa.array([packed.as_py()], pa.binary()))[0].reshape(len(reps), BITS), axis=1, count=SPREAD).astype(bool)
            if strings:
                again[reps] = got[:, 0]
            else:
                bits[reps] = got
        at, i = np.nonzero(bits[inverse])
        begin = np.concatenate([b.anchor[run[at]] - i, start[again[which]]])
        depth = np.zeros(len(b.buf) + 1, np.int32)
        np.add.at(depth, begin, 1)
        np.add.at(depth, begin + LENGTH, -1)
        gone = np.cumsum(depth)[:-1] > 0
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inner = b.offsets[:-1][b.offsets[:-1] < len(gone)]
        opens[inner] = gone[inner]
        sums, spans = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(opens)])
        n_removed, n_spans = np.diff(sums[b.offsets]), np.diff(spans[b.offsets])
        sha = []
        for lo, hi, n in zip(b.offsets[:-1], b.offsets[1:], n_removed, strict=True):
            part = b.buf[lo:hi]
            sha.append(hashlib.sha256((part[~gone[lo:hi]] if n else part).tobytes()).hexdigest())
        return pa.table({"doc_id": b.ids, "n_bytes": np.diff(b.offsets), "n_removed": n_removed.astype(np.int64), "n_spans": n_spans.astype(np.int64),
                         "kept_sha256": pa.array(sha, pa.string())})

    def split(key: tuple[pa.Scalar, ...], docs: pa.Table, both: pa.Table) -> pa.Table:
        step = both.column("step").to_numpy()
        return remove(key, docs, both.filter(pa.array(step == 1)), both.filter(pa.array(step == 2)))
    return split


def splitters_of(docs: DataFrame, ranges: int) -> np.ndarray:
    """At most ``ranges`` - 1 leading words that cut a sample of anchors evenly."""
    def run(batches):
        for b in batches:
            buf, offsets = ta.raw(b.column(0))
            for lo, hi in ta.slices(offsets):
                part = buf[offsets[lo]:offsets[hi]]
                _, _, anchor, _, _ = find_runs(part, offsets[lo:hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([pa.array(leading(part, anchor))], names=["k1"])

    if ranges < 2:
        return np.zeros(0, np.int64)
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(run, "k1 bigint")
    shares = [i / ranges for i in range(1, ranges)]
    found = sample.agg(F.percentile_approx("k1", shares, 10_000).alias("q")).first()["q"]
    return np.unique(np.array(found or [], np.int64))


def remove_repeats(docs: DataFrame, hot_above: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``."""
    spark = docs.sparkSession
    width = common.shuffle_width(spark)
    n_shards = 4 * width
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    splitters = splitters_of(docs, width)
    packed = common.packed_buckets(docs, common.bucket_count(docs))
    by_bucket = lambda df: df.groupBy("bucket")
    told = (by_bucket(packed).applyInArrow(gram_questions(n_shards), common.ASK + ", n binary")
            .groupBy("shard").applyInArrow(gram_answers(hot_above), common.ANSWER + ", hot binary"))
    runs = by_bucket(packed).cogroup(by_bucket(told)).applyInArrow(suffix_rows(n_shards, splitters), RUN)
    found = (runs.repartitionById(len(splitters) + 1, F.col("part")).sortWithinPartitions("k1", "k2", "k3")
             .mapInArrow(compared, "bucket int, strings boolean, reps binary, bits binary"))
    null = lambda kind: F.lit(None).cast(kind)
    both = (told.select("bucket", F.lit(1).alias("step"), "shard", "a", "hot", null("boolean").alias("strings"), null("binary").alias("reps"), null("binary").alias("bits"))
            .unionByName(found.select("bucket", F.lit(2).alias("step"), null("int").alias("shard"), null("binary").alias("a"), null("binary").alias("hot"), "strings", "reps", "bits")))
    return by_bucket(packed).cogroup(by_bucket(both)).applyInArrow(removal(n_shards), RESULT)


@query("op1_suffix_array_dedup")
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(common.documents(spark, sf_dir))
