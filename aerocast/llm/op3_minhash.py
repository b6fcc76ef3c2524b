"""Near-duplicate detection by MinHash with tensored banding.

A document's set holds the distinct hashes of its 4-word shingles. Two small
collections of BANDS sub-signatures, HALF minhashes each, are computed; a table
key joins one sub-signature of the first with one of the second, so BANDS
squared tables need only 2 * BANDS * HALF minhashes. Documents with equal sets
are one node from the start (its smallest id). At similarity 0.8 a pair misses
every table with probability 2 * (1 - 0.8**HALF)**BANDS = 2e-4.

Links are confirmed on full sets, made anew from the texts, in two steps.
First every bucket compares its members with its least one, and components are
joined: most copies of a family are found at one comparison per bucket. Then the
members of buckets that still hold several components are dealt, with their
texts, by each of the BANDS sub-signatures of the first collection (a pair at
0.8 shares none with probability 1e-4), and the pairs of a group that lie in
different components are searched whole inside its task: sketches of SKETCH
further minhashes, 8 bits each, are held against each other in blocks, pairs
that agree in MIN_AGREE of them (at 0.8, all but 3e-5 do) are compared on full
sets, and a link joins two components for the rest of the search. So a group
gives at most as many links as it has members, and no list of its pairs is
made. A pair is looked at in the first group only that has it. Groups above
WIDE members are divided by a sub-signature of the second collection, each
member under every one of them.

No task holds a group: its members are dealt to blocks of about BLOCK, a
component above that to blocks of its own, and a task searches two blocks that
hold different components (or one that holds several). So the members of a
large component meet foreign ones only.

Edge cases: a text with fewer than four words is one shingle of all its words;
null texts and texts without words have an empty set and link with nothing;
rows with one id are versions of one document (links of any of them count, each
row is listed); a null id has a null component and is kept; other columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import textarrays as ta
from aerocast.llm.common import documents, written
from aerocast.llm.components import components
from aerocast.llm.registry import query

SHINGLE = 4
VERSION = "xxhash64(cast(doc_id as bigint), text) version"  # rows of one id with different texts are nodes of their own
SHARE = (80, 100)  # 100 * intersection >= 80 * union
BANDS, HALF = 9, 2
HASHES = 2 * BANDS * HALF
SKETCH, MIN_AGREE = 256, 179
WIDE = 10_000
BLOCK = 2048
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_salt = ta.mix(np.arange(1, 2 * (HASHES + SKETCH) + 1, dtype=np.uint64)).reshape(2, -1)
FACTOR, ADD = _salt[0] | np.uint64(1), _salt[1]  # the first HASHES for tables, the others for sketches


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document index, shingle hash), distinct, sorted by document and hash; slice by slice, so
    that many long documents at once need little memory."""
    found = [(lo, *_sets_of_slice(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], k)) for lo, hi in ta.slices(offsets)]
    return (np.concatenate([d + lo for lo, d, _ in found] or [np.zeros(0, np.int64)]),
            np.concatenate([h for *_, h in found] or [np.zeros(0, np.uint64)]))


def _sets_of_slice(buf: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    low = LOWER[buf]
    start, end, doc = ta.word_spans(low, offsets)
    words = ta.Prefix(ta.word_codes(low, start, end))
    first = np.searchsorted(doc, np.arange(len(offsets)))
    h = words.rolling(k)
    inside = doc[:len(h)] == doc[k - 1:k - 1 + len(h)]
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < k))
    h = np.concatenate([h[inside], words.spans(first[few], first[few + 1])])
    d = np.concatenate([doc[:len(inside)][inside], few]).astype(np.uint32)
    order = np.argsort(h)
    order = order[np.argsort(d[order].astype(np.uint16) if len(offsets) < 1 << 16 else d[order], kind="stable")]
    d, h = d[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[new].astype(np.int64), h[new]


def minhashes(d: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One row of HASHES values for each document that occurs in ``d``."""
    first = np.flatnonzero(np.diff(d, prepend=-1))
    out = np.empty((len(first), HASHES), np.uint32)
    for i in range(HASHES if len(first) else 0):
        out[:, i] = np.minimum.reduceat(h * FACTOR[i] + ADD[i], first) >> np.uint64(32)
    return out


def sketches(d: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Low bytes of SKETCH further minhashes of each document that occurs in ``d``."""
    first = np.flatnonzero(np.diff(d, prepend=-1))
    out = np.empty((len(first), SKETCH), np.uint8)
    for i in range(SKETCH if len(first) else 0):
        out[:, i] = (ta.mix(np.minimum.reduceat(h * FACTOR[HASHES + i] + ADD[HASHES + i], first)) & np.uint64(255))
    return out


def sub_signatures(sig: np.ndarray) -> np.ndarray:
    """2 * BANDS codes of HALF minhashes each."""
    out = np.zeros((len(sig), 2 * BANDS), np.uint64)
    for j in range(HALF):
        out = ta.mix(out * np.uint64(ta.R) + sig[:, j::HALF].astype(np.uint64) + np.uint64(j + 1))
    return out


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, version (hash of id and text), n_shingles, s1, s2 (128-bit digest of the set), sig (minhashes, null for empty sets), z (packed text)."""
    def run(batches):
        for b in batches:
            buf, offsets = ta.raw(b.column(1))
            for lo, hi in ta.slices(offsets):
                part, rel = buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                d, h = shingle_sets(part, rel)
                count = np.bincount(d, minlength=hi - lo)
                full = np.flatnonzero(count)
                first = np.flatnonzero(np.diff(d, prepend=-1))
                digest = np.zeros((2, hi - lo), np.uint64)
                if len(first):
                    digest[0, full] = np.add.reduceat(ta.mix(h), first)
                    digest[1, full] = np.add.reduceat(ta.mix(h ^ np.uint64(ta.R)), first)
                sig = np.empty(hi - lo, object)
                for i, row in zip(full, minhashes(d, h), strict=True):
                    sig[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(count.astype(np.int64)), signed(digest[0]), signed(digest[1]),
                     pa.array(sig.tolist(), pa.binary())], names=["doc_id", "version", "n_shingles", "s1", "s2", "sig"])

    return (docs.selectExpr("cast(doc_id as bigint) doc_id", "text", VERSION)
            .mapInArrow(run, "doc_id bigint, version bigint, n_shingles bigint, s1 bigint, s2 bigint, sig binary"))


def _packed(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), ta.pack([(t or "").encode() for t in b.column(1).to_pylist()])], names=["doc_id", "z"])

    return docs.filter("doc_id is not null").selectExpr(VERSION, "text").withColumnRenamed("version", "doc_id").mapInArrow(run, "doc_id bigint, z binary")


def keys_of(sub: np.ndarray) -> np.ndarray:
    """Keys of all tables, table i * BANDS + j in that column."""
    pairs = ta.mix(sub[:, :BANDS])[:, :, None] + sub[:, None, BANDS:]
    return ta.mix(pairs.reshape(len(sub), -1) + np.arange(BANDS * BANDS, dtype=np.uint64) * np.uint64(ta.R))


def table_keys(nodes: DataFrame) -> DataFrame:
    """(key, doc_id): BANDS squared keys of each node, from pairs of sub-signatures."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                keys = keys_of(sub_signatures(np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, HASHES)))
                yield pa.RecordBatch.from_arrays(
                    [signed(keys.ravel()), pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False), BANDS * BANDS))], names=["key", "doc_id"])

    return nodes.select("doc_id", "sig").mapInArrow(run, "key bigint, doc_id bigint")


def pairwise(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether text i of ``left`` and text i of ``right`` (bytes, offsets) are similar enough."""
    n = len(left[1]) - 1
    sets = [shingle_sets(*x) for x in (left, right)]
    d, h = (np.concatenate(x) for x in zip(*sets, strict=True))
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    same = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
    both = np.bincount(d[1:][same], minlength=n)
    either = np.bincount(d, minlength=n) - both
    return (both > 0) & (SHARE[1] * both >= SHARE[0] * either)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                keep = pa.array(pairwise(ta.unpack(part.column(2)), ta.unpack(part.column(3))))
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["a", "b"])

    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("z").alias("zb")), "b")
    with_both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("z").alias("za")), "a")
    return with_both.select("a", "b", "za", "zb").mapInArrow(run, "a bigint, b bigint").distinct()


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Component labels after more links."""
    name = lambda side: labels.select(F.col("doc_id").alias(side), F.col("comp").alias(f"c{side}"))
    between = links.join(name("a"), "a").join(name("b"), "b")
    moved = components(between, "ca", "cb")
    return written(labels.join(moved.withColumnRenamed("node", "comp"), "comp", "left")
                   .select("doc_id", F.coalesce("component", "comp").alias("comp")), "labels")


def mixed(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, comp) of the members of buckets with several components."""
    named = groups.filter("size > 2").join(labels, "doc_id")
    several = named.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x != y").select("key")
    return named.join(several, "key").select("doc_id", "comp").distinct()


def search_groups(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(part, band, third, doc_id, comp): groups of members that share sub-signature
    ``band`` of the first collection, wide ones divided by ``third`` of the second."""
    def sub(batches):
        for b in batches:
            x = sub_signatures(np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint32).reshape(-1, HASHES))
            parts = ta.mix(x[:, :BANDS] + np.arange(BANDS, dtype=np.uint64) * np.uint64(ta.R))
            n = len(x)
            yield pa.RecordBatch.from_arrays(
                [signed(parts.ravel()), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n)),
                 b.column(0).take(pa.array(np.repeat(np.arange(n), BANDS))), b.column(1).take(pa.array(np.repeat(np.arange(n), BANDS))),
                 ta.binary_array(np.repeat(x[:, BANDS:], BANDS, axis=0), np.arange(n * BANDS + 1) * 8 * BANDS)],
                names=["part", "band", "doc_id", "comp", "second"])

    def divide(batches):
        for b in batches:
            part, size = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()
            second = np.frombuffer(b"".join(b.column(4).to_pylist()), np.uint64).reshape(-1, BANDS)
            times = np.where(size > WIDE, BANDS, 1)
            row = np.repeat(np.arange(len(part)), times)
            third = np.where(size[row] > WIDE, np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times), -1)
            finer = ta.mix(part[row] + ta.mix(second[row, third] + third.astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [signed(np.where(third < 0, part[row], finer)), b.column(2).take(pa.array(row)), pa.array(third.astype(np.int32)), b.column(3).take(pa.array(row)), b.column(5).take(pa.array(row))],
                names=["part", "band", "third", "doc_id", "comp"])

    known = members.join(nodes, "doc_id").select("doc_id", "comp", "sig")
    spread = written(known.mapInArrow(sub, "part bigint, band int, doc_id bigint, comp bigint, second binary"), "spread")
    several = (spread.groupBy("part").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("members"))
               .filter("x != y").select("part", "members"))
    return (spread.join(several, "part").select("part", "members", "band", "doc_id", "second", "comp")
            .mapInArrow(divide, "part bigint, band int, third int, doc_id bigint, comp bigint"))


def block_pairs(groups: DataFrame, most: int) -> DataFrame:
    """The members of ``groups`` once for each task (part, x, y) that needs them; ``side``
    is 0 in a block held against itself, else 1 in block x and 2 in block y."""
    sizes = groups.groupBy("part", "comp").agg(F.count("*").alias("n")).withColumn("large", F.col("n") > most)
    parts = (sizes.groupBy("part").agg(F.count("*").alias("comps"), F.ceil(F.sum(F.when(~F.col("large"), F.col("n"))) / most).alias("shared"))
             .filter("comps > 1").drop("comps"))
    # a block is of one large component or shared by small ones
    block = lambda number: F.struct("large", F.when(F.col("large"), F.col("comp")).otherwise(0).alias("whose"), number.cast("long").alias("number"))
    dealt = sizes.join(parts, "part").withColumn("blocks", F.when(F.col("large"), F.ceil(F.col("n") / most)).otherwise(F.col("shared")))
    blocks = (dealt.filter("large").select("part", "large", "comp", "blocks")
              .unionByName(parts.filter("shared > 0").select("part", F.lit(False).alias("large"), F.lit(0).cast("long").alias("comp"), F.col("shared").alias("blocks")))
              .withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("part", block(F.col("number")).alias("x")))
    pairs = (blocks.join(blocks.withColumnRenamed("x", "y"), "part")
             .filter("x < y and not (x.large and y.large and x.whose = y.whose) or x = y and not x.large"))
    ends = (pairs.withColumn("block", F.explode(F.array_distinct(F.array("x", "y"))))
            .withColumn("side", F.when(F.col("x") == F.col("y"), 0).when(F.col("block") == F.col("x"), 1).otherwise(2)))
    number = F.pmod(F.when(F.col("large"), F.xxhash64("doc_id")).otherwise(F.xxhash64("comp")), F.col("blocks"))
    return (groups.join(dealt.select("part", "comp", "large", "blocks"), ["part", "comp"])
            .select("part", "band", "third", "doc_id", "comp", block(number).alias("block"))
            .join(ends, ["part", "block"]).drop("block"))


def linked_in_blocks(table: pa.Table) -> pa.Table:
    """Links between the components of two blocks or one, one for each two that it joins."""
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    comp, side = table.column("comp").to_numpy(), table.column("side").to_numpy()
    order = np.lexsort((comp, side))  # members of one component lie together
    table, comp, side = table.take(pa.array(order)), comp[order], side[order]
    ids, n, step = table.column("doc_id").to_numpy(), table.num_rows, 256
    if side[0]:
        half = int((side == 1).sum())
        tiles = [(i, min(i + step, half), j, min(j + step, n)) for i in range(0, half, step) for j in range(half, n, step)]
    else:
        tiles = [(i, min(i + step, n), j, min(j + step, n)) for i in range(0, n, step) for j in range(i, n, step)]
    tiles = [t for t in tiles if not comp[t[0]] == comp[t[1] - 1] == comp[t[2]] == comp[t[3] - 1]]
    if not tiles:
        return none
    band, third = int(table.column("band")[0].as_py()), int(table.column("third")[0].as_py())
    sub, sketch, sets = np.empty((n, 2 * BANDS), np.uint64), np.empty((n, SKETCH), np.uint8), []
    for at in range(0, n, 256):
        d, h = shingle_sets(*ta.unpack(table.column("z").slice(at, 256)))
        sub[at:at + 256], sketch[at:at + 256] = sub_signatures(minhashes(d, h)), sketches(d, h)
        sets += np.split(h, np.flatnonzero(np.diff(d)) + 1)
    _, root = np.unique(comp, return_inverse=True)
    root = root.tolist()

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    home = list(root)  # a member's component, an entry of root after the next line
    root = list(range(max(home) + 1))
    a, b = [], []
    for i, i_end, j, j_end in tiles:
        agree = np.zeros((i_end - i, j_end - j), np.uint16)
        for k in range(SKETCH):
            agree += sketch[i:i_end, None, k] == sketch[None, j:j_end, k]
        x, y = np.nonzero((agree >= MIN_AGREE) & (comp[i:i_end, None] != comp[None, j:j_end]))
        likely = np.argsort(-agree[x, y].astype(np.int64), kind="stable")
        x, y = x[likely] + i, y[likely] + j
        keep = x < y
        equal = sub[x] == sub[y]
        keep &= equal[:, :BANDS].argmax(1) == band
        if third >= 0:
            keep &= equal[:, BANDS:].argmax(1) == third
        for p, q in zip(x[keep].tolist(), y[keep].tolist(), strict=True):
            u, v = top(home[p]), top(home[q])
            if u == v:
                continue
            small, large = sorted((sets[p], sets[q]), key=len)
            at = np.searchsorted(large, small)
            both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            if SHARE[1] * both >= SHARE[0] * (len(small) + len(large) - both):
                root[max(u, v)] = min(u, v)
                a.append(ids[p])
                b.append(ids[q])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    base = written(signatures(docs), "minhash")
    sets = (base.filter("n_shingles > 0 and doc_id is not null")
            .groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("node")))
    nodes = written(base.filter("n_shingles > 0").join(sets.select(F.col("node").alias("doc_id"), "s1", "s2", "n_shingles"), ["doc_id", "s1", "s2", "n_shingles"])
                    .dropDuplicates(["doc_id", "s1", "s2"]).select(F.col("version").alias("doc_id"), F.col("doc_id").alias("id"), "sig"), "nodes")
    keys = table_keys(nodes)
    # nearly all keys are alone: the first shuffle carries the key and its count only
    buckets = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    groups = written(keys.join(buckets, "key"), "buckets")
    centres = groups.groupBy("key").agg(F.min("doc_id").alias("centre"))
    labels = written(groups.select("doc_id").distinct().withColumn("comp", F.col("doc_id")), "labels")
    texts = written(_packed(docs).join(labels.select("doc_id"), "doc_id", "left_semi"), "texts")
    pairs = groups.join(centres, "key").filter("centre != doc_id").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()
    labels = joined(labels, confirmed(pairs, texts))
    members = written(mixed(groups, labels), "mixed")
    dealt = block_pairs(written(search_groups(members, nodes), "groups"), BLOCK)
    searched = (dealt.join(texts.select("doc_id", "z"), "doc_id").groupBy("part", "x", "y")
                .applyInArrow(linked_in_blocks, "a bigint, b bigint"))
    labels = joined(labels, searched.distinct())
    same = base.filter("n_shingles > 0 and doc_id is not null").join(sets, ["s1", "s2", "n_shingles"]).select("doc_id", "node").distinct()
    links = (same.filter("doc_id != node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
             .unionByName(labels.filter("doc_id != comp").join(nodes.select("doc_id", F.col("id").alias("a")), "doc_id")
                          .join(nodes.select(F.col("doc_id").alias("comp"), F.col("id").alias("b")), "comp").select("a", "b")))
    whole = components(links, "a", "b").withColumnRenamed("node", "doc_id")
    return (base.select("doc_id", "n_shingles").join(whole, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document stays, all columns unchanged."""
    gone = near_components(docs).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) BETWEEN 1 AND 3 THEN [array_to_string(ws, ' ')]
             ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (max(a.n) + max(b.n) - count(*))),
c AS (SELECT doc_id AS node, doc_id AS reach FROM documents UNION SELECT c.node, l.b FROM c JOIN l ON l.a = c.reach)
SELECT s.doc_id, len(sh) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM s JOIN (SELECT node, min(reach) AS component_id FROM c GROUP BY node) m ON s.doc_id = m.node
"""


@query("op3_minhash_near_dedup", SQL)
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir))
