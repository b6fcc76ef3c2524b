"""LM scoring by a probabilistic suffix tree.

Symbols are words (A-Z lower-cased) and one end per document; a begin symbol
stands before each document and is never predicted. States of the tree are
contexts of 0 to DEPTH symbols. A context is a candidate if it occurs at least
LEAST times in the training documents, and is retained if its next-symbol
counts diverge from those of its suffix (the context without its first
symbol): the likelihood gain ``N * KL(context || suffix)``, in nats, must be at
least PENALTY for each distinct next symbol. A description of the distribution
that costs more than it explains is not kept, so contexts have variable length.

The distribution of a state ``s`` with ``N`` occurrences and ``T`` distinct
next symbols is smoothed by that of its longest retained proper suffix ``s'``:
``P(x|s) = (c(s,x) + T * P(x|s')) / (N + T)``; the root has
``(c(x) + 0.5) / (N + 0.5 * (V + 1))``, 0.5 of it for each unseen word. Each
symbol is scored at the longest suffix of its history that is a state.
Divergences are rounded to 1/1024 nat per next symbol, so that sums don't
depend on their order.

Everything is counted over all training documents: chunks of documents (see
``chunks``) ask for the counts of their n-grams, level by level; the first
chunk that holds an n-gram adds its share to the divergence of the context.
Words and n-grams are told apart by 64-bit hashes.

Edge cases: null and empty texts have one token, the end; a null id counts as
the empty text for the choice of training documents; repeated rows count as
often as they occur; without training documents N and V are 0 and every token
has probability 1; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import chunks as ch
from aerocast.llm import common
from aerocast.llm import textarrays as ta
from aerocast.llm.registry import query

DEPTH = 2
LEAST = 8
PENALTY = 6.0
UNIT = 1024.0
END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CHUNK = "chunk bigint, ids array<bigint>, held array<boolean>, ends binary, vocab binary, tokens binary"
RESULT = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def chunked(docs: DataFrame) -> DataFrame:
    """The documents as chunks of numbered words, each with its begin and end."""

    def form(batches):
        for number, table in ch.batches_of(batches):
            buf, offsets = ta.raw(table.column("text"))
            found = [(doc, code) for _, _, doc, code in ta.word_blocks(LOWER[buf], offsets)]
            doc = np.concatenate([d for d, _ in found] or [np.zeros(0, np.int64)])
            n = len(table)
            stream = np.full(len(doc) + 2 * n, END)
            ends = np.cumsum(np.bincount(doc, minlength=n) + 2)
            stream[np.append(0, ends[:-1])] = BEGIN
            stream[np.arange(len(doc)) + 2 * doc + 1] = np.concatenate([c for _, c in found] or [np.zeros(0, np.uint64)])
            vocab, tokens = np.unique(stream, return_inverse=True)
            ids = table.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([number], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())),
                "held": pa.array([[held_out(i) for i in ids]], pa.list_(pa.bool_())),
                "ends": pa.array([ch.packed_sorted(ends)], pa.binary()), "vocab": pa.array([ch.packed_sorted(vocab)], pa.binary()),
                "tokens": pa.array([ch.packed(tokens.astype(np.uint32))], pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(form, CHUNK)


def word_step(k: int) -> int:
    """Steps of the sums: 0 words, 2k - 1 n-grams of k + 1 symbols, 2k contexts of k symbols."""
    return 2 * k - 1 if k else 0


class Chunk:
    """One chunk with the totals told so far."""

    def __init__(self, row: pa.Table, told: pa.Table | None = None):
        self.number = row.column("chunk")[0].as_py()
        self.ids, held = row.column("ids")[0].as_py(), row.column("held")[0].as_py()
        self.held = np.array(held, bool)
        self.ends = ch.unpacked_sorted(row.column("ends")[0].as_py(), np.int64)
        self.vocab = ch.unpacked_sorted(row.column("vocab")[0].as_py(), np.uint64)
        self.tokens = ch.unpacked(row.column("tokens")[0].as_py(), np.uint32)
        lengths = np.diff(self.ends, prepend=0)
        self.doc = np.repeat(np.arange(len(self.ids)), lengths)
        self.place = np.arange(len(self.tokens)) - np.repeat(self.ends - lengths, lengths)
        self.train = ~self.held[self.doc]
        self.told = told

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens, self.train, len(self.vocab)).astype(np.int64)

    def levels(self, n_tokens: int, depth: int, least: int):
        """For each level whose words' totals are known: (k, positions, position among the distinct
        n-grams, distinct n-grams, counts, marks of the first), and lastly the level to ask for."""
        self.hash = self.vocab[self.tokens]
        self.count = ch.totals(self.told, 0)[0][0][self.tokens]
        self.log_parent = None
        gram, count, total = self.hash, self.count, np.full(len(self.tokens), n_tokens)
        for k in range(1, depth + 1):
            # context of k symbols: the n-gram that ends just before
            context, times = np.roll(gram, 1), np.roll(count, 1)
            at = np.flatnonzero((self.place >= k) & (times >= least))
            gram = ta.mix(context * np.uint64(ta.R) + self.hash + np.uint64(k))
            distinct, first, inverse = np.unique(gram[at], return_index=True, return_inverse=True)
            level = {"k": k, "at": at, "context": context[at], "N": times[at], "grams": distinct, "first": at[first],
                     "inverse": inverse, "parent": count, "parent_total": total}
            sums, mine = ch.totals(self.told, word_step(k))
            if sums or not len(at):
                c = sums[0] if sums else np.zeros(0, np.int64)
                level |= {"counts": c, "mine": mine}
                total, count = times, np.zeros(len(self.tokens), np.int64)
                count[at] = c[inverse]
                yield level
            else:
                yield level
                return

    def ask_level(self, level: dict, n_shards: int) -> pa.Table:
        times = np.bincount(level["inverse"], self.train[level["at"]], len(level["grams"])).astype(np.int64)
        return ch.questions(self.number, word_step(level["k"]), level["grams"], [times], n_shards)

    def contexts(self, level: dict) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(level["context"], return_inverse=True)

    def ask_contexts(self, level: dict, n_shards: int) -> pa.Table:
        """Distinct next symbols and divergence from the suffix, of the n-grams that this chunk is the first to hold."""
        contexts, of = self.contexts(level)
        place = np.zeros(len(self.tokens), np.int64)
        place[level["at"]] = of
        own = level["mine"] & (level["counts"] > 0)
        at, c = level["first"][own], level["counts"][own].astype(float)
        n = np.zeros(len(self.tokens), np.int64)
        n[level["at"]] = level["N"]
        gain = c * (np.log(c / n[at]) - np.log(level["parent"][at] / level["parent_total"][at]))
        which = place[at]
        types = np.bincount(which, minlength=len(contexts)).astype(np.int64)
        return ch.questions(self.number, 2 * level["k"], contexts, [types, np.bincount(which, np.rint(gain * UNIT), len(contexts)) + 0.0], n_shards)

    def scores(self, n_tokens: int, n_types: int, depth: int, least: int, penalty: float) -> pa.Table:
        levels = list(self.levels(n_tokens, depth, least))
        p = (self.count + 0.5) / (n_tokens + 0.5 * (n_types + 1))
        base = np.log10(p)
        for level in levels:
            at = level["at"]
            if not len(at):
                continue
            (types, gain), _ = ch.totals(self.told, 2 * level["k"])
            of = self.contexts(level)[1]
            kept = (types > 0) & (gain >= penalty * UNIT * types)
            at_kept = kept[of]
            i, t = at[at_kept], types[of[at_kept]]
            p[i] = (level["counts"][level["inverse"][at_kept]] + t * p[i]) / (level["N"][at_kept] + t)
        real = self.place > 0
        n = len(self.ids)
        add = lambda v: np.bincount(self.doc[real], v[real], n)
        return pa.table({"doc_id": pa.array(self.ids, pa.int64()), "held_out": pa.array(self.held),
                         "n_tokens": np.bincount(self.doc[real], minlength=n), "n_known": add(self.count > 0).astype(np.int64),
                         "train_tokens": np.full(n, n_tokens), "base_score": add(base), "score": add(np.log10(p))})


def tree_scores(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, penalty: float = PENALTY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    table = common.written(chunked(docs), "chunks")
    n_shards = ch.shard_count(table)

    def ask_words(batches):
        for b in batches:
            for i in range(b.num_rows):
                c = Chunk(pa.Table.from_batches([b.slice(i, 1)]))
                yield from ch.questions(c.number, 0, c.vocab, [c.word_counts()], n_shards).to_batches()

    def sizes(hashes, sums):
        words = hashes != BEGIN
        return {"n_types": int((sums[0][words] > 0).sum()), "n_words": int(sums[0][words].sum())}

    told = common.written(ch.summed(table.mapInArrow(ask_words, ch.ASK), sizes, ", n_types bigint, n_words bigint"), "words")
    whole = told.dropDuplicates(["shard"]).agg(F.sum("n_types").alias("v"), F.sum("n_words").alias("n")).first()
    n_types, n_tokens = whole["v"] or 0, whole["n"] or 0
    told = told.select(*[c.split()[0] for c in ch.TOLD.split(", ")])

    def ask_level(k: int):
        def run(key, row, told):
            c = Chunk(row, told)
            asked = [ch.questions(c.number, 0, c.vocab[:0], [], n_shards)]  # no rows
            for level in c.levels(n_tokens, min(k, depth), least):
                if level["k"] == k - 1:
                    asked.append(c.ask_contexts(level, n_shards))
                elif level["k"] == k:
                    asked.append(c.ask_level(level, n_shards))
            return pa.concat_tables(asked)
        return run

    def score(key, row, told):
        return Chunk(row, told).scores(n_tokens, n_types, depth, least, penalty)

    meet = lambda: table.groupBy("chunk").cogroup(told.groupBy("chunk"))
    for k in range(1, depth + 2):
        told = told.unionByName(common.written(ch.summed(meet().applyInArrow(ask_level(k), ch.ASK)), f"level{k}"))
    return meet().applyInArrow(score, RESULT)


@query("op11_suffix_tree_scores")
def op11_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_scores(common.documents(spark, sf_dir))
