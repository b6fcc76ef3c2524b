"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A encodes blank + text by a byte-level BPE, B the text by a piece BPE that adds
the blank itself. Both cut the same bytes, so token ends are byte offsets that
can be joined. Inside a task this is an Arrow pipeline over many documents:

* token lists are flattened, parent indices name the documents, and cumulative
  sums over the token lengths, restarted at each document by its own start,
  give the end offset of each token;
* an Acero full outer join of both token tables on (document, end) orders all
  ends. Each stretch between two neighbouring ends belongs to one token of A
  and one of B, found by filling the joined columns backwards; so the stretches
  are the links. Ends that both sides have close the groups;
* ``Table.group_by`` counts the links of each pair of ids, per document and per
  chunk; Spark adds the chunks' partial counts by shards (see ``chunks``; the
  pair is kept inside its hash, so these sums are exact) and the largest count
  for each id of B, a table bounded by B's vocabulary, which is sent back whole.

Equal texts of a chunk are encoded once. Files of the vocabularies are read by
the driver and sent along. For A, merges are run by ``tiktoken`` where the file
proves to be a plain byte-level BPE whose ids are its merge ranks; other files,
and texts that it gives up on (very long white space), go through
``tokenizers``.

Edge cases: null and empty texts, and texts whose tokens don't spell blank +
text byte by byte, have no tokens: zeros and an empty ``groups_sha256``; they
count in no pair. Strings of special tokens are plain text. Null ids and
repeated rows get a row each and count each; other columns are ignored; no rows
give no rows.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import chunks as ch
from aerocast.llm import common
from aerocast.llm import textarrays as ta
from aerocast.llm.registry import query

SLICE_BYTES = 1 << 20  # of text in one Arrow join
# fixed value: the published pattern of byte-level pre-tokenizers
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK = ("chunk bigint, ids array<bigint>, text_of array<int>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
         "groups_sha256 array<string>, pairs binary, times binary, doc_pairs binary, doc_times binary, doc_sizes binary")
RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 characters stand for themselves, the others for 256, 257, ..."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class SideA:
    """A ``tokenizers`` file with byte-level tokens."""

    def __init__(self, spec: str):
        self.tok = tokenizers.Tokenizer.from_str(spec)
        self.tok.encode_special_tokens = True
        self.tok.no_truncation()
        self.tok.no_padding()
        told, table = json.loads(spec), byte_level()
        vocab = told["model"]["vocab"]
        self.bytes = [b""] * self.tok.get_vocab_size()
        for token, i in vocab.items():
            self.bytes[i] = bytes(table[c] for c in token)
        self.fast = None
        pre = told["pre_tokenizer"] or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        plain = (told["model"]["type"] == "BPE" and not told["normalizer"] and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space") and not told["model"].get("dropout") and not told["model"].get("ignore_merges")
                 and not told["model"].get("continuing_subword_prefix") and not told["model"].get("end_of_word_suffix")
                 and len(vocab) == 256 + len(merges) and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
                 and all(vocab.get(c, 256) < 256 for c in table))
        if plain:
            ranks = {b: i for i, b in enumerate(self.bytes[:len(vocab)])}
            self.fast = tiktoken.Encoding("side_a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _one(self, text: str) -> list[int]:
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as e:  # the regular expression's stack; a panic of the library, not an Exception
            if type(e).__name__ != "PanicException":
                raise
            return self.tok.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return [self._one(t) for t in texts]


class SideB:
    """A ``sentencepiece`` model with byte pieces."""

    def __init__(self, model: bytes):
        self.tok = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.tok.get_piece_size()
        self.bytes = [b"" if self.tok.is_control(i) or self.tok.is_unknown(i) else
                      bytes([int(self.tok.id_to_piece(i)[3:5], 16)]) if self.tok.is_byte(i) else
                      self.tok.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.tok.encode(texts, num_threads=1)


class Tokens:
    """The tokens of one side over the documents of a slice, as flat columns."""

    def __init__(self, lists: list[list[int]], spelled: pa.Array, sizes: pa.Array, names: pa.Array):
        nested = pa.array(lists, pa.list_(pa.int32()))
        self.id, self.doc = pc.list_flatten(nested), pc.list_parent_indices(nested)
        self.size = pc.take(sizes, self.id)
        self.names, self.spelled = names, spelled
        self.count = pc.list_value_length(nested).to_numpy()
        ends = pc.cumulative_sum(self.size).to_numpy()
        self.bytes_of = np.diff(np.append(0, ends)[np.append(0, np.cumsum(self.count))])
        # the cumulative sum restarts at each document
        starts = np.cumsum(self.bytes_of) - self.bytes_of
        self.end = pa.array(ends - starts[self.doc.to_numpy()])

    def spells(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether the tokens of each document are its bytes ``buf[offsets[i]:offsets[i + 1]]``."""
        ok = self.bytes_of == np.diff(offsets)
        data, _ = ta.raw(pc.take(self.spelled, pc.filter(self.id, pa.array(ok[self.doc.to_numpy()]))))
        want = buf if ok.all() else buf[np.repeat(ok, np.diff(offsets))]
        wrong = np.flatnonzero(data != want)
        if len(wrong):
            docs = np.flatnonzero(ok)
            ends = np.cumsum(np.diff(offsets)[docs])
            ok[docs[np.unique(np.searchsorted(ends, wrong, side="right"))]] = False
        return ok

    def table(self, side: str) -> pa.Table:
        return pa.table({"doc": self.doc, "end": self.end, side: self.id, f"{side}_at": pa.array(np.arange(len(self.id)))})


def grouped_text(side: Tokens, last: np.ndarray) -> pa.Array:
    """For each group, the decimal ids of one side joined by commas; ``last`` is the place of each group's last token."""
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, last + 1), pa.int32()), pc.take(side.names, side.id))
    return pc.binary_join(lists, ",")


def aligned(texts: list[str], a: SideA, b: SideB, columns: dict) -> dict:
    """Per text: tokens, groups and digest; and the links of each pair of ids, per text."""
    n = len(texts)
    spaced = [" " + t for t in texts]
    want = pa.array(spaced, pa.large_string())
    buf, offsets = ta.raw(want)
    lists_a, lists_b = a.encode(spaced), b.encode(texts)
    side_a, side_b = (Tokens(x, *columns[k]) for k, x in (("a", lists_a), ("b", lists_b)))
    good = side_a.spells(buf, offsets) & side_b.spells(buf, offsets) & (np.diff(offsets) > 1)
    if not good.all():
        lists_a = [x if g else [] for x, g in zip(lists_a, good.tolist(), strict=True)]
        lists_b = [x if g else [] for x, g in zip(lists_b, good.tolist(), strict=True)]
        side_a, side_b = (Tokens(x, *columns[k]) for k, x in (("a", lists_a), ("b", lists_b)))
    ends = side_a.table("a").join(side_b.table("b"), ["doc", "end"], join_type="full outer", use_threads=False)
    key = pc.add(pc.multiply(pc.cast(ends.column("doc"), pa.int64()), int(np.diff(offsets).max(initial=0)) + 1), ends.column("end"))
    ends = ends.take(pc.array_sort_indices(key))
    both = ends.filter(pc.and_(pc.is_valid(ends.column("a_at")), pc.is_valid(ends.column("b_at"))))
    last_a, last_b, doc = (both.column(c).to_numpy() for c in ("a_at", "b_at", "doc"))
    groups = pc.binary_join_element_wise(grouped_text(side_a, last_a), grouped_text(side_b, last_b), "|")
    n_groups = np.bincount(doc, minlength=n)
    spelled = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_groups)), pa.int32()), groups), ";").to_pylist()
    pair = pc.add(pc.multiply(pc.cast(pc.fill_null_backward(ends.column("a")), pa.int64()), len(b.bytes)),
                  pc.cast(pc.fill_null_backward(ends.column("b")), pa.int64()))
    links = pa.table({"doc": ends.column("doc"), "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    return {"n_a": side_a.count, "n_b": side_b.count, "n_groups": n_groups,
            "sha": [hashlib.sha256(s.encode()).hexdigest() if g else "" for s, g in zip(spelled, good.tolist(), strict=True)],
            "links": links}


def pair_hash(pair: np.ndarray) -> np.ndarray:
    """32 mixed bits, then the pair's 32 bits themselves: spread by value and exact."""
    p = pair.astype(np.uint64)
    return (ta.mix(p) >> np.uint64(32) << np.uint64(32)) | p


def chunked(docs: DataFrame, spec_a, spec_b) -> DataFrame:
    """Documents as chunks with their groups' digests and the links of each pair of ids.

    ``spec_a`` and ``spec_b`` are broadcast variables of the two files' contents."""

    def form(batches):
        a, b = SideA(spec_a.value), SideB(spec_b.value)
        if len(a.bytes) * len(b.bytes) > 1 << 32:
            raise ValueError("pairs of ids must fit in 32 bits")
        columns = {k: (pa.array(s.bytes, pa.large_binary()), pa.array([len(x) for x in s.bytes], pa.int64()), pa.array([str(i) for i in range(len(s.bytes))]))
                   for k, s in (("a", a), ("b", b))}
        for number, table in ch.batches_of(batches):
            told = pc.fill_null(table.column("text"), "").combine_chunks().dictionary_encode()
            texts, text_of = told.dictionary.to_pylist(), told.indices.to_numpy()
            found = {"n_a": [], "n_b": [], "n_groups": [], "sha": []}
            docs_of, pairs, counts = [], [], []
            sizes = np.append(0, np.cumsum([len(t) + 1 for t in texts]))
            for lo, hi in ta.slices(sizes, SLICE_BYTES):
                got = aligned(texts[lo:hi], a, b, columns)
                for k in found:
                    found[k].extend(got[k])
                docs_of.append(got["links"].column("doc").to_numpy().astype(np.int64) + lo)
                pairs.append(got["links"].column("pair").to_numpy())
                counts.append(got["links"].column("count_all").to_numpy())
            doc, pair, count = (np.concatenate(x) for x in (docs_of, pairs, counts))
            hashes, of = np.unique(pair_hash(pair), return_inverse=True)
            order = np.lexsort((of, doc))
            doc, of, count = doc[order], of[order], count[order]
            rows_of = np.bincount(text_of, minlength=len(texts))
            partial = pa.table({"pair": of, "links": count * rows_of[doc]}).group_by("pair", use_threads=False).aggregate([("links", "sum")])
            times = np.zeros(len(hashes), np.int64)
            times[partial.column("pair").to_numpy()] = partial.column("links_sum").to_numpy()
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([number], pa.int64()), "ids": pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                "text_of": pa.array([text_of.tolist()], pa.list_(pa.int32())),
                **{k: pa.array([[int(x) for x in found[k]]], pa.list_(pa.int64())) for k in ("n_a", "n_b", "n_groups")},
                "groups_sha256": pa.array([found["sha"]], pa.list_(pa.string())),
                "pairs": pa.array([ch.packed_sorted(hashes)], pa.binary()), "times": pa.array([ch.numbers(times)], pa.binary()),
                "doc_pairs": pa.array([ch.packed(of.astype(np.uint32))], pa.binary()), "doc_times": pa.array([ch.numbers(count)], pa.binary()),
                "doc_sizes": pa.array([ch.numbers(np.bincount(doc, minlength=len(texts)))], pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(form, CHUNK)


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Tokens, groups and links of every row of ``docs``; see RESULT."""
    spark = docs.sparkSession
    with open(path_a, encoding="utf-8") as f:
        spec_a = spark.sparkContext.broadcast(f.read())
    with open(path_b, "rb") as f:
        model = f.read()
    spec_b = spark.sparkContext.broadcast(model)
    n_b = sentencepiece.SentencePieceProcessor(model_proto=model).get_piece_size()
    table = common.written(chunked(docs, spec_a, spec_b), "aligned")
    n_shards = ch.shard_count(table)

    def ask(batches):
        for batch in batches:
            for r in batch.select(["chunk", "pairs", "times"]).to_pylist():
                yield from ch.questions(r["chunk"], 1, ch.unpacked_sorted(r["pairs"], np.uint64), [ch.to_numbers(r["times"])], n_shards).to_batches()

    told = common.written(ch.summed(table.select("chunk", "pairs", "times").mapInArrow(ask, ch.ASK)), "pairs")

    def id_b(pairs: bytes) -> np.ndarray:
        return ((ch.unpacked_sorted(pairs, np.uint64) & np.uint64(0xFFFFFFFF)) % np.uint64(n_b)).astype(np.int64)

    def largest(key, row, told):
        """The largest count of each id of B among the pairs of a chunk."""
        sums, _ = ch.totals(told, 1)
        top = np.zeros(n_b, np.int64)
        if sums:
            np.maximum.at(top, id_b(row.column("pairs")[0].as_py()), sums[0])
        at = np.flatnonzero(top)
        return pa.table({"b": at, "n": top[at]})

    # one row for each id of B at most
    per_b = (table.select("chunk", "pairs").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(largest, "b bigint, n bigint")
             .groupBy("b").agg(F.max("n").alias("n")).collect())
    best = np.zeros(n_b, np.int64)
    best[[r["b"] for r in per_b]] = [r["n"] for r in per_b]
    sent = spark.sparkContext.broadcast(best)

    def score(key, row, told):
        r = row.to_pylist()[0]
        sums, _ = ch.totals(told, 1)
        count = sums[0] if sums else np.zeros(0, np.int64)
        of, times = ch.unpacked(r["doc_pairs"], np.uint32), ch.to_numbers(r["doc_times"])
        sizes = ch.to_numbers(r["doc_sizes"])
        is_best = count == sent.value[id_b(r["pairs"])]
        ends = np.append(0, np.cumsum(sizes))
        add = lambda v: np.diff(np.append(0, np.cumsum(v))[ends])
        per_text = {"n_a": np.array(r["n_a"], np.int64), "n_b": np.array(r["n_b"], np.int64), "n_groups": np.array(r["n_groups"], np.int64),
                    "n_links": add(times), "n_best": add(times * is_best[of]), "count_sum": add(times * count[of])}
        text_of = np.array(r["text_of"], np.int64)
        return pa.table({"doc_id": pa.array(r["ids"], pa.int64()), **{k: v[text_of] for k, v in per_text.items()},
                         "groups_sha256": pa.array([r["groups_sha256"][i] for i in r["text_of"]], pa.string())})

    meet = table.drop("times").groupBy("chunk").cogroup(told.groupBy("chunk"))
    return meet.applyInArrow(score, RESULT)


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(common.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
