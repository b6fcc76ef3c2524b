"""Small document tables for the operators' tests: edge cases, ties, repeated
rows, clashing column names, and a slice of the given tables."""

import random

from pyspark.sql import types as T

from conftest import SF_SMALL

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def table(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in pairs], DOCS)


def edge_pairs(seed=3, words=None):
    """Texts with nulls, blanks, copies, near copies, shared passages, periodic
    and very long ones, many scripts, and a hot group of copies."""
    rng = random.Random(seed)
    vocab = words or [f"w{i}" for i in range(400)] + ["é", "Ünïcode", "日本", "ß", "it's", "don't", "x,y"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base, passage, long = say(180), say(70), say(3000)
    texts = [None, "", "   ", "\t\n", "one", "two words", base, base, base + " ", base.replace(" ", "\n", 3), base.upper()]
    for k in range(12):  # near copies
        w = base.split(" ")
        for _ in range(k % 5):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(" ".join(w))
    for _ in range(8):
        texts.append(say(rng.randrange(1, 60)) + " " + passage + "\n" + say(rng.randrange(1, 40)))
    texts += [long, long[:9000] + say(40) + long[9000:], "a " * 600, "ab" * 700, "a" * 900, "\0\0" + base, say(40) + "<|endoftext|>" + say(3)]
    texts += ["hot copy " + passage] * 25 + [say(rng.randrange(1, 90)) for _ in range(15)]
    return list(enumerate(texts))


def with_ties(pairs):
    """Adds repeated rows and null ids."""
    return [*pairs, pairs[6], pairs[8], (None, pairs[6][1]), (None, None)]


def small(spark, n=None):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return docs if n is None else docs.limit(n)


def odd_columns(docs):
    """Extra columns whose names an operator may use inside."""
    from pyspark.sql import functions as F
    for c in ("bucket", "shard", "kept", "key", "n", "score", "component_id", "row", "z", "fp"):
        docs = docs.withColumn(c, F.lit("x"))
    return docs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
