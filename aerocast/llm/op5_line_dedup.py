"""Line deduplication by distributed prefix doubling, in DataFrame functions only.

Every line of every document starts a suffix of the sequence of line ids. Round
by round suffixes are put in classes by their first 1, 2, 4, ... lines: the
class of twice the length is that of a pair of classes, one of them further
down the document by the length so far (the last round overlaps, so any length
is reached). A suffix alone in its class shares no longer prefix with any other
and leaves, so rounds shrink to the repeated text. Left at RUN lines are the
suffixes whose longest common prefix with another is RUN lines or more. Of each
class the earliest place stays; the RUN lines at all later ones are deleted.
Longer repeats are chains of such runs, so their unions, the spans, are the
maximal repeated runs.

Places are ordered by doc_id, then by a hash of the text, then by the number
among rows with equal id and text, then by line. Classes are counted by an
aggregate that combines before the shuffle and joined back, so a line that
fills a third of the rows is split like any skewed join key.

Edge cases: null text has no lines and no digest; the empty text is one empty
line; a text shorter than RUN lines loses nothing; repeated rows are later
copies of the first of them; null ids come last; other columns are ignored; no
rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerocast.llm.common import documents
from aerocast.llm.registry import query

RUN = 3
ROW = ["none", "id", "th", "nth"]  # a row's place among the documents


def hashes(*values: Column) -> list[Column]:
    """Two independent 64-bit hashes."""
    return [F.xxhash64(*values).alias("h1"), F.xxhash64(F.lit(1), *values).alias("h2")]


def _rows(docs: DataFrame) -> DataFrame:
    """Documents with their place; one shuffle of the texts, which later steps share."""
    same = Window.partitionBy("none", "id", "th").orderBy(F.lit(0))
    return (docs.select(F.isnull("doc_id").alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                        F.xxhash64("text").alias("th"), "text")
            .withColumn("nth", F.row_number().over(same)))


def repeated(suffixes: DataFrame) -> DataFrame:
    """The suffixes whose class has other members."""
    several = suffixes.groupBy("h1", "h2").agg(F.count("*").alias("size")).filter("size > 1").select("h1", "h2")
    return suffixes.join(several, ["h1", "h2"], "left_semi")


def classes(lines: DataFrame, run: int) -> DataFrame:
    """(place, pos, h1, h2) of the suffixes whose first ``run`` lines occur elsewhere."""
    length, suffixes = 1, repeated(lines)
    while length < run:
        step = min(length, run - length)
        further = Window.partitionBy(*ROW).orderBy("pos").rangeBetween(step, step)
        pairs = (suffixes.withColumns({"g1": F.first("h1").over(further), "g2": F.first("h2").over(further)})
                 .filter("g1 is not null").select(*ROW, "pos", *hashes("h1", "h2", "g1", "g2")))
        suffixes, length = repeated(pairs), length + step
    return suffixes


def drop_repeated_runs(docs: DataFrame, run: int = RUN) -> DataFrame:
    """doc_id, n_lines, n_removed, n_spans and kept_sha256 of every row of ``docs``."""
    rows = _rows(docs)
    # shorter texts can't hold a run
    lines = rows.filter(F.size(F.split("text", "\n")) >= run).select(*ROW, F.posexplode(F.split("text", "\n")).alias("pos", "line")).select(*ROW, "pos", *hashes("line"))
    found = classes(lines, run)
    place = F.struct(*ROW, "pos")
    earliest = found.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    later = found.join(earliest, ["h1", "h2"]).filter(place != F.col("first"))
    gone = (later.select(*ROW, F.explode(F.sequence("pos", F.col("pos") + run - 1)).alias("pos")).distinct().withColumn("gone", F.lit(True)))
    touched = lines.select(*ROW, "pos").join(gone.select(*ROW).distinct(), ROW, "left_semi").join(gone, [*ROW, "pos"], "left")
    flags = touched.groupBy(*ROW).agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("gone", F.lit(False)).alias("gone")))).alias("flags"))
    text_lines = F.split("text", "\n")
    state = F.struct(F.lit(0).alias("n"), F.lit(False).alias("in"))
    spans = F.aggregate("flags", state, lambda s, x: F.struct(
        (s["n"] + (x["gone"] & ~s["in"]).cast("int")).alias("n"), x["gone"].alias("in")), lambda s: s["n"])
    kept = F.transform(F.filter(F.arrays_zip(text_lines.alias("line"), F.col("flags")), lambda x: ~x["flags"]["gone"]), lambda x: x["line"])
    some = F.col("flags").isNotNull()
    # the texts lie by these three keys already; nth, almost always 1, is compared without shuffling them again
    flags = flags.select(*[F.col(c).alias(f"_{c}") for c in ROW], "flags")
    same = (F.col("none") == F.col("_none")) & (F.col("id") == F.col("_id")) & (F.col("th") == F.col("_th"))
    return (rows.join(flags, same & (F.col("nth") <= F.col("_nth")) & (F.col("nth") >= F.col("_nth")), "left").select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"),
        F.coalesce(F.size(F.when(F.col("text").isNotNull(), text_lines)), F.lit(0)).cast("long").alias("n_lines"),
        F.when(some, F.size(F.filter("flags", lambda x: x["gone"]))).otherwise(0).cast("long").alias("n_removed"),
        F.when(some, spans).otherwise(0).cast("long").alias("n_spans"),
        F.sha2(F.when(some, F.array_join(kept, "\n")).otherwise(F.col("text")), 256).alias("kept_sha256")))


SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
w AS (
  SELECT doc_id, pos, [line, {', '.join(f'lead(line, {k}) OVER d' for k in range(1, RUN))}] AS run, lead(pos, {RUN - 1}) OVER d AS last
  FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
f AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS nth FROM w WHERE last IS NOT NULL),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + {RUN})) AS pos FROM f WHERE nth > 1),
k AS (
  SELECT l.doc_id, l.pos, l.line, g.pos IS NOT NULL AS gone,
         g.pos IS NOT NULL AND lag(g.pos) OVER (PARTITION BY l.doc_id ORDER BY l.pos) IS NULL AS opens
  FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.pos = g.pos),
a AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
  FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM documents d LEFT JOIN a ON d.doc_id = a.doc_id
"""


@query("op5_line_dedup", SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_runs(documents(spark, sf_dir))
