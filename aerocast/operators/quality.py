"""Contract checks on observation batches (V1-V6), as rows or as a gate.

Per-row flags are column expressions, duplicates an aggregate on ``(key, ts)``,
arrival order a chunked positional lag over ``seq``. ``report`` counts flags per
key. The gate comes in three forms, all with the same rules and first error:

* ``enforce`` checks at once (one scan; arrival order, where asked, a second);
* ``observed`` checks inside the job that reads the rows anyway: the counts are
  metrics of that job, and ``Gate.check`` raises when it has ended;
* ``guarded`` checks inside a lazy plan: a row that breaks a rule stops the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocast.contract import FEATURE_COLUMNS, RAW_FEATURES, DataQualityError, require_observation_columns
from aerocast.functions import try_number
from aerocast.operators.ordered import shifted

RULES = ("invalid_timestamp", "duplicate_timestamp", "out_of_order", "invalid_value", "negative_value")
REASONS = {
    "absent_key": "{n} rows have no key",
    "invalid_timestamp": "{n} rows have a time that is absent or not a time",
    "duplicate_timestamp": "{n} rows share their key and time; times must be unique per key",
    "out_of_order": "{n} rows arrive after a later one; arrival must be chronological",
    "invalid_value": "{column} is absent or not a number in {n} rows",
    "negative_value": "{column} is negative in {n} rows",
}


def value_columns(require_aqi: bool = True) -> list[str]:
    return [*RAW_FEATURES, "aqi"] if require_aqi else list(RAW_FEATURES)


def coerce(df: DataFrame, *, ts: str = "timestamp", require_aqi: bool = True) -> DataFrame:
    """Timestamps parsed (naive = UTC), numbers coerced; bad values -> NULL."""
    require_observation_columns(df.columns, require_aqi=require_aqi, ts_col=ts)
    t = df.schema[ts].dataType
    ts_col = F.col(ts) if isinstance(t, T.TimestampType) else F.try_to_timestamp(F.col(ts).cast("string"))
    return df.withColumns({ts: ts_col, **{c: try_number(c) for c in value_columns(require_aqi)}})


def flag_rows(df: DataFrame, *, key: str = "city", ts: str = "timestamp", seq: str = "seq",
              require_aqi: bool = True, chunk_rows: int | None = None) -> DataFrame:
    """Coerced rows plus one boolean column per rule and ``bad_columns``.

    ``seq`` is the arrival order (a DataFrame has none of its own).
    """
    require_observation_columns(df.columns, require_aqi=require_aqi, ts_col=ts)
    raw_cols = value_columns(require_aqi)
    raw = df.select(key, seq, ts, *raw_cols)
    c = coerce(raw, ts=ts, require_aqi=require_aqi)
    c = c.withColumns({f"_neg_{x}": F.col(x) < 0 for x in raw_cols})
    c = c.withColumns({f"_bad_{x}": F.col(x).isNull() for x in raw_cols})
    # duplicate and order flags on the narrow (key, seq, ts) projection, then
    # joined back once on (key, seq): one shuffle of the wide rows
    narrow = c.select(key, seq, ts)
    dups = narrow.where(F.col(ts).isNotNull()).groupBy(key, ts).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    flags = shifted(narrow.join(dups, [key, ts], "left"), [key], seq, [ts], max_lag=1, chunk_rows=chunk_rows) \
        .select(key, seq, F.col("_n").isNotNull().alias("_dup"),
                F.coalesce(F.col(ts) < F.col(f"{ts}__lag1"), F.lit(False)).alias("_ooo"))
    c = c.join(flags, [key, seq], "left")
    bad_cols = F.filter(
        F.array(*[F.when(F.col(f"_bad_{x}") | F.coalesce(F.col(f"_neg_{x}"), F.lit(False)), F.lit(x)) for x in raw_cols]),
        lambda v: v.isNotNull(),
    )
    return c.select(
        key, seq, ts, *raw_cols,
        F.col(ts).isNull().alias("invalid_timestamp"),
        F.coalesce(F.col("_dup"), F.lit(False)).alias("duplicate_timestamp"),
        F.coalesce(F.col("_ooo"), F.lit(False)).alias("out_of_order"),
        F.greatest(*[F.col(f"_bad_{x}") for x in raw_cols]).alias("invalid_value"),
        F.coalesce(F.greatest(*[F.col(f"_neg_{x}") for x in raw_cols]), F.lit(False)).alias("negative_value"),
        bad_cols.alias("bad_columns"),
    )


def out_of_order(df: DataFrame, *, key: str = "city", ts: str = "timestamp", seq: str = "seq",
                 chunk_rows: int | None = None) -> DataFrame:
    """Rows (key, seq, ts) whose time is before the previous arrival's.

    Reads only the three columns; text timestamps are parsed (bad -> NULL,
    never out of order).
    """
    t = df.schema[ts].dataType
    ts_col = F.col(ts) if isinstance(t, T.TimestampType) else F.try_to_timestamp(F.col(ts).cast("string"))
    narrow = df.select(key, seq, ts_col.alias(ts))
    sh = shifted(narrow, [key], seq, [ts], max_lag=1, chunk_rows=chunk_rows)
    return sh.where(F.col(ts) < F.col(f"{ts}__lag1")).select(key, seq, ts)


def violations(df: DataFrame, **kw) -> DataFrame:
    """Long form: one row per (key, seq, rule)."""
    key = kw.get("key", "city")
    seq = kw.get("seq", "seq")
    f = flag_rows(df, **kw)
    stacked = f.select(key, seq, F.explode(F.array(*[
        F.when(F.col(r), F.lit(r)) for r in RULES])).alias("rule"))
    return stacked.where(F.col("rule").isNotNull())


def report(df: DataFrame, *, key: str = "city", ts: str = "timestamp", seq: str = "seq",
           require_aqi: bool = True, chunk_rows: int | None = None) -> DataFrame:
    """Counts per key: rows and rows breaking each rule.

    Row-local rules and duplicates come from one aggregate on ``(key, ts)``,
    summed per key; arrival order (a lag over ``seq``) reads ``key, seq, ts``.
    """
    raw_cols = value_columns(require_aqi)
    c = coerce(df.select(key, seq, ts, *raw_cols), ts=ts, require_aqi=require_aqi)
    count = lambda e: F.count(F.when(e, 1))
    per_time = c.groupBy(key, ts).agg(
        F.count(F.lit(1)).alias("n"), count(F.greatest(*[F.col(x).isNull() for x in raw_cols])).alias("absent"),
        count(F.greatest(*[F.coalesce(F.col(x) < 0, F.lit(False)) for x in raw_cols])).alias("negative"))
    local = per_time.groupBy(key).agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col(ts).isNull(), F.col("n")).otherwise(0)).alias("invalid_timestamp"),
        F.sum(F.when(F.col(ts).isNotNull() & (F.col("n") > 1), F.col("n")).otherwise(0)).alias("duplicate_timestamp"),
        F.sum("absent").alias("invalid_value"), F.sum("negative").alias("negative_value"))
    order = (shifted(c.select(key, seq, ts), [key], seq, [ts], max_lag=1, chunk_rows=chunk_rows).groupBy(F.col(key).alias("__key"))
             .agg(count(F.col(ts) < F.col(f"{ts}__lag1")).alias("out_of_order")))
    return (local.join(order, F.col(key).eqNullSafe(F.col("__key")), "left")  # a null key is a key of its own
            .select(key, "n_rows", *[F.coalesce(r, F.lit(0)).cast("long").alias(r) for r in RULES]))


def _row_faults(key: str, ts: str, require_aqi: bool) -> list[tuple[str, str, Column]]:
    """(rule, column, condition) of what one coerced row can break, in the contract's order."""
    out = [("absent_key", key, F.col(key).isNull()), ("invalid_timestamp", ts, F.col(ts).isNull())]
    for x in value_columns(require_aqi):
        out += [("invalid_value", x, F.col(x).isNull()), ("negative_value", x, F.coalesce(F.col(x) < 0, F.lit(False)))]
    return out


class Gate:
    """Counts of broken rules that a job gathers while it runs."""

    def __init__(self):
        self.rows, self.keys = Observation(), Observation()

    def watch(self, coerced: DataFrame, *, key: str, ts: str, require_aqi: bool) -> DataFrame:
        counts = [F.count(F.when(bad, 1)).alias(f"{rule}:{x}") for rule, x, bad in _row_faults(key, ts, require_aqi)]
        return coerced.observe(self.rows, F.count(F.lit(1)).alias("n"), *counts)

    def twins(self, per_key: DataFrame, n: str, ts: str) -> DataFrame:
        return per_key.observe(self.keys, F.sum(F.when(F.col(ts).isNotNull() & (F.col(n) > 1), F.col(n)).otherwise(0)).alias("n"))

    @property
    def n_rows(self) -> int:
        return self.rows.get["n"]

    def check(self, out_of_order=lambda: 0) -> None:
        """Raise the first error; waits for the job. Key and time rules come first, then
        arrival order, then the value columns in order."""
        found = self.rows.get
        time_rules = [(r, "", sum(n for k, n in found.items() if k.startswith(f"{r}:"))) for r in ("absent_key", "invalid_timestamp")]
        for rule, column, n in [*time_rules, ("duplicate_timestamp", "", self.keys.get["n"] or 0)]:
            if n:
                raise DataQualityError(REASONS[rule].format(n=n, column=column))
        if n := out_of_order():
            raise DataQualityError(REASONS["out_of_order"].format(n=n, column=""))
        for name, n in found.items():
            rule, _, column = name.partition(":")
            if n and rule in ("invalid_value", "negative_value"):
                raise DataQualityError(REASONS[rule].format(n=n, column=column))


def observed(df: DataFrame, *, key: str = "city", ts: str = "timestamp",
             require_aqi: bool = True) -> tuple[DataFrame, Gate]:
    """Coerced rows, one per (key, ts), and the gate over them.

    The rows carry the gate's counts: run one job that reads them all, then
    ``check`` the gate before its results are used. Nothing is read twice.
    """
    gate = Gate()
    c = gate.watch(coerce(df, ts=ts, require_aqi=require_aqi), key=key, ts=ts, require_aqi=require_aqi)
    rest = [x for x in c.columns if x not in (key, ts)]
    one = c.groupBy(key, ts).agg(F.count(F.lit(1)).alias("__n"), *[F.any_value(x).alias(x) for x in rest])
    return gate.twins(one, "__n", ts).select(*df.columns), gate


def enforce(df: DataFrame, *, key: str = "city", ts: str = "timestamp", seq: str | None = "seq",
            require_aqi: bool = True, chunk_rows: int | None = None) -> DataFrame:
    """Raise the contract error when any rule fails; else ``df`` coerced.

    One scan for the row rules and duplicates (only key and time are
    shuffled). With ``seq``, arrival order is tested by a second job over
    three columns, if nothing failed before it.
    """
    gate = Gate()
    c = coerce(df, ts=ts, require_aqi=require_aqi)
    wide = c.select(*dict.fromkeys([key, ts, *value_columns(require_aqi)]))
    per_key = gate.watch(wide, key=key, ts=ts, require_aqi=require_aqi).groupBy(key, ts).agg(F.count(F.lit(1)).alias("n"))
    gate.twins(per_key, "n", ts).agg(F.count(F.lit(1))).collect()
    gate.check(lambda: out_of_order(df, key=key, ts=ts, seq=seq, chunk_rows=chunk_rows).count() if seq and seq != ts else 0)
    return c


def guarded(df: DataFrame, *, key: str = "city", ts: str = "timestamp", require_aqi: bool = True) -> DataFrame:
    """Coerced rows of a plan that stops at a row without key, time or value, or with a negative one."""
    c = coerce(df, ts=ts, require_aqi=require_aqi)
    fault = F.lit(None).cast("string")
    for rule, column, bad in reversed(_row_faults(key, ts, require_aqi)):
        fault = F.when(bad, F.lit(REASONS[rule].format(n="some", column=column))).otherwise(fault)
    return c.where(stop_at(fault))


def stop_at(fault: Column) -> Column:
    """A filter that every row without ``fault`` passes; a fault stops the job with its text."""
    return F.when(fault.isNotNull(), F.raise_error(fault).cast("boolean")).otherwise(F.lit(True))


def require_valid(history: DataFrame, *, key: str = "city", ts: str = "timestamp", require_aqi: bool = True) -> DataFrame:
    """``enforce`` for stored history: a table has no arrival order, so the
    rules are those of key, time, uniqueness and values, in one scan."""
    return enforce(history, key=key, ts=ts, seq=None, require_aqi=require_aqi)


def missing_lags(rows: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLUMNS[-4:])) -> DataFrame:
    """Rows that cannot be served: any of ``columns`` is NULL (F4/F5)."""
    cond = None
    for c in columns:
        e = F.col(c).isNull()
        cond = e if cond is None else cond | e
    return rows.where(cond)
