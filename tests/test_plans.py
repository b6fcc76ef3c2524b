"""Plan-shape regression tests for the properties that matter at scale."""

import re

from aerocast.plans.catalog import QUERIES
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_page_is_top_k(spark):
    assert "TakeOrderedAndProject(limit=750, offset=500" in _plan(QUERIES["history_page"](spark, SF_SMALL))


def test_key_filter_reaches_the_scan(spark):
    pl = _plan(QUERIES["scan_city_history"](spark, SF_SMALL))
    assert "EqualTo(event_type,click)" in pl and "Exchange" not in pl


def test_daily_features_two_shuffles_no_join(spark):
    pl = _plan(QUERIES["daily_features"](spark, SF_SMALL))
    assert len(re.findall(r"Exchange hashpartitioning", pl)) == 2
    assert "Join" not in pl


def test_scans_read_only_needed_columns(spark):
    # the events table has event_id, ts, user_id, event_type, value, props;
    # the daily path never needs event_type or event_id
    pl = _plan(QUERIES["daily_features"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", pl)
    assert schemas and all("event_type" not in s and "event_id" not in s for s in schemas)


def test_latest_per_key_cuts_before_the_shuffle(spark):
    pl = _plan(QUERIES["latest_per_key"](spark, SF_SMALL))
    assert "SortAggregate" not in pl and "WindowGroupLimit" in pl


def test_ranks_inside_the_row_shuffle_nothing(spark):
    from aerocast.contract import FEATURE_COLUMNS
    from aerocast.operators.attribution import rank_in_row
    wide = spark.createDataFrame([(1, *[float(i) for i in range(len(FEATURE_COLUMNS))])], ["id", *FEATURE_COLUMNS])
    df = rank_in_row(wide, ["id"], "v")
    assert "Exchange" not in _plan(df)
    assert [r.feature for r in df.orderBy("rank").collect()] == FEATURE_COLUMNS[::-1]


def test_small_tables_need_no_chunks(spark):
    for name in ("hourly_features", "pit_join"):
        pl = _plan(QUERIES[name](spark, SF_SMALL))
        assert "percentile" not in pl and "Join" not in pl, name
    assert len(re.findall(r"Exchange hashpartitioning", _plan(QUERIES["hourly_features"](spark, SF_SMALL)))) == 1


def test_large_tables_shuffle_the_wide_rows_once(spark):
    """Above the chunk size: one small side of cuts, no sketch, no aggregate over all keys."""
    from aerocast.operators.ordered import CHUNK_ROWS_CONF
    spark.conf.set(CHUNK_ROWS_CONF, "100")
    try:
        pl = _plan(QUERIES["hourly_features"](spark, SF_SMALL))
    finally:
        spark.conf.unset(CHUNK_ROWS_CONF)
    assert "percentile" not in pl and "__ck_cuts" in pl and "Aggregate" not in pl
