from datetime import date, datetime

import pytest

from viewtide.operators.constraints import ConstraintViolation, assert_clean, duplicates, null_counts
from viewtide.operators.spread import find_splits
from viewtide.plans import checks

HISTORY = "gid string, views bigint, likes bigint, dislikes bigint, comments bigint, updated_at timestamp"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


@pytest.fixture(scope="module")
def history(spark):
    rows = [("a", 5, at(1)), ("a", 9, at(1, 2)), ("a", 7, at(2)), ("b", 1, at(1)), ("b", 2, at(2)), ("c", 3, at(1)),
            ("c", None, at(3))]
    return spark.createDataFrame([(g, v, 0, 0, 0, t) for g, v, t in rows], HISTORY)


@pytest.fixture(scope="module")
def meta(spark):
    rows = [("a", "u", 10, at(1), 60), ("b", "u", 20, at(1), 60), ("d", "u", 20, at(1), 60), ("e", "u", 20, at(1), 1)]
    return spark.createDataFrame(
        rows, "gid string, user_id string, category_id bigint, created_at timestamp, duration bigint"
    )


def test_meta_without_history(meta, history):
    found = checks.meta_without_history(meta, history)
    assert found.columns == meta.columns
    assert sorted(r.gid for r in found.collect()) == ["d", "e"]
    assert [r.gid for r in checks.meta_without_history(meta, history, limit=1).collect()] == ["d"]


def test_history_without_meta(meta, history):
    found = checks.history_without_meta(history, meta)
    assert found.columns == history.columns
    assert sorted((r.gid, r.updated_at) for r in found.collect()) == [("c", at(1)), ("c", at(3))]
    assert checks.history_without_meta(history, meta, limit=1).first().updated_at == at(1)
    none = checks.history_without_meta(history.filter("gid <> 'c'"), meta)
    assert none.isEmpty() and none.columns == history.columns


def test_history_without_meta_in_chunks(meta, history):
    whole = sorted(checks.history_without_meta(history, meta).collect(), key=repr)
    found = checks.history_without_meta(history, meta, splits=find_splits(history, rows_per_chunk=1))
    assert sorted(found.collect(), key=repr) == whole


def test_fact_decreased_ignores_a_missing_last_value(history):
    assert checks.fact_decreased(history).collect() == [("a", 7, 9)]
    assert checks.fact_decreased(history, limit=0).isEmpty()


def test_lookups(history):
    assert [r.views for r in checks.video_history(history, "a").collect()] == [5, 9, 7]
    assert [r.views for r in checks.video_day_history(history, "a", date(2024, 1, 1)).collect()] == [5, 9]


def test_profiles(history, meta):
    assert checks.multi_updates_per_day(history).collect() == [("a", date(2024, 1, 1), 2)]
    assert [r.day.day for r in checks.updated_days(history).collect()] == [1, 2, 3]
    assert [r.day.day for r in checks.created_days(meta).collect()] == [1]
    assert checks.updates_per_video(history).collect() == [(3, "a"), (2, "b"), (2, "c")]
    assert checks.updates_per_video(history, limit=1).collect() == [(3, "a")]
    assert checks.row_count(history).collect() == [(7,)]


def test_changed_row_count(spark, history):
    joined = history.selectExpr("*", "10L as category_id")
    assert checks.changed_row_count(joined).collect() == [(5,)]
    assert checks.changed_row_count(joined, mode="any").collect() == [(6,)]
    # A table that already has diffs is counted anew.
    assert checks.changed_row_count(joined.selectExpr("*", "0L as views_diff", "0L as hour")).collect() == [(5,)]


def test_duplicates_and_nulls(history):
    assert duplicates(history, ("gid", "updated_at")).isEmpty()
    assert sorted(duplicates(history, ("gid",)).collect()) == [("a", 3), ("b", 2), ("c", 2)]
    assert sorted(null_counts(history, ("gid", "views")).collect()) == [("gid", 0), ("views", 1)]


def test_assert_clean(spark, history, meta):
    assert_clean(history, "history")
    assert_clean(meta, "meta")
    with pytest.raises(ConstraintViolation, match="meta: 1 duplicate keys; first: {'gid': 'a'}"):
        assert_clean(meta.union(meta.filter("gid = 'a'")), "meta")
    with pytest.raises(ConstraintViolation, match="meta: NULL in gid"):
        assert_clean(meta.selectExpr("nullif(gid, 'a') as gid"), "meta")
    uncategorized = history.selectExpr("*", "cast(null as bigint) as category_id", "date(updated_at) as day_updated_at")
    with pytest.raises(ConstraintViolation, match="denorm: NULL in category_id"):
        assert_clean(uncategorized, "denorm")
