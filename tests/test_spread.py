"""Splitting of frequent keys: same results, bounded chunks, order kept."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from viewtide.operators import transform
from viewtide.operators.ordered import with_previous, with_running_totals
from viewtide.operators.spread import CHUNK, WHOLE, find_splits, replicate, spread
from viewtide.schemas import FACTS

START = datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """One video with most rows, crowded at the end of its time; the rest with few."""
    rng = random.Random(7)
    data = []
    seconds = 0
    for i in range(3000):
        seconds += 3600 if i < 300 else 1
        data.append(("hot", START + timedelta(seconds=seconds)))
    for video in range(200):
        for i in range(rng.randint(1, 8)):
            data.append((f"v{video}", START + timedelta(hours=rng.randint(0, 9), seconds=video * 10 + i)))
    filled = []
    for gid, at in data:
        facts = [rng.choice([None, *range(-2, 40)]) for _ in FACTS]
        filled.append((gid, *facts, at))
    schema = "gid string, views bigint, likes bigint, dislikes bigint, comments bigint, updated_at timestamp"
    history = spark.createDataFrame(filled, schema).dropDuplicates(["gid", "updated_at"]).cache()
    history.count()
    return history


@pytest.fixture(scope="module")
def meta(spark, skewed):
    known = skewed.select("gid").distinct().filter("gid <> 'v3'").collect()
    data = [(r.gid, f"u{i % 5}", 10 + 10 * (i % 2), START, i) for i, r in enumerate(sorted(known))]
    return spark.createDataFrame(
        data + [("unseen", "u9", 10, START, 1)],
        "gid string, user_id string, category_id bigint, created_at timestamp, duration bigint",
    )


def test_no_splits_below_the_limit(skewed):
    assert find_splits(skewed) is None
    assert find_splits(skewed.filter("gid <> 'hot'"), rows_per_chunk=10) is None


def test_chunks_are_bounded_ordered_and_complete(skewed):
    splits = find_splits(skewed, rows_per_chunk=100)
    spread_rows = spread(skewed, splits)
    assert rows(spread_rows.drop(CHUNK)) == rows(skewed)
    assert spread_rows.filter("gid <> 'hot'").select(CHUNK).distinct().collect() == [(WHOLE,)]
    chunks = (
        spread_rows.filter("gid = 'hot'").groupBy(CHUNK)
        .agg(F.count("*").alias("n"), F.min("updated_at").alias("lo"), F.max("updated_at").alias("hi"))
        .orderBy(CHUNK).collect()
    )
    assert chunks[0][CHUNK] == 0
    assert all(c.n <= 100 for c in chunks)
    assert all(a.hi < b.lo for a, b in zip(chunks, chunks[1:]))


def test_second_round_refines_pieces_that_are_still_too_large(skewed):
    splits = find_splits(skewed, rows_per_chunk=4)
    sizes = spread(skewed, splits).filter("gid = 'hot'").groupBy(CHUNK).count()
    assert splits.longest > 256
    assert sizes.agg(F.max("count")).first()[0] <= 4


def test_number_of_cuts_is_bounded(skewed):
    splits = find_splits(skewed, rows_per_chunk=1, max_chunks=20)
    assert splits.table.agg(F.sum(F.size("_cuts"))).first()[0] <= 2 * 20


def test_equal_order_values_cannot_be_cut(spark):
    same = spark.createDataFrame([("a", START)] * 50, "gid string, updated_at timestamp")
    assert find_splits(same, rows_per_chunk=10) is None
    crowded = same.union(spark.createDataFrame([("a", START + timedelta(1))], same.schema))
    splits = find_splits(crowded, rows_per_chunk=10)
    assert spread(crowded, splits).groupBy(CHUNK).count().orderBy(CHUNK).collect() == [(0, 50), (1, 1)]


def test_sampled_search_finds_the_frequent_key_only(spark):
    rows = spark.range(400_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('v', id % 5000)) as gid", "timestamp_seconds(id) as updated_at"
    )
    splits = find_splits(rows, rows_per_chunk=20_000)
    assert [r.gid for r in splits.table.collect()] == ["hot"]
    sizes = spread(rows, splits).filter("gid = 'hot'").groupBy(CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 20_000
    assert sizes.agg(F.sum("count")).first()[0] == 133_334


def test_replicate_meets_every_chunk_once(skewed, meta):
    splits = find_splits(skewed, rows_per_chunk=100)
    copies = replicate(meta, splits).groupBy("gid").count()
    assert copies.filter("gid = 'hot'").first()["count"] == splits.longest + 1
    assert copies.filter("gid <> 'hot' and count <> 1").isEmpty()


@pytest.mark.parametrize("rows_per_chunk", [3, 100])
def test_previous_and_running_totals_by_brute_force(skewed, rows_per_chunk):
    splits = find_splits(skewed, rows_per_chunk=rows_per_chunk)
    frame = spread(skewed.select("gid", "views", "likes", "updated_at"), splits)
    lagged, previous = with_previous(frame, ("views", "likes"), ("gid",), "updated_at")
    got_previous = lagged.select("gid", "updated_at", previous["views"], previous["likes"])
    summed, totals = with_running_totals(frame, {"v": F.col("views"), "l": F.col("likes")}, ("gid",), "updated_at")
    got_totals = summed.select("gid", "updated_at", totals["v"], totals["l"])

    want_previous, want_totals, state = [], [], {}
    for r in skewed.orderBy("gid", "updated_at").collect():
        before, sums = state.get(r.gid, ((None, None), (None, None)))
        sums = tuple(s if x is None else (s or 0) + x for s, x in zip(sums, (r.views, r.likes)))
        want_previous.append((r.gid, r.updated_at, *before))
        want_totals.append((r.gid, r.updated_at, *sums))
        state[r.gid] = ((r.views, r.likes), sums)
    assert rows(got_previous) == sorted(want_previous, key=repr)
    assert rows(got_totals) == sorted(want_totals, key=repr)


@pytest.mark.parametrize("rows_per_chunk", [3, 100])
def test_stages_are_the_same_with_and_without_splits(skewed, meta, rows_per_chunk):
    splits = find_splits(skewed, rows_per_chunk=rows_per_chunk)

    def stages(splits):
        kept = transform.denorm(meta, skewed, splits, steps=True)
        joined_first = transform.changed_only(
            transform.with_diffs(transform.denormalize(meta, skewed, splits))
        )
        return [
            transform.denormalize(meta, skewed, splits).drop(CHUNK),
            kept.drop(CHUNK),
            transform.with_steps(joined_first).select(*kept.columns).drop(CHUNK),
            transform.latest(kept),
            transform.daily(kept.drop(*[f"{f}_step" for f in FACTS])),
            transform.daily_from_steps(kept),
        ]

    plain, split = stages(None), stages(splits)
    for a, b in zip(plain, split):
        assert a.columns == b.columns
        assert rows(a) == rows(b)
    assert rows(plain[1]) == rows(plain[2])
    assert rows(plain[4]) == rows(plain[5])


def test_the_chunk_is_the_number_of_cuts_up_to_the_row(spark):
    """Cuts that crowd in places, and rows before, between, on and behind them."""
    from bisect import bisect_right

    from viewtide.operators import spread as module
    rnd, begin = random.Random(6), datetime(2024, 1, 1)
    cuts = sorted({begin + timedelta(seconds=int(3 ** rnd.uniform(0, 14))) for _ in range(300)})
    table = spark.createDataFrame([("hot", cuts)], "gid string, _cuts array<timestamp>")
    splits = module._with_slots("gid", "updated_at", table, table.schema["_cuts"].dataType.elementType)
    times = [*cuts, *(begin + timedelta(seconds=rnd.randrange(-9, 5_000_000)) for _ in range(500))]
    rows = spark.createDataFrame([(g, t) for t in times for g in ("hot", "cold", None)], "gid string, updated_at timestamp")
    got = module.spread(rows, splits).collect()
    assert len(got) == 3 * len(times)
    assert all(r[CHUNK] == (bisect_right(cuts, r.updated_at) if r.gid == "hot" else -1) for r in got)
    most = splits.slots.agg(F.max(F.size("_near"))).first()[0]
    assert splits.slots.count() <= len(cuts) + 1 and most < len(cuts)


def test_splits_are_found_inside(spark, monkeypatch):
    """The default call on a frame with a hot video works on it in several tasks."""
    from viewtide.operators import spread as module
    from viewtide.plans import checks
    monkeypatch.setattr(module.find_splits, "__defaults__", ("gid", "updated_at", 25, module.MAX_CHUNKS))
    rows = spark.range(100).selectExpr(
        "'hot' as gid", "1 as category_id", *[f"id * 2 as {f}" for f in FACTS], "timestamp_seconds(id * 60) as updated_at"
    )
    plan = transform.with_steps(module.spread(rows, module.found_splits(rows, module.FIND)))
    assert plan.select(CHUNK).distinct().count() >= 4
    assert checks.changed_row_count(rows).first().row_count == 99
