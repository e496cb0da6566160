"""Relations that hold for any input."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from viewtide.operators import transform
from viewtide.plans import reports
from viewtide.schemas import FACTS

fact = st.one_of(st.none(), st.integers(0, 10**7))
observation = st.tuples(st.sampled_from("abc"), fact, fact, st.integers(0, 200))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(observation, min_size=1, max_size=40, unique_by=lambda o: (o[0], o[3])))
def test_stages_against_a_plain_loop(spark, observations):
    start = datetime(2024, 1, 1)
    rows = [(g, v, l, 0, 0, start + timedelta(hours=h)) for g, v, l, h in observations]
    history = spark.createDataFrame(
        rows, "gid string, views bigint, likes bigint, dislikes bigint, comments bigint, updated_at timestamp"
    )
    meta = spark.createDataFrame(
        [(g, "u", 10, start, 1) for g in "abc"],
        "gid string, user_id string, category_id bigint, created_at timestamp, duration bigint",
    )
    kept = transform.denorm(meta, history).cache()
    latest, daily = transform.latest(kept), transform.daily(kept)

    want_kept, want_latest, want_daily = [], {}, {}
    before, kept_before = {}, {}

    def growth(now, earlier):
        return tuple(None if n is None else n - (e or 0) for n, e in zip(now, earlier))

    for g, *facts, at in sorted(rows, key=lambda r: (r[0], r[-1])):
        change = growth(facts, before.get(g, [None] * 4))
        before[g] = facts
        if not any(c is not None and c > 0 for c in change):
            continue
        want_kept.append((g, at, *change))
        want_latest[g] = tuple(facts)
        for i, s in enumerate(growth(facts, kept_before.get(g, [None] * 4))):
            day = want_daily.setdefault((g, at.date()), [None] * 4)
            day[i] = day[i] if s is None else (day[i] or 0) + s
        kept_before[g] = facts

    assert sorted(kept.select("gid", "updated_at", *[f"{f}_diff" for f in FACTS]).collect(), key=repr) == sorted(
        want_kept, key=repr
    )
    assert {r.gid: tuple(r[1:5]) for r in latest.collect()} == want_latest
    assert {(r.gid, r.day_updated_at): list(r[1:5]) for r in daily.collect()} == want_daily
    counted = reports.view_bins(latest).agg(F.sum("count_videos")).first()[0]
    assert (counted or 0) == len(want_latest)
    kept.unpersist()
