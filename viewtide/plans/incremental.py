"""Increments merged into the persistent tables, in place of a run over all history.

`start` writes the tables from a first load, `merge` adds an increment: new observations,
observations that come late, new readings of old ones, new and changed videos. Afterwards
the tables hold, row by row, what a full run over everything would give. `purge` takes old
days out of them.

| Table | Cut by | Content |
|---|---|---|
| `observations` | day | all observations as loaded |
| `denorm`, `daily` | day | as in a full run; `denorm` with the steps |
| `meta`, `latest` | part of the videos | as in a full run |
| `videos` | part | per video, its last observation, its last kept one, its first kept day |
| `opening` | part | the same as of the last purged day |

A video's new rows need no more of the past than its row in `videos`, unless some are late.
Only for videos with late rows, or changed attributes, are the stored observations read:
from the first late day on what they have to be computed again, and before it the last row
of each. A late row changes the row after it and the next kept one, so what is computed
anew is compared with what is stored, and only days in which a row differs are written.

All results are staged first, cut as the tables are; then their partitions are moved into
place. A merge that breaks off in between is ended by the next call, or by `finish`;
merging the same increment again changes nothing.
"""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.functions.expressions import day_of
from viewtide.operators.constraints import assert_clean
from viewtide.operators.spread import CHUNK, ROWS_PER_CHUNK, find_splits, spread
from viewtide.operators.transform import changed_only, daily_from_steps, denorm, with_attributes, with_diffs, with_steps
from viewtide.plans.pipeline import mark, marker
from viewtide.schemas import ATTRIBUTES, DENORM_COLUMNS, FACTS, HISTORY_COLUMNS, LATEST_COLUMNS, VIDEO, step
from viewtide.sources import partitions
from viewtide.sources.partitions import DAY, drop_partitions, move_partitions, partition_values, write_all_partitions
from viewtide.sources.stages import REJECTS, read_stage, stage_path, write_stage

PART = "part"
PARTS = 16
STAGED = "staged"
MERGE, RETENTION = "merge", "retention"
EXCHANGING, MERGED = "exchanging", "merged"

_BY = {"observations": DAY, "denorm": DAY, "daily": DAY, "meta": PART, "latest": PART, "videos": PART, "opening": PART}
_SORT = {
    "observations": ("gid", "updated_at"), "denorm": (*VIDEO, "updated_at"), "daily": VIDEO,
    "meta": ("gid",), "latest": VIDEO, "videos": ("gid",), "opening": ("gid",),
}
_STEPPED = (*DENORM_COLUMNS, *map(step, FACTS))
_CARRIED = "_carried"
_META = ("gid", *ATTRIBUTES)


def start(spark: SparkSession, out: str, meta: DataFrame, history: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> None:
    """Write all tables from a first load, replacing what is there."""
    _together(
        lambda: _write_all(spark, out, "observations", history.select(*HISTORY_COLUMNS, day_of("updated_at").alias(DAY))),
        lambda: _write_all(spark, out, "meta", _parted(meta.select(*_META))),
    )
    history, meta = _observations(spark, out), _table(spark, out, "meta").drop(PART)
    _together(lambda: assert_clean(history, "history"), lambda: assert_clean(meta, "meta"))
    splits = find_splits(history, rows_per_chunk=rows_per_chunk)
    _write_all(spark, out, "denorm", denorm(meta, history, splits, steps=True).drop(CHUNK))
    kept = _table(spark, out, "denorm")

    def last_rows() -> None:
        _write_all(spark, out, "videos", _parted(_ends(history, kept)))
        videos = _table(spark, out, "videos")
        _write_all(spark, out, "latest", _latest(videos, _table(spark, out, "meta")))
        _write_all(spark, out, "opening", videos.limit(0))

    _together(lambda: _write_all(spark, out, "daily", daily_from_steps(kept)), last_rows)
    write_stage(spark.createDataFrame([], "state string"), stage_path(out, "markers"), RETENTION)
    mark(spark, out, MERGE, MERGED)


def merge(
    spark: SparkSession, out: str, history: DataFrame, meta: DataFrame | None = None, rows_per_chunk: int = ROWS_PER_CHUNK
) -> None:
    """Add an increment. An observation of a known time replaces that one, a known video its attributes.

    Observations of purged days are not merged but go to `rejects/late`.
    """
    finish(spark, out)
    staged = stage_path(out, STAGED)

    def keep(df: DataFrame, name: str) -> DataFrame:
        if name in _BY:
            write_all_partitions(df, staged, name, _BY[name], _SORT[name])
        else:
            write_stage(df, staged, name)
        return read_stage(spark, staged, name)

    new = keep(_within_retention(spark, out, history.select(*HISTORY_COLUMNS)), "new")
    known = _table(spark, out, "meta")
    _, changed = _together(
        lambda: assert_clean(new, "history"), lambda: keep(_changed_videos(known, meta), "changed_videos")
    )
    if meta is not None:
        assert_clean(changed, "meta")
    beginning = F.lit("1000-01-01").cast(new.schema["updated_at"].dataType)
    # Since when each video has to be computed again.
    touched = keep(
        new.select("gid", "updated_at").union(changed.select("gid", beginning))
        .groupBy("gid").agg(F.min("updated_at").alias("since")), "touched",
    )
    videos = _table(spark, out, "videos")
    placed = touched.join(videos.drop(PART), "gid", "left")
    late = keep(placed.filter(F.col("obs.updated_at") >= F.col("since")).select("gid", "since"), "late")
    first_late = late.agg(F.min("since").cast("date")).first()[0]

    # What precedes each video's rows, and the rows themselves.
    carry = placed.filter(F.col("obs").isNull() | (F.col("obs.updated_at") < F.col("since"))).drop("since")
    rows = new
    if first_late is not None:
        carry = carry.unionByName(_before(spark, out, late))
        stored = _since(_observations(spark, out, first_late), late).select(*HISTORY_COLUMNS)
        rows = new.union(stored.join(new, ["gid", "updated_at"], "left_anti").select(*HISTORY_COLUMNS))
    carry = keep(carry, "carry")
    rows = keep(rows.withColumn(_CARRIED, F.lit(False)).unionByName(_as_rows(carry, "obs")), "rows")
    merged_meta = known.drop(PART).join(changed, "gid", "left_anti").select(*_META).union(changed)
    recomputed = keep(_recompute(merged_meta, rows, carry, rows_per_chunk), "recomputed")

    # The days that differ from what is stored. One row per day comes to the driver.
    days = recomputed
    if first_late is not None:
        old = _since(_table(spark, out, "denorm").filter(F.col(DAY) >= F.lit(first_late)), late).select(*_STEPPED)
        days = _differing(recomputed, old, DAY)
    days, new_days, parts, meta_parts = _together(
        lambda: _values(days, DAY), lambda: _values(new.select(day_of("updated_at").alias(DAY)), DAY),
        lambda: _values(_parted(touched), PART), lambda: _values(_parted(changed), PART),
    )

    stored = _table(spark, out, "denorm").filter(F.col(DAY).isin(days)).select(*_STEPPED)
    again = recomputed.filter(F.col(DAY).isin(days))
    seen = _table(spark, out, "observations").filter(F.col(DAY).isin(new_days))
    ends = _joined_ends(carry, _ends(rows.filter(~F.col(_CARRIED)), recomputed))
    others = videos.filter(F.col(PART).isin(parts)).join(touched, "gid", "left_anti")

    def whole_days() -> None:
        keep(daily_from_steps(keep(_not_since(stored, late).union(again.select(*_STEPPED)), "denorm")), "daily")

    def observed_days() -> None:
        keep(
            seen.join(new, ["gid", "updated_at"], "left_anti").select(*HISTORY_COLUMNS, DAY)
            .union(new.withColumn(DAY, day_of("updated_at"))), "observations",
        )

    def last_rows() -> None:
        all_ends = keep(_parted(ends.filter(F.col("obs").isNotNull())).unionByName(others), "videos")
        keep(_latest(all_ends, _parted(merged_meta).filter(F.col(PART).isin(parts))), "latest")

    _together(
        whole_days, observed_days, last_rows,
        lambda: keep(_parted(merged_meta).filter(F.col(PART).isin(meta_parts)), "meta"),
    )

    wanted = {"observations": new_days, "denorm": days, "daily": days, "meta": meta_parts, "latest": parts, "videos": parts}
    lists = []
    for table, values in wanted.items():
        left = set(partition_values(spark, staged, table, _BY[table]))
        lists += [(table, str(value), str(value) not in left) for value in values]
    write_stage(spark.createDataFrame(lists, "table string, value string, emptied boolean"), staged, "exchanged")
    mark(spark, out, MERGE, EXCHANGING)
    finish(spark, out)


def finish(spark: SparkSession, out: str) -> None:
    """Exchange the partitions of a merge that was staged; nothing to do for one that has ended."""
    state = marker(spark, out, MERGE)
    if state is None:
        raise ValueError(f"{out}: no tables to merge into; begin with `start`")
    if state != EXCHANGING:
        return
    staged = stage_path(out, STAGED)
    # One row per partition. What is no longer there to move has been moved before.
    exchanged = read_stage(spark, staged, "exchanged").collect()
    for table, by in _BY.items():
        moved = [r.value for r in exchanged if r.table == table and not r.emptied]
        emptied = [r.value for r in exchanged if r.table == table and r.emptied]
        move_partitions(spark, staged, table, moved, out, by)
        drop_partitions(spark, out, table, emptied, by)
    mark(spark, out, MERGE, MERGED)


def purge(spark: SparkSession, out: str, before: date, archive: str | None = None) -> list[date]:
    """Take the days before `before` out of the tables, and return them.

    Where each video stood at that time is kept in `opening`, so that late rows of later
    days can still be merged. `latest` keeps all videos.
    """
    finish(spark, out)
    old = _table(spark, out, "observations").filter(F.col(DAY) < F.lit(before))
    kept = _table(spark, out, "denorm").filter(F.col(DAY) < F.lit(before))
    opening = stage_path(out, STAGED)
    write_stage(_joined_ends(_table(spark, out, "opening").drop(PART), _ends(old, kept)), opening, "opening")
    _write_all(spark, out, "opening", _parted(read_stage(spark, opening, "opening")))
    mark(spark, out, RETENTION, before.isoformat())
    gone = {d for table in ("observations", "denorm", "daily") for d in partitions.purge(spark, out, table, before, archive)}
    return sorted(gone)


def _table(spark: SparkSession, out: str, name: str) -> DataFrame:
    return read_stage(spark, out, name)


def _observations(spark: SparkSession, out: str, since: date | None = None) -> DataFrame:
    return partitions.read_days(spark, out, "observations", since).select(*HISTORY_COLUMNS)


def _write_all(spark: SparkSession, out: str, name: str, df: DataFrame) -> None:
    write_all_partitions(df, out, name, _BY[name], _SORT[name])


def _parted(df: DataFrame) -> DataFrame:
    return df.withColumn(PART, F.pmod(F.xxhash64("gid"), F.lit(PARTS)).cast("int"))


def _values(df: DataFrame, column: str) -> list:
    """The different values of a partition column: days or parts, few by their nature."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _together(*steps: Callable[[], object]) -> list:
    """Run steps that do not need each other at the same time, so that one fills the other's gaps."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(step) for step in steps]]


def _differing(one: DataFrame, other: DataFrame, by: str) -> DataFrame:
    """The values of `by` under which the two tables, each without repeated rows, do not hold the same.

    A few numbers per value are compared, and no rows are brought together: counts, and two
    hashes of all columns, 128 bits. NULLs are hashed by their places, as a hash passes over them.
    """
    columns = [*one.columns, *[F.col(c).isNull() for c in one.columns]]
    signed = one.withColumn("n", F.lit(1)).union(other.withColumn("n", F.lit(-1)))
    return signed.select(
        by, "n", F.xxhash64(*columns).alias("hash"), F.xxhash64(F.lit(by), *columns).alias("other"),
    ).groupBy(by).agg(F.sum("n").alias("n"), F.bit_xor("hash").alias("hash"), F.bit_xor("other").alias("other")).filter(
        "n <> 0 or hash <> 0 or other <> 0"
    )


def _row() -> Column:
    """An observation as one value; the time comes first and decides which is the last."""
    return F.struct("updated_at", *FACTS)


def _ends(observations: DataFrame, kept: DataFrame) -> DataFrame:
    """Per video: last observation, last kept one, first kept day."""
    seen = _last(observations, "obs")
    grew = _last(kept, "kept", F.min(DAY).alias("first_day"))
    return seen.join(grew, "gid", "left")


def _last(rows: DataFrame, name: str, *more: Column) -> DataFrame:
    """Per video its last row as one value, aggregated in columns of fixed width, which can be hashed."""
    last = [F.max_by(c, "updated_at").alias(c) for c in FACTS]
    ends = rows.groupBy("gid").agg(F.max("updated_at").alias("updated_at"), *last, *more)
    return ends.select("gid", _row().alias(name), *[c for c in ends.columns if c not in ("gid", "updated_at", *FACTS)])


def _joined_ends(earlier: DataFrame, later: DataFrame) -> DataFrame:
    return earlier.select("gid", "obs", "kept", "first_day").unionByName(later).groupBy("gid").agg(
        F.max("obs").alias("obs"), F.max("kept").alias("kept"), F.min("first_day").alias("first_day")
    )


def _latest(videos: DataFrame, meta: DataFrame) -> DataFrame:
    """The `latest` rows of some parts of the videos."""
    kept = videos.filter(F.col("kept").isNotNull()).select(
        "gid", PART, *[F.col(f"kept.{c}").alias(c) for c in (*FACTS, "updated_at")], F.col("first_day").alias(DAY)
    )
    return kept.join(meta, ["gid", PART]).select(*LATEST_COLUMNS, PART)


def _since(df: DataFrame, late: DataFrame) -> DataFrame:
    return df.join(late, "gid").filter(F.col("updated_at") >= F.col("since"))


def _not_since(df: DataFrame, late: DataFrame) -> DataFrame:
    """The rows that are not among those computed again."""
    return df.alias("d").join(
        late.alias("l"), (F.col("d.gid") == F.col("l.gid")) & (F.col("d.updated_at") >= F.col("l.since")), "left_anti"
    )


def _before(spark: SparkSession, out: str, late: DataFrame) -> DataFrame:
    """How the videos with late rows stood before the first of them."""
    earlier = lambda df: df.join(late, "gid").filter(F.col("updated_at") < F.col("since"))
    stored = _ends(earlier(_observations(spark, out)), earlier(_table(spark, out, "denorm")))
    opening = _table(spark, out, "opening").join(late, "gid", "left_semi")
    none = late.select("gid").join(stored.unionByName(opening.drop(PART)), "gid", "left")
    return none.groupBy("gid").agg(
        F.max("obs").alias("obs"), F.max("kept").alias("kept"), F.min("first_day").alias("first_day")
    )


def _as_rows(carry: DataFrame, column: str) -> DataFrame:
    """The carried observations as rows ahead of the others."""
    return carry.filter(F.col(column).isNotNull()).select(
        "gid", *[F.col(f"{column}.{c}").alias(c) for c in (*FACTS, "updated_at")], F.lit(True).alias(_CARRIED)
    )


def _recompute(meta: DataFrame, rows: DataFrame, carry: DataFrame, rows_per_chunk: int) -> DataFrame:
    """The kept rows, with diffs and steps, from rows that follow on carried ones."""
    by_video = ("gid",)
    splits = find_splits(rows, rows_per_chunk=rows_per_chunk)
    grown = changed_only(with_diffs(spread(rows, splits), keys=by_video)).filter(~F.col(_CARRIED))
    last_kept = spread(_as_rows(carry, "kept"), splits)
    ahead = grown.unionByName(last_kept, allowMissingColumns=True)
    stepped = with_steps(ahead, keys=by_video).filter(~F.col(_CARRIED))
    return with_attributes(stepped, meta, splits, _STEPPED).drop(CHUNK)


def _changed_videos(known: DataFrame, meta: DataFrame | None) -> DataFrame:
    """New videos, and known ones with other attributes."""
    if meta is None:
        return known.select(*_META).limit(0)
    same = reduce(lambda a, b: a & b, [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in _META])
    return meta.select(*_META).alias("n").join(known.alias("k"), same, "left_anti")


def _within_retention(spark: SparkSession, out: str, history: DataFrame) -> DataFrame:
    boundary = marker(spark, out, RETENTION)
    if boundary is None:
        return history
    since = F.lit(boundary).cast("date")
    too_late = history.filter(day_of("updated_at") < since)
    write_stage(too_late, stage_path(out, REJECTS), "late")
    return history.filter(day_of("updated_at") >= since)
