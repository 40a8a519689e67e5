"""Which dates are available, complete, missing, kept or dropped.

All of these run on distinct dates. A table of cells or objects is first reduced to its dates
by a map-side aggregate; windows, if any, then see a few thousand rows per collection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from floegrid.functions.names import glob_match


def dates_side(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The small side of a join on dates.

    With a date as the only key it has at most one row per calendar day and is broadcast. With
    more keys its size is not proven, and the runtime statistics decide.
    """
    return F.broadcast(frame) if len(keys) == 1 and frame.schema[keys[0]].dataType.typeName() == "date" else frame


def distinct_dates(table: DataFrame, keys: Sequence[str] = ("collection",),
                   date: str = "acq_date") -> DataFrame:
    return table.select(*keys, F.to_date(date).alias(date)).distinct()


def newest_dates(table: DataFrame, n: int, keys: Sequence[str] = ("collection",),
                 date: str = "acq_date") -> DataFrame:
    """The n most recent dates that have data, per key."""
    dates = distinct_dates(table, keys, date).where(F.col(date).isNotNull())
    if n <= 0:
        return dates
    if not keys:
        return dates.orderBy(F.desc(date)).limit(n)
    w = Window.partitionBy(*keys).orderBy(F.desc(date))
    return dates.withColumn("_r", F.dense_rank().over(w)).where(F.col("_r") <= n).drop("_r")


def retain_newest(table: DataFrame, n: int, keys: Sequence[str] = ("collection",),
                  date: str = "acq_date") -> DataFrame:
    """Rows on the n most recent dates that have data, per key; n <= 0 keeps all."""
    if n <= 0:
        return table
    on = [*keys, date]
    return table.join(dates_side(newest_dates(table, n, keys, date), on), on, "left_semi")


def expired_dates(table: DataFrame, n: int, keys: Sequence[str] = ("collection",),
                  date: str = "acq_date") -> DataFrame:
    """The complement of newest_dates: what a retention sweep would drop."""
    return distinct_dates(table, keys, date).join(newest_dates(table, n, keys, date),
                                                  [*keys, date], "left_anti")


def granule_counts(granules: DataFrame, keys: Sequence[str] = ("acq_date", "collection"),
                   name: str | None = None, glob: str | None = None) -> DataFrame:
    kept = granules if name is None else granules.where(glob_match(F.col(name), glob))
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def availability(granules: DataFrame, sources: Sequence[str], date: str = "acq_date",
                 source: str = "source") -> DataFrame:
    """One row per date with a count column per source; a source without data counts 0."""
    return (granules.groupBy(date).pivot(source, list(sources)).agg(F.count(F.lit(1)))
            .na.fill(0, list(sources)))


def choose_source(primary: DataFrame, secondary: DataFrame, date: str = "acq_date", n: str = "n",
                  names: tuple[str, str] = ("asf", "cdse"),
                  secondary_enabled: bool = True) -> DataFrame:
    """Per date the source to read: the primary once it has caught up with the secondary."""
    p = primary.select(date, F.col(n).alias("n_primary"))
    s = secondary.select(date, F.col(n).alias("n_secondary"))
    both = p.join(s, date, "full_outer").na.fill(0, ["n_primary", "n_secondary"])
    behind = F.col("n_primary") < F.col("n_secondary")
    use_secondary = behind if secondary_enabled else F.lit(False)
    return both.select(
        date, "n_primary", "n_secondary",
        F.when(use_secondary, F.lit(names[1])).otherwise(F.lit(names[0])).alias("source"),
        F.when(use_secondary, F.col("n_secondary")).otherwise(F.col("n_primary")).alias("n"))


def complete_dates(counts: DataFrame, min_granules: int = 20, min_fraction: float = 0.0,
                   n: str = "n") -> DataFrame:
    """Dates above an absolute floor, then above a fraction of the largest survivor."""
    kept = counts.where(F.col(n) >= min_granules) if min_granules > 0 else counts
    if min_fraction > 0:
        largest = kept.agg((F.max(n) * F.lit(float(min_fraction))).alias("floor"))
        kept = kept.where(F.col(n) >= largest.scalar())
    return kept


def candidate_dates(dates: DataFrame, n: int, today: Column, lookback: int, start_offset: int = 0,
                    drop_newest: int = 0, collect: int | None = None,
                    date: str = "acq_date") -> DataFrame:
    """The newest dates with data in a lookback window, without the newest `drop_newest`.

    `collect` bounds how many dates the walk back gathers before the newest are dropped; the
    result holds at most n. Two top-k steps replace an unpartitioned window.
    """
    window = (dates.select(F.to_date(date).alias(date)).distinct()
              .where((F.col(date) <= F.date_sub(today, start_offset))
                     & (F.col(date) >= F.date_sub(today, lookback))))
    walked = window.orderBy(F.desc(date)).limit(collect if collect else n + drop_newest)
    if drop_newest:
        walked = walked.orderBy(F.desc(date)).offset(drop_newest)
    return walked.orderBy(F.desc(date)).limit(n)


def calendar_dates(spark, n: int, today: Column, date: str = "acq_date") -> DataFrame:
    """The n calendar dates ending today, for feeds without a listing."""
    return spark.range(n).select(F.date_sub(today, F.col("id").cast("int")).alias(date))


def sync_diff(desired: DataFrame, existing: DataFrame, keys: Sequence[str] = ("acq_date",)) -> DataFrame:
    """Keys to add and to drop. An empty desired set drops nothing."""
    want, have = desired.select(*keys).distinct(), existing.select(*keys).distinct()
    add = want.join(have, list(keys), "left_anti").withColumn("action", F.lit("add"))
    any_wanted = want.limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    drop = (have.join(want, list(keys), "left_anti").where(any_wanted)
            .withColumn("action", F.lit("drop")))
    return add.unionByName(drop)


def missing_outputs(candidates: DataFrame, listing: DataFrame, min_count: int = 1,
                    keys: Sequence[str] = ("collection", "acq_date")) -> DataFrame:
    """Candidates with fewer listed objects than expected."""
    enough = (listing.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") >= min_count))
    return candidates.select(*keys).distinct().join(enough, list(keys), "left_anti")


def missing_any(*parts: DataFrame) -> DataFrame:
    """Set union of several missing-date tests, newest first."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out = out.distinct()
    return out.orderBy(*[F.desc(c) for c in out.columns])


def keep_dates(slices: DataFrame, dates: DataFrame, keys: Sequence[str] = ("acq_date",)) -> DataFrame:
    wanted = dates.select(*keys).distinct()
    return slices.join(dates_side(wanted, keys), list(keys), "left_semi")


def dedupe_latest(table: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by `order`, combined before the shuffle so hot keys stay small."""
    row = F.struct(*table.columns)
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    best = table.groupBy(*key).agg(F.max_by(row, rank).alias("_row"))
    return best.select("_row.*")


def pick_per_date(listing: DataFrame, uri: str, order: str, prefer: str = "daily_COG",
                  keys: Sequence[str] = ("collection", "acq_date")) -> DataFrame:
    """One object per date: the last preferred one, else the first of the others."""
    preferred = F.col(uri).contains(prefer)
    rank = F.struct(preferred, F.when(preferred, F.col(order)).otherwise(-F.col(order)))
    return listing.groupBy(*keys).agg(F.max_by(uri, rank).alias(uri))


def group_inputs_by_date(inputs: DataFrame, time: Column, max_date: Column | None = None,
                         keys: Sequence[str] = ()) -> DataFrame:
    """Inputs with their acquisition date, without those after `max_date` or without a date.

    The date stays a column, so one job mosaics every date.
    """
    dated = inputs.withColumn("acq_date", F.to_date(time))
    known = F.col("acq_date").isNotNull() if max_date is None else F.col("acq_date") <= max_date
    return dated.where(known)


def expire_before(table: DataFrame, cutoff: Column, time_end: str = "time_end") -> DataFrame:
    """Rows whose interval has not ended before the cutoff."""
    return table.where(F.col(time_end) >= cutoff)


def forget_load_state(state: DataFrame, cutoff: Column, inputs: DataFrame,
                      date: str = "acq_date") -> DataFrame:
    """Load progress of expired dates is dropped unless the input is still there."""
    fresh = state.where(F.col(date) >= cutoff)
    kept = state.where(F.col(date) < cutoff).join(inputs.select(date).distinct(), date, "left_semi")
    return fresh.unionByName(kept)


def time_overlap(rows: DataFrame, t0: Column, t1: Column, start: str = "time",
                 end: str = "time_end") -> DataFrame:
    """Rows whose interval meets a closed query window."""
    return rows.where((F.col(start) <= t1) & (F.col(end) >= t0))
