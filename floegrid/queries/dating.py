"""Dates: availability, completeness, retention, differences and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from floegrid.functions import names as N
from floegrid.operators import dates as D
from floegrid.plans.bindings import bind, cte
from floegrid.queries import query

L = f"WITH {cte('listing_b')}"


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, "listing_b")


# Collection as the object's own, dates with data twenty apart stand for outputs.
_DONE = "ord % 4 <> 1 AND day(acq_date) % 3 <> 0"


@query("granule_counts", f"""{L}
SELECT acq_date, collection, count(*) AS n FROM listing_b WHERE key_ LIKE '%_daily_COG.tif' GROUP BY ALL""")
def granule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.granule_counts(listing(spark, sf_dir), name="key_", glob="*_daily_COG.tif")


@query("availability", f"""{L}
SELECT acq_date, count(*) FILTER (source = 'asf') AS asf, count(*) FILTER (source = 'cdse') AS cdse
FROM listing_b GROUP BY acq_date""")
def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.availability(listing(spark, sf_dir), ["asf", "cdse"])


@query("choose_source", f"""{L},
p AS (SELECT acq_date, count(*) AS n FROM listing_b WHERE source = 'asf' GROUP BY ALL),
s AS (SELECT acq_date, count(*) AS n FROM listing_b WHERE source = 'cdse' GROUP BY ALL),
b AS (SELECT acq_date, coalesce(p.n, 0) AS n_primary, coalesce(s.n, 0) AS n_secondary FROM p FULL JOIN s USING (acq_date))
SELECT *, CASE WHEN n_primary >= n_secondary THEN 'asf' ELSE 'cdse' END AS source,
  greatest(n_primary, n_secondary) AS n FROM b""")
def choose_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir)
    primary = rows.where("source = 'asf'").groupBy("acq_date").agg(F.count(F.lit(1)).alias("n"))
    secondary = rows.where("source = 'cdse'").groupBy("acq_date").agg(F.count(F.lit(1)).alias("n"))
    return D.choose_source(primary, secondary)


@query("complete_dates", f"""{L},
c AS (SELECT acq_date, collection, count(*) AS n FROM listing_b GROUP BY ALL),
f AS (SELECT * FROM c WHERE n >= 5)
SELECT * FROM f WHERE n >= 0.8 * (SELECT max(n) FROM f)""")
def complete_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.complete_dates(D.granule_counts(listing(spark, sf_dir)), 5, 0.8)


@query("candidate_dates", f"""{L}
SELECT DISTINCT acq_date FROM listing_b WHERE acq_date <= DATE '2024-01-26' AND acq_date >= DATE '2023-12-28'
ORDER BY acq_date DESC LIMIT 7 OFFSET 1""")
def candidate_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    today = F.lit("2024-01-27").cast("date")
    return D.candidate_dates(listing(spark, sf_dir), 7, today, lookback=30, start_offset=1, drop_newest=1,
                             collect=10)


@query("retain_newest", f"""{L}, d AS (SELECT DISTINCT collection, acq_date FROM listing_b),
r AS (SELECT *, row_number() OVER (PARTITION BY collection ORDER BY acq_date DESC) AS k FROM d)
SELECT l.collection, l.acq_date, l.key_, l.ord FROM listing_b l JOIN r USING (collection, acq_date) WHERE k <= 7""")
def retain_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.retain_newest(listing(spark, sf_dir), 7).select("collection", "acq_date", "key_", "ord")


@query("retain_newest_cells", f"""WITH {cte('cell_b')}, d AS (SELECT DISTINCT collection, acq_date FROM cell_b),
r AS (SELECT *, row_number() OVER (PARTITION BY collection ORDER BY acq_date DESC) AS k FROM d)
SELECT c.collection, c.acq_date, count(*) AS n, CAST(sum(dn) AS BIGINT) AS total FROM cell_b c
JOIN r USING (collection, acq_date) WHERE k <= 30 GROUP BY ALL""")
def retain_newest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = D.retain_newest(bind(spark, sf_dir, "cell_b"), 30)
    return kept.groupBy("collection", "acq_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dn").cast("long").alias("total"))


@query("expired_dates", f"""{L}, d AS (SELECT DISTINCT collection, acq_date FROM listing_b),
r AS (SELECT *, row_number() OVER (PARTITION BY collection ORDER BY acq_date DESC) AS k FROM d)
SELECT collection, acq_date FROM r WHERE k > 7""")
def expired_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.expired_dates(listing(spark, sf_dir), 7)


@query("distinct_dates", f"WITH {cte('cell_b')} SELECT DISTINCT collection, acq_date FROM cell_b")
def distinct_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.distinct_dates(bind(spark, sf_dir, "cell_b"))


@query("dedupe_latest", f"""{L}
SELECT collection, acq_date, key_, etag, ord, source FROM (
  SELECT *, row_number() OVER (PARTITION BY key_ ORDER BY ord DESC) AS r FROM listing_b) WHERE r = 1""")
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dedupe_latest(listing(spark, sf_dir), ["key_"], ["ord"])


@query("pick_per_date", f"""{L},
r AS (SELECT *, key_ LIKE '%daily_COG%' AS d FROM listing_b)
SELECT collection, acq_date, key_ FROM (SELECT *, row_number() OVER (PARTITION BY collection, acq_date
  ORDER BY d DESC, CASE WHEN d THEN -ord ELSE ord END) AS k FROM r) WHERE k = 1""")
def pick_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.pick_per_date(listing(spark, sf_dir), "key_", "ord")


_WANT = "ord % 3 = 0 AND day(acq_date) % 5 <> 0"
_HAVE = "ord % 4 <> 1 AND day(acq_date) % 3 <> 0"


@query("sync_diff", f"""{L},
w AS (SELECT DISTINCT collection, acq_date FROM listing_b WHERE {_WANT}),
h AS (SELECT DISTINCT collection, acq_date FROM listing_b WHERE {_HAVE})
SELECT *, 'add' AS action FROM (SELECT * FROM w EXCEPT SELECT * FROM h)
UNION ALL SELECT *, 'drop' AS action FROM (SELECT * FROM h EXCEPT SELECT * FROM w) WHERE EXISTS (SELECT 1 FROM w)""")
def sync_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir)
    return D.sync_diff(rows.where(_WANT), rows.where(_HAVE), ["collection", "acq_date"])


@query("sync_diff_empty_desired", f"""{L},
w AS (SELECT DISTINCT acq_date FROM listing_b WHERE ord < 0),
h AS (SELECT DISTINCT acq_date FROM listing_b)
SELECT *, 'drop' AS action FROM (SELECT * FROM h EXCEPT SELECT * FROM w) WHERE EXISTS (SELECT 1 FROM w)""")
def sync_diff_empty_desired(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir)
    return D.sync_diff(rows.where("ord < 0"), rows)


@query("date_difference", f"""{L}
(SELECT DISTINCT acq_date FROM listing_b WHERE day(acq_date) % 5 <> 0)
EXCEPT (SELECT DISTINCT acq_date FROM listing_b WHERE {_HAVE})""")
def date_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir)
    diff = D.sync_diff(rows.where("day(acq_date) % 5 <> 0"), rows.where(_HAVE))
    return diff.where("action = 'add'").select("acq_date")


@query("missing_outputs", f"""{L},
c AS (SELECT DISTINCT collection, acq_date FROM listing_b),
o AS (SELECT collection, acq_date FROM listing_b WHERE {_DONE} GROUP BY ALL HAVING count(*) >= 2)
SELECT * FROM c EXCEPT SELECT * FROM o""")
def missing_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir)
    return D.missing_outputs(rows, rows.where(_DONE), 2)


@query("missing_any", f"""{L},
c AS (SELECT DISTINCT acq_date FROM listing_b),
a AS (SELECT acq_date FROM listing_b WHERE collection = 'click' AND {_DONE} GROUP BY ALL HAVING count(*) >= 2),
g AS (SELECT acq_date FROM listing_b WHERE collection = 'view' AND day(acq_date) % 4 <> 0 GROUP BY ALL HAVING count(*) >= 2)
SELECT acq_date FROM ((SELECT * FROM c EXCEPT SELECT * FROM a) UNION (SELECT * FROM c EXCEPT SELECT * FROM g))
ORDER BY acq_date DESC""")
def missing_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir)
    a = rows.where(f"collection = 'click' AND {_DONE}")
    g = rows.where("collection = 'view' AND day(acq_date) % 4 <> 0")
    return D.missing_any(D.missing_outputs(rows, a, 2, ["acq_date"]), D.missing_outputs(rows, g, 2, ["acq_date"]))


@query("keep_dates", f"""{L}
SELECT ord, acq_date FROM listing_b WHERE acq_date IN (SELECT acq_date FROM listing_b WHERE key_ LIKE '%_daily_COG.tif'
  AND day(acq_date) % 4 = 1)""")
def keep_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir)
    daily = rows.where(N.glob_match(F.col("key_"), "*_daily_COG.tif") & (F.expr("day(acq_date) % 4 = 1")))
    return D.keep_dates(rows, daily).select("ord", "acq_date")


@query("union_collections", f"""{L}
SELECT collection, acq_date, count(*) AS n FROM (
  SELECT collection, acq_date FROM listing_b WHERE collection = 'click'
  UNION ALL SELECT collection, acq_date FROM listing_b WHERE collection = 'view'
  UNION ALL SELECT collection, acq_date FROM listing_b WHERE collection NOT IN ('click', 'view')) GROUP BY ALL""")
def union_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    from functools import reduce
    rows = listing(spark, sf_dir).select("collection", "acq_date")
    parts = [rows.where(part) for part in ("collection = 'click'", "collection = 'view'", "collection NOT IN ('click', 'view')")]
    return D.granule_counts(reduce(DataFrame.unionByName, parts), ["collection", "acq_date"])


@query("group_inputs_by_date", f"""{L},
d AS (SELECT collection, CAST(try_strptime(nullif(regexp_extract(key_, '_(\\d{{8}})_daily_COG', 1), ''), '%Y%m%d') AS DATE) AS acq_date
  FROM listing_b)
SELECT collection, acq_date, count(*) AS n FROM d WHERE acq_date <= DATE '2024-01-20' GROUP BY ALL""")
def group_inputs_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = listing(spark, sf_dir).select("collection", "key_")
    time = N.acq_time(F.col("key_"), regex=r"_(?P<start_date>\d{8})_daily_COG")
    dated = D.group_inputs_by_date(inputs, time, F.lit("2024-01-20").cast("date"))
    return D.granule_counts(dated, ["collection", "acq_date"])


@query("expire_before", f"""WITH {cte('wind_b')}
SELECT event_id, acq_date FROM wind_b WHERE acq_date + 1 >= DATE '2024-01-25' - 7""")
def expire_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind(spark, sf_dir, "wind_b").withColumn("time_end", F.date_add("acq_date", 1))
    return D.expire_before(rows, F.date_sub(F.lit("2024-01-25").cast("date"), 7)).select("event_id", "acq_date")


@query("time_overlap", f"""WITH {cte('granule_b')}
SELECT ord FROM granule_b WHERE acq_date <= DATE '1998-03-02' AND acq_date + 1 >= DATE '1998-03-01'""")
def time_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind(spark, sf_dir, "granule_b").withColumns({
        "time": F.col("acq_date"), "time_end": F.date_add("acq_date", 1)})
    t0, t1 = F.lit("1998-03-01").cast("date"), F.lit("1998-03-02").cast("date")
    return D.time_overlap(rows, t0, t1).select("ord")
