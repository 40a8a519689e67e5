from __future__ import annotations

from floegrid.queries import load_all
from tests.test_queries import SF


def test_sides_of_the_cell_join_are_not_broadcast(spark):
    """Rows are repeated over cells and days after sizes were estimated."""
    found = load_all()["overlap_pairs_by_day_diff"][0](spark, SF)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")]
    joins = [line for line in final.splitlines() if "Join [_ka" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_metrics_by_satellite_equal_the_rounded_pairs(spark):
    """Maxima that are rounded once are those of rounded pairs; pairs with fractions of a km2 and of an hour."""
    from pyspark.sql import functions as F

    from floegrid.operators.overlap import metrics_by, overlap_metrics
    pairs = spark.range(200).selectExpr(
        "id % 3 AS k", "date'2024-01-01' AS date_a", "date_add(date'2024-01-01', int(id % 7)) AS date_b",
        "timestamp'2024-01-01 00:00:00' AS start_a", "timestamp_seconds(1704067200 + id * 997) AS start_b",
        "100 + id / 7 AS area_a_km2", "IF(id % 50 = 0, 0, 90 + id / 11) AS area_b_km2", "50 + id / 13 AS intersect_km2")
    got = metrics_by(pairs, "k").orderBy("k").collect()
    want = overlap_metrics(pairs).groupBy("k").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.min("day_diff").alias("min_day_diff"), F.max("day_diff").alias("max_day_diff"),
        F.sum("intersect_km2").cast("long").alias("total_km2"),
        *[F.max(c).alias(f"max_{c}") for c in ("iou", "frac_of_a", "frac_of_b", "dt_hours")]).orderBy("k").collect()
    assert got == want and len(got) == 3


def test_rings_are_not_shuffled_with_the_footprint_pairs(spark):
    plan = load_all()["overlap_footprints"][0](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("overlap_parts")


def above_join(frame) -> str:
    """The physical plan from the result down to the join of the granules."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan[:plan.index("SortMergeJoin")]


def test_flagship_pairs_are_exchanged_once_and_tested_without_rounding(spark):
    found = load_all()["overlap_flagship"][0](spark, SF)
    assert above_join(found).count("Exchange") == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):].splitlines()[0]
    assert ">= 0.0999995" in join and "round(" not in join


def test_iou_test_equals_the_rounded_iou(spark):
    """Values on both sides of where rounding to six digits reaches the threshold, and a pair without area."""
    from pyspark.sql import functions as F

    from floegrid.operators.overlap import overlap_metrics, reaches_iou
    shares = [0.0, 0.0999994, 0.09999949999999999, 0.0999995, 0.09999950000000001, 0.0999999, 0.1, 0.25, 0.2500004, 0.2500005, 0.3, 1.0]
    pairs = spark.createDataFrame([(s, 1.0) for s in shares] + [(0.0, 0.0)], "inter double, total double").select(
        F.lit("2024-01-01").cast("date").alias("date_a"), F.lit("2024-01-01").cast("date").alias("date_b"),
        F.lit(0).cast("timestamp").alias("start_a"), F.lit(0).cast("timestamp").alias("start_b"),
        (F.col("total") / 2 + F.col("inter") / 2).alias("area_a_km2"), (F.col("total") / 2 + F.col("inter") / 2).alias("area_b_km2"),
        F.col("inter").alias("intersect_km2"))
    union = F.col("area_a_km2") + F.col("area_b_km2") - F.col("intersect_km2")
    for least in (0.1, 0.25, 0.2500001, 0.7):
        tested = pairs.withColumn("passes", reaches_iou(F.col("intersect_km2"), union, least))
        rows = overlap_metrics(tested).select("passes", (F.col("iou") >= least).alias("want")).collect()
        assert len(rows) == 13 and all(r["passes"] == r["want"] for r in rows)


def test_pairs_are_exchanged_once_and_without_metrics(spark):
    found = load_all()["overlap_pairs"][0](spark, SF)
    plan = above_join(found)
    assert plan.count("Exchange") == 1
    assert "frac_of_a" in plan[:plan.index("Exchange")] and "frac_of_a" not in plan[plan.index("Exchange"):]
    keys = [(-r["intersect_km2"], r["granule_a"], r["granule_b"]) for r in found.collect()]
    assert len(keys) > 100 and keys == sorted(keys)


def test_index_read_stores_only_the_pairs_asked_for(spark, monkeypatch):
    from floegrid.queries import flows
    written = []

    def write(overlaps, path, **options):
        written.append((above_join(overlaps), overlaps.count()))
        return flows_write(overlaps, path, **options)
    flows_write = flows.write_overlaps
    monkeypatch.setattr(flows, "write_overlaps", write)
    found = load_all()["overlap_index_read"][0](spark, SF).collect()
    [(plan, stored)] = written
    assert stored == len(found) > 0 and "Exchange" not in plan


def test_index_of_one_day_difference_is_written_without_an_exchange(spark, tmp_path):
    from floegrid.sources.sinks import read_overlaps, write_overlaps
    pairs = spark.range(0, 1000, 1, 4).selectExpr("id AS granule_a", "id + 1 AS granule_b", "4S AS day_diff",
                                                  "double(id * 7919 % 1000) AS intersect_km2", "id / 1000D AS iou")
    write_overlaps(pairs, str(tmp_path / "index"), group_bytes=1 << 17, cluster=False)
    back = read_overlaps(spark, str(tmp_path / "index"), day_diff=4, min_iou=0.2)
    assert {r["granule_a"] for r in back.collect()} == set(range(200, 1000))
    assert len(list((tmp_path / "index").glob("*.parquet"))) == 4


def test_footprints_ride_packed_and_come_back_the_same(spark):
    """Several rings, one ring, no ring and null."""
    import numpy as np
    import pyarrow as pa

    from floegrid.functions.clip import POINT, unpacked, packed_parts
    shapes = [[[(0.5, 1.0), (2.0, -3.25), (0.5, 1.0)], [(1e7, -1e-9)]], [[(1.0, 2.0), (3.0, 4.0)]], [], None, [[(1.0, 2.0), (3.0, 4.0)]]]
    column = pa.array([s and [[dict(x=x, y=y) for x, y in r] for r in s] if s is not None else None for s in shapes],
                      pa.list_(pa.list_(POINT)))
    back = list(unpacked(packed_parts.func(column)))
    assert back[3] is None and len(back) == 5
    assert [s if s is None else [np.asarray(r).tolist() for r in s] for s in back] == [
        s if s is None else [[list(p) for p in r] for r in s] for s in shapes]


def test_crowded_cells_do_not_shuffle_the_sides_again(spark):
    """Each side of the cell join is exchanged once, whatever its size is taken to be."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = load_all()["overlap_exact_clip"][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
