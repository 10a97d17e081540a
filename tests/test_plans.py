"""Shapes of the physical plans."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from boxlake.operators import worklist as W
from boxlake.plans.queries import QUERIES


def _plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_worklists_are_anti_joins(spark, sf_dir):
    for name in ("missing_games", "missing_teambox", "missing_playerbox"):
        assert "LeftAnti" in _plan(spark, sf_dir, name)
    assert "TakeOrderedAndProject" in _plan(spark, sf_dir, "worklist_one_season")


def test_entries_of_a_game_are_found_once(spark, sf_dir):
    """A condition on the measures does not find the entries anew for each of them, and no text is cast to see if it is a number."""
    for name in ("teambox_rows", "teambox_rejects", "empty_team_boxes", "teambox_zeros_kept"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert 0 < plan.count("try_element_at(filter(") + plan.count("element_at(filter(") <= 4, name
        assert "StructField(pts,LongType" not in plan and "StructField(netRating,DoubleType" not in plan


def test_limits_sort_blocks_and_not_seasons(spark):
    todo = spark.range(5000).selectExpr(
        "lpad(cast(id as string), 10, '0') as game_id", "if(id % 5 = 0, 'b', 'a') as season",
        "date_add(date'2024-01-01', cast(id % 90 as int)) as game_date",
    )
    for order in (W.SPINE_ORDER, W.GAME_ORDER):
        for n in (0, 7, 2500):
            taken = W.first_n_per_season(todo, order, n)
            place = F.row_number().over(Window.partitionBy("season").orderBy(*order))
            want = todo.withColumn("place", place).filter(F.col("place") <= n)
            assert sorted(r.game_id for r in taken.collect()) == sorted(r.game_id for r in want.collect())
        plan = taken._jdf.queryExecution().executedPlan().toString()
        ranks = [line for line in plan.splitlines() if "Window [row_number" in line]
        assert ranks and all("_block" in line for line in ranks)


def test_scans_are_pruned(spark, sf_dir):
    plan = _plan(spark, sf_dir, "missing_playerbox")
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    plan = _plan(spark, sf_dir, "errors_totals")
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(event_type,error)" in pushed and "GreaterThanOrEqual(ts," in pushed


def test_wide_joins_reuse_the_collapse(spark, sf_dir):
    """Without broadcasts a merge shuffles each side once for collapse and join together."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, sf_dir, "upsert_playerbox")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "FullOuter" in plan
    assert plan.count("Exchange hashpartitioning(game_id") == 2
