from pyspark.sql import functions as F

from rulelake.operators.latest import latest_per_key


def test_latest_per_key_picks_highest_order(spark):
    df = spark.createDataFrame(
        [("g1", 1, 10, "old"), ("g1", 2, 10, "new"), ("g2", 5, 1, "only"),
         ("g1", 2, 9, "tie-lower")],
        "group_name string, seq int, tie int, members string")
    out = {r.group_name: r.members for r in latest_per_key(df, ["group_name"], ["seq", "tie"]).collect()}
    assert out == {"g1": "new", "g2": "only"}


def test_latest_plan_has_partial_aggregate(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert plan.count("HashAggregate") + plan.count("ObjectHashAggregate") + plan.count("SortAggregate") >= 2
