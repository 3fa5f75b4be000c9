"""Rule-table operators on the reference's truth tables."""

from pyspark.sql import functions as F

from rulelake.operators import rules as R


def test_id_sort(spark):
    ids = spark.createDataFrame([("H100",), ("HFOO",), ("H200",), ("HBAR",), ("",)], "rule_id string")
    got = [r.rule_id for r in R.sort_rule_ids(ids).collect()]
    assert got == ["H100", "H200", "", "HBAR", "HFOO"]


def test_merge_truth_table(spark):
    existing = spark.createDataFrame(
        [("H1", 0, "old1"), ("H2", 1, "old2"), ("H3", 2, "old3"), ("H4", 3, "old4")],
        "rule_id string, pos long, name string")
    fetched = spark.createDataFrame([("H1", 0, "new1"), ("H5", 1, "new5")], "rule_id string, pos long, name string")
    attempted = spark.createDataFrame([("H1",), ("H2",), ("H3",), ("H5",)], "rule_id string")
    failed = spark.createDataFrame([("H3",)], "rule_id string")
    out = R.merge_snapshot(existing, fetched, attempted, failed)
    rows = out.orderBy(F.col("existing_pos").asc_nulls_last(), "fetched_pos").collect()
    # H1 updated in place, H2 dropped (attempted, not fetched, not failed),
    # H3 kept on failure, H4 kept (not listed), H5 appended
    assert [(r.rule_id, r.name) for r in rows] == [("H1", "new1"), ("H3", "old3"), ("H4", "old4"), ("H5", "new5")]


def test_first_n_discovered(spark):
    listed = spark.createDataFrame(
        [(1, 0, "H30"), (1, 1, "H40"), (2, 0, "H40"), (2, 1, "H10"), (3, 0, "H5")],
        "page_no int, pos int, rule_id string")
    got = [r.rule_id for r in R.first_n_discovered(listed, 3).orderBy("sort_group", "sort_num").collect()]
    assert got == ["H10", "H30", "H40"]
