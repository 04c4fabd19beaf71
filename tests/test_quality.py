import datetime as dt

import pytest
from pyspark.sql import functions as F

from brightlake.operators import quality


@pytest.mark.parametrize("failures,status", [(0, "pass"), (9, "warn"), (10, "fail"), (11, "fail")])
def test_status_boundaries(spark, failures, status):
    df = spark.range(1000).withColumn("ok", F.col("id") >= failures)
    r = quality.run_rules(df, "t", "silver", {"rule": F.col("ok")}, "2026-01-01").first()
    assert (r.rows_tested, r.rows_failed, r.status) == (1000, failures, status)


def results(spark, rows):
    return spark.createDataFrame(
        rows, "table_name string, layer string, check_name string, status string, "
              "rows_tested long, rows_failed long, run_at timestamp_ntz")


AS_OF = dt.datetime(2026, 1, 1, 12, 0)


def test_gate(spark):
    old = AS_OF - dt.timedelta(minutes=61)
    fresh = AS_OF - dt.timedelta(minutes=59)
    rows = [("o", "silver", "a", "fail", 10, 5, old), ("o", "silver", "b", "pass", 10, 0, fresh)]
    g = quality.dq_gate(results(spark, rows), AS_OF).first()
    assert (g.total_checks, g.failures, g.decision) == (1, 0, "dq_passed")
    g = quality.dq_gate(results(spark, []), AS_OF).first()
    assert (g.total_checks, g.decision) == (0, "dq_passed")
    warn = rows + [("o", "silver", "c", "warn", 10, 1, fresh)]
    g = quality.dq_gate(results(spark, warn), AS_OF).first()
    assert (g.warnings, g.decision) == (1, "dq_passed")
    fail = warn + [("o", "silver", "d", "fail", 10, 9, fresh), ("o", "gold", "e", "fail", 1, 1, fresh)]
    g = quality.dq_gate(results(spark, fail), AS_OF)
    assert g.first().failed_checks == ["d"]
    with pytest.raises(RuntimeError):
        quality.assert_gate(g)


def test_column_tests_and_pass_rate(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c")], "k long, v string")
    out = {(r.column_name, r.test): r.failures for r in
           quality.column_tests(df, "t", unique=["k"], not_null=["k", "v"]).collect()}
    assert out == {("k", "not_null"): 1, ("v", "not_null"): 1, ("k", "unique"): 1}
    rows = [("o", "silver", n, s, 1, 0, AS_OF) for n, s in [("a", "pass"), ("b", "warn"),
                                                           ("c", "pass"), ("d", "fail")]]
    assert quality.pass_rate(results(spark, rows)).first().pass_rate == 50.0
    assert quality.data_present(df) and not quality.data_present(df.limit(0))


def test_column_tests_several_unique_and_none(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, None), (None, "b")],
                               "k long, v string")
    out = {(r.column_name, r.test): (r.failures, r.status) for r in
           quality.column_tests(df, "t", unique=["k", "v"], not_null=["v"]).collect()}
    assert out == {("k", "unique"): (1, "fail"), ("v", "unique"): (2, "fail"),
                   ("v", "not_null"): (1, "fail")}
    only_nn = quality.column_tests(df.filter("k = 2"), "t", not_null=["k", "v"]).collect()
    assert {(r.column_name, r.failures, r.status) for r in only_nn} == {("k", 0, "pass"),
                                                                        ("v", 0, "pass")}
