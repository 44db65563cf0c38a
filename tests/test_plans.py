"""Plan guards over every registered query: no cross joins, no row-at-a-time
Python UDFs, no window without a partition spec."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from plan_report import plan_facts  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_query_plan_is_scale_safe(spark):
    import __spark_entry__ as E
    bad = []
    from vqaspark.plans.registry import QUERIES, load_all
    load_all()
    for name, fn in sorted((n, f) for n, f in E.queries().items() if n in QUERIES):
        s = plan_facts(fn(spark, SF))
        if s["unpartitioned_window"]:
            bad.append((name, "unpartitioned window"))
        if "BatchEvalPython" in s["python"]:
            bad.append((name, "row-at-a-time UDF"))
        if any("NestedLoop" in j or "Cartesian" in j for j in s["joins"]):
            bad.append((name, "cross join"))
    assert not bad, bad


def test_detector_flags_known_bad_plans(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10)
    bad = df.withColumn("rn", F.row_number().over(Window.orderBy("id")))
    assert plan_facts(bad)["unpartitioned_window"]
    good = df.withColumn("rn", F.row_number().over(Window.partitionBy(F.col("id") % 2).orderBy("id")))
    assert not plan_facts(good)["unpartitioned_window"]
    no_order = df.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("id")))
    assert not plan_facts(no_order)["unpartitioned_window"]
    cross = df.crossJoin(spark.range(3).withColumnRenamed("id", "x"))
    j = plan_facts(cross)["joins"]
    assert any("NestedLoop" in x or "Cartesian" in x for x in j)
