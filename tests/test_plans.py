"""Physical plans of the feature families, and the lifetime of what is staged."""

import re

import pytest
from pyspark.sql import functions as F

from ebbtide.functions import staging
from ebbtide.operators import feature_table
from ebbtide.plans.inputs import Inputs

ROOT = "/root/testdata/sf0.001"


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, ROOT)


def test_families_meet_without_an_exchange_on_the_parent(spark, inputs):
    """All six families aggregate and join in the buckets that were written, also where none is small enough for a broadcast."""
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check_families(inputs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def check_families(inputs):
    plan = physical(feature_table.feature_table(inputs.families, inputs.p))
    assert plan.count("Bucketed: true") >= 6
    assert not re.search(r"Exchange hashpartitioning\(parentname", plan)
    assert plan.count("SortMergeJoin [parentname") >= 5


def test_buckets_hold_each_parent_once(spark, inputs):
    files = inputs.labelled.select("parentname", F.input_file_name().alias("file")).distinct().groupBy("parentname").agg(F.count("*").alias("files"))
    assert files.agg(F.max("files")).first()[0] == 1
    plain = staging.stage(inputs.labelled, "plain")
    assert plain.exceptAll(inputs.labelled).isEmpty() and inputs.labelled.exceptAll(plain).isEmpty()


def test_a_scope_is_released_alone_and_not_while_it_is_read(spark):
    outside = staging.stage(spark.range(5), "outside")
    with staging.scope(spark, "part"):
        inside = staging.stage(spark.range(7), "inside")
    assert not staging.release_scope(spark, "part", still_read=inside.where("id > 2"))
    assert inside.count() == 7
    assert staging.release_scope(spark, "part", still_read=outside)
    assert outside.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(inside.inputFiles()[0]).count()
