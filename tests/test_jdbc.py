"""A5 against an embedded in-memory Derby database (inside the test JVM: no file, no port)."""

from __future__ import annotations

import pytest

from signals.sources.jdbc import CollectorTarget, read_jdbc_target

DERBY = "org.apache.derby.jdbc.EmbeddedDriver"


@pytest.fixture(scope="module")
def target(spark):
    url = "jdbc:derby:memory:signals_a5;create=true"
    rows = [(i, f"line {i}", i * 10) for i in range(1, 1001)]
    df = spark.createDataFrame(rows, "ID BIGINT, RAW_DATA STRING, SEQ BIGINT")
    df.write.format("jdbc").option("url", url).option("driver", DERBY).option("dbtable", "EVENTS").mode("overwrite").save()
    return CollectorTarget("derby", "jdbc", connection_info={"url": url, "driver": DERBY, "table": "EVENTS"})


def test_parallel_incremental_read(spark, target):
    df = read_jdbc_target(spark, target, since=5000, high_water_column="SEQ", partition_column="ID", num_partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 500 and df.agg({"SEQ": "min"}).first()[0] == 5010
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(SEQ,5000)" in plan


def test_full_read_and_errors(spark, target):
    assert read_jdbc_target(spark, target).count() == 1000
    with pytest.raises(ValueError):
        read_jdbc_target(spark, CollectorTarget("x", "ssh"))
    with pytest.raises(ValueError):
        read_jdbc_target(spark, CollectorTarget("x", "jdbc", is_active=False, connection_info={"table": "T"}))
