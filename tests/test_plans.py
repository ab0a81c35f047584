"""What the plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

import countersign as cs
from checks.pairs import EVENTS, LINEITEM
from checks.queries import compared, sides

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_compare_shuffles_profiles_only(spark):
    text = plan(compared(spark, DATA, LINEITEM))
    assert text.count("Exchange hashpartitioning") == 2  # one per side, both after aggregation
    assert "Join" not in text and "CartesianProduct" not in text
    for exchange in re.findall(r"Exchange hashpartitioning.*\n.*", text):
        assert "HashAggregate" in exchange  # partial aggregation is below the exchange
    assert "Python" not in text and "ObjectHashAggregate" not in text


def test_whole_table_compare_has_no_join(spark):
    df = spark.read.parquet(f"{DATA}/orders.parquet")
    text = plan(cs.compare(df.drop("o_totalprice"), df.drop("o_totalprice").filter("o_custkey > 5"), table_name="t"))
    assert "Join" not in text and "hashpartitioning" not in text
    # Doubles are summed by their range of powers first: a few rows a task, aggregated before they are shuffled.
    text = plan(cs.compare(df, df.filter("o_custkey > 5"), table_name="t"))
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 2
    for exchange in re.findall(r"Exchange hashpartitioning.*\n.*", text):
        assert "hashpartitioning(c#" in exchange and "HashAggregate" in exchange


def test_only_numeric_columns_are_read(spark):
    df = spark.read.parquet(f"{DATA}/lineitem.parquet")
    text = plan(cs.compare(df, df, table_name="t"))
    for schema in re.findall(r"ReadSchema: (\S+)", text):
        assert "l_returnflag" not in schema and "l_shipdate" not in schema
    counts = plan(cs.compare(df.select("l_returnflag"), df.select("l_returnflag"), table_name="t"))
    assert set(re.findall(r"ReadSchema: (\S+)", counts)) == {"struct<>"}


@pytest.mark.parametrize("start,end", [("20240104", "20240111"), ("20240104", "2024-01-11"), (None, "20240111")])
def test_range_prunes_partitions(spark, tmp_path, start, end):
    left, _ = sides(spark, DATA, EVENTS)
    path = str(tmp_path / "events")
    left.write.partitionBy("pt").parquet(path)
    from countersign.sources.tables import open_side

    df = open_side(spark, cs.Stored(path))
    text = plan(cs.compare(df, df, table_name="t", partition_column="pt", start=start, end=end))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert filters and all("pt" in f for f in filters)


def test_keys_are_reduced_before_the_shuffle(spark):
    text = plan(cs.partition_keys(*sides(spark, DATA, EVENTS)))
    assert text.count("Exchange") == 1 and "keys=[pt" in text.split("Exchange")[1]


def test_hot_partition_ships_one_row_per_task(spark):
    """A key with a third of all rows costs no more in the shuffle than any other."""
    df = spark.range(0, 30000, numPartitions=8).select(
        F.col("id").alias("v"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("pt"))
    metrics = cs.compare(df, df, table_name="t", partition_column="pt")
    assert cs.differences(metrics).count() == 0
    assert cs.partition_status(metrics).filter("pt = 'hot'").first().left_count == 10000


def test_sides_whose_shuffles_are_coalesced_differently_still_meet(spark):
    """The united profiles are grouped where they lie, which must hold for any coalescing."""
    setting = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "false")
    spark.conf.set(size, "128k")
    try:
        def keyed(n):
            return spark.range(n).select("id", F.col("id").cast("string").alias("pt"))

        metrics = cs.compare(keyed(60000), keyed(3000), table_name="t", partition_column="pt")
        counts = cs.partition_status(metrics).groupBy("presence").count().collect()
        assert {r["presence"]: r["count"] for r in counts} == {"BOTH": 3000, "LEFT_ONLY": 57000}
    finally:
        spark.conf.unset(setting)
        spark.conf.unset(size)
