"""Counts of stored tables from the footers of their files."""

import pytest
from pyspark.sql import functions as F

import countersign as cs


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def rows_by_key(df, by):
    return {r[by]: r.total_count for r in cs.row_counts(df, by=by).collect()}


@pytest.fixture(params=["parquet", "orc"])
def stored(request, spark, tmp_path):
    """Keys with leading zeros, odd characters and NULL, several files a key, and a column of NULLs."""
    keys = F.expr("element_at(array('007', '2024 01/02', '=', NULL), CAST(id % 4 + 1 AS INT))")
    rows = spark.range(0, 1000, 1, 4).select("id", F.lit(None).cast("string").alias("note"), keys.alias("pt"))
    rows.write.format(request.param).partitionBy("pt").save(str(tmp_path / "t"))
    return cs.Stored(str(tmp_path / "t"), request.param)


def test_counts_come_from_footers(spark, stored):
    opened = cs.open_for_counts(spark, stored)
    for counted in (cs.row_counts(opened), cs.row_counts(opened, by="pt"),
                    cs.row_counts(cs.partition_range(opened, "pt", "0", "2025"), by="pt")):
        assert "PushedAggregation: [COUNT(*)]" in plan_of(counted)
    assert cs.row_counts(opened).first().total_count == 1000
    assert rows_by_key(opened, "pt") == {"007": 250, "2024 01/02": 250, "=": 250, None: 250}
    assert rows_by_key(cs.partition_range(opened, "pt", "0", "2025"), "pt") == {"007": 250, "2024 01/02": 250}


def test_other_keys_and_copies_are_scanned(spark, stored):
    opened = cs.open_for_counts(spark, stored)
    by_column = cs.row_counts(opened.withColumn("k", F.col("id") % 3), by="k")
    assert "COUNT(*)" not in plan_of(by_column)
    assert sorted(r.total_count for r in by_column.collect()) == [333, 333, 334]
    frame = spark.range(3)
    assert cs.open_for_counts(spark, frame) is frame


def test_tables_without_rows(spark, tmp_path):
    spark.range(5).limit(0).selectExpr("CAST(id AS STRING) AS note").write.parquet(str(tmp_path / "none"))
    opened = cs.open_for_counts(spark, cs.Stored(str(tmp_path / "none")))
    assert cs.row_counts(opened).first().total_count == 0
    assert cs.row_counts(opened, by="note").count() == 0


def test_a_given_schema_and_the_session_are_kept(spark, tmp_path):
    spark.range(10).selectExpr("CAST(id AS STRING) AS note", "id % 2 AS pt").write.partitionBy("pt").parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        opened = cs.open_for_counts(spark, cs.Stored(str(tmp_path / "t"), schema="note string, pt int"))
        assert rows_by_key(opened, "pt") == {0: 5, 1: 5}
        assert opened.sparkSession.conf.get("spark.sql.shuffle.partitions") == "5"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_a_run_counts_by_footers(spark, tmp_path):
    rows = spark.range(100).selectExpr("CAST(id AS STRING) AS note", "CAST(id % 3 AS STRING) AS pt")
    rows.write.partitionBy("pt").parquet(str(tmp_path / "l"))
    rows.filter("note <> '7'").write.partitionBy("pt").parquet(str(tmp_path / "r"))
    left, right = cs.Stored(str(tmp_path / "l")), cs.Stored(str(tmp_path / "r"))
    specs = {"p": cs.TableSpec("p", left, right, "pt"), "w": cs.TableSpec("w", left, right), "s": cs.TableSpec("s", left, rows, "pt")}
    listed = spark.createDataFrame(list(enumerate(specs)), "line_no bigint, table_name string")
    found = cs.run(spark, listed, specs).tables.orderBy("line_no").collect()
    assert [(r.branch, r.status, r.n_diffs) for r in found] == [
        ("count_only_by_partition", "FAIL", 1), ("count_only_global", "FAIL", 1), ("count_only_by_partition", "PASS", 0)]
