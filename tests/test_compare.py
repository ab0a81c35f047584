"""Rules of the comparison."""

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import countersign as cs
import fixtures as fx

DATA = "/root/testdata/sf0.001"


def listed(metrics, *columns):
    return [tuple(r[c] for c in columns) for r in cs.in_order(metrics).collect()]


def test_numeric_columns_in_schema_order(spark):
    df = spark.sql("""
        SELECT 'x' AS s, 1Y AS b, 1S AS h, 1 AS i, 1L AS l, CAST(1 AS FLOAT) AS f, 1D AS d,
               CAST(1 AS DECIMAL(10,2)) AS m, true AS t, DATE'2025-01-01' AS day, array(1) AS a,
               named_struct('n', 1) AS st, INTERVAL '1' DAY AS iv, CAST('a' AS BINARY) AS bin""")
    assert cs.numeric_columns(df) == [
        ("b", "tinyint"), ("h", "smallint"), ("i", "int"), ("l", "bigint"), ("f", "float"),
        ("d", "double"), ("m", "decimal(10,2)"),
    ]


@pytest.mark.parametrize("columns,expected", [(["dt", "pt"], True), (["dt"], False), (["PT"], False), ([], False)])
def test_only_the_exact_name_makes_a_table_partitioned(columns, expected):
    assert cs.is_partitioned(columns) is expected


def test_profile_of_no_rows(spark):
    empty = spark.createDataFrame([], "a int, s string")
    assert tuple(cs.profile(empty).first()) == (0, None, None, None)
    assert cs.profile(empty, by="s").count() == 0
    assert cs.row_counts(empty).first().total_count == 0


def test_all_null_column_and_empty_tables_match(spark):
    nulls = spark.createDataFrame([(None,), (None,)], "a double")
    assert all(m for m, in listed(cs.compare(nulls, nulls, table_name="t"), "match"))
    assert listed(cs.compare(nulls.limit(0), nulls.limit(0), table_name="t"), "left_value", "match") == [
        ("0", True), (None, True), (None, True), (None, True)]


def test_null_differs_from_value(spark):
    left = spark.createDataFrame([(None,)], "a int")
    right = spark.createDataFrame([(1,)], "a int")
    assert listed(cs.differences(cs.compare(left, right, table_name="t")), "metric") == [("sum",), ("max",), ("min",)]


def test_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "a double")
    assert cs.differences(cs.compare(df, df, table_name="t")).count() == 0
    strict = cs.compare(df, df, table_name="t", nan_equal=False)
    assert listed(cs.differences(strict), "metric") == [("sum",), ("max",)]


def test_partition_on_one_side(spark):
    left, right = fx.keyed(spark)
    left, right = left.filter("pt = '20250101'"), right.filter("pt = '20250102'")
    metrics = cs.compare(left, right, table_name="t", partition_column="pt")
    assert listed(cs.differences(metrics), "pt", "column", "metric", "left_value", "right_value") == [
        ("20250101", "*", "partition", "EXISTS", "MISSING"),
        ("20250102", "*", "partition", "MISSING", "EXISTS"),
    ]
    status = cs.partition_status(metrics).orderBy("pt").collect()
    assert [(r.left_count, r.right_count, r.presence, r.n_diffs, r.status) for r in status] == [
        (3, 0, "LEFT_ONLY", 1, "FAIL"), (0, 3, "RIGHT_ONLY", 1, "FAIL")]
    # Every metric is still listed, with nothing on the missing side.
    assert metrics.count() == 2 * (2 + 9)


def test_count_only_partition_on_one_side(spark):
    left, right = fx.texts(spark)
    right = right.filter("pt <> '20250102'")
    metrics = cs.compare(left, right, table_name="t", partition_column="pt")
    assert listed(cs.differences(metrics), "pt", "metric", "left_value", "right_value") == [
        ("20250102", "count", "4", "0")]


def test_null_key_is_a_partition_without_range_and_dropped_with_one(spark):
    left = spark.createDataFrame([(1, None), (2, "a")], "v int, pt string")
    right = spark.createDataFrame([(3, None), (2, "a")], "v int, pt string")
    metrics = cs.compare(left, right, table_name="t", partition_column="pt")
    assert {r.pt for r in cs.differences(metrics).collect()} == {None}
    assert cs.partition_status(metrics).count() == 2
    ranged = cs.compare(left, right, table_name="t", partition_column="pt", start="a")
    assert [r.pt for r in cs.partition_status(ranged).collect()] == ["a"]


def test_empty_range_passes_with_nothing_compared(spark):
    left, right = fx.keyed(spark)
    metrics = cs.compare(left, right, table_name="t", partition_column="pt", start="20260101", end="20260131")
    assert metrics.count() == 0
    assert cs.table_status(metrics).count() == 0


def test_bounds_do_not_touch_a_whole_table_comparison(spark):
    left, right = fx.flat(spark)
    assert fx.diffs_of(cs.compare(left, right, table_name="t", start="x", end="y")) == fx.diffs_of(
        cs.compare(left, right, table_name="t"))


def test_missing_right_column_fails_at_plan_time_and_additional_ones_do_not_matter(spark):
    left, right = fx.flat(spark)
    with pytest.raises(AnalysisException):
        cs.compare(left, right.drop("score"), table_name="t")
    same = cs.compare(right, right.withColumn("more", F.lit(1)), table_name="t")
    assert cs.differences(same).count() == 0


def test_values_across_types(spark):
    left = spark.createDataFrame([(1, 1.5)], "a int, b double")
    right = left.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("decimal(10,4)").alias("b"))
    metrics = cs.compare(left, right, table_name="t")
    assert cs.differences(metrics).count() == 0
    assert listed(metrics, "type")[1] == ("int",)


def test_key_types_must_fit(spark):
    left = spark.createDataFrame([(1, "1")], "v int, pt string")
    with pytest.raises(ValueError, match="partition column pt is string on the left, int on the right"):
        cs.compare(left, left.withColumn("pt", F.col("pt").cast("int")), table_name="t", partition_column="pt")


def test_integral_keys_of_different_width_meet(spark):
    left = spark.createDataFrame([(1, 20250101)], "v int, pt int")
    right = left.withColumn("pt", F.col("pt").cast("bigint"))
    metrics = cs.compare(left, right, table_name="t", partition_column="pt")
    assert cs.differences(metrics).count() == 0
    assert {r.column for r in metrics.collect()} == {"*", "v", "pt"}


def test_awkward_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, "k")], "`a.b` int, `c d` int, `e``f` int, `g'h\\\\` int, `p.t` string")
    metrics = cs.compare(df, df, table_name="t", partition_column="p.t", start="k", end="k")
    assert [c for c, in listed(metrics, "column")] == ["*"] + ["a.b"] * 3 + ["c d"] * 3 + ["e`f"] * 3 + ["g'h\\\\"] * 3
    assert all(m for m, in listed(metrics, "match"))
    df.createOrReplaceTempView("awkward")
    text = cs.check_sql("awkward", [n for n, _ in cs.numeric_columns(df)], "p.t", "k", "k")
    assert spark.sql(text).collect() == cs.profile(df, by="p.t").collect()


def test_key_of_another_name_next_to_a_number_called_pt(spark):
    df = spark.createDataFrame([(5, "a"), (7, "a"), (9, "b")], "pt int, dt string")
    for key in ("dt", "DT"):
        metrics = cs.compare(df, df.filter("pt <> 7"), table_name="t", partition_column=key)
        assert listed(cs.differences(metrics), "pt", "column", "metric", "left_value", "right_value") == [
            ("a", "*", "count", "2", "1"), ("a", "pt", "sum", "12", "5"), ("a", "pt", "max", "7", "5")]
    with pytest.raises(ValueError, match="no column day among pt, dt"):
        cs.compare(df, df, table_name="t", partition_column="day")


def test_right_column_that_is_no_number(spark):
    left = spark.createDataFrame([(1,), (2,)], "a int")
    right = spark.createDataFrame([("1",), ("2",)], "a string")
    # Spark sums numeric text as double; as maximum and minimum a text never equals a number.
    metrics = cs.compare(left, right, table_name="t")
    assert listed(cs.differences(metrics), "metric") == [("max",), ("min",)]
    with pytest.raises(AnalysisException):
        cs.compare(left, right.select((F.col("a") == "1").alias("a")), table_name="t")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_integers_add_up_exactly_in_either_mode(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(2**63 - 1,), (2**63 - 1,), (5,)], "a bigint")
        sums = cs.compare(df, df, table_name="t").filter("metric = 'sum'").first()
        assert (sums.left_value, sums.match) == (str(2**64 + 3), True)
        # Sums that differ by 2^64 are equal where they wrap around.
        other = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (4,)], "a bigint")
        assert not cs.compare(df, other, table_name="t").filter("metric = 'sum'").first().match
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_decimal_overflow_is_an_error_in_either_mode(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.sql("SELECT CAST(repeat('9', 38) AS DECIMAL(38,0)) AS a FROM range(20)")
        with pytest.raises(Exception, match="(?i)overflow"):
            cs.compare(df, df, table_name="t").collect()
        empty = cs.compare(df.filter("a < 0"), df.filter("a < 0"), table_name="t")
        assert cs.differences(empty).count() == 0
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_layout_and_order_change_nothing(spark):
    df = spark.read.parquet(f"{DATA}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.date_format("l_shipdate", "yyyyMM").alias("pt"))
    other = df.repartition(7, "l_linenumber").sortWithinPartitions("price")
    metrics = cs.compare(df, other, table_name="t", partition_column="pt")
    assert cs.differences(metrics).count() == 0
    assert metrics.count() == df.select("pt").distinct().count() * 10


def test_swapping_sides_swaps_values(spark):
    left, right = fx.keyed(spark)
    left = left.filter("id <> 2")
    there = cs.compare(left, right, table_name="t", partition_column="pt")
    back = cs.compare(right, left, table_name="t", partition_column="pt")
    assert listed(there, "pt", "ord", "left_value", "right_value", "match", "diff") == listed(
        back, "pt", "ord", "right_value", "left_value", "match", "diff")


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    """Random small tables, one partition holding a third of all rows, compared in plain Python."""
    chance = random.Random(seed)

    def rows():
        keys = ["hot"] * 10 + [f"k{i}" for i in range(18)] + [None] * 2
        return [(chance.choice([None, *range(-3, 4)]), chance.choice([1.5, 0.25, None]), chance.choice(keys))
                for _ in range(120)]

    left_rows, right_rows = rows(), rows()
    schema = "a int, b double, pt string"

    def fingerprint(table):
        groups = {}
        for row in table:
            groups.setdefault(row[2], []).append(row)
        result = {}
        for key, members in groups.items():
            values = [len(members)]
            for at in (0, 1):
                known = [m[at] for m in members if m[at] is not None]
                values += [sum(known), max(known), min(known)] if known else [None] * 3
            result[key] = values
        return result

    left, right = fingerprint(left_rows), fingerprint(right_rows)
    expected = set()
    names = [("*", "count")] + [(c, m) for c in "ab" for m in ("sum", "max", "min")]
    for key in left.keys() | right.keys():
        if key not in left or key not in right:
            expected.add((key, "*", "partition"))
        else:
            expected |= {(key, *n) for n, x, y in zip(names, left[key], right[key]) if x != y}
    metrics = cs.compare(
        spark.createDataFrame(left_rows, schema), spark.createDataFrame(right_rows, schema),
        table_name="t", partition_column="pt")
    assert {(r.pt, r.column, r.metric) for r in cs.differences(metrics).collect()} == expected


def test_200_numeric_columns(spark):
    df = spark.range(1000).select(
        *[(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(200)], (F.col("id") % 3).cast("string").alias("pt"))
    changed = df.withColumn("c150", F.when(F.col("c0") == 5, 0).otherwise(F.col("c150")))
    metrics = cs.compare(df, changed, table_name="t", partition_column="pt")
    assert metrics.count() == 3 * 601
    assert {(r.pt, r.column, r.metric) for r in cs.differences(metrics).collect()} == {
        ("2", "c150", "sum"), ("2", "c150", "min")}
