"""Partition keys: range filter, distinct keys of two tables, their bounds."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countersign.functions.bounds import range_condition
from countersign.functions.names import literal, quoted, quoted_table
from countersign.operators.schema import PARTITION_COLUMN, field_type


def partition_range(
    df: DataFrame,
    column: str = PARTITION_COLUMN,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Rows whose key lies from ``start`` to ``end``, both included; see ``range_condition``."""
    condition = range_condition(column, field_type(df, column), start, end)
    return df if condition is None else df.filter(condition)


def partition_keys(left: DataFrame, right: DataFrame, column: str = PARTITION_COLUMN) -> DataFrame:
    """Every key that occurs on either side, once."""
    key = quoted(column)
    return left.select(key).union(right.select(key)).distinct()


NULL_KEY = "__HIVE_DEFAULT_PARTITION__"


def stored_partition_keys(spark: SparkSession, *names: str, column: str = PARTITION_COLUMN) -> DataFrame:
    """Every key of the named catalog tables, once, as text, from the catalog: no file is listed or read.

    Takes tables partitioned by ``column``, alone or among others. A partition that is registered counts, also when its last row
    is gone. ``partition_keys`` looks at rows instead, and takes any copies.
    """
    def keys(name: str) -> DataFrame:
        # A listing has lines such as "pt=20240101/hour=3", where odd characters are written as %XX.
        listed = spark.sql(f"SHOW PARTITIONS {quoted_table(name)}").toDF("line")
        part = f"element_at(filter(split(line, '/'), p -> lower(split(p, '=')[0]) = {literal(column.lower())}), 1)"
        text = f"substring({part}, {len(column) + 2})"
        plain = f"url_decode(replace({text}, '+', '%2B'))"
        return listed.selectExpr(f"if({text} = '{NULL_KEY}', NULL, {plain}) AS {quoted(column)}")

    return reduce(DataFrame.union, map(keys, names)).distinct()


def partition_bounds(
    left: DataFrame,
    right: DataFrame,
    column: str = PARTITION_COLUMN,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """One row ``pt_start, pt_end``: the given bounds, each missing one discovered on both sides."""
    key = quoted(column)
    both = left.select(key).union(right.select(key))

    def bound(given, found):
        return F.lit(given) if given else found.cast("string")

    return both.agg(
        bound(start, F.min(key)).alias("pt_start"), bound(end, F.max(key)).alias("pt_end")
    )
