"""Many small tables compared in one plan: tables of like shape share scans' union, profiles and rules."""

from collections import defaultdict
from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countersign.functions.names import quoted
from countersign.operators.compare import METRICS_SCHEMA, check_key_types, merge_profiles, metric_rows
from countersign.operators.partitions import partition_range
from countersign.operators.schema import field_type, numeric_columns


class Opened(NamedTuple):
    """Both copies of a manifest line."""

    line_no: int
    table_name: str
    left: DataFrame
    right: DataFrame
    partition_column: str | None = None


def shape(table: Opened) -> tuple:
    """Tables of one shape differ in names alone: the types of key and numeric columns are the same on either side."""
    key = table.partition_column
    if key:
        check_key_types(table.left, table.right, key)
    sides = (table.left, table.right)
    return (
        tuple(field_type(df, key).simpleString() for df in sides) if key else None,
        tuple((label, field_type(table.right, name).simpleString()) for name, label in numeric_columns(table.left)),
    )


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a table's size before it is read; enormous where nothing is known."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def compare_together(
    spark: SparkSession,
    tables: Iterable[Opened],
    start: str | None = None,
    end: str | None = None,
    nan_equal: bool = True,
    rel_tol: float | None = None,
) -> DataFrame:
    """The rows that ``compare`` has for each of the tables, and their ``line_no``, from one plan.

    All tables of a shape are united with their line as part of the key, so there is one profile a side and one set of
    rules for a shape, however many tables have it. Meant for small tables: what fails for one fails for all.
    """
    shapes: dict[tuple, list[Opened]] = defaultdict(list)
    for table in tables:
        shapes[shape(table)].append(table)
    if not shapes:
        return spark.createDataFrame([], f"line_no bigint, {METRICS_SCHEMA}")
    compared = [_one_shape(spark, alike, start, end, nan_equal, rel_tol) for alike in shapes.values()]
    return reduce(DataFrame.unionByName, compared)


def _one_shape(spark: SparkSession, tables: list[Opened], start, end, nan_equal, rel_tol) -> DataFrame:
    labels = [label for _, label in numeric_columns(tables[0].left)]
    places = [f"c{n}" for n in range(len(labels))]
    partitioned = tables[0].partition_column is not None

    def united(side: str) -> DataFrame:
        return reduce(DataFrame.unionAll, (_numbered(table, side, places, start, end) for table in tables))

    merged = merge_profiles(united("left"), united("right"), places, "key")
    merged = merged.select("pt.line_no", "pt.pt", "l", "r")
    # A row a manifest line of the batch: names of the table and of its columns by place.
    names = spark.createDataFrame(
        [(t.line_no, t.table_name, [name for name, _ in numeric_columns(t.left)]) for t in tables],
        "line_no bigint, named string, columns array<string>",
    )
    # A table compared as a whole has its row also when it is empty; a partition is one that has rows.
    found = merged.join(F.broadcast(names), "line_no") if partitioned else names.join(merged, "line_no", "left")
    rows = metric_rows(
        found, list(zip(places, labels)), table_name="", partitioned=partitioned, nan_equal=nan_equal, rel_tol=rel_tol,
        keep=("line_no", "named", "columns"),
    )
    place = F.substring("column", 2, 10).try_cast("int") + 1
    own = F.when(F.col("column") == "*", F.col("column")).otherwise(F.element_at("columns", place))
    rows = rows.withColumn("column", own).withColumn("table_name", F.col("named"))
    return rows.drop("named", "columns")


def _numbered(table: Opened, side: str, places: list[str], start: str | None, end: str | None) -> DataFrame:
    """One copy with the columns of its shape, its line being part of the key."""
    df, key = getattr(table, side), table.partition_column
    if key:
        df = partition_range(df, key, start, end)
    value = quoted(key) if key else "CAST(NULL AS STRING)"
    columns = [name for name, _ in numeric_columns(table.left)]
    return df.selectExpr(
        f"named_struct('line_no', {table.line_no}L, 'pt', {value}) AS key",
        *[f"{quoted(column)} AS {place}" for column, place in zip(columns, places)],
    )
