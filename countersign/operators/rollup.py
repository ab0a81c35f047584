"""From metrics to verdicts: per partition, per table, per run, and the reasons in words."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countersign.functions.text import difference_text, shown, status_label
from countersign.operators.compare import differences

TABLE_KEY = ("table_name",)
LABELS = ("Left", "Right")


def partition_status(metrics: DataFrame, keys: Sequence[str] = TABLE_KEY) -> DataFrame:
    """One row per table and partition: counts, presence, number of differences, verdict.

    A table that is not partitioned has one row with a NULL ``pt``.
    """
    count_row = F.col("metric") == "count"

    def count_of(side: str):
        return F.max(F.when(count_row, F.col(side).cast("bigint")))

    grouped = metrics.groupBy(*keys, "partitioned", "pt").agg(
        count_of("left_value").alias("left_count"),
        count_of("right_value").alias("right_count"),
        F.count_if("diff").alias("n_diffs"),
    )
    presence = (
        F.when(F.col("partitioned") & (F.col("left_count") == 0), "RIGHT_ONLY")
        .when(F.col("partitioned") & (F.col("right_count") == 0), "LEFT_ONLY")
        .otherwise("BOTH")
    )
    match = F.col("n_diffs") == 0
    return grouped.select(
        *keys, "partitioned", "pt", "left_count", "right_count", presence.alias("presence"),
        "n_diffs", match.alias("match"), status_label(match).alias("status"),
    )


def table_status(metrics: DataFrame, keys: Sequence[str] = TABLE_KEY) -> DataFrame:
    """One row per table that has metrics: partitions compared, differences, verdict."""
    grouped = metrics.groupBy(*keys).agg(
        F.bool_or("partitioned").alias("partitioned"),
        F.count_if((F.col("metric") == "count") & F.col("partitioned")).alias("partitions_compared"),
        F.min("pt").alias("first_pt"),
        F.max("pt").alias("last_pt"),
        F.count_if("diff").alias("n_diffs"),
        F.bool_and(~F.col("diff")).alias("match"),
    )
    return grouped.withColumn("status", status_label(F.col("match")))


def partition_reasons(
    metrics: DataFrame, keys: Sequence[str] = TABLE_KEY, labels: tuple[str, str] = LABELS
) -> DataFrame:
    """Why each failing partition fails: its differences in metric order, joined with ``"; "``.

    One row per table and failing partition, however many there are. A group holds at most one row per metric of the table, however many rows the partition
    or partitions the table has.
    """
    prefix = F.when(F.col("partitioned"), F.concat(F.lit("pt="), shown(F.col("pt")), F.lit(": ")))
    text = F.concat(F.coalesce(prefix, F.lit("")), difference_text(" vs ", labels))
    listed = F.array_sort(F.collect_list(F.struct("ord", text.alias("text"))))
    return (
        differences(metrics)
        .groupBy(*keys, "partitioned", "pt")
        .agg(F.count(F.lit(1)).alias("n_diffs"), F.array_join(listed["text"], "; ").alias("reason"))
    )


def failing_tables(tables: DataFrame, order: Sequence[str] = TABLE_KEY) -> DataFrame:
    """Failing tables, errors included, numbered from 1.

    The window has no partitions: it sorts one short row per table of the manifest, which the
    run has listed on the driver before.
    """
    numbered = F.row_number().over(Window.orderBy(*order))
    return tables.filter(~F.coalesce(F.col("match"), F.lit(True))).withColumn("number", numbered)


def run_totals(tables: DataFrame) -> DataFrame:
    """One row: tables compared, tables failed (errors included)."""
    failed = ~F.coalesce(F.col("match"), F.lit(True))
    return tables.agg(
        F.count(F.lit(1)).alias("n_tables"), F.count_if(failed).alias("n_failed")
    )
