"""Writing: shared work folders, partitioned tables, row updates."""

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countersign.functions.names import quoted, quoted_table

SHARED_FOLDER = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one the cluster names, or else below the warehouse."""
    shared = (
        spark.conf.get(SHARED_FOLDER, None) or spark.sparkContext.getCheckpointDir()
        or spark.conf.get(WAREHOUSE, None)
    )
    if not shared:
        raise ValueError(f"set {SHARED_FOLDER} to a folder all executors reach")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Parquet files anywhere below a folder; None where there is no such folder."""
    try:
        return spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted_table(name)}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted_table(name)}")


def write_table(
    df: DataFrame,
    name: str,
    partition_column: str | None = None,
    path: str | None = None,
    format: str = "parquet",
) -> None:
    """Create or replace a catalog table, partitioned where asked, at ``path`` where given.

    Rows are rebalanced by key first, so a partition has few files, and one that holds a large
    share of the table is split among tasks.
    """
    if partition_column:
        df = df.hint("rebalance", F.col(quoted(partition_column)))
    writer = df.write.format(format).mode("overwrite")
    if partition_column:
        writer = writer.partitionBy(partition_column)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def insert_rows(df: DataFrame, name: str) -> None:
    """Append rows to a catalog table, columns matched by name."""
    target = df.sparkSession.table(name)
    df.select(*[quoted(c) for c in target.columns]).write.insertInto(name)


def update_rows(df: DataFrame, assignments: Mapping[str, str], condition: str) -> DataFrame:
    """``UPDATE ... SET ... WHERE`` as a projection: all expressions see the old row.

    A condition that is NULL leaves the row as it is.
    """
    chosen = F.expr(condition)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            F.when(chosen, F.expr(assignments[name]).cast(dtype))
            .otherwise(F.col(quoted(name))).alias(name)
            if name in assignments else F.col(quoted(name))
            for name, dtype in types.items()
        ]
    )


def update_table(
    spark: SparkSession, name: str, assignments: Mapping[str, str], condition: str, partition_column: str | None = None
) -> None:
    """``UPDATE name SET ... WHERE`` on a stored table: only partitions with a row that meets the condition are rewritten.

    Their rows, updated and others alike, are written beside the table first and then put in their place, so a job that
    fails before leaves the table as it was. Files of all other partitions stay untouched; the search for
    the rows reads the condition's columns and the key alone. Without a partition column the whole table is rewritten, where
    a row meets the condition. Rows do not move between partitions.
    """
    if partition_column and partition_column.lower() in {column.lower() for column in assignments}:
        raise ValueError(f"{partition_column} is the partition column; an update does not move rows")
    table = spark.table(name)
    met = table.filter(condition)
    if met.isEmpty():
        return
    rows = table
    if partition_column:
        key = quoted(partition_column)
        touched = met.select(F.col(key).alias("touched")).distinct()
        rows = table.join(touched, F.col(key).eqNullSafe(F.col("touched")), "left_semi")
    staged = work_folder(spark, "update")
    updated = update_rows(rows, assignments, condition)
    updated.write.parquet(staged)
    own = spark.newSession()  # the mode of overwriting is a setting of a session
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    placed = own.read.schema(updated.schema).parquet(staged)
    if partition_column:
        placed = placed.hint("rebalance", F.col(quoted(partition_column)))
    placed.select(*[quoted(c) for c in table.columns]).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)
