"""The list of tables to compare: text, one table name per line."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countersign.sources.storage import work_folder

HEADER = "table_name"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, table_name`` from any file system Spark reads.

    Lines are trimmed; blank ones and all that start with the header word are left out.
    Repeated names stay, as they are compared twice. ``line_no`` grows by file path and
    position in the file, from 1. There is no quoting. The lines are written once, each with its place
    in its block of a file; the lines of all blocks before, one number a block, are then added.
    """
    name = F.regexp_replace("value", r"(?U)^\s+|\s+$", "")
    block = F.struct("_metadata.file_path", "_metadata.file_block_start")
    lines = spark.read.text(path).select(
        block.alias("block"), F.monotonically_increasing_id().alias("spot"), name.alias("table_name")
    )
    folder = work_folder(spark, "manifest-lines")
    lines.write.parquet(folder)
    stored = spark.read.schema(lines.schema).parquet(folder)
    # A block is read by one task from its first line to its last.
    blocks = stored.groupBy("block").agg(F.min("spot").alias("first"), F.count(F.lit(1)).alias("n_lines"))
    so_far = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    before = F.coalesce(F.sum("n_lines").over(so_far), F.lit(0)).alias("before")
    offsets = blocks.select(F.col("block").alias("of"), "first", before)
    return (
        stored.filter((F.length("table_name") > 0) & ~F.startswith("table_name", F.lit(HEADER)))
        .join(F.broadcast(offsets), F.col("block") == F.col("of"))
        .select((F.col("before") + F.col("spot") - F.col("first") + 1).alias("line_no"), "table_name")
    )
