"""Places of rows in an order, without gathering them in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countersign.functions.names import free_name, quoted
from countersign.sources.storage import work_folder

#: Spark's monotonic ids hold the number of the partition above these bits and that of the row within them.
ROW_BITS = 33


def numbered(df: DataFrame, *order: str | Column, place: str = "place") -> DataFrame:
    """``df`` with ``place``: 0 for the first row in the given order, then 1, and so on without a gap.

    Rows are dealt out by ranges of the order, sorted within their range and written once with their place
    there; the rows of all ranges before, one number a range, are then added. Equal rows stand in any
    order; they are spread over ranges too, so one hot key does not end in one task. ``df`` is computed twice, as Spark
    samples it for the ranges.
    """
    spark = df.sparkSession
    tie, spot, part, before = (free_name(df.columns + [place], name) for name in ("tie", "spot", "part", "before"))
    keys = [F.col(quoted(o)) if isinstance(o, str) else o for o in order] + [F.col(tie)]
    ranged = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    path = work_folder(spark, "numbered")
    spotted = ranged.withColumn(spot, F.monotonically_increasing_id()).drop(tie)
    spotted.write.parquet(path)
    stored = spark.read.schema(spotted.schema).parquet(path)
    range_of = F.shiftright(spot, ROW_BITS)
    sizes = stored.groupBy(range_of.alias(part)).agg(F.count(F.lit(1)).alias(before))
    so_far = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = sizes.select(part, F.coalesce(F.sum(before).over(so_far), F.lit(0)).alias(before))
    within = F.col(spot).bitwiseAND((1 << ROW_BITS) - 1)
    return stored.join(F.broadcast(offsets), range_of == F.col(part)).select(
        *[quoted(c) for c in df.columns], (F.col(before) + within).alias(place)
    )
