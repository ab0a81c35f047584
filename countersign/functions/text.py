"""Texts of values, statuses and differences."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def value_text(value: str, dtype: T.DataType) -> str:
    """SQL of the readable text of a metric value.

    Doubles from 1e-4 up to 1e16 are written in positional notation (``10000000.0``), where
    a plain cast gives ``1.0E7``; float values are widened to double first.
    """
    if not isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"CAST({value} AS STRING)"
    double = f"CAST({value} AS DOUBLE)"
    plain, size = f"CAST({double} AS STRING)", f"abs({double})"
    digits = f"regexp_replace(CAST(try_cast({plain} AS DECIMAL(38,21)) AS STRING), '0+$', '')"
    return (
        f"CASE WHEN ({size} >= 1e7D AND {size} < 1e16D) OR ({size} >= 1e-4D AND {size} < 1e-3D)"
        f" THEN if(endswith({digits}, '.'), concat({digits}, '0'), {digits}) ELSE {plain} END"
    )


def status_label(match: Column) -> Column:
    return F.when(match, "PASS").otherwise("FAIL")


def yes_no(match: Column) -> Column:
    return F.when(match, "Y").otherwise("N")


def shown(value: Column) -> Column:
    """A value as printed in reports, where a missing one reads ``None``."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def difference_text(separator: str, labels: tuple[str, str]) -> Column:
    """`` `column`.metric: Left=a<separator>Right=b `` of a row of metrics."""
    return F.concat(
        F.lit("`"), F.col("column"), F.lit("`."), F.col("metric"),
        F.lit(f": {labels[0]}="), shown(F.col("left_value")),
        F.lit(f"{separator}{labels[1]}="), shown(F.col("right_value")),
    )
