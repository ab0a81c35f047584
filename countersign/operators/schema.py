"""Questions put to a schema: which columns are numeric, is the table partitioned."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PARTITION_COLUMN = "pt"


def numeric_columns(df: DataFrame) -> list[tuple[str, str]]:
    """Name and type label of the numeric top-level columns, in schema order.

    Byte, short, int, long, float, double and decimal. An id counts, and so does a numeric
    partition column; every other type is covered by the row count only.
    """
    return [
        (field.name, field.dataType.simpleString())
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType)
    ]


def integer_columns(df: DataFrame) -> set[str]:
    """Names of the numeric columns whose sums have to be exact."""
    return {field.name for field in df.schema.fields if isinstance(field.dataType, T.IntegralType)}


def floating_columns(df: DataFrame) -> set[str]:
    """Names of the columns whose plain sums depend on the order of addition."""
    return {field.name for field in df.schema.fields if isinstance(field.dataType, (T.FloatType, T.DoubleType))}


def is_partitioned(partition_columns: Iterable[str], name: str = PARTITION_COLUMN) -> bool:
    """Whether the table is compared per partition: only a column of exactly this name counts."""
    return name in list(partition_columns)


def field_type(df: DataFrame, column: str) -> T.DataType:
    """Type of a top-level column, whose name may differ in case as in Spark."""
    names = [f.name for f in df.schema.fields]
    if column not in names:
        names = [name.lower() for name in names]
        column = column.lower()
    if column not in names:
        raise ValueError(f"no column {column} among {', '.join(df.columns)}")
    return df.schema.fields[names.index(column)].dataType
