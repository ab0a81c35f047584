"""The check as SQL text. It is made of the same expressions that run, and runs itself."""

from collections.abc import Container, Sequence

from pyspark.sql import types as T

from countersign.functions.bounds import range_condition
from countersign.functions.metrics import aggregate_expressions
from countersign.functions.names import quoted, quoted_table


def check_sql(
    table: str,
    columns: Sequence[str],
    partition_column: str | None = None,
    start: str | None = None,
    end: str | None = None,
    partition_type: T.DataType = T.StringType(),
    integers: Container[str] = (),
) -> str:
    """SQL of one side's profile; with no columns it is the count-only check."""
    selected = aggregate_expressions(columns, integers)
    lines = []
    if partition_column:
        selected.insert(0, quoted(partition_column))
    lines.append("SELECT " + ",\n       ".join(selected))
    lines.append(f"FROM {quoted_table(table)}")
    if partition_column:
        condition = range_condition(partition_column, partition_type, start, end)
        if condition:
            lines.append(f"WHERE {condition}")
        lines.append(f"GROUP BY {quoted(partition_column)}")
        lines.append(f"ORDER BY {quoted(partition_column)}")
    return "\n".join(lines)
