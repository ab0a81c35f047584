"""The fingerprint of a table: one row count, then sum, max and min of each numeric column."""

from collections.abc import Container, Iterable

from countersign.functions.exact import integer_sum
from countersign.functions.names import quoted

METRICS = ("sum", "max", "min")
COUNT = "total_count"


def metric_alias(column: str, metric: str) -> str:
    return f"{column}_{metric}"


def aggregate(column: str, metric: str, integers: Container[str] = ()) -> str:
    """SQL of one metric of a column."""
    return integer_sum(quoted(column)) if metric == "sum" and column in integers else f"{metric}({quoted(column)})"


def aggregate_expressions(columns: Iterable[str], integers: Container[str] = ()) -> list[str]:
    """SQL of every aggregate, in report order.

    Sums of ``integers`` are decimals of 38 digits, so 64-bit ids add up exactly whatever the ANSI setting.
    """
    expressions = [f"count(1) AS {COUNT}"]
    for column in columns:
        for metric in METRICS:
            expressions.append(f"{aggregate(column, metric, integers)} AS {quoted(metric_alias(column, metric))}")
    return expressions


def profile_expression(columns: Iterable[str], integers: Container[str] = ()) -> str:
    """All aggregates as one struct, so that a wide table takes one expression to plan."""
    count, *others = aggregate_expressions(columns, integers)
    # Counts that Spark takes from footers are NULL where there are no rows; greatest passes over NULLs.
    counted = f"greatest({count.removesuffix(f' AS {COUNT}')}, 0L) AS {COUNT}"
    return f"struct({', '.join([counted, *others])})"
