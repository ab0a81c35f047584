"""Comparison of two copies of a table, as rows of metrics."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countersign.functions.equality import values_match
from countersign.functions.metrics import COUNT, METRICS, metric_alias
from countersign.functions.names import literal, quoted
from countersign.functions.text import value_text
from countersign.operators.ordering import numbered
from countersign.operators.partitions import partition_range
from countersign.operators.profile import fingerprints
from countersign.operators.schema import field_type, numeric_columns


METRICS_SCHEMA = (
    "table_name string, partitioned boolean, pt string, ord int, column string, type string, "
    "metric string, left_value string, right_value string, match boolean, diff boolean"
)


def check_key_types(left: DataFrame, right: DataFrame, column: str) -> None:
    left_type, right_type = field_type(left, column), field_type(right, column)
    both_integral = isinstance(left_type, T.IntegralType) and isinstance(right_type, T.IntegralType)
    if left_type != right_type and not both_integral:
        raise ValueError(
            f"partition column {column} is {left_type.simpleString()} on the left, "
            f"{right_type.simpleString()} on the right"
        )


def merge_profiles(
    left: DataFrame, right: DataFrame, columns: Sequence[str], by: str | None = None, exact_doubles: bool = True
) -> DataFrame:
    """Profiles of both sides next to each other: ``l, r`` and the key as ``pt``, a row per key.

    ``l`` and ``r`` are structs with each side's own types, NULL where the key is missing.
    Each side is aggregated on its own, with three aggregates per column and row; the two
    profiles, a row per key each, are then united and grouped once more. Both exchanges
    carry profile rows only. NULL keys meet like any other key, which they would not do in
    an equi-join.
    """
    united = fingerprints(left, columns, by, "l", exact_doubles).unionByName(
        fingerprints(right, columns, by, "r", exact_doubles), allowMissingColumns=True
    )
    # Each key has at most one profile per side, so max only picks the one that is there.
    return united.groupBy(*["pt"] if by else []).agg(F.max("l").alias("l"), F.max("r").alias("r"))


def _widest(dtype: T.DataType) -> T.DataType:
    """One type for all integers and one for all floating values, which loses nothing."""
    if isinstance(dtype, T.IntegralType):
        return T.LongType()
    return T.DoubleType() if isinstance(dtype, T.FloatType) else dtype


def _by_type(merged: DataFrame, columns: Sequence[tuple[str, str]]) -> dict:
    """Metrics grouped by the types on both sides, so that each rule is planned once, not per metric."""
    types = {
        side: {f.name: _widest(f.dataType) for f in merged.schema[side].dataType.fields}
        for side in ("l", "r")
    }
    groups: dict = {}
    order = 2
    for column, label in columns:
        for metric in METRICS:
            name = metric_alias(column, metric)
            kind = (types["l"][name], types["r"][name], metric == "sum")
            groups.setdefault(kind, []).append((order, column, label, metric))
            order += 1
    return groups


def _value(side: str, column: str, metric: str, dtype: T.DataType) -> str:
    """A metric of one side. A decimal sum that is NULL next to a maximum has overflowed.

    In ANSI mode Spark raises that error itself; outside it, two NULL sums would pass as equal.
    """
    value = f"{side}.{quoted(metric_alias(column, metric))}"
    if metric != "sum" or not isinstance(dtype, T.DecimalType):
        return value
    highest = f"{side}.{quoted(metric_alias(column, 'max'))}"
    message = literal(f"the sum of {column} overflows")
    return f"if({value} IS NULL AND {highest} IS NOT NULL, raise_error({message}), {value})"


def metric_rows(
    merged: DataFrame,
    columns: Sequence[tuple[str, str]],
    *,
    table_name: str,
    partitioned: bool,
    nan_equal: bool = True,
    rel_tol: float | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Long form of merged profiles: one row per key and metric (``METRICS_SCHEMA``), with the columns to ``keep``.

    ``match`` compares the values of a row. ``diff`` marks the rows that count as
    differences: where a partition exists on one side only, a table with numeric columns has
    the single difference ``partition`` (MISSING/EXISTS), and its other rows are only listed;
    a count-only table has the difference ``count`` against 0.
    """
    presence_counts = partitioned and bool(columns)
    on_both = "(l IS NOT NULL AND r IS NOT NULL)"

    def row(order, column, label, metric, left_value, right_value, match, counts=True) -> str:
        diff = f"NOT {match} AND {on_both}" if presence_counts and counts else f"NOT {match}"
        return (
            f"named_struct('ord', {order}, 'column', {column}, 'type', {label}, "
            f"'metric', {metric}, 'left_value', {left_value}, 'right_value', {right_value}, "
            f"'match', {match}, 'diff', {diff})"
        )

    left_count, right_count = f"coalesce(l.{COUNT}, 0L)", f"coalesce(r.{COUNT}, 0L)"
    count_row = row(
        1, "'*'", "'-'", "'count'", f"CAST({left_count} AS STRING)",
        f"CAST({right_count} AS STRING)", f"({left_count} = {right_count})",
    )
    listings = [f"array({count_row})"]
    if presence_counts:
        present = "if({} IS NULL, 'MISSING', 'EXISTS')"
        one_sided = row(
            0, "'*'", "'-'", "'partition'", present.format("l"), present.format("r"), "false",
            counts=False,
        )
        listings.append(f"if({on_both}, array(), array({one_sided}))")

    for (left_type, right_type, is_sum), members in _by_type(merged, columns).items():
        labels = ", ".join(
            f"named_struct('ord', {order}, 'column', {literal(column)}, 'type', {literal(label)}, "
            f"'metric', {literal(metric)})"
            for order, column, label, metric in members
        )
        lefts, rights = (
            ", ".join(
                f"CAST({_value(side, column, metric, dtype)} AS {dtype.simpleString()})"
                for _, column, _, metric in members
            )
            for side, dtype in (("l", left_type), ("r", right_type))
        )
        label, left, right = "entry.`0`", "entry.`1`", "entry.`2`"
        match = values_match(
            left, right, left_type, right_type,
            nan_equal=nan_equal, rel_tol=rel_tol if is_sum else None,
        )
        compared = row(
            f"{label}.ord", f"{label}.column", f"{label}.type", f"{label}.metric",
            value_text(left, left_type), value_text(right, right_type), match,
        )
        zipped = f"arrays_zip(array({labels}), array({lefts}), array({rights}))"
        listings.append(f"transform({zipped}, entry -> {compared})")

    return merged.selectExpr(
        *keep,
        f"{literal(table_name)} AS table_name",
        f"{str(partitioned).lower()} AS partitioned",
        "CAST(pt AS STRING) AS pt" if partitioned else "CAST(NULL AS STRING) AS pt",
        f"inline(concat({', '.join(listings)}))",
    )


def compare(
    left: DataFrame,
    right: DataFrame,
    *,
    table_name: str,
    partition_column: str | None = None,
    start: str | None = None,
    end: str | None = None,
    nan_equal: bool = True,
    rel_tol: float | None = None,
    exact_doubles: bool = True,
) -> DataFrame:
    """All metrics of both copies and whether they match, as one lazy DataFrame.

    Columns and type labels come from the left copy; a numeric column the right copy lacks
    fails the analysis, and the right copy's additional columns are ignored. Without numeric
    columns only row counts are compared. With a partition column the comparison is per key,
    narrowed to ``start``..``end`` where given; without one the bounds do not apply. Sums of
    doubles are exact, so that two layouts of the same rows agree; ``exact_doubles=False`` adds them as they come.
    """
    columns = numeric_columns(left)
    if partition_column:
        check_key_types(left, right, partition_column)
        left = partition_range(left, partition_column, start, end)
        right = partition_range(right, partition_column, start, end)
    merged = merge_profiles(left, right, [name for name, _ in columns], partition_column, exact_doubles)
    return metric_rows(
        merged, columns, table_name=table_name, partitioned=bool(partition_column),
        nan_equal=nan_equal, rel_tol=rel_tol,
    )


def differences(metrics: DataFrame) -> DataFrame:
    """Only the rows that count as differences."""
    return metrics.filter("diff")


def in_order(metrics: DataFrame) -> DataFrame:
    """Rows by table, partition (NULL first) and metric, as reports list them."""
    return metrics.orderBy(*_listing())


def places_in_order(metrics: DataFrame) -> DataFrame:
    """The same listing as rows that carry their ``place``, from 0, so that it can be stored and cut anywhere."""
    return numbered(metrics, *_listing())


def _listing() -> list:
    return ["table_name", F.col("pt").asc_nulls_first(), "ord"]
