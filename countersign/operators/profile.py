"""Profiles: the fingerprint of a whole table or of each of its partitions, in one pass."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countersign.functions import exact
from countersign.functions.metrics import COUNT, METRICS, metric_alias, profile_expression
from countersign.functions.names import quoted
from countersign.operators.schema import floating_columns, integer_columns, numeric_columns

def fingerprints(
    df: DataFrame, columns: Sequence[str], by: str | None, name: str, exact_doubles: bool = True
) -> DataFrame:
    """``pt`` (with ``by``) and the struct ``name`` of all metrics, a row per key.

    All aggregates combine on the map side, so a task ships one row per key it has seen, however large the
    partition behind that key is; where doubles far from 1 occur, also one per key, column and power range of these.
    """
    floating = floating_columns(df) & set(columns) if exact_doubles else set()
    if not floating:
        packed = F.expr(profile_expression(columns, integer_columns(df))).alias(name)
        return df.groupBy(F.col(quoted(by)).alias("pt")).agg(packed) if by else df.agg(packed)
    parts = _by_window(df, columns, by, [c for c in columns if c in floating])
    return _put_together(parts, columns, by, [c for c in columns if c in floating], name)


def _by_window(df: DataFrame, columns: Sequence[str], by: str | None, floating: Sequence[str]) -> DataFrame:
    """First sums: a row per key, and one more per key, column and window of doubles outside window 0."""
    key = ["pt"] if by else []
    values, doubles = [f"v{n}" for n in range(len(columns))], [f"x{n}" for n in range(len(floating))]
    as_doubles = [f"CAST({quoted(c)} AS DOUBLE)" for c in floating]
    kept = [*key, *values, *doubles]
    # A row with a value outside is repeated: once for itself (c is NULL) and for each of its doubles. Those of
    # its doubles that are inside add nothing more. Steps whose values are used twice are projections of their own.
    shown = df.selectExpr(
        *[f"{quoted(by)} AS pt" for _ in key], *[f"{quoted(c)} AS {v}" for v, c in zip(values, columns)],
        *[f"{value} AS {x}" for x, value in zip(doubles, as_doubles)], f"explode_outer({exact.candidates(as_doubles)}) AS o",
    )
    far = f"if({exact.is_outside('o.x')}, {exact.window_of('o.x')}, NULL)"
    windowed = shown.selectExpr(*kept, "if(o.c < 0, NULL, o.c) AS c", "o.x AS x", f"{far} AS w")
    in_units = f"if(w IS NULL, 0D, {exact.scaled('x', 'w')} * {float(1 << exact.UPPER)!r}D)"
    kept = [*key, *values, "c", "w"]
    units = windowed.selectExpr(
        *kept, *[f"if(c IS NULL, {exact.in_units(x)}, if(c = {n}, {in_units}, 0D)) AS {x}" for n, x in enumerate(doubles)]
    )
    upper = units.selectExpr(*kept, *doubles, *[f"{exact.upper_part(x)} AS {x}_upper" for x in doubles])
    split = upper.selectExpr(
        *key, *[v if c in floating else f"if(c IS NULL, {v}, NULL) AS {v}" for v, c in zip(values, columns)],
        "if(c IS NULL, 1, NULL) AS one", "if(w IS NULL, NULL, c) AS c", "w", *[f"{x}_upper" for x in doubles],
        *[f"{exact.lower_part(x, f'{x}_upper')} AS {x}_lower" for x in doubles],
    )
    integers = integer_columns(df)
    aggregates = [f"count(one) AS {COUNT}"]
    for v, column in zip(values, columns):
        if column in floating:
            aggregates += exact.part_sums(f"x{floating.index(column)}")
        else:
            aggregates.append(f"{exact.integer_sum(v) if column in integers else f'sum({v})'} AS {v}_sum")
        aggregates += [f"max({v}) AS {v}_max", f"min({v}) AS {v}_min"]
    return split.groupBy(*key, "c", "w").agg(*map(F.expr, aggregates))


def _put_together(parts: DataFrame, columns: Sequence[str], by: str | None, floating: Sequence[str], name: str) -> DataFrame:
    """The profile of each key from its few rows of first sums."""
    types = {f.name: f.dataType.simpleString() for f in parts.schema.fields}
    # The row of a column's other window has that column's sums in the column's own place.
    own = "".join(
        f" WHEN {n} THEN named_struct('c', c, 'w', w, "
        + ", ".join(f"'{sum_[len(f'x{n}_'):]}', {sum_}" for sum_ in exact.sums_of(f"x{n}")) + ")"
        for n in range(len(floating))
    )
    aggregates = [f"coalesce(sum({COUNT}), 0L) AS {COUNT}", f"collect_list(CASE c{own} END) AS others"]
    for n, column in enumerate(columns):
        if column in floating:
            aggregates += [
                f"sum(if(c IS NULL, {sum_}, 0L)) AS {sum_}" for sum_ in exact.sums_of(f"x{floating.index(column)}")
            ]
        else:
            # A sum that is NULL next to a maximum has overflowed, outside ANSI mode.
            aggregates.append(
                f"if(bool_or(v{n}_sum IS NULL AND v{n}_max IS NOT NULL), NULL, "
                f"CAST(sum(v{n}_sum) AS {types[f'v{n}_sum']})) AS v{n}_sum"
            )
        aggregates += [f"max(v{n}_max) AS v{n}_max", f"min(v{n}_min) AS v{n}_min"]
    merged = parts.groupBy(*["pt"] if by else []).agg(*map(F.expr, aggregates))

    places = {column: columns.index(column) for column in floating}
    totals = exact.double_totals(
        [(f"x{n}", f"CAST(v{places[c]}_max AS DOUBLE)", f"CAST(v{places[c]}_min AS DOUBLE)") for n, c in enumerate(floating)], "others"
    )
    summed = merged.selectExpr("*", f"{totals} AS totals")
    fields = [COUNT] + [
        (f"totals[{floating.index(column)}]" if metric == "sum" and column in floating else f"v{n}_{metric}")
        + f" AS {quoted(metric_alias(column, metric))}"
        for n, column in enumerate(columns) for metric in METRICS
    ]
    return summed.selectExpr(*["pt"] if by else [], f"struct({', '.join(fields)}) AS {name}")


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    by: str | None = None,
    ordered: bool = False,
    exact_doubles: bool = True,
) -> DataFrame:
    """``total_count`` and ``<column>_sum|_max|_min`` of the given (default: numeric) columns.

    Without ``by`` it has exactly one row, also for an empty table. With ``by`` it has a row
    per key, NULL included. Sums of floating columns are the doubles nearest to the exact sums, alike in any layout;
    ``exact_doubles=False`` adds them as they come. A sum beyond the range of doubles is NaN.
    """
    if columns is None:
        columns = [name for name, _ in numeric_columns(df)]
    packed = fingerprints(df, columns, by, "profile", exact_doubles)
    if not by:
        return packed.select("profile.*")
    result = packed.select(F.col("pt").alias(by), "profile.*")
    return result.orderBy(F.col(quoted(by)).asc_nulls_first()) if ordered else result


def row_counts(df: DataFrame, by: str | None = None) -> DataFrame:
    """Only ``total_count``: the check for tables without numeric columns."""
    return profile(df, columns=[], by=by)
