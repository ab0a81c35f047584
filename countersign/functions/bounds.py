"""Partition bounds: inclusive on both ends as given, half open where the end can be counted up."""

from pyspark.sql import types as T

from countersign.functions.names import literal, quoted


def exclusive_end(end: str) -> str | None:
    """The end plus one as an integer (not a calendar step), zero-padded to its width.

    None where that cannot be used as a string bound: the end is no plain integer, or one
    more digit would be needed, which sorts before the end instead of after it.
    """
    if not (end.isascii() and end.isdigit()):
        return None
    following = str(int(end) + 1).zfill(len(end))
    return following if len(following) == len(end) else None


def range_condition(
    column: str, dtype: T.DataType, start: str | None = None, end: str | None = None
) -> str | None:
    """SQL condition that keeps the partitions from ``start`` to ``end``; None keeps all.

    A string key counts as inside when it starts with the end, so that the hourly key
    ``2026052223`` belongs to the day ``20260522``. ``pt < end + 1`` says that for keys of the
    end's width or more; where the end cannot be counted up, the prefix is tested. A missing
    bound does not filter on its side. NULL keys are dropped as soon as there is any bound.
    All forms are pruned as partition filters.
    """
    key = quoted(column)
    conditions = []
    if isinstance(dtype, T.IntegralType):
        if start:
            conditions.append(f"{key} >= {int(start)}")
        if end:
            conditions.append(f"{key} < {int(end) + 1}")
    else:
        if start:
            conditions.append(f"{key} >= {literal(start)}")
        if end:
            following = exclusive_end(end)
            if not isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
                conditions.append(f"{key} <= {literal(end)}")
            elif following is not None:
                conditions.append(f"{key} < {literal(following)}")
            else:
                conditions.append(f"({key} <= {literal(end)} OR startswith({key}, {literal(end)}))")
    return " AND ".join(conditions) or None
