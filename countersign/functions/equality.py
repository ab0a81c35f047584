"""Equality of two metric values, exact across numeric types, as SQL."""

from pyspark.sql import types as T


def _is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def _integral_equals_floating(whole: str, floating: str) -> str:
    # try_cast cuts the fraction off and clamps 2^63, so both are ruled out.
    truncated = f"try_cast({floating} AS BIGINT)"
    return (
        f"(CAST({truncated} AS DOUBLE) = {floating} AND {floating} < 9223372036854775808D"
        f" AND {truncated} = {whole})"
    )


def _decimal_equals_floating(exact: str, dtype: T.DecimalType, floating: str) -> str:
    # 1.10 equals 1.1: the decimal nearest to the double, which must lead back to it.
    nearest = f"try_cast({floating} AS DECIMAL(38,{dtype.scale}))"
    return f"({nearest} = {exact} AND CAST({nearest} AS DOUBLE) = {floating})"


def _decimals_equal(left: str, left_type: str, right: str, right_type: str) -> str:
    # No common decimal type may exist within 38 digits, so the left value is moved to the
    # right type and back: it is equal only where neither step changes it.
    moved = f"try_cast({left} AS {right_type})"
    return f"({moved} = {right} AND try_cast({moved} AS {left_type}) = {left})"


def _close(left: str, right: str, rel_tol: float) -> str:
    first, second = f"CAST({left} AS DOUBLE)", f"CAST({right} AS DOUBLE)"
    size = f"greatest(abs({first}), abs({second}))"
    return (
        f"(abs({first} - {second}) <= {size} * {float(rel_tol)!r}D"
        f" AND {size} < CAST('Infinity' AS DOUBLE))"
    )


def values_match(
    left: str,
    right: str,
    left_type: T.DataType,
    right_type: T.DataType,
    *,
    nan_equal: bool = True,
    rel_tol: float | None = None,
) -> str:
    """True where both values are the same number or both are NULL; never NULL itself.

    ``nan_equal=False`` makes NaN differ from NaN. ``rel_tol`` accepts a relative error and
    is meant for sums of floating-point columns, which depend on the order of addition.
    """
    both_null = f"({left} IS NULL AND {right} IS NULL)"
    left_floating, right_floating = _is_floating(left_type), _is_floating(right_type)
    left_decimal = isinstance(left_type, T.DecimalType)
    right_decimal = isinstance(right_type, T.DecimalType)

    if not (isinstance(left_type, T.NumericType) and isinstance(right_type, T.NumericType)):
        return both_null  # a number never equals a text
    if left_floating:
        left = f"CAST({left} AS DOUBLE)"
    if right_floating:
        right = f"CAST({right} AS DOUBLE)"

    if left_floating and right_floating:
        same = f"({left} = {right})" if nan_equal else f"({left} = {right} AND NOT isnan({left}))"
    elif left_floating and right_decimal:
        same = _decimal_equals_floating(right, right_type, left)
    elif right_floating and left_decimal:
        same = _decimal_equals_floating(left, left_type, right)
    elif left_floating:
        same = _integral_equals_floating(right, left)
    elif right_floating:
        same = _integral_equals_floating(left, right)
    elif (left_decimal or right_decimal) and left_type != right_type:
        types = [t.simpleString() if isinstance(t, T.DecimalType) else "DECIMAL(20,0)"
                 for t in (left_type, right_type)]
        same = _decimals_equal(
            f"CAST({left} AS {types[0]})", types[0], f"CAST({right} AS {types[1]})", types[1]
        )
    else:
        same = f"({left} = {right})"

    accepted = [both_null, same]
    if rel_tol is not None and (left_floating or right_floating):
        accepted.append(_close(left, right, rel_tol))
    return f"coalesce({' OR '.join(accepted)}, false)"
