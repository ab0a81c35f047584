"""Sums that do not depend on the order of addition, as SQL made of sums of longs.

A long is cut into limbs of 22 bits (the upper one keeps the sign). Limbs are summed as longs, which generated
code does as fast as any sum, and are put together once per key. 2^40 rows of a key fit without overflow.

A double is a whole multiple of a power of two, so one of a window of powers is two longs: its upper part in units
of 2^-14 and the rest in units of 2^-60. Windows are numbered: window 0 holds 2^-7 to 2^31, window w the same times
2^(38 w); scaling by a power of two is exact. Window 0 is summed for every column in the main aggregation; the
values outside travel as rows of their own, which take their column's place, and are summed by column and window.
"""

from countersign.functions.names import quoted

#: Bits of a limb of a long, and of a limb of the two parts of a double.
LIMB, PART_LIMB = 22, 23
LOWEST, HIGHEST = -7, 31
WINDOW = HIGHEST - LOWEST
#: Bits of the fraction that the upper part of a double holds, and both parts together.
UPPER, LOWER = 14, 60
PARTS = ("upper", "lower")


def _low(value: str, bits: int) -> str:
    return f"({value} & {(1 << bits) - 1}L)"


def joined(limbs: list[str], bits: int) -> str:
    """The sum of longs from the sums of their limbs, the lowest first, as a decimal of 38 digits."""
    parts = [f"CAST({limb} AS DECIMAL(19,0)) * {1 << (bits * place)}" for place, limb in enumerate(limbs)]
    return f"CAST({' + '.join(parts)} AS DECIMAL(38,0))"


def integer_sum(value: str) -> str:
    """An exact sum of whole numbers of up to 64 bits: a decimal of 38 digits, NULL without values."""
    value = f"CAST({value} AS BIGINT)"
    limbs = [_low(value, LIMB), _low(f"shiftright({value}, {LIMB})", LIMB), f"shiftright({value}, {2 * LIMB})"]
    return joined([f"sum({limb})" for limb in limbs], LIMB)


def ordinary(value: str) -> str:
    """Is a double NULL, zero or in window 0?"""
    size = f"abs({value})"
    return f"({value} IS NULL OR {value} = 0D OR ({size} >= {2.0 ** LOWEST!r}D AND {size} < {2.0 ** HIGHEST!r}D))"


def candidates(values: list[str]) -> str:
    """NULL for a row whose values are all ordinary, else an entry ``c, x`` for the row (-1) and for each value."""
    entries = "".join(f", named_struct('c', {number}, 'x', {value})" for number, value in enumerate(values))
    return f"if({' AND '.join(ordinary(value) for value in values)}, NULL, array(named_struct('c', -1, 'x', 0D){entries}))"


def is_outside(value: str) -> str:
    """Infinities and NaN are not: maximum and minimum show them."""
    return f"(NOT {ordinary(value)} AND abs({value}) < double('Infinity'))"


def window_of(value: str) -> str:
    return f"CAST(floor((log2(abs({value})) - {LOWEST}) / {WINDOW}) AS INT)"


def scaled(value: str, window: str) -> str:
    """A value of a window as one of window 0. In two steps, as the power for the smallest doubles is no double itself."""
    half = f"pow(2D, -{WINDOW // 2} * {window})"
    return f"({value} * {half} * {half})"


def in_units(value: str) -> str:
    """A value of window 0 in units of its upper part; 0 for all others. Never NULL, so that sums need no test."""
    return f"coalesce(if({ordinary(value)}, {value}, 0D), 0D) * {float(1 << UPPER)!r}D"


def upper_part(units: str) -> str:
    return f"CAST({units} AS BIGINT)"


def lower_part(units: str, upper: str) -> str:
    """What the upper part leaves; a double holds it exactly."""
    return f"CAST(({units} - CAST({upper} AS DOUBLE)) * {float(1 << (LOWER - UPPER))!r}D AS BIGINT)"


def part_sums(name: str) -> list[str]:
    """Aggregates of the limbs of ``<name>_upper`` and ``<name>_lower``."""
    sums = []
    for part in PARTS:
        value = quoted(f"{name}_{part}")
        sums += [f"sum({_low(value, PART_LIMB)}) AS {name}_{part}0", f"sum(shiftright({value}, {PART_LIMB})) AS {name}_{part}1"]
    return sums


def sums_of(name: str) -> list[str]:
    """Names of ``part_sums``."""
    return [f"{name}_{part}{place}" for part in PARTS for place in range(2)]


def double_totals(columns: list[tuple[str, str, str]], others: str) -> str:
    """An array of the doubles nearest to the exact sums of all columns, planned as one expression.

    A column is the name of its ``part_sums``, which hold window 0, and the SQL of its maximum and minimum. ``others``
    is an array of the sums of other windows: ``c`` (place of the column), ``w, upper0, upper1, lower0, lower1``.
    """
    entries = ", ".join(
        f"named_struct('c', {number}, "
        + ", ".join(f"'{part}', {joined([f'{name}_{part}0', f'{name}_{part}1'], PART_LIMB)}" for part in PARTS)
        + f", 'highest', {highest}, 'lowest', {lowest})"
        for number, (name, highest, lowest) in enumerate(columns)
    )
    # 2^79 times 2^46 fits 38 digits; beyond that, and where other windows have a part, parts are added as doubles without error.
    small = f"NOT exists({others}, o -> o.c = e.c) AND abs(e.upper) < {1 << 79}BD"
    direct = f"CAST(CAST(e.upper * {1 << (LOWER - UPPER)}BD + e.lower AS DECIMAL(38,0)) AS DOUBLE) * {2.0 ** -LOWER!r}D"
    window_0 = "array(named_struct('w', 0, 'upper', e.upper, 'lower', e.lower))"
    joins = ", ".join(f"'{part}', {joined([f'o.{part}0', f'o.{part}1'], PART_LIMB)}" for part in PARTS)
    listed = f"transform(filter({others}, o -> o.c = e.c), o -> named_struct('w', o.w, {joins}))"
    parts = f"flatten(transform(concat({window_0}, {listed}), o -> {_as_doubles('o')}))"
    infinity = "double('Infinity')"
    total = (
        f"CASE WHEN e.highest IS NULL THEN CAST(NULL AS DOUBLE) "
        f"WHEN isnan(e.highest) OR (e.highest = {infinity} AND e.lowest = -{infinity}) THEN double('NaN') "
        f"WHEN e.highest = {infinity} THEN e.highest WHEN e.lowest = -{infinity} THEN e.lowest "
        f"WHEN {small} THEN {direct} ELSE {added(parts)} END"
    )
    return f"transform(array({entries}), e -> {total})"


def _as_doubles(entry: str) -> str:
    """Both parts of a window, each as two doubles of its sign that together are exactly its share."""
    half = f"pow(2D, {WINDOW // 2} * {entry}.w)"
    digit = f"{1 << 53}BD"
    cut = [
        (f"{entry}.{part} {cut} {digit}", (53 if cut == "div" else 0) - unit)
        for part, unit in zip(PARTS, (UPPER, LOWER)) for cut in ("div", "%")
    ]
    return f"array({', '.join(f'CAST({part} AS DOUBLE) * {2.0 ** power!r}D * {half} * {half}' for part, power in cut)})"


def added(doubles: str) -> str:
    """The double nearest to the exact sum of an array of finite doubles.

    Partial sums are kept as doubles that do not overlap: adding a number to one gives their rounded sum and, exactly,
    what rounding took away.
    """
    # t is the rounded sum of s.x and p, b the part of p in it.
    error = "(s.x - (q.t - q.b)) + (p - q.b)"
    step = (
        "transform(transform(array(s.x + p), t -> named_struct('t', t, 'b', t - s.x)), q -> "
        f"named_struct('x', q.t, 'rest', if({error} = 0D, s.rest, concat(s.rest, array({error})))))[0]"
    )
    start = "named_struct('x', d, 'rest', CAST(array() AS array<double>))"
    grown = f"aggregate(ps, {start}, (s, p) -> {step}, s -> concat(s.rest, array(s.x)))"
    partials = f"aggregate({doubles}, CAST(array() AS array<double>), (ps, d) -> {grown})"
    # From the largest down: the first sum that is not exact is the result, but for a half that a smaller part decides.
    sum_ = "(s.hi + p)"
    step = (
        f"CASE WHEN s.lo <> 0D THEN if(s.next = 0D, named_struct('hi', s.hi, 'lo', s.lo, 'next', p), s) "
        f"ELSE named_struct('hi', {sum_}, 'lo', p - ({sum_} - s.hi), 'next', 0D) END"
    )
    doubled = "(s.hi + 2 * s.lo)"
    decided = f"if(s.lo * s.next > 0D AND {doubled} - s.hi = 2 * s.lo, {doubled}, s.hi)"
    return f"aggregate(reverse({partials}), named_struct('hi', 0D, 'lo', 0D, 'next', 0D), (s, p) -> {step}, s -> {decided})"
