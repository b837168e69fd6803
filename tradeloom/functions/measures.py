"""Aggregate expressions.

Functions over order items take a ``weight``: a column that says how many items
a row stands for, for frames that hold several items per row with their summed
price and freight. Without it a row is one item.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is added in millionths, in two pieces of this many bits at most, so that
# 2**40 rows fit into one group.
_MONEY_BITS = 24
_MONEY = 10**6
_LARGEST = 2**47
# Other doubles are cut into integers of this many bits, counted in these powers
# of two, lowest first; 2**36 rows fit into one group.
_BITS = 28
_UNITS = range(-6 * _BITS, 3 * _BITS, _BITS)
_HUGE = 2.0 ** (_UNITS[-1] + _BITS - 1)
# Zeros below the pieces, so that every total has enough digits, and above for carries.
_BELOW, _ABOVE = 4, 3


def _rounded_sql() -> str:
    """SQL of the double nearest to a total, from its pieces ``s.odd``.

    Carries are settled first, for the total without its sign. The leading
    digits, below 2**53 together, and the next digit are exact doubles, with a
    bit set for anything below, so that their one addition rounds as the whole
    total does.
    """
    mask, step = f"{(1 << _BITS) - 1}L", float(2**_BITS)

    def settled(limbs: str) -> str:
        return (
            f"reduce({limbs}, named_struct('d', CAST(array() AS ARRAY<BIGINT>), 'c', 0L), (t, l) -> named_struct("
            f"'d', array_append(t.d, (l + t.c) & {mask}), 'c', shiftright(l + t.c, {_BITS})))")

    def size(digits: str) -> str:
        return (
            f"reduce(reverse({digits}), named_struct('top', 0L, 'low', 0L, 'n', 0, 'left', 0), (t, d) -> CASE "
            f"WHEN t.top < {1 << 53 - _BITS} THEN "
            f"named_struct('top', shiftleft(t.top, {_BITS}) + d, 'low', t.low, 'n', t.n, 'left', t.left) "
            f"WHEN t.n < 1 THEN named_struct('top', t.top, 'low', shiftleft(d, 1), 'n', 1, 'left', t.left) "
            f"ELSE named_struct('top', t.top, 'low', IF(d = 0, t.low, t.low | 1L), 'n', t.n, 'left', t.left + 1) END, "
            f"t -> (CAST(t.top AS DOUBLE) * {2 * step!r}D + CAST(t.low AS DOUBLE)) "
            f"* pow(2D, t.left * {_BITS} + {_UNITS[0] - _BELOW * _BITS - 1}))")

    plain = f"concat(array_repeat(0L, {_BELOW}), s.odd, array_repeat(0L, {_ABOVE}))"
    return (
        f"transform(array({settled(plain)}), f -> IF(f.c < 0, "
        f"-{size(settled(f'transform({plain}, x -> -x)') + '.d')}, {size('f.d')}))[0]")


def _total_sql() -> str:
    """SQL of a group's total from the sums ``s``."""
    millionths = f"(s.high * {1 << _MONEY_BITS}L + s.low)"
    exact = (f"CAST((CAST(s.high AS DECIMAL(20,0)) * {1 << _MONEY_BITS}BD + CAST(s.low AS DECIMAL(20,0))) "
             f"/ {_MONEY}BD AS DOUBLE)")
    money = (f"CASE WHEN s.high IS NULL THEN NULL WHEN abs(s.high) >= {1 << 37} THEN {exact} "
             f"WHEN abs({millionths}) < {1 << 53} THEN CAST({millionths} AS DOUBLE) / {_MONEY}D ELSE {exact} END")
    odd = f"IF(s.odd[0] IS NULL, NULL, {_rounded_sql()})"
    return (f"CASE WHEN s.odd[0] IS NULL AND s.huge IS NULL THEN {money} "
            f"ELSE coalesce({money}, 0D) + coalesce({odd}, 0D) + coalesce(s.huge, 0D) END")


_TOTAL = _total_sql()


def exact_sum(name: str) -> Column:
    """SUM of a double column of money, independent of the order of addition.

    Adding doubles in another order moves the last digits, so a retried task or
    another partitioning can turn x.50 into x.49999 and flip a rounding. Values
    with up to six decimal places (below 140 million) are added as the decimals
    they are written as, in millionths as longs; sums of such sums lose nothing.
    All other values are cut into integers at fixed powers of two, which are
    added as longs too, and their total is rounded once, as ``math.fsum`` does.
    That holds for bits from 2**-168 on in values below 2**83; smaller bits are
    rounded value by value and larger values are added as doubles. NaN and
    infinities make the total what adding doubles makes of them.
    """
    value = "CAST(`{}` AS DOUBLE)".format(name.replace("`", "``"))
    count = f"rint({value} * {_MONEY}D)"
    money = f"(abs({count}) < {_LARGEST} AND {count} / {_MONEY}D = {value})"
    high, step = f"rint({count} * {2.0 ** -_MONEY_BITS!r}D)", float(2**_MONEY_BITS)
    odd = f"IF({money} OR abs({value}) >= {_HUGE!r}D, NULL, {value})"
    scaled = [f"rint({odd} * {2.0 ** -u!r}D)" for u in [*_UNITS, _UNITS[-1] + _BITS]]
    pieces = ", ".join(
        f"sum(CAST({low} - {up} * {float(2**_BITS)!r}D AS BIGINT))" for low, up in zip(scaled, scaled[1:]))
    sums = (
        f"named_struct('high', sum(IF({money}, CAST({high} AS BIGINT), NULL)), "
        f"'low', sum(IF({money}, CAST({count} - {high} * {step!r}D AS BIGINT), NULL)), "
        f"'odd', array({pieces}), 'huge', sum(IF(abs({value}) < {_HUGE!r}D, NULL, {value})))")
    return F.expr(f"transform(array({sums}), s -> {_TOTAL})[0]")


def exact_avg(name: str) -> Column:
    return F.try_divide(exact_sum(name), F.count(name))


def item_count(where: Column | None = None, weight: str | None = None) -> Column:
    """Number of order items in a group, or of those meeting a condition."""
    if weight is None:
        return F.count("*") if where is None else F.count_if(where)
    counted = F.col(weight) if where is None else F.when(where, F.col(weight))
    return F.coalesce(F.sum(counted), F.lit(0))


def item_avg(name: str, digits: int, weight: str | None = None) -> Column:
    """Rounded average of an integer column over order items, NULLs skipped."""
    if weight is None:
        return F.round(F.avg(name), digits)
    total = F.sum(F.col(name) * F.col(weight))
    known = F.sum(F.when(F.col(name).isNotNull(), F.col(weight)))
    return F.round(F.try_divide(total.cast("double"), known.cast("double")), digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole of two counts as a double; NULL when ``whole`` is 0.

    The quotient is rounded as a decimal, so halves round away from zero.
    """
    hundredfold = part.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
    quotient = F.try_divide(hundredfold, whole.cast("decimal(20,0)"))
    return F.round(quotient, digits).cast("double")
