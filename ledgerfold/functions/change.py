"""Percentage change of a balance, its threshold test and its display."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfold.functions.money import let, number, units, whole_quotient, with_decimals
from ledgerfold.schemas import USD

# The alert threshold and the change shown for a move off zero.
THRESHOLD_PERCENT = Decimal("50.00")
FROM_ZERO_PERCENT = Decimal("999999.99")
FROM_ZERO_TEXT = "N/A (From Zero)"
FIRST_DAY_TEXT = "N/A (First Day?)"
MISSING_TEXT = "N/A"


# Balances below 10^19 take Spark's own division: decimal(30,8) / decimal(27,8) is
# typed decimal(38,8), one half-up rounding. Larger ones are divided in steps.
_SHORT = "decimal(27,8)"


def _short(old: Column, new: Column) -> tuple[Column, Column, Column]:
    """Both balances in the short type, and whether they fit."""
    o, n = old.try_cast(_SHORT), new.try_cast(_SHORT)
    return o, n, o.isNotNull() & n.isNotNull()


def _ratio(old: Column, new: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of |new - old| / |old| as whole + extra + rest / base, exact for every decimal(38,8).

    With equal signs the difference of the magnitudes is divided, with different ones
    the new magnitude, and one is added: so nothing is larger than a balance.
    """

    def sized(v: Column) -> Column:
        size = F.when(v.apart, v.other).when(v.other > v.base, v.other - v.base).otherwise(v.base - v.other)
        return let(
            lambda w: let(
                body, base=w.base, extra=w.extra, rest=w.size % w.base, whole=whole_quotient(w.size, w.base)
            ),
            base=v.base, size=size.cast("decimal(38,0)"),
            extra=F.when(v.apart, number(1)).otherwise(number(0)),
        )

    return let(
        sized, base=F.nullif(units(old, 8), number(0, 38)), other=units(new, 8),
        apart=(old < 0) != (new < 0),
    )


def _part(r: Column, scale: int, body: Callable[[Column], Column]) -> Column:
    """``body`` of rest / base in parts of 1 / scale: ``near``, and the ``side`` of the middle above it.

    Doubles give the candidate, which may be one off next to an integer; compared
    exactly with the middle above it, it still tells which integer is nearest.
    """
    near = F.floor(r.rest.cast("double") / r.base.cast("double") * scale).cast("decimal(12,0)")
    return let(
        lambda v: let(
            body, near=v.near, side=_compare(v.rest, number(2 * scale), v.base, v.near * 2 + 1),
            whole=v.whole,
        ),
        near=near, rest=r.rest, base=r.base, whole=r.whole + r.extra,
    )


def _compare(x: Column, by_x: Column, y: Column, by_y: Column) -> Column:
    """Sign of x * by_x - y * by_y for decimal(38,0) and factors below 10^13, limb by limb."""
    size = number(10**19)

    def halves(value: Column, factor: Column) -> Column:
        factor = factor.cast("decimal(13,0)")

        def product(v: Column) -> Column:
            high = ((v.value - v.low) / size).cast("decimal(19,0)")
            return let(
                lambda w: F.struct(
                    (w.high + ((w.low - w.low % size) / size).cast("decimal(13,0)")).alias("high"),
                    (w.low % size).alias("low"),
                ),
                high=(high * v.factor).cast("decimal(33,0)"), low=(v.low * v.factor).cast("decimal(32,0)"),
            )

        return let(product, value=value, low=(value % size).cast("decimal(19,0)"), factor=factor)

    def sign(v: Column) -> Column:
        return (
            F.when(v.a.high > v.b.high, 1).when(v.a.high < v.b.high, -1)
            .when(v.a.low > v.b.low, 1).when(v.a.low < v.b.low, -1).otherwise(0)
        )

    return let(sign, a=halves(x, by_x), b=halves(y, by_y))


def pct_change(old: Column, new: Column) -> Column:
    """(new - old) / |old| * 100, half-up at eight decimals; NULL if either side is missing.

    Exact at every size; percentages from 10^30 up do not fit and are NULL.
    """

    def exact(v: Column) -> Column:
        return let(joined, digits=F.when(v.side >= 0, v.near + 1).otherwise(v.near).cast("decimal(12,0)"),
                   whole=v.whole, negative=new < old)

    def joined(v: Column) -> Column:
        decimals = v.digits % number(10**8)
        carried = ((v.digits - decimals) / number(10**8)).cast("decimal(4,0)")
        return with_decimals((v.whole * number(100) + carried).try_cast("decimal(30,0)"), decimals, v.negative)

    o, n, fits = _short(old, new)
    short = F.try_divide(((n - o) * number(100)).cast("decimal(30,8)"), F.abs(o)).cast(USD)
    size = _ratio(old, new, lambda r: _part(r, 10**10, exact))
    off_zero = F.lit(FROM_ZERO_PERCENT).cast(USD)
    return (
        F.when(old.isNull() | new.isNull(), F.lit(None).cast(USD))
        .when((old != 0) & fits, short)
        .when(old != 0, size)
        .when(new == 0, F.lit(0).cast(USD))
        .when(new > 0, off_zero)
        .otherwise(-off_zero)
    )


def exceeds(old: Column, new: Column, threshold: Decimal = THRESHOLD_PERCENT) -> Column:
    """True where |pct_change| is strictly above the threshold.

    Decided on the exact quotient, so that 50.0000000001 % counts as above 50
    although the rounded percentage equals it.
    """
    limit = _limit(threshold)

    def exact(r: Column) -> Column:
        # In hundredths of a percent: (whole + extra) * 10^4 + rest / base * 10^4 > limit.
        left = (limit * 100).cast("decimal(10,0)") - (r.whole + r.extra) * number(10**4)
        return let(
            lambda v: F.when(v.left.isNull() | (v.left < 0), True).when(v.left >= 10**4, False).otherwise(
                _compare(v.rest, number(10**4), v.base, v.left.try_cast("decimal(13,0)")) > 0
            ),
            left=left, rest=r.rest, base=r.base,
        )

    o, n, fits = _short(old, new)
    off_zero = (new != 0) & (F.lit(FROM_ZERO_PERCENT) > limit)
    return (
        F.when(old.isNull() | new.isNull(), F.lit(False))
        .when((old != 0) & fits, F.abs(n - o) * number(100) > limit * F.abs(o))
        .when(old != 0, _ratio(old, new, exact))
        .otherwise(off_zero)
    )


def _limit(threshold: Decimal) -> Column:
    value = Decimal(threshold)
    if not 0 <= value < 10**8 or value != round(value, 2):
        raise ValueError(f"threshold must be a percentage with two decimals, not {threshold}")
    return F.lit(value).cast("decimal(10,2)")


def money_text(value: Column, missing: str) -> Column:
    """Thousands separators and two decimals, half-even."""
    return F.coalesce(F.format_number(value, 2), F.lit(missing))


def pct_text(old: Column, new: Column) -> Column:
    """Signed percentage change with two decimals, half-even.

    Rounded from the exact quotient: the eight-decimal percentage may sit on a
    tie that the quotient does not.
    """

    def exact(v: Column) -> Column:
        up = (v.side > 0) | ((v.side == 0) & (v.near % 2 == 1))
        return let(shown, digits=F.when(up, v.near + 1).otherwise(v.near).cast("decimal(6,0)"), whole=v.whole)

    def shown(v: Column) -> Column:
        last = v.digits % number(100)
        whole = v.whole * number(100) + ((v.digits - last) / number(100)).cast("decimal(4,0)")
        return F.concat_ws(
            ".", whole.cast("decimal(38,0)").cast("string"), F.lpad(last.cast("string"), 2, "0")
        )

    # Hundredths of a percent in the short type; NULL where it does not hold them.
    o, n, _ = _short(old, new)
    parts, base = F.abs(n - o) * number(10**4), F.abs(o)
    rest = parts % base
    near = F.try_divide(parts - rest, F.nullif(base, number(0))).try_cast("decimal(32,0)")
    up = (rest * 2 > base) | ((rest * 2 == base) & (near % 2 == 1))
    short = (F.when(up, near + 1).otherwise(near).cast("decimal(33,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("string")
    size = (
        F.when((old != 0) & near.isNotNull(), short)
        .when(old != 0, _ratio(old, new, lambda r: _part(r, 10**4, exact)))
        .when(old == 0, "0.00")
    )
    return F.when((old == 0) & (new != 0), FROM_ZERO_TEXT).otherwise(
        F.concat(F.when(new >= old, "+").otherwise("-"), size, F.lit("%"))
    )
