"""Safe decimal casts and conversion to USD, exact at every size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfold.schemas import BASE_CURRENCY, MONEY, RATE, USD


def safe_money(text: Column) -> Column:
    """Two-decimal amount; NULL where the text is no such number."""
    return text.try_cast(MONEY)


def safe_rate(text: Column) -> Column:
    """Eight-decimal rate; NULL where the text is no number below 100000."""
    return text.try_cast(RATE)


def number(value: int, digits: int | None = None) -> Column:
    """An integer as a decimal literal just wide enough, or of ``digits``."""
    return F.lit(str(value)).cast(f"decimal({digits or len(str(value))},0)")


def units(value: Column, scale: int) -> Column:
    """The magnitude of a decimal(38, scale) in units of its last digit, as decimal(38,0).

    The integer part and the rest are taken apart first: multiplied as a whole, a
    value of 38 digits would not fit. The sign goes last, by a subtraction: Spark's
    minus and abs round to 34 digits.
    """
    rest = value % F.lit(1).cast("decimal(1,0)")
    whole = (value - rest).cast(f"decimal({38 - scale},0)")
    last = (rest * number(10**scale)).cast(f"decimal({scale},0)")
    signed = (whole * number(10**scale) + last).cast("decimal(38,0)")
    return F.when(value < 0, (number(0) - signed).cast("decimal(38,0)")).otherwise(signed)


def negated(value: Column) -> Column:
    """The negative of a decimal(38,8), exact beyond the 34 digits that Spark's minus keeps."""
    digits = value.cast("string")
    text = F.when(value < 0, F.substring(digits, 2, 40)).otherwise(F.concat(F.lit("-"), digits))
    return F.when(value.try_cast("decimal(34,8)").isNotNull(), (-value).cast(USD)).otherwise(text.cast(USD))


def whole_quotient(dividend: Column, divisor: Column) -> Column:
    """Integer quotient of decimal(38,0) columns; NULL from 10^28 up, or by zero."""
    return F.try_divide(dividend - dividend % divisor, divisor).try_cast("decimal(28,0)")


def with_decimals(whole: Column, hundred_millionths: Column, negative: Column) -> Column:
    """A decimal(38,8) from its sign, its integer part and its eight decimals.

    A sum is typed with a digit to spare, so the largest values are put together as text.
    """
    decimals = hundred_millionths.cast("decimal(8,0)")
    sign = F.when(negative, number(0) - number(1)).otherwise(number(1)).cast("decimal(1,0)")
    summed = (whole.try_cast("decimal(29,0)") * sign).cast("decimal(29,0)") + (
        (decimals * sign).cast("decimal(8,0)") * F.lit("0.00000001").cast("decimal(8,8)")
    )
    text = F.concat(
        F.when(negative, "-").otherwise(""), whole.cast("string"), F.lit("."),
        F.lpad(decimals.cast("string"), 8, "0"),
    )
    return F.coalesce(summed.cast(USD), F.when(whole.isNotNull(), text.try_cast(USD)))


def let(body: Callable[[Column], Column], **values: Column) -> Column:
    """``body`` of a struct of the values, each of which is worked out once.

    Long exact formulas use their parts many times; written out they would be too
    large to compile.
    """
    bound = F.array(F.struct(*[value.alias(name) for name, value in values.items()]))
    return F.transform(bound, body)[0]


def _quotient(amount: Column, rate: Column) -> Column:
    """amount / rate with eight decimals, half-up; NULL from 10^30 up, or by zero.

    The quotient in hundred-millionths is (cents / divisor) * 10^14: first the
    integer quotient, then 14 more digits of what is left.
    """

    def divided(v: Column) -> Column:
        left = (v.cents % v.divisor).cast("decimal(13,0)")
        return let(
            lambda w: let(lambda x: let(joined, first=x.first, second=rounded(x), negative=x.negative),
                          first=w.first, dividend=w.dividend, divisor=w.divisor, negative=w.negative,
                          rest=(w.dividend % w.divisor).cast("decimal(13,0)")),
            first=F.try_divide(v.cents - left, v.divisor).try_cast("decimal(24,0)"),
            dividend=(left * number(10**14)).cast("decimal(27,0)"),
            divisor=v.divisor, negative=v.negative,
        )

    def rounded(x: Column) -> Column:
        whole = ((x.dividend - x.rest) / x.divisor).cast("decimal(15,0)")
        return F.when(x.rest * 2 >= x.divisor, whole + 1).otherwise(whole).cast("decimal(15,0)")

    def joined(y: Column) -> Column:
        decimals = (y.second % number(10**8)).cast("decimal(8,0)")
        carried = ((y.second - decimals) / number(10**8)).cast("decimal(7,0)")
        return with_decimals((y.first * number(10**6) + carried).try_cast("decimal(30,0)"), decimals, y.negative)

    divisor = units(rate.cast(USD), 8).cast("decimal(13,0)")
    return let(
        divided, cents=units(amount, 2), divisor=F.nullif(divisor, number(0, 13)),
        negative=(amount < 0) != (rate < 0),
    )


def to_usd(currency: Column, amount: Column, rate: Column) -> Column:
    """USD value of a text amount; the rate is local units per USD.

    The currency compare is case-sensitive. A missing currency gives NULL, as
    does a foreign amount with a missing or zero rate. Values from 10^30 USD up
    do not fit the result and give NULL (the USD checks report such rows).

    Quotients are rounded once, half-up. Spark types decimal(24,2) / decimal(13,8) as
    decimal(38,8) and so rounds it right; longer amounts are divided in steps.
    """
    money, per_usd = safe_money(amount), safe_rate(rate)
    short = money.try_cast("decimal(24,2)")
    foreign = F.when(short.isNotNull(), F.try_divide(short, per_usd).cast(USD)).otherwise(
        _quotient(money, per_usd)
    )
    return (
        F.when(currency == BASE_CURRENCY, money.try_cast(USD))
        .when(currency != BASE_CURRENCY, foreign)
    )
