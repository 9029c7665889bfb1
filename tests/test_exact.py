"""Exact conversion and percentages at every size, against Python's decimals."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal, getcontext

import pytest

from ledgerfold.functions import change, money

getcontext().prec = 120
EIGHT, TWO = Decimal("1e-8"), Decimal("0.01")


def _random(rng, digits, scale):
    size = rng.randint(1, digits + scale)
    return Decimal(rng.randint(1, 10**size) * rng.choice([1, 1, 1, -1])).scaleb(-scale)


def test_usd_is_exact_half_up(spark):
    rng = random.Random(5)
    rows = [("EUR", _random(rng, 36, 2), abs(_random(rng, 5, 8))) for _ in range(3000)]
    rows += [("EUR", Decimal("1" + "0" * 22), Decimal(1)), ("EUR", Decimal("9" * 30), Decimal(1)),
             ("EUR", Decimal("9" * 36) + Decimal("0.99"), Decimal("99999.99999999")),
             ("EUR", Decimal("0.01"), Decimal("0.00000001")), ("EUR", Decimal("0.05"), Decimal(10_000)),
             ("EUR", Decimal(1), Decimal("-3")), ("EUR", Decimal(1), Decimal(0)),
             ("USD", Decimal("9" * 29), Decimal(7)), ("USD", Decimal("1" + "0" * 30), Decimal(1))]
    df = spark.createDataFrame([(c, f"{a:f}", f"{r:f}") for c, a, r in rows], "c string, a string, r string")
    got = [x[0] for x in df.select(money.to_usd(df.c, df.a, df.r)).collect()]
    for (currency, amount, rate), usd in zip(rows, got):
        if currency == "USD":
            expected = amount
        else:
            expected = (amount / rate).quantize(EIGHT, ROUND_HALF_UP) if rate else None
        if expected is not None and abs(expected) >= 10**30:
            expected = None
        assert usd == expected, (amount, rate)


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(8)
    rows = []
    for _ in range(1500):
        old = _random(rng, 30, 8)
        new = rng.choice([_random(rng, 30, 8), old * rng.choice([1, -1, 2]), old + _random(rng, 8, 8)])
        near = old * Decimal(rng.choice(["1.5", "0.5"])) + rng.choice([0, EIGHT, -EIGHT])
        rows += [(old, new), (old, near), (old * 8, old * 8 + old * Decimal("0.00025"))]
    rows += [(Decimal("2e18"), Decimal("3e18") + EIGHT), (Decimal("2e19"), Decimal("3e19") + EIGHT),
             (Decimal("2e19"), Decimal("3e19")), (Decimal("-9e29"), Decimal("9e29")), (Decimal(3), Decimal(3))]
    limit = Decimal(10) ** 30
    return [(o.quantize(EIGHT), n.quantize(EIGHT)) for o, n in rows if abs(o) < limit and abs(n) < limit and o.quantize(EIGHT)]


def test_percentages_are_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "o decimal(38,8), n decimal(38,8)")
    got = df.select(
        change.pct_change(df.o, df.n), change.exceeds(df.o, df.n), change.exceeds(df.o, df.n, Decimal("250.25")),
        change.pct_text(df.o, df.n),
    ).collect()
    for (old, new), (pct, half, more, text) in zip(pairs, got):
        exact = (new - old) / abs(old) * 100
        rounded = exact.quantize(EIGHT, ROUND_HALF_UP)
        assert pct == (rounded if abs(rounded) < Decimal(10) ** 30 else None), (old, new)
        assert half == (abs(exact) > 50) and more == (abs(exact) > Decimal("250.25")), (old, new)
        shown = abs(exact).quantize(TWO, ROUND_HALF_EVEN)
        if abs(rounded) < Decimal(10) ** 30:
            assert text == f"{'+' if new >= old else '-'}{shown:f}%", (old, new)
