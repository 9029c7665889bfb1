"""Hand-written invoices that meet every rule once, and what must come out."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import types as T

from ledgerfold.schemas import RAW_INVOICES

AS_OF = date(2024, 1, 11)

RAW_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType() if f.name == "ORGANIZATION_ID" else f.dataType)
    for f in RAW_INVOICES
])

# id, org, status, currency, payment currency, amount, paid amount, rate, payment rate, created
_ROWS = """
1  A paid     USD USD 100.00 100.00 1      1      2024-01-03T23:59:59
2  A refunded EUR EUR 100.00 -      3      -      2024-01-05
3  A credited GBP -   10     -      0      -      2024-01-06
4  B refunded USD -   40.00  -      1      -      2024-01-01
5  B paid     EUR EUR 90     90     0.9    0.9    2024-01-09
6  C paid     usd usd 5      5      -      -      2024-01-04
7  C open     USD USD 7      7      1      1      2024-01-04
8  D paid     USD USD 1      1.005  1      1      2024-01-11T00:00:00
9  E paid     USD USD 3      3      1      1      2024-02-01
10 - paid     USD USD 10     10     1      1      2024-01-04
11 F paid     USD USD n/a    n/a    1      1      2024-01-04
12 F paid     USD -   4      4      1      1      2024-01-04
13 F paid     JPY JPY 4      4      100000 100000 2024-01-04
14 G paid     USD USD 100    100    1      1      2024-01-08
15 G paid     USD USD 50     50     1      1      2024-01-10
16 H paid     USD USD 100    100    1      1      2024-01-08
17 H paid     USD USD 50.01  50.01  1      1      2024-01-10
18 I paid     USD USD 100    100    1      1      2024-01-08
19 I refunded USD USD 100    100    1      1      2024-01-08T09:00:00
20 I paid     USD USD 5      5      1      1      2024-01-10
21 J paid     USD USD 10     10     1      1      2024-01-10
22 K refunded USD USD 100    100    1      1      2024-01-08
23 K paid     USD USD 40     40     1      1      2024-01-10
24 L paid     USD USD 20     20     1      1      2024-01-08
25 L credited USD USD 20     20     1      1      2024-01-08
26 L refunded USD USD 5      5      1      1      2024-01-10
"""

# id: (amount_usd, payment_amount_usd)
USD = {
    1: ("100", "100"), 2: ("33.33333333", None), 3: (None, None), 4: ("40", None),
    5: ("100", "100"), 6: (None, None), 7: ("7", "7"), 8: ("1", "1.01"), 9: ("3", "3"),
    10: ("10", "10"), 11: (None, None), 12: ("4", None), 13: (None, None),
}

# org: (rows, first day of January, last change, last balance)
SNAPSHOT = {
    "A": (8, 3, "0", "66.66666667"),
    "B": (8, 3, "0", "100"),
    "G": (3, 8, "50", "150"),
    "H": (3, 8, "50.01", "150.01"),
    "I": (3, 8, "5", "5"),
    "J": (1, 10, "10", "10"),
    "K": (3, 8, "40", "-60"),
    "L": (3, 8, "-5", "-5"),
    None: (7, 4, "0", "0"),
}

# org: (previous, percentage)
CHANGES = {
    "A": ("66.66666667", "0"),
    "B": ("100", "0"),
    "G": ("100", "50"),
    "H": ("100", "50.01"),
    "I": ("0", "999999.99"),
    "J": (None, None),
    "K": ("-100", "40"),
    "L": ("0", "-999999.99"),
    None: ("0", "0"),
}

# org: (previous, current, change) as shown
ALERTS = {
    "H": ("100.00", "150.01", "+50.01%"),
    "I": ("0.00", "5.00", "N/A (From Zero)"),
    "L": ("0.00", "-5.00", "N/A (From Zero)"),
}


def dec(text):
    return None if text is None else Decimal(text)


def invoice(number, org, status, ccy, pay_ccy, amount, paid, rate, pay_rate, created):
    if created is not None and "T" not in created:
        created += "T08:00:00"
    return (
        number, None, None, org, None, status, ccy, pay_ccy, None, amount, paid, rate, pay_rate,
        None if created is None else datetime.fromisoformat(created),
    )


def raw_rows():
    for line in _ROWS.strip().splitlines():
        number, *fields = [None if f == "-" else f for f in line.split()]
        yield invoice(int(number), *fields)


def raw_invoices(spark, rows=None):
    return spark.createDataFrame(list(raw_rows()) if rows is None else list(rows), RAW_SCHEMA)
