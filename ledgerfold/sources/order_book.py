"""Raw invoices and organisations derived from the ``orders``/``customer`` tables.

Every order becomes an invoice and every customer an organisation. Keys select
status, currency and rates, and a share of missing, malformed, negative, repeated
or orphaned values, so that each rule of staging, balancing and checking meets
data. No payment counts before ``FIRST_PAYMENT``, so earlier credits and refunds
precede the date spine. Two orders in 41 belong to an organisation of their own: one
opens its series, with a payment or, two times in three, a refund before the spine,
which keeps it at zero; the other moves it on ``LAST_DAY``. So balances move and leave
zero, both ways, on the day alerts look at. Some open invoices have amounts of 24 digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.schemas import RAW_INVOICES, RAW_ORGANIZATIONS

# Statuses by order key modulo 16.
STATUS_BY_KEY = (
    ["paid"] * 6
    + ["credited", "refunded", "open", "skipped", "cancelled", "pending",
       "processing", "failed", "unpayable", "awaiting_payment"]
)
FIRST_PAYMENT = "1995-03-01"
OPENING, LAST_DAY = "1995-01-15 13:00:00", "2001-07-31 13:00:00"
FIRST_OWN_ORGANIZATION = 10_000_000
HUGE = "123456789012345678901234.56"
CURRENCY_BY_CUSTOMER = ["USD", "USD", "USD", "EUR", "GBP", "JPY", "usd"]
RATE_BY_CUSTOMER = ["1", "1", "1", "0.92", "0.79", "149.5", "1"]
PAYMENT_CURRENCY_BY_SUM = ["USD", "USD", "EUR", "GBP", "JPY"]
PAYMENT_RATE_BY_SUM = ["1", "1", "0.92", "0.79", "149.5"]


def _pick(values: list[str], key: Column) -> Column:
    at = F.pmod(key, F.lit(len(values))) + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw invoice per order."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    nothing = F.lit(None)
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    early = F.col("o_orderdate") < F.lit(FIRST_PAYMENT).cast("timestamp_ntz")
    status = _pick(STATUS_BY_KEY, k)
    moves, opens, pays = k % 41 == 0, k % 41 == 1, k % 123 == 1
    huge = (k % 16 == 8) & (k % 9 == 0)
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.when(k % 1013 == 0, k - 1).otherwise(k).alias("INVOICE_ID"),
        F.when((k % 16).isin(6, 7), k - 1).alias("PARENT_INVOICE_ID"),
        (k * 10 + 1).alias("TRANSACTION_ID"),
        F.when(moves | opens, F.floor(k / 41) + FIRST_OWN_ORGANIZATION).when(k % 499 == 0, nothing).when(k % 503 == 0, -c).otherwise(c)
        .alias("ORGANIZATION_ID"),
        F.col("o_orderpriority").alias("TYPE"),
        F.when(opens, F.when(pays & ~early, "paid").when(pays, "pending").otherwise("refunded"))
        .when(k % 991 == 0, nothing).when(k % 997 == 0, "disputed")
        .when((status == "paid") & early, "pending").otherwise(status).alias("STATUS"),
        F.when(k % 101 != 0, _pick(CURRENCY_BY_CUSTOMER, c)).alias("CURRENCY"),
        _pick(PAYMENT_CURRENCY_BY_SUM, c + k).alias("PAYMENT_CURRENCY"),
        F.when(k % 3 == 0, "card").when(k % 3 == 1, "bank_transfer").alias("PAYMENT_METHOD"),
        F.when(huge, HUGE).when(k % 97 == 0, "n/a").when(k % 89 == 0, "").otherwise(price).alias("AMOUNT"),
        F.when(huge, HUGE).when(k % 83 == 0, nothing).when(k % 61 == 0, "100.005")
        .when(k % 107 == 0, F.concat(F.lit("-"), price)).otherwise(price)
        .alias("PAYMENT_AMOUNT"),
        F.when(k % 79 == 0, "0").when(k % 73 == 0, "100000").when(k % 71 == 0, nothing)
        .otherwise(_pick(RATE_BY_CUSTOMER, c)).alias("FX_RATE"),
        F.when(k % 79 == 1, "0").otherwise(_pick(PAYMENT_RATE_BY_SUM, c + k))
        .alias("FX_RATE_PAYMENT"),
        F.when(moves, F.lit(LAST_DAY).cast("timestamp_ntz"))
        .when(opens & ~pays, F.lit(OPENING).cast("timestamp_ntz"))
        .when(k % 983 != 0, F.col("o_orderdate") + F.expr("INTERVAL 13 HOURS"))
        .alias("CREATED_AT"),
    )
    return rows.to(RAW_INVOICES)


def raw_organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw organisation per customer.

    Orders are summed up per customer before the join, so that a customer with
    very many orders reaches the join as one row.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    history = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"),
    )
    customers = (
        spark.read.parquet(f"{sf_dir}/customer.parquet")
        .groupBy("c_custkey")
        .agg(F.max("c_nationkey").alias("nation"))
    )
    rows = customers.join(history, "c_custkey", "left").select(
        F.col("c_custkey").alias("ORGANIZATION_ID"),
        F.col("first_order").cast("date").alias("FIRST_PAYMENT_DATE"),
        F.col("last_order").cast("date").alias("LAST_PAYMENT_DATE"),
        F.col("nation").alias("LEGAL_ENTITY_COUNTRY_CODE"),
        F.coalesce("open_orders", F.lit(0).cast("bigint")).alias("COUNT_TOTAL_CONTRACTS_ACTIVE"),
        F.col("first_order").alias("CREATED_DATE"),
    )
    return rows.to(RAW_ORGANIZATIONS)


def deliver(invoices: DataFrame, path: str) -> None:
    """Write raw invoices as CSV files in which some records are broken.

    One record in 113 has two fields only; one in 127 has a date that is none, and one
    in 131 a parent that is no number.
    """
    k = F.col("INVOICE_ID")
    fields = [F.col(f.name).cast("string").alias(f.name) for f in RAW_INVOICES]
    dated = F.when(k % 127 == 0, "2001-13-01").otherwise(F.col("CREATED_AT").cast("string"))
    parent = F.when(k % 131 == 0, "none").otherwise(F.col("PARENT_INVOICE_ID").cast("string"))
    text = invoices.select(*fields).withColumns({"CREATED_AT": dated, "PARENT_INVOICE_ID": parent})
    line = F.when(k % 113 == 0, F.concat(k, F.lit(",short"))).otherwise(F.to_csv(F.struct(*RAW_INVOICES.names)))
    writer = text.select(line.alias(",".join(RAW_INVOICES.names))).write.option("header", True)
    # The lines are whole records: no separator or quote of the writer's own.
    writer.option("sep", "\x01").option("quote", "").option("escapeQuotes", False).csv(path)
