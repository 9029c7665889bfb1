"""Typed, renamed views of the raw tables, and the organisation dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.money import safe_money, safe_rate, to_usd
from ledgerfold.schemas import with_comments

_KEPT = (
    "invoice_id", "parent_invoice_id", "transaction_id", "organization_id",
    "type", "status", "currency", "payment_currency", "payment_method",
)


def stg_invoices(raw: DataFrame) -> DataFrame:
    """Typed invoices with both USD amounts, 17 columns."""
    col = lambda name: F.col(name.upper())
    staged = raw.select(
        *[col(name).alias(name) for name in _KEPT],
        safe_money(col("amount")).alias("amount"),
        safe_money(col("payment_amount")).alias("payment_amount"),
        safe_rate(col("fx_rate")).alias("fx_rate"),
        safe_rate(col("fx_rate_payment")).alias("fx_rate_payment"),
        col("created_at").alias("created_at_timestamp"),
        col("created_at").cast("date").alias("created_date"),
        to_usd(col("currency"), col("amount"), col("fx_rate")).alias("amount_usd"),
        to_usd(
            col("payment_currency"), col("payment_amount"), col("fx_rate_payment")
        ).alias("payment_amount_usd"),
    )
    return with_comments(staged, "stg_invoices")


def stg_organizations(raw: DataFrame) -> DataFrame:
    """Renamed organisations with their registration day, 7 columns."""
    staged = raw.withColumnsRenamed({c: c.lower() for c in raw.columns}).select(
        "organization_id",
        "first_payment_date",
        "last_payment_date",
        "legal_entity_country_code",
        "count_total_contracts_active",
        F.col("created_date").alias("created_date_timestamp"),
        F.col("created_date").cast("date").alias("organization_created_date"),
    )
    return with_comments(staged, "stg_organizations")


def dim_organizations(staged: DataFrame) -> DataFrame:
    """The dimension: staged organisations without the timestamp."""
    return with_comments(staged.drop("created_date_timestamp"), "dim_organizations")
