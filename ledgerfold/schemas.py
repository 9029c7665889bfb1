"""Table schemas, status domains and column comments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw monetary columns and rates stay text: staging safe-casts them.
RAW_INVOICES = T.StructType([
    T.StructField("INVOICE_ID", T.LongType()),
    T.StructField("PARENT_INVOICE_ID", T.LongType()),
    T.StructField("TRANSACTION_ID", T.LongType()),
    T.StructField("ORGANIZATION_ID", T.LongType()),
    T.StructField("TYPE", T.StringType()),
    T.StructField("STATUS", T.StringType()),
    T.StructField("CURRENCY", T.StringType()),
    T.StructField("PAYMENT_CURRENCY", T.StringType()),
    T.StructField("PAYMENT_METHOD", T.StringType()),
    T.StructField("AMOUNT", T.StringType()),
    T.StructField("PAYMENT_AMOUNT", T.StringType()),
    T.StructField("FX_RATE", T.StringType()),
    T.StructField("FX_RATE_PAYMENT", T.StringType()),
    T.StructField("CREATED_AT", T.TimestampNTZType()),
])

RAW_ORGANIZATIONS = T.StructType([
    T.StructField("ORGANIZATION_ID", T.LongType()),
    T.StructField("FIRST_PAYMENT_DATE", T.DateType()),
    T.StructField("LAST_PAYMENT_DATE", T.DateType()),
    T.StructField("LEGAL_ENTITY_COUNTRY_CODE", T.IntegerType()),
    T.StructField("COUNT_TOTAL_CONTRACTS_ACTIVE", T.LongType()),
    T.StructField("CREATED_DATE", T.TimestampNTZType()),
])

USD = T.DecimalType(38, 8)
SHORT_USD = T.DecimalType(18, 8)  # a 64-bit number
MONEY = T.DecimalType(38, 2)
RATE = T.DecimalType(13, 8)

# The currency that needs no rate and the status domain.
BASE_CURRENCY = "USD"
INFLOW_STATUS = "paid"
OUTFLOW_STATUSES = ("credited", "refunded")
BALANCE_STATUSES = (INFLOW_STATUS, *OUTFLOW_STATUSES)
INVOICE_STATUSES = (
    "paid", "open", "skipped", "cancelled", "pending", "credited",
    "processing", "failed", "refunded", "unpayable", "awaiting_payment",
)

COMMENTS: dict[str, dict[str, str]] = {
    "stg_organizations": {
        "organization_id": "Organisation key",
        "legal_entity_country_code": "Numeric country code of the legal entity",
        "organization_created_date": "Day the organisation was registered",
    },
    "stg_invoices": {
        "invoice_id": "Invoice key",
        "organization_id": "Organisation that owns the invoice",
        "status": "Lifecycle status, one of eleven values",
        "amount_usd": "Invoice amount in USD, the measure of credits and refunds",
        "payment_amount_usd": "Paid amount in USD, the measure of paid invoices",
        "created_date": "Day the invoice was created",
    },
    "dim_organizations": {
        "organization_id": "Organisation key",
        "organization_created_date": "Day the organisation was registered",
    },
    "fct_daily_financial_snapshot": {
        "snapshot_date": "Day of the balance",
        "organization_id": "Organisation key",
        "daily_net_change_usd": "Net USD movement of the day, 0 on quiet days",
        "cumulative_net_financial_balance_usd": "USD balance at the end of the day",
    },
}

TABLE_COMMENTS: dict[str, str] = {
    "raw_invoices": "Invoices as delivered, amounts and rates still text",
    "raw_organizations": "Organisations as delivered",
    "stg_organizations": "Organisations with typed and renamed columns",
    "stg_invoices": "Invoices with typed columns and USD amounts",
    "int_daily_activity": "One row per organisation and day with movements",
    "dim_organizations": "One row per organisation",
    "latest_snapshot_date": "The latest day of the snapshot, one row",
    "fct_daily_financial_snapshot": "One row per organisation and day with its running balance",
}


def with_comments(df: DataFrame, table: str) -> DataFrame:
    """Attach the table's column comments, kept by parquet and the catalog."""
    comments = COMMENTS.get(table, {})
    return df.select([
        F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
        for c in df.columns
    ])
