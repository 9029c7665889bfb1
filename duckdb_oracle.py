"""Independent DuckDB statements for the queries in ``__spark_entry__``.

Division is done on integers: DuckDB divides decimals as doubles.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"

RAW_INVOICES = """
raw_invoices AS (
  SELECT CASE WHEN k % 1013 = 0 THEN k - 1 ELSE k END AS "INVOICE_ID",
         CASE WHEN k % 16 IN (6, 7) THEN k - 1 END AS "PARENT_INVOICE_ID",
         k * 10 + 1 AS "TRANSACTION_ID",
         CASE WHEN k % 41 <= 1 THEN 10000000 + k // 41 WHEN k % 499 = 0 THEN NULL WHEN k % 503 = 0 THEN -c ELSE c END
           AS "ORGANIZATION_ID",
         o_orderpriority AS "TYPE",
         CASE WHEN k % 123 = 1 AND o_orderdate < DATE '1995-03-01' THEN 'pending'
              WHEN k % 123 = 1 THEN 'paid' WHEN k % 41 = 1 THEN 'refunded' WHEN k % 991 = 0 THEN NULL WHEN k % 997 = 0 THEN 'disputed'
              WHEN k % 16 <= 5 AND o_orderdate < DATE '1995-03-01' THEN 'pending'
              WHEN k % 16 <= 5 THEN 'paid'
              ELSE ['credited', 'refunded', 'open', 'skipped', 'cancelled', 'pending',
                    'processing', 'failed', 'unpayable', 'awaiting_payment'][k % 16 - 5]
         END AS "STATUS",
         CASE WHEN k % 101 = 0 THEN NULL
              ELSE ['USD', 'USD', 'USD', 'EUR', 'GBP', 'JPY', 'usd'][c % 7 + 1]
         END AS "CURRENCY",
         ['USD', 'USD', 'EUR', 'GBP', 'JPY'][(c + k) % 5 + 1] AS "PAYMENT_CURRENCY",
         CASE k % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'bank_transfer' END AS "PAYMENT_METHOD",
         CASE WHEN huge THEN '123456789012345678901234.56'
              WHEN k % 97 = 0 THEN 'n/a' WHEN k % 89 = 0 THEN '' ELSE price END AS "AMOUNT",
         CASE WHEN huge THEN '123456789012345678901234.56'
              WHEN k % 83 = 0 THEN NULL WHEN k % 61 = 0 THEN '100.005'
              WHEN k % 107 = 0 THEN '-' || price ELSE price
         END AS "PAYMENT_AMOUNT",
         CASE WHEN k % 79 = 0 THEN '0' WHEN k % 73 = 0 THEN '100000' WHEN k % 71 = 0 THEN NULL
              ELSE ['1', '1', '1', '0.92', '0.79', '149.5', '1'][c % 7 + 1]
         END AS "FX_RATE",
         CASE WHEN k % 79 = 1 THEN '0'
              ELSE ['1', '1', '0.92', '0.79', '149.5'][(c + k) % 5 + 1]
         END AS "FX_RATE_PAYMENT",
         CASE WHEN k % 41 = 0 THEN TIMESTAMP '2001-07-31 13:00:00'
              WHEN k % 41 = 1 AND k % 123 <> 1 THEN TIMESTAMP '1995-01-15 13:00:00'
              WHEN k % 983 <> 0 THEN o_orderdate + INTERVAL 13 HOUR END AS "CREATED_AT"
  FROM (SELECT *, o_orderkey AS k, o_custkey AS c,
               o_orderkey % 16 = 8 AND o_orderkey % 9 = 0 AS huge,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price
        FROM orders)
)"""

RAW_ORGANIZATIONS = """
raw_organizations AS (
  SELECT c_custkey AS "ORGANIZATION_ID",
         CAST(MIN(o_orderdate) AS DATE) AS "FIRST_PAYMENT_DATE",
         CAST(MAX(o_orderdate) AS DATE) AS "LAST_PAYMENT_DATE",
         MAX(c_nationkey) AS "LEGAL_ENTITY_COUNTRY_CODE",
         CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT)
           AS "COUNT_TOTAL_CONTRACTS_ACTIVE",
         MIN(o_orderdate) AS "CREATED_DATE"
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey
)"""


def _usd(currency: str, amount: str, rate: str) -> str:
    """Quotient at scale 8, rounded half away from zero."""
    cents = f"ABS(CAST(REPLACE(CAST({amount} AS VARCHAR), '.', '') AS HUGEINT))"
    units = f"CAST(CAST({rate} AS DECIMAL(21,8)) * 100000000 AS HUGEINT)"
    size = (
        f"(({cents} // {units}) * 100000000000000"
        f" + (2 * ({cents} % {units}) * 100000000000000 + {units}) // (2 * {units}))"
    )
    return f"""CASE
      WHEN {currency} = 'USD' THEN CAST({amount} AS DECIMAL(38,8))
      WHEN {currency} <> 'USD' AND {rate} <> 0 THEN CAST(
        CASE WHEN {amount} < 0 THEN '-' ELSE '' END || CAST({size} // 100000000 AS VARCHAR) || '.'
        || LPAD(CAST({size} % 100000000 AS VARCHAR), 8, '0') AS DECIMAL(38,8))
    END"""


def _unscale(units: str) -> str:
    """Integer hundred-millionths to a decimal."""
    return (
        f"CAST(CAST({units} AS DECIMAL(30,0)) * CAST(0.00000001 AS DECIMAL(8,8))"
        " AS DECIMAL(38,8))"
    )


STAGED = f"""
typed AS (
  SELECT "INVOICE_ID" AS invoice_id, "PARENT_INVOICE_ID" AS parent_invoice_id,
         "TRANSACTION_ID" AS transaction_id, "ORGANIZATION_ID" AS organization_id,
         "TYPE" AS type, "STATUS" AS status, "CURRENCY" AS currency,
         "PAYMENT_CURRENCY" AS payment_currency, "PAYMENT_METHOD" AS payment_method,
         TRY_CAST("AMOUNT" AS DECIMAL(38,2)) AS amount,
         TRY_CAST("PAYMENT_AMOUNT" AS DECIMAL(38,2)) AS payment_amount,
         TRY_CAST("FX_RATE" AS DECIMAL(13,8)) AS fx_rate,
         TRY_CAST("FX_RATE_PAYMENT" AS DECIMAL(13,8)) AS fx_rate_payment,
         "CREATED_AT" AS created_at_timestamp,
         CAST("CREATED_AT" AS DATE) AS created_date
  FROM raw_invoices
),
invoices AS (
  SELECT *, {_usd("currency", "amount", "fx_rate")} AS amount_usd,
         {_usd("payment_currency", "payment_amount", "fx_rate_payment")} AS payment_amount_usd
  FROM typed
)"""

ORGANIZATIONS = """
organizations AS (
  SELECT "ORGANIZATION_ID" AS organization_id, "FIRST_PAYMENT_DATE" AS first_payment_date,
         "LAST_PAYMENT_DATE" AS last_payment_date,
         "LEGAL_ENTITY_COUNTRY_CODE" AS legal_entity_country_code,
         "COUNT_TOTAL_CONTRACTS_ACTIVE" AS count_total_contracts_active,
         "CREATED_DATE" AS created_date_timestamp,
         CAST("CREATED_DATE" AS DATE) AS organization_created_date
  FROM raw_organizations
)"""

# signed: one row per invoice that moves a balance.
MOVES = """
signed AS (
  SELECT organization_id, created_date, status, payment_amount_usd AS delta
  FROM invoices WHERE status = 'paid' AND payment_amount_usd IS NOT NULL
  UNION ALL
  SELECT organization_id, created_date, status, -amount_usd
  FROM invoices WHERE status IN ('credited', 'refunded') AND amount_usd IS NOT NULL
),
moves AS (
  SELECT organization_id, created_date AS day, CAST(SUM(delta) AS DECIMAL(38,8)) AS net
  FROM signed GROUP BY ALL
),
opening AS (
  SELECT COALESCE(MIN(created_date), {as_of}) AS day FROM signed WHERE status = 'paid'
)"""

SNAPSHOT = """
series AS (
  SELECT organization_id, MIN(day) AS first_day FROM moves GROUP BY organization_id
),
calendar AS (
  SELECT organization_id,
         CAST(UNNEST(GENERATE_SERIES(GREATEST(first_day, (SELECT day FROM opening)),
                                     {as_of} - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE)
           AS snapshot_date
  FROM series WHERE first_day IS NOT NULL
),
filled AS (
  SELECT snapshot_date, calendar.organization_id,
         COALESCE(net, CAST(0 AS DECIMAL(38,8))) AS daily_net_change_usd
  FROM calendar LEFT JOIN moves
    ON moves.organization_id = calendar.organization_id AND moves.day = snapshot_date
),
snapshot AS (
  SELECT *, CAST(SUM(daily_net_change_usd) OVER (
              PARTITION BY organization_id ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING
            ) AS DECIMAL(38,8)) AS cumulative_net_financial_balance_usd
  FROM filled
)"""


def _cents(units: str) -> str:
    """Half-even cents of non-negative hundred-millionths."""
    return f"""({units} // 1000000 + CASE
        WHEN {units} % 1000000 > 500000
          OR ({units} % 1000000 = 500000 AND ({units} // 1000000) % 2 = 1) THEN 1 ELSE 0 END)"""


def _money_text(units: str) -> str:
    cents = _cents(f"ABS({units})")
    return f"""(CASE WHEN {units} < 0 THEN '-' ELSE '' END
      || FORMAT('{{:,}}', CAST({cents} // 100 AS BIGINT))
      || '.' || LPAD(CAST({cents} % 100 AS VARCHAR), 2, '0'))"""


PAIRS = """
pairs AS (
  SELECT today.snapshot_date, today.organization_id,
         today.cumulative_net_financial_balance_usd AS current_balance,
         before.cumulative_net_financial_balance_usd AS previous_day_balance
  FROM snapshot AS today LEFT JOIN snapshot AS before
    ON before.organization_id IS NOT DISTINCT FROM today.organization_id
   AND before.snapshot_date = today.snapshot_date - INTERVAL 1 DAY
  WHERE today.snapshot_date = (SELECT MAX(snapshot_date) FROM snapshot)
)"""

ALL_PAIRS = """
pairs AS (
  SELECT snapshot_date, organization_id, cumulative_net_financial_balance_usd AS current_balance,
         LAG(cumulative_net_financial_balance_usd) OVER (
           PARTITION BY organization_id ORDER BY snapshot_date) AS previous_day_balance
  FROM snapshot
)"""

CHANGES = f"""
scaled AS (
  SELECT *, CAST(CAST(current_balance AS DECIMAL(28,8)) * 100000000 AS HUGEINT) AS n,
         CAST(CAST(previous_day_balance AS DECIMAL(28,8)) * 100000000 AS HUGEINT) AS o
  FROM pairs
),
changes AS (
  SELECT *, CASE
      WHEN o <> 0 THEN SIGN(n - o) * ((2 * ABS(n - o) * 10000000000 + ABS(o)) // (2 * ABS(o)))
      WHEN n IS NULL OR o IS NULL THEN NULL
      ELSE SIGN(n) * CAST(99999999000000 AS HUGEINT) END AS p
  FROM scaled
)"""

_ALERT = "(o <> 0 AND ABS(n - o) * 100 > 50 * ABS(o)) OR (o = 0 AND n <> 0)"


# What the catalog says of tables (no column) and columns.
DESCRIPTIONS = (
    ("int_daily_activity", None, "One row per organisation and day with movements"),
    ("int_daily_activity", "organization_id", "Organisation that owns the invoice"),
    ("int_daily_activity", "transaction_date", "Day the invoice was created"),
    ("dim_organizations", None, "One row per organisation"),
    ("dim_organizations", "organization_id", "Organisation key"),
    ("dim_organizations", "legal_entity_country_code", "Numeric country code of the legal entity"),
    ("dim_organizations", "organization_created_date", "Day the organisation was registered"),
    ("fct_daily_financial_snapshot", None, "One row per organisation and day with its running balance"),
    ("fct_daily_financial_snapshot", "snapshot_date", "Day of the balance"),
    ("fct_daily_financial_snapshot", "organization_id", "Organisation key"),
    ("fct_daily_financial_snapshot", "daily_net_change_usd", "Net USD movement of the day, 0 on quiet days"),
    ("fct_daily_financial_snapshot", "cumulative_net_financial_balance_usd", "USD balance at the end of the day"),
    ("latest_snapshot_date", None, "The latest day of the snapshot, one row"),
)


def _descriptions() -> str:
    text = lambda x: "NULL" if x is None else f"'{x}'"
    rows = ", ".join(f"({text(t)}, {text(c)}, {text(d)})" for t, c, d in DESCRIPTIONS)
    return f"SELECT * FROM (VALUES {rows}) AS d(table_name, column_name, comment)"


def _rejects() -> str:
    """A row per column and reason for which staging gives NULL."""
    rows = []

    def row(column: str, reason: str, condition: str) -> None:
        rows.append(f"""SELECT '{column.lower()}' AS column_name, '{reason}' AS reason,
            CAST(COUNT(*) FILTER (WHERE {condition}) AS BIGINT) AS rejected_rows FROM raw_invoices""")

    for column, digits, currency in (
        ("AMOUNT", "38,2", None), ("PAYMENT_AMOUNT", "38,2", None),
        ("FX_RATE", "13,8", "CURRENCY"), ("FX_RATE_PAYMENT", "13,8", "PAYMENT_CURRENCY"),
    ):
        lost = f'"{column}" IS NOT NULL AND TRY_CAST("{column}" AS DECIMAL({digits})) IS NULL'
        row(column, "malformed", f'{lost} AND TRY_CAST("{column}" AS DOUBLE) IS NULL')
        row(column, "out_of_range", f'{lost} AND TRY_CAST("{column}" AS DOUBLE) IS NOT NULL')
        if currency:
            row(column, "zero_rate", f""""{currency}" <> 'USD' AND TRY_CAST("{column}" AS DECIMAL({digits})) = 0""")
            row(column, "missing_rate", f""""{currency}" <> 'USD' AND "{column}" IS NULL""")
            row(currency, "missing_currency", f'"{currency}" IS NULL')
    return " " + " UNION ALL ".join(rows)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def oracle_sql() -> dict[str, str]:
    invoices = _with(RAW_INVOICES, STAGED)
    orgs = _with(RAW_ORGANIZATIONS, ORGANIZATIONS)
    at = lambda part: part.replace("{as_of}", AS_OF)
    moves = invoices + "," + at(MOVES)
    snapshot = moves + "," + at(SNAPSHOT)
    pairs = snapshot + "," + PAIRS
    changes = pairs + "," + CHANGES
    everything = snapshot + "," + RAW_ORGANIZATIONS + "," + ORGANIZATIONS

    def check(check_id: str, table: str, column: str, failures: str) -> str:
        return (
            f"SELECT '{check_id}' AS check_id, '{table}' AS table_name, "
            f"'{column}' AS column_name, f AS failures, f = 0 AS passed "
            f"FROM (SELECT CAST(({failures}) AS BIGINT) AS f)"
        )

    def nulls(check_id: str, table: str, source: str, column: str) -> str:
        return check(check_id, table, column, f"SELECT COUNT(*) - COUNT({column}) FROM {source}")

    def repeats(check_id: str, table: str, source: str, keys: str) -> str:
        strict = f"WHERE {keys} IS NOT NULL" if "," not in keys else ""
        return check(
            check_id, table, keys,
            f"SELECT COUNT(*) FROM (SELECT {keys} FROM {source} {strict} "
            f"GROUP BY {keys} HAVING COUNT(*) > 1)",
        )

    def orphans(check_id: str, table: str, source: str) -> str:
        return check(
            check_id, table, "organization_id",
            f"SELECT COUNT(*) FROM {source} WHERE organization_id NOT IN "
            "(SELECT organization_id FROM organizations) AND organization_id IS NOT NULL",
        )

    fact = "fct_daily_financial_snapshot"
    balance = "cumulative_net_financial_balance_usd"
    not_null = [
        nulls("Q02", "stg_organizations", "organizations", "organization_id"),
        nulls("Q03", "stg_organizations", "organizations", "legal_entity_country_code"),
        nulls("Q04", "stg_organizations", "organizations", "organization_created_date"),
        nulls("Q06", "stg_invoices", "invoices", "invoice_id"),
        nulls("Q07", "stg_invoices", "invoices", "organization_id"),
        nulls("Q08", "stg_invoices", "invoices", "status"),
        nulls("Q10", "stg_invoices", "invoices", "created_date"),
        nulls("Q12", "dim_organizations", "organizations", "organization_id"),
        nulls("Q13", "dim_organizations", "organizations", "organization_created_date"),
        nulls("Q14", fact, "snapshot", "snapshot_date"),
        nulls("Q16", fact, "snapshot", "organization_id"),
        nulls("Q17", fact, "snapshot", "daily_net_change_usd"),
        nulls("Q18", fact, "snapshot", balance),
    ]
    unique = [
        repeats("Q01", "stg_organizations", "organizations", "organization_id"),
        repeats("Q05", "stg_invoices", "invoices", "invoice_id"),
        repeats("Q11", "dim_organizations", "organizations", "organization_id"),
    ]
    domain = [check(
        "Q09", "stg_invoices", "status",
        "SELECT COUNT(DISTINCT status) FROM invoices WHERE status NOT IN ('paid', 'open', "
        "'skipped', 'cancelled', 'pending', 'credited', 'processing', 'failed', 'refunded', "
        "'unpayable', 'awaiting_payment')",
    )]
    grain = [repeats("Q15", fact, "snapshot", "snapshot_date, organization_id")]
    fallen = f"""SELECT snapshot_date, organization_id, daily_net_change_usd,
               previous_day_balance, {balance}
        FROM (SELECT *, COALESCE(LAG({balance}) OVER (
                PARTITION BY organization_id ORDER BY snapshot_date),
                CAST(0 AS DECIMAL(38,8))) AS previous_day_balance FROM snapshot)
        WHERE daily_net_change_usd >= 0 AND {balance} < previous_day_balance"""
    paid_gap = """SELECT invoice_id, organization_id, status, payment_amount_usd
        FROM invoices WHERE status = 'paid' AND payment_amount_usd IS NULL"""
    negative_gap = """SELECT invoice_id, organization_id, status, amount_usd
        FROM invoices WHERE status IN ('credited', 'refunded') AND amount_usd IS NULL"""
    rows = [
        check("Q19", "stg_invoices", "payment_amount_usd", f"SELECT COUNT(*) FROM ({paid_gap})"),
        check("Q20", "stg_invoices", "amount_usd", f"SELECT COUNT(*) FROM ({negative_gap})"),
        check("Q21", fact, balance, f"SELECT COUNT(*) FROM ({fallen})"),
    ]
    parents = [orphans("Q22", "stg_invoices", "invoices"), orphans("Q23", fact, "snapshot")]
    union = lambda checks: everything + " UNION ALL ".join(checks)

    pct = _unscale("p")
    size = "(ABS(n - o) * 10000)"
    shown_pct = f"""({size} // ABS(o) + CASE
        WHEN 2 * ({size} % ABS(o)) > ABS(o)
          OR (2 * ({size} % ABS(o)) = ABS(o) AND ({size} // ABS(o)) % 2 = 1)
        THEN 1 ELSE 0 END)"""
    shown_alerts = f""" SELECT organization_id, snapshot_date, previous_day_balance,
          current_balance, {pct} AS pct_change, o = 0 AS from_zero,
          {_money_text("o")} AS previous_display, {_money_text("n")} AS current_display,
          CASE WHEN o = 0 THEN 'N/A (From Zero)' ELSE
            (CASE WHEN p < 0 THEN '-' ELSE '+' END || CAST({shown_pct} // 100 AS VARCHAR)
             || '.' || LPAD(CAST({shown_pct} % 100 AS VARCHAR), 2, '0') || '%')
          END AS change_display
        FROM changes WHERE {_ALERT}"""
    alerts = changes + shown_alerts
    history = snapshot + "," + ALL_PAIRS + "," + CHANGES + shown_alerts
    suite = union(not_null + unique + domain + grain + rows + parents)
    return {
        "scan_invoices": _with(RAW_INVOICES) + " SELECT * FROM raw_invoices",
        "scan_organizations": _with(RAW_ORGANIZATIONS) + " SELECT * FROM raw_organizations",
        "ingest_invoices_csv": _with(RAW_INVOICES) + " SELECT * FROM raw_invoices",
        "ingest_good_records": _with(RAW_INVOICES) + """ SELECT * FROM raw_invoices WHERE "INVOICE_ID" % 113 <> 0
            AND "INVOICE_ID" % 127 <> 0 AND "INVOICE_ID" % 131 <> 0""",
        "ingest_quarantine": _with(RAW_INVOICES) + """ SELECT CAST("INVOICE_ID" AS VARCHAR) AS invoice_id,
            CASE WHEN "INVOICE_ID" % 113 = 0 THEN 'malformed record'
                 WHEN "INVOICE_ID" % 127 = 0 AND "INVOICE_ID" % 131 = 0 THEN 'invalid PARENT_INVOICE_ID, CREATED_AT'
                 WHEN "INVOICE_ID" % 127 = 0 THEN 'invalid CREATED_AT' ELSE 'invalid PARENT_INVOICE_ID' END AS reason
            FROM raw_invoices WHERE "INVOICE_ID" % 113 = 0 OR "INVOICE_ID" % 127 = 0 OR "INVOICE_ID" % 131 = 0""",
        "stg_invoices": invoices + " SELECT * FROM invoices",
        "safe_cast_amounts": invoices
        + " SELECT invoice_id, amount, payment_amount, fx_rate, fx_rate_payment FROM invoices",
        "amount_usd": invoices + " SELECT invoice_id, currency, amount_usd FROM invoices",
        "payment_amount_usd": invoices
        + " SELECT invoice_id, payment_currency, payment_amount_usd FROM invoices",
        "stg_organizations": orgs + " SELECT * FROM organizations",
        "dim_organizations": orgs
        + " SELECT * EXCLUDE (created_date_timestamp) FROM organizations",
        "relevant_invoices": invoices + """ SELECT * FROM invoices
            WHERE CASE status WHEN 'paid' THEN payment_amount_usd
                  WHEN 'credited' THEN amount_usd WHEN 'refunded' THEN amount_usd END
                  IS NOT NULL""",
        "signed_contributions": moves + """ SELECT organization_id, created_date, status,
            delta AS daily_amount_change_usd FROM signed""",
        "global_min_invoice_date": moves + " SELECT day AS global_min_invoice_date FROM opening",
        "daily_net_aggregates": moves + """ SELECT organization_id, day AS transaction_date,
            net AS daily_net_change_usd FROM moves""",
        "organization_first_transaction_date": snapshot
        + " SELECT organization_id, first_day AS first_transaction_date FROM series",
        "date_spine": moves + f""" SELECT CAST(UNNEST(GENERATE_SERIES(day,
            {AS_OF} - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date_day FROM opening""",
        "organization_daily_scaffold": snapshot
        + " SELECT snapshot_date, organization_id FROM calendar",
        "daily_net_filled": snapshot + " SELECT * FROM filled",
        fact: snapshot + " SELECT * FROM snapshot",
        "fct_snapshot_by_scaffold": snapshot + " SELECT * FROM snapshot",
        "incremental_snapshot": snapshot + " SELECT * FROM snapshot",
        "latest_snapshot_date": snapshot
        + " SELECT MAX(snapshot_date) AS latest_snapshot_date FROM snapshot",
        "balance_day_pairs": pairs + " SELECT * FROM pairs",
        "balance_pct_change": changes + f""" SELECT snapshot_date, organization_id,
            current_balance, previous_day_balance, {pct} AS pct_change FROM changes""",
        "balance_change_alerts": alerts,
        "stored_snapshot_alerts": alerts,
        "sql_over_views": moves + "," + RAW_ORGANIZATIONS + "," + ORGANIZATIONS + """
            SELECT o.legal_entity_country_code, CAST(COUNT(*) AS BIGINT) AS paid_invoices,
                   CAST(SUM(payment_amount_usd) AS DECIMAL(38,8)) AS paid_usd, MIN(i.created_date) AS first_paid
            FROM invoices i JOIN organizations o USING (organization_id)
            WHERE i.status = 'paid' AND i.created_date >= (SELECT day FROM opening) GROUP BY o.legal_entity_country_code""",
        "numbered_alert_report": f"""SELECT row_number() OVER (ORDER BY organization_id NULLS LAST) AS row_number, *
            FROM ({alerts})""",
        "stored_descriptions": _descriptions(),
        "balance_alert_history": history,
        "segment_store_alerts": alerts,
        "segment_store_days": snapshot + """ SELECT * FROM snapshot
            WHERE snapshot_date BETWEEN DATE '2000-11-20' AND DATE '2001-01-19'""",
        "rejected_values": _with(RAW_INVOICES) + _rejects(),
        "alert_summary": changes + f""" SELECT MAX(snapshot_date) AS snapshot_date,
            CAST(COUNT(*) AS BIGINT) AS organizations_processed,
            CAST(COUNT(*) FILTER (WHERE {_ALERT}) AS BIGINT) AS alerts_raised FROM changes""",
        "dq_not_null": union(not_null),
        "dq_unique": union(unique),
        "dq_accepted_values": union(domain),
        "dq_unique_combination": union(grain),
        "dq_paid_missing_usd": invoices + paid_gap,
        "dq_negative_missing_usd": invoices + negative_gap,
        "dq_balance_consistency": snapshot + fallen,
        "dq_relationships": union(parents),
        "dq_stored_suite": suite,
        "dq_folder_suite": suite,
        "dq_suite": suite,
    }
