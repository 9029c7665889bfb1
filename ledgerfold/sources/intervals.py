"""The snapshot stored as segments: one row for each stretch of days with one balance.

Rows lie in folders by the month in which their stretch ends, and in the order in which
they begin. Days are made when they are asked for: a range of days becomes a test for
overlap, so that months which end before it are not opened, and row groups that begin
after it are skipped.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.operators.segments import balance_segments, expand_days

CLOSED = "closed_month"


def write_segments(days: DataFrame, as_of: date, path: str, spine_scope: str = "paid") -> DataFrame:
    """Replace the stored segments of the activity ``days``; returns them.

    Every series ends with a segment that is open, so the last month holds a row for
    each organisation. Spark cuts large months into several files and joins small ones.
    """
    segments = balance_segments(days, as_of, spine_scope).withColumn(CLOSED, F.trunc("valid_to", "MM"))
    files = segments.hint("rebalance", CLOSED).sortWithinPartitions(CLOSED, "valid_from", "organization_id")
    writer = files.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(CLOSED).parquet(path)
    return days.sparkSession.read.schema(segments.schema).parquet(path)


def overlapping(segments: DataFrame, first: Column, last: Column) -> DataFrame:
    """The stored segments with a day from ``first`` to ``last``, dates known before the scan."""
    return segments.where(
        (F.col(CLOSED) >= F.trunc(first, "MM")) & (F.col("valid_to") >= first) & (F.col("valid_from") <= last)
    )


def snapshot_days(segments: DataFrame, first: date | Column, last: date | Column) -> DataFrame:
    """The snapshot from ``first`` to ``last``, both included."""
    lower, upper = (x if isinstance(x, Column) else F.lit(x) for x in (first, last))
    return expand_days(overlapping(segments, lower, upper), lower, last=upper)


def latest_day(segments: DataFrame) -> DataFrame:
    """One row: the latest day, NULL without segments. Only the last month is opened."""
    month = segments.agg(F.max(CLOSED)).scalar()
    return segments.where(F.col(CLOSED) == month).agg(F.max("valid_to").alias("latest_snapshot_date"))


def register_days(spark: SparkSession, segments: DataFrame, view: str, function: str) -> None:
    """Make the segments a view, and the days of a range a table function of SQL.

    ``SELECT * FROM <function>(DATE '2024-01-01', DATE '2024-01-31')``
    """
    segments.createOrReplaceTempView(view)
    organization = segments.schema["organization_id"].dataType.simpleString()
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {function}(first_day DATE, last_day DATE)
        RETURNS TABLE (snapshot_date DATE, organization_id {organization}, daily_net_change_usd DECIMAL(38,8),
                       cumulative_net_financial_balance_usd DECIMAL(38,8))
        RETURN SELECT day, organization_id, if(day = valid_from, net_change_usd, CAST(0 AS DECIMAL(38,8))), balance_usd
               FROM (SELECT *, explode(sequence(greatest(valid_from, first_day), least(valid_to, last_day))) AS day
                     FROM {view} WHERE {CLOSED} >= trunc(first_day, 'MM') AND valid_to >= first_day
                     AND valid_from <= last_day)""")
