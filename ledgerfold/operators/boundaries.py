"""Checks of a snapshot that shuffle and sort summaries of its rows instead of the rows.

Neighbouring days of an organisation are summed up as one run: its first and last day and
balance, and the failures inside. Runs are put in order per organisation, and only where
one ends and the next begins is there anything left to compare. Where the runs of an
organisation overlap, or have a day twice or none, its rows are checked one by one.

``stretches`` makes runs by a hash aggregation, in any order of the rows: one for each
balance in 64 days, whose days are the bits of a number. ``runs`` makes them without an
aggregation, of rows that lie together, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = ("organization_id", "snapshot_date", "daily_net_change_usd", "cumulative_net_financial_balance_usd")


def _chunk_and_bit() -> tuple[Column, Column]:
    """The number of the 64 days in which a day lies, and its bit in them."""
    day = F.unix_date("snapshot_date")
    return F.shiftright(day, 6), F.call_function("shiftleft", F.lit(1).cast("long"), day.bitwiseAND(F.lit(63)))


def _short(balance: T.DataType) -> T.DataType:
    """The type of balances that fit a 64-bit number; that of others if they are no decimals."""
    if not isinstance(balance, T.DecimalType):
        return balance
    return T.DecimalType(max(18, balance.scale), balance.scale)


def stretches(snapshot: DataFrame) -> DataFrame:
    """The runs of rows with one balance inside 64 days, in the columns of ``runs``.

    Rows are counted per (organisation, 64 days, balance, whether the change is not
    negative), which is map-side and needs no order. Neighbouring bits are a run; inside
    it the balance cannot fall. A day that such a group has twice leaves it without days.
    A balance is a key of two parts, of which the first, a plain number, holds most.
    """
    chunk, bit = _chunk_and_bit()
    key, day, change, balance = COLUMNS
    kind = snapshot.schema[balance].dataType
    short = F.col(balance).try_cast(_short(kind))
    groups = (
        snapshot.select(
            key, day, F.coalesce(F.col(change) >= 0, F.lit(False)).alias("rises"),
            short.alias("short"), F.when(short.isNull(), F.col(balance)).alias("long"),
            F.col(change).isNull().alias("unknown"), chunk.alias("chunk"), bit.alias("bit"),
        )
        .groupBy(key, "chunk", "rises", "short", "long")
        .agg(
            F.bit_or("bit").alias("bits"), F.min(day).alias("first"), F.count(F.lit(1)).alias("rows"),
            F.count_if("unknown").alias("unknown"),
        )
        .withColumn("balance", F.coalesce(F.col("short").cast(kind), F.col("long")))
    )
    bits, first, days = F.col("bits"), F.unix_date("first"), F.bit_count("bits")
    begins = bits.bitwiseAND(F.bitwise_not(F.shiftleft(bits, 1)))
    ends = bits.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(bits, 1)))

    def places(mask: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.bit_get(mask, i) == 1)

    def run(begin: Column, end: Column) -> Column:
        return F.struct(begin.alias("begin"), end.alias("end"))

    base = F.col("chunk") * 64
    found = F.when(F.bit_count(begins) == 1, F.array(run(first, first + days - 1))).otherwise(
        F.zip_with(places(begins), places(ends), lambda b, e: run(base + b, base + e))
    )
    single, rows = days == F.col("rows"), F.col("rows")
    # What the group counts stands at its first run.
    here = F.col("run.begin").eqNullSafe(first)

    def counted(count: Column) -> Column:
        return F.when(here, count).otherwise(F.lit(0).cast("long"))

    nulls = [F.col(key).isNull(), F.col("first").isNull(), None, F.col("balance").isNull()]
    return groups.select("*", F.explode_outer(found).alias("run")).select(
        key,
        F.when(single, F.date_from_unix_date("run.begin")).alias("first_day"),
        F.when(single, F.date_from_unix_date("run.end")).alias("last_day"),
        "rises", F.col("balance").alias("first_balance"), F.col("balance").alias("last_balance"),
        F.lit(0).cast("long").alias("falls"), counted(rows).alias("rows"),
        *[
            (counted(F.col("unknown")) if null is None else counted(F.when(null, rows).otherwise(F.lit(0).cast("long"))))
            .alias(f"no_{c}") for c, null in zip(COLUMNS, nulls)
        ],
    )


def suspects(snapshot: DataFrame) -> DataFrame:
    """The organisations with a fall, or with rows that only a check row by row can judge."""
    return joined(stretches(snapshot)).where(F.col("torn") | (F.col("falls") > 0)).select("organization_id")


def repeating(snapshot: DataFrame) -> DataFrame:
    """The organisations with a day, or rows without one, more than once."""
    chunk, bit = _chunk_and_bit()
    groups = snapshot.select("organization_id", chunk.alias("chunk"), bit.alias("bit")).groupBy("organization_id", "chunk")
    days = groups.agg(F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("rows"))
    twice = F.col("rows") > F.coalesce(F.bit_count("bits"), F.lit(1))
    return days.where(twice).select("organization_id").distinct()


def runs(snapshot: DataFrame) -> DataFrame:
    """The runs of the rows, without a shuffle.

    Columns: organization_id, first_day and last_day (NULL for rows without a day),
    rises (the first change is not negative), first_balance, last_balance, falls (days
    inside whose balance fell although their change is not negative), rows, and for
    each column the number of NULLs, ``no_<column>``.
    """
    organization = snapshot.schema["organization_id"].dataType.simpleString()
    counts = ", ".join(f"no_{c} long" for c in COLUMNS)
    return snapshot.select(*COLUMNS).mapInArrow(
        _runs,
        f"organization_id {organization}, first_day date, last_day date, rises boolean, first_balance decimal(38,8), "
        f"last_balance decimal(38,8), falls long, rows long, {counts}",
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        organization = batch.column(0).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        dated = _known(batch.column(1))
        day = batch.column(1).cast(pa.int32()).fill_null(0).to_numpy().astype(np.int64)
        order = np.lexsort((day, dated, organization))
        rows = batch.take(pa.array(order))
        organization, day, dated = organization[order], day[order], dated[order]
        same = (organization[1:] == organization[:-1]) & (day[1:] == day[:-1] + 1) & dated[1:] & dated[:-1]
        high, low = _halves(rows.column(3))
        rises = _known(rows.column(2)) & (_halves(rows.column(2))[0] >= 0)
        less = (high[1:] < high[:-1]) | ((high[1:] == high[:-1]) & (low[1:] < low[:-1]))
        comparable = _known(rows.column(3))
        fell = np.concatenate([[False], same & rises[1:] & less & comparable[1:] & comparable[:-1]])
        starts = np.concatenate([[0], np.flatnonzero(~same) + 1])
        ends = np.concatenate([starts[1:], [len(batch)]]) - 1
        first, last = rows.take(pa.array(starts)), rows.take(pa.array(ends))

        def total(flags):
            return pa.array(np.add.reduceat(flags.astype(np.int64), starts))

        arrays = [
            first.column(0), first.column(1), last.column(1), pa.array(rises[starts]), first.column(3), last.column(3),
            total(fell), pa.array(ends - starts + 1), *[total(~_known(rows.column(i))) for i in range(len(COLUMNS))],
        ]
        names = ["organization_id", "first_day", "last_day", "rises", "first_balance", "last_balance", "falls", "rows"]
        yield pa.RecordBatch.from_arrays(arrays, names=[*names, *(f"no_{c}" for c in COLUMNS)])


def _known(column: pa.Array) -> np.ndarray:
    return column.is_valid().to_numpy(zero_copy_only=False)


def _halves(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The upper, signed and the lower 64 bits of decimals; anything for a NULL."""
    words = np.frombuffer(column.buffers()[1], "<i8").reshape(-1, 2)[column.offset:column.offset + len(column)]
    return words[:, 1], words[:, 0].astype(np.uint64)


def joined(found: DataFrame) -> DataFrame:
    """One row per organisation: what its runs count, with the days on which a run begins.

    ``torn`` tells that the runs do not follow each other, so that ``falls`` is not
    to be relied on.
    """
    in_order = Window.partitionBy("organization_id").orderBy("first_day", "last_day")
    before = F.lag("last_balance", 1, Decimal(0)).over(in_order)
    fell = F.coalesce(F.col("rises") & (F.col("first_balance") < before), F.lit(False))
    torn = F.col("first_day").isNull() | (F.lag("last_day").over(in_order) >= F.col("first_day"))
    counts = ["rows", *(f"no_{c}" for c in COLUMNS)]
    return found.withColumns({"fell": fell, "torn": F.coalesce(torn, F.lit(False))}).groupBy("organization_id").agg(
        F.sum(F.col("falls") + F.col("fell").cast("long")).alias("falls"),
        F.bool_or("torn").alias("torn"),
        *[F.sum(c).alias(c) for c in counts],
    )


def rows_of(snapshot: DataFrame, organizations: DataFrame) -> DataFrame:
    """The rows of some organisations, a missing one included."""
    wanted = organizations.select(F.struct("organization_id").alias("_wanted"))
    return snapshot.join(wanted, F.struct("organization_id").eqNullSafe(F.col("_wanted")), "left_semi")
