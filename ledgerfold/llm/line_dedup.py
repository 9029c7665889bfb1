"""Line deduplication by overlapping three-line windows. DataFrame functions only.

Every window of three consecutive lines is hashed (128 bits). Windows that occur
more than once keep their first occurrence; every later one covers its three lines,
and the covered positions of a document are merged and removed. A removed line
always has an equal line earlier that stays.

Windows are counted map-side and joined back from a written table, so that a
passage that a third of all documents share is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.sources.workspace import shared_folder, written

WINDOW = 3


def lines(text: Column) -> Column:
    """The lines of a text; NULL counts as empty."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _identity(text: Column) -> Column:
    """Tells rows apart that share a doc_id."""
    return F.xxhash64(F.lit(3), F.coalesce(text, F.lit("")))


def windows(docs: DataFrame) -> DataFrame:
    """A row per window: doc_id, twin, line (from 0) and its hash h1, h2."""
    hashed = docs.select(
        "doc_id",
        _identity(F.col("text")).alias("twin"),
        lines(F.col("text")).alias("lines"),
    ).select(
        "doc_id", "twin",
        F.transform("lines", lambda x: F.xxhash64(F.lit(1), x)).alias("one"),
        F.transform("lines", lambda x: F.xxhash64(F.lit(2), x)).alias("two"),
    )
    many = F.greatest(F.size("one") - WINDOW + 1, F.lit(0))
    first, second = [[f"{hashes}{i}" for i in range(WINDOW)] for hashes in ("one", "two")]
    shifted = hashed.select("doc_id", "twin", *[
        F.slice(name[:-1], int(name[-1]) + 1, many).alias(name) for name in (*first, *second)
    ])
    return shifted.select(
        "doc_id", "twin", F.posexplode(F.arrays_zip(*first, *second)).alias("line", "w")
    ).select(
        "doc_id", "twin", "line",
        F.xxhash64(F.lit(1), *[f"w.{x}" for x in first]).alias("h1"),
        F.xxhash64(F.lit(2), *[f"w.{x}" for x in second]).alias("h2"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, text (what stays).

    Occurrences are ordered by doc_id (missing ones last) and line. Texts of fewer
    than three lines stay as they are; NULL comes out empty, as one line. Rows
    that repeat both doc_id and text are one document and come out alike; rows that
    share only the doc_id are told apart. An empty table gives no rows. Other
    columns of ``docs`` are not read, whatever their names.
    """
    folder = shared_folder(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    found = written(windows(docs), f"{folder}/windows")
    at = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "twin", "line")
    repeated = written(
        found.groupBy("h1", "h2")
        .agg(F.min(at).alias("first"), F.max(at).alias("last"))
        .where("first != last"),
        f"{folder}/repeated",
    ).drop("last")
    later = written(
        found.join(repeated, ["h1", "h2"]).where(at != F.col("first")).select("doc_id", "twin", "line"),
        f"{folder}/later",
    )
    covered = later.distinct().groupBy("doc_id", "twin").agg(F.collect_list("line").alias("starts"))
    covered = covered.select(
        F.col("doc_id").alias("covered_id"), F.col("twin").alias("covered_twin"),
        F.flatten(F.transform("starts", lambda i: F.sequence(i, i + WINDOW - 1))).alias("gone"),
    )
    split = docs.select("doc_id", _identity(F.col("text")).alias("twin"), lines(F.col("text")).alias("lines"))
    joined = split.join(
        covered, F.col("doc_id").eqNullSafe(F.col("covered_id")) & (F.col("twin") == F.col("covered_twin")),
        "left",
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(
        F.transform(stay, lambda i: F.col("lines")[i])
    )
    return joined.select(
        "doc_id",
        F.size("lines").alias("n_lines"),
        F.coalesce(F.size(F.array_distinct("gone")), F.lit(0)).alias("n_removed"),
        F.array_join(kept, "\n").alias("text"),
    )
