"""Raw invoice and organisation tables, from parquet or CSV."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.schemas import RAW_INVOICES, RAW_ORGANIZATIONS
from ledgerfold.sources.workspace import exists

LOADS, MANIFEST = "loads", "manifest"
_LISTED = "path string, length long, modified timestamp"
_MANIFEST = f"{_LISTED}, load string"
_QUARANTINE = T.StructType([T.StructField(c, T.StringType()) for c in ("file", "record", "reason")])


def read_invoices(spark: SparkSession, path: str) -> DataFrame:
    """Scan raw invoices stored as parquet."""
    return spark.read.schema(RAW_INVOICES).parquet(path)


def read_organizations(spark: SparkSession, path: str) -> DataFrame:
    """Scan raw organisations stored as parquet."""
    return spark.read.schema(RAW_ORGANIZATIONS).parquet(path)


def read_table(spark: SparkSession, place: str, schema: T.StructType) -> DataFrame:
    """A raw table by its path, or by its name in the catalog, ``database.table``."""
    if re.fullmatch(r"\w+\.\w+", place):
        return spark.table(place).select(*schema.names)
    return spark.read.schema(schema).parquet(place)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read headed CSV files as text and cast strictly to ``schema``.

    Columns are checked against the header by position, so a file with other
    columns fails rather than shifts. Keys and dates that do not parse fail
    under ANSI mode; monetary columns are text in the raw schema and pass.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        # An absent field or \N is NULL; a quoted empty field stays an empty text.
        .option("nullValue", "\\N")
        .csv(path)
    )
    return rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def ingest_csv(
    spark: SparkSession, path: str, target: str, schema: T.StructType = RAW_INVOICES
) -> DataFrame:
    """Load CSV files (a path or glob) into a parquet raw table and return its scan.

    A missing path fails before anything is written.
    """
    read_csv(spark, path, schema).write.mode("overwrite").parquet(target)
    return spark.read.schema(schema).parquet(target)


def parsed_csv(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """All records of headed CSV files, typed, with what is wrong with them.

    Beside the columns of ``schema``: file, record (its text, where it is rejected) and
    reason, NULL for a good record. A record is rejected if it has another number of
    fields, if a key or date does not parse, or if its file has another header.
    """
    text = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema), T.StructField("_record", T.StringType())])
    rows = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_record")
        .option("nullValue", "\\N")
        .csv(paths)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )
    bad = [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in schema]
    invalid = F.array_compact(F.array(*[F.when(b, F.lit(f.name)) for b, f in zip(bad, schema)]))
    reason = (
        F.when(F.col("good_header").isNull(), "other header")
        .when(F.col("_record").isNotNull(), "malformed record")
        .when(F.size(invalid) > 0, F.concat(F.lit("invalid "), F.concat_ws(", ", invalid)))
    )
    # A file is one row here, so the join is a lookup.
    headed = rows.join(_headed(spark, paths, schema), "file", "left").withColumn("reason", reason)
    whole = F.to_csv(F.struct(*schema.names))
    return headed.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema],
        "file",
        F.when(F.col("reason").isNotNull(), F.coalesce("_record", whole)).alias("record"),
        "reason",
    )


def _headed(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The files whose first line names the columns of ``schema``, from their first blocks."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    names = F.transform(F.split("header", ","), lambda x: F.lower(F.trim(F.translate(x, '"', ""))))
    expected = F.array(*[F.lit(n.lower()) for n in schema.names])
    return first.where(names == expected).select("file", F.lit(True).alias("good_header"))


def load_new_files(
    spark: SparkSession, path: str, folder: str, schema: T.StructType = RAW_INVOICES
) -> DataFrame:
    """Load the files of ``path`` that were not loaded before; the whole raw table below ``folder``.

    Bad records do not stop the load: they are set apart and can be read with
    ``read_quarantine``. A load counts once its files are in the manifest, which is
    appended in one step, so one that failed leaves no row and is done again. A file
    that changed since it was loaded is an error before anything is read.
    """
    listed = spark.read.format("binaryFile").load(path).select(
        "path", "length", F.col("modificationTime").alias("modified")
    )
    known = _manifest(spark, folder).select("path", F.struct("length", "modified").alias("was"))
    found = listed.join(known, "path", "left").where(
        F.col("was").isNull() | (F.col("was") != F.struct("length", "modified"))
    ).collect()
    changed = sorted(r.path for r in found if r.was)
    if changed:
        raise ValueError(f"changed since they were loaded: {', '.join(changed[:10])}")
    if found:
        load = uuid.uuid4().hex
        rows = parsed_csv(spark, sorted(r.path for r in found), schema)
        rows.withColumn("bad", F.col("reason").isNotNull()).write.partitionBy("bad").parquet(f"{folder}/{LOADS}/{load}")
        entries = [(r.path, r.length, r.modified, load) for r in found]
        spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/{MANIFEST}")
    return read_loaded(spark, folder, schema)


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files that were loaded, each with its load."""
    path = f"{folder}/{MANIFEST}"
    return spark.read.schema(_MANIFEST).parquet(path) if exists(spark, path) else spark.createDataFrame([], _MANIFEST)


def _loaded(spark: SparkSession, folder: str, schema: T.StructType, bad: bool) -> DataFrame:
    loads = sorted(r.load for r in _manifest(spark, folder).select("load").distinct().collect())
    paths = [p for load in loads if exists(spark, p := f"{folder}/{LOADS}/{load}/bad={str(bad).lower()}")]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_loaded(spark: SparkSession, folder: str, schema: T.StructType = RAW_INVOICES) -> DataFrame:
    """The good records of all loads below ``folder``."""
    return _loaded(spark, folder, schema, bad=False)


def read_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all loads that were set apart: file, record and reason."""
    return _loaded(spark, folder, _QUARANTINE, bad=True)
