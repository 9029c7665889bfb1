"""Exact deduplication by distributed MSD radix partitioning.

Texts are equal if they are identical without their ASCII white space. Level by
level, every group of texts is split by its next bytes: a digit is first 64 bytes
wide and eight times as wide at each further level, up to 1 MiB. A group of one
row, or one whose texts have all ended, is finished; the others go on with the
rest of their bytes. Equality is decided on the bytes themselves, never on a
digest, and only texts that still share their prefix are read again.

Scale: the row side of each join may have a hot key (a third of all rows can be
copies of one text); the group side is written first, so both sides are plain
exchanges and adaptive execution can split the hot partition. The join is a merge
join at every size, as the groups grow with the documents. Groups are counted
map-side. No group is ever gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.rows import carried
from ledgerfold.sources.workspace import remove, shared_folder, written

FIRST_DIGIT, GROWTH, WIDEST_DIGIT = 64, 8, 1 << 20


def normalised(text: Column) -> Column:
    """The text without ASCII white space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def exact_dedup(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: its group of equal texts and whether it stays.

    Columns: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` (of
    the normalised text) and ``row``, a struct of the columns named in ``carry``.

    Of equal texts, the row with the most code points in the original text stays,
    then the one with the smallest doc_id. A missing doc_id counts as larger than
    any other; of rows that repeat both, exactly one stays. NULL, empty and blank
    texts are one group. An empty table gives no rows. Other columns of ``docs``
    are not read, whatever their names.
    """
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    text, plain = F.col("text"), normalised(F.col("text"))
    state = docs.select(
        "doc_id",
        F.length(F.coalesce(text, F.lit(""))).alias("n"),
        F.sha2(plain, 256).alias("text_sha256"),
        carried(carry).alias("row"),
        F.lit(0).cast("long").alias("group"),
        plain.cast("binary").alias("rest"),
    )
    done, level, width, previous = [], 1, FIRST_DIGIT, None
    while True:
        path = f"{folder}/level-{level}"
        table = written(_split(state, width, level, f"{folder}/groups-{level}"), path, "open")
        if previous:
            remove(spark, f"{previous}/open=true")
        done.append(table.where("not open"))
        state = table.where("open").drop("open", "size", "best")
        if state.isEmpty():
            break
        previous, level, width = path, level + 1, min(width * GROWTH, WIDEST_DIGIT)
    alone = F.col("best").isNull()
    return reduce(DataFrame.unionByName, done).select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("uid") == F.col("best.uid"))).alias("kept"),
        "text_sha256",
        "row",
    )


def _split(state: DataFrame, width: int, level: int, groups_path: str) -> DataFrame:
    """The rows of ``state`` after one more digit; ``open`` where a group goes on.

    The first level gives every row its number as it is written. Its groups all go
    on, as the row that stays is chosen with these numbers.
    """
    digits = state.withColumns({
        "digit": F.substring("rest", 1, width),
        "ended": F.octet_length("rest") <= width,
        "rest": F.expr(f"substring(rest, {width + 1})"),
    })
    keys = ["group", "digit", "ended"]
    if level == 1:
        choice = F.struct(
            F.lit(0).alias("less"), F.lit(True).alias("nameless"),
            F.lit(None).cast(state.schema["doc_id"].dataType).alias("doc_id"),
            F.lit(0).cast("long").alias("uid"),
        )
        counted = digits.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
        counted = counted.withColumn("best", choice)
    else:
        choice = F.struct(
            (-F.col("n")).alias("less"), F.col("doc_id").isNull().alias("nameless"), "doc_id", "uid"
        )
        counted = digits.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("size"), F.min(choice).alias("best")
        )
    groups = written(
        counted.where("size > 1").withColumn("next", F.monotonically_increasing_id()), groups_path
    )
    goes_on = F.col("next").isNotNull() & (F.lit(level == 1) | ~F.col("ended"))
    joined = digits.join(groups.hint("merge"), keys, "left")
    return joined.select(
        (F.monotonically_increasing_id() if level == 1 else F.col("uid")).alias("uid"),
        "doc_id", "n", "text_sha256", "row", F.col("next").alias("group"),
        F.when(goes_on, F.col("rest")).alias("rest"),
        "size", "best", goes_on.alias("open"),
    )
