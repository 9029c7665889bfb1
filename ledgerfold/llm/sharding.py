"""Sharding with a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in its own order, a
permutation made from two hashes of its name. Shards take turns, each claiming the
first slot of its order that is still free, until the table is full. So shards own
nearly equal numbers of slots, and a shard that comes or goes moves little else.
A document's slot is its hash modulo the table size; the table is broadcast, its
size a parameter, and gives the shard at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.rows import free_name

TABLE_SIZE = 65537


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> np.ndarray:
    """For every slot the number of the shard that owns it; ``size`` must be prime."""
    if not 1 <= len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError(f"need 1 to {size} different shards, not {len(shards)}")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table size must be prime, not {size}")
    offset = [xxhash.xxh64_intdigest(s, 1) % size for s in shards]
    skip = [xxhash.xxh64_intdigest(s, 2) % (size - 1) + 1 for s in shards]
    owner, at = np.full(size, -1, np.int32), list(offset)
    claimed = 0
    while True:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % size
            owner[at[shard]] = shard
            claimed += 1
            if claimed == size:
                return owner


def slot(doc_id: Column, text: Column, size: int = TABLE_SIZE) -> Column:
    """A document's slot, from its doc_id; from its text where that is missing."""
    key = F.coalesce(F.xxhash64(F.when(doc_id.isNotNull(), doc_id)), F.lit(0))
    return F.pmod(
        F.when(doc_id.isNull(), F.xxhash64(F.coalesce(text, F.lit("")))).otherwise(key), F.lit(size)
    ).cast("int")


def place(docs: DataFrame, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """doc_id, slot and shard of every row of ``docs``, without a shuffle.

    A row without doc_id goes by its text, without both by the empty text. Rows that
    repeat a doc_id go to one shard. Other columns are not read, whatever their names.
    """
    return _placed(docs.select("doc_id", slot(F.col("doc_id"), F.col("text"), size).alias("slot")), shards, size)


def _placed(rows: DataFrame, shards: Sequence[str], size: int) -> DataFrame:
    owner = lookup_table(shards, size)
    table = rows.sparkSession.createDataFrame(
        [(i, shards[int(s)]) for i, s in enumerate(owner)], "slot int, shard string"
    )
    return rows.join(F.broadcast(table), "slot").select(
        *[c for c in rows.columns if c != "slot"], "slot", "shard"
    )


def write_shards(docs: DataFrame, shards: Sequence[str], path: str, size: int = TABLE_SIZE) -> None:
    """Write ``docs`` with all their columns, one folder per shard.

    The folder name holds the shard; a column of that name in ``docs`` stays, as the
    folder column is called ``shard_``, with more underscores where that is taken too.
    """
    folder = free_name(docs.columns, "shard_")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        slot(F.col("doc_id"), F.col("text"), size).alias("slot"),
    )
    placed = _placed(rows, shards, size)
    placed.select("row.*", F.col("shard").alias(folder)).write.partitionBy(folder).parquet(path)
