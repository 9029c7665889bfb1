"""A Merkle manifest of documents, with the proof of every document by pointer jumping.

A leaf is the SHA-256 of a row's fields. The leaves of each language form a binary
tree, and the roots of these trees form one more. Every node starts out holding its
own sibling as a segment of length one that leads to its parent; joining the nodes
to themselves, again and again, doubles the distance of the ancestor that a segment
leads to and appends the ancestor's segment, until every leaf has reached its root.

Scale: a round joins on an exact ancestor, and only nodes whose height is a multiple
of the round's distance can be one, so the nodes left besides the leaves shrink to a
third, a fifteenth, and so on, and a tree of 2**32 leaves takes five rounds. A
language may hold most of the rows: ranks come from a range partitioning and one
count per (language, partition), an ancestor has at most 2**distance leaves, and a
root meets its leaves by runs of 2**RUN_LEVELS.
Digests travel as 32 bytes; every round is a written table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.sources.workspace import remove, shared_folder, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_LEVELS, RUN_LEVELS = 8, 14


def leaf_hash(fields: Mapping[str, Column] | Sequence[str]) -> Column:
    """SHA-256 of the fields in order, each as its byte length, a colon and its value; NULL as a dash."""
    columns = fields.values() if isinstance(fields, Mapping) else [F.col(f) for f in fields]
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def manifest(docs: DataFrame, presented: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: its leaf, both roots, and the siblings on its way up.

    ``presented`` replaces fields of the rows as somebody hands them in for
    verification; ``folded_root`` is computed from the leaf of that row and the
    siblings of the original one, and ``verified`` tells whether it is the root.

    Columns: doc_id, leaf, subroot, root, siblings (array of lowercase digests from
    the leaf's up to the root, NULL where a node had none), left (whether that sibling
    stands on the left), folded_root, verified.

    Trees are ordered by lang, a missing one first, and leaves by doc_id, a missing one
    last; of rows that repeat a doc_id, the one with the smaller leaf comes first, and
    rows that repeat both can be told apart by nothing and follow in any order. NULL,
    empty and very long fields are hashed whole. An empty table gives no rows. Other
    columns of ``docs`` are not read, whatever their names.
    """
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    own = {f: F.col(f) for f in FIELDS}
    seen = F.lit(None) if not presented else leaf_hash({**own, **presented})
    leaves = docs.select(
        # Orders by bytes with the missing language first, and is never NULL.
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
        F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id").alias("place"),
        F.unhex(leaf_hash(own)).alias("digest"),
        F.struct("doc_id", F.unhex(seen).alias("seen")).alias("carried"),
    )
    ends, roots = proofs(written(leaves, f"{folder}/leaves"), f"{folder}/leaf")
    trees = roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("place"), "digest",
        F.struct(F.col("tree").alias("name"), "size").alias("carried"),
    )
    above = _meet(*proofs(written(trees, f"{folder}/trees"), f"{folder}/root")).select(
        F.col("carried.name").alias("tree"), F.col("carried.size").alias("size"), "digest",
        F.struct("at", "segment", "root").alias("above"),
    )
    joined = _meet(ends, above).select(
        "carried.*", "at", "height", F.col("above.at").alias("root_at"), "root", F.col("above.root").alias("top"),
        "digest", F.concat("segment", "above.segment").alias("segment"),
    )
    steps = F.sequence(F.lit(0), F.size("segment") - 1)
    # Which side: the bits of the node's place in its tree, then those of its root's place.
    left = F.transform(steps, lambda i: F.when(
        i < F.col("height"), F.call_function("getbit", "at", F.least(i, F.col("height")))
    ).otherwise(F.call_function("getbit", "root_at", F.greatest(i - F.col("height"), F.lit(0)))) == 1)
    empty = F.array().cast("array<boolean>")
    shown = joined.select(
        "doc_id",
        _hex(F.col("digest")).alias("leaf"),
        _hex(F.col("root")).alias("subroot"),
        _hex(F.col("top")).alias("root"),
        F.transform("segment", _hex).alias("siblings"),
        F.when(F.size("segment") > 0, left).otherwise(empty).alias("left"),
        _hex(F.coalesce("seen", "digest")).alias("seen"),
    )
    folded = fold(F.col("seen"), F.col("siblings"), F.col("left"))
    return shown.withColumn("folded_root", folded).select(
        "doc_id", "leaf", "subroot", "root", "siblings", "left", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def fold(leaf: Column, siblings: Column, left: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    steps = F.arrays_zip(siblings.alias("digest"), left.alias("left"))

    def up(node: Column, step: Column) -> Column:
        both = F.when(step["left"], F.concat(step["digest"], node)).otherwise(F.concat(node, step["digest"]))
        return F.sha2(F.coalesce(both, node), 256)

    return F.aggregate(steps, leaf, up)


def proofs(leaves: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Every leaf with the ``segment`` that leads to its root, and the roots.

    ``leaves`` is a written table with tree (a string), place (what orders a tree's
    leaves), digest (32 bytes) and carried (anything). The leaves come back with their
    rank (``at``) and their tree's ``height``; ``segment`` holds a sibling or NULL for
    every level. Roots have tree, size (leaves) and digest. A run of one node is hashed
    alone, as long as its tree has other nodes; the only leaf of a tree is its root.
    """
    nodes, roots = _grow(_ranked(leaves, f"{folder}-order"), folder)
    highest = roots.agg(F.max("height")).first()[0] or 0
    done, state, distance = [nodes.where("done")], nodes.where("not done"), 1
    while distance < highest:
        table = written(_jump(state, distance), f"{folder}-jump-{distance}", "done")
        if distance > 1:
            remove(leaves.sparkSession, f"{folder}-jump-{distance // 2}/done=false")
        done.append(table.where("done"))
        state, distance = table.where("not done"), 2 * distance
    return reduce(DataFrame.unionByName, done).drop("done", "level"), roots.drop("height")


def _meet(ends: DataFrame, roots: DataFrame) -> DataFrame:
    """The leaves with their root's digest as ``root`` and its other columns.

    A tree may have most of the leaves, so its root is given to each of its runs of
    2**RUN_LEVELS leaves, and the join is on the run.
    """
    last = F.call_function("shiftright", F.col("size") - 1, F.lit(RUN_LEVELS))
    by_run = roots.withColumnRenamed("digest", "root").withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    runs = ends.withColumn("run", F.call_function("shiftright", "at", F.lit(RUN_LEVELS)))
    return runs.join(by_run.drop("size"), ["tree", "run"]).drop("run")


def _jump(state: DataFrame, distance: int) -> DataFrame:
    """The nodes at every second multiple of ``distance``, their segments joined to those of their ancestors."""
    near = state.where(F.col("level") % (2 * distance) == 0)
    far = state.where(F.col("level") % (2 * distance) == distance).select(
        "tree", F.col("level").alias("up"), F.col("at").alias("up_at"), F.col("segment").alias("rest"),
    )
    # What is at its root already meets nothing: there is no node at that level.
    joined = near.withColumns({
        "up": F.col("level") + distance, "up_at": F.call_function("shiftright", "at", F.lit(distance)),
    }).join(far, ["tree", "up", "up_at"], "left")
    segment = F.concat("segment", F.coalesce("rest", F.array().cast("array<binary>")))
    reached = F.col("level") + 2 * distance >= F.col("height")
    return joined.select(
        "tree", "level", "at", "height", segment.alias("segment"), "digest", "carried",
        ((F.col("level") == 0) & reached).alias("done"),
    )


def _grow(leaves: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """All nodes but the roots, each with its sibling as its segment, and the roots.

    Blocks of 2**BLOCK_LEVELS neighbours are brought together and hashed upwards; the
    topmost nodes of the blocks are the next round's leaves.
    """
    carried = leaves.schema["carried"].dataType.simpleString()
    written_nodes, tops, base = [], [], 0
    while True:
        block = F.call_function("shiftright", "at", F.lit(BLOCK_LEVELS))
        blocks = leaves.groupBy("tree", "size", "height", block.alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("at", "digest", "carried"))).alias("nodes")
        )
        levels = blocks.withColumn("d0", F.col("nodes.digest"))
        for i in range(BLOCK_LEVELS):
            higher = F.when(F.col("height") > base + i, _pairs(f"d{i}")).otherwise(F.col(f"d{i}"))
            levels = levels.withColumn(f"d{i + 1}", higher)
        kept = [
            F.when(
                # The leaf that is its tree's root is kept as well, as it has a row to give.
                (F.col("height") > base + i) | F.lit(base + i == 0), _nodes(base + i, i, f"d{i}", carried)
            ).otherwise(F.array())
            for i in range(BLOCK_LEVELS)
        ]
        path = f"{folder}-nodes-{base}"
        top = F.col(f"d{BLOCK_LEVELS}")[0]
        table = written(levels.select(
            "tree", "size", "height", "block", top.alias("top"), F.flatten(F.array(*kept)).alias("nodes")
        ), path)
        written_nodes.append(table.select("tree", "height", F.inline("nodes")))
        base += BLOCK_LEVELS
        next_leaves = table.select(
            "tree", "size", "height", F.col("block").alias("at"), F.col("top").alias("digest"),
            F.lit(None).cast(carried).alias("carried"),
        )
        tops.append(next_leaves.where(F.col("height") <= base).select("tree", "size", "height", "digest"))
        leaves = next_leaves.where(F.col("height") > base)
        if leaves.isEmpty():
            break
    nodes = reduce(DataFrame.unionByName, written_nodes)
    done = (F.col("level") == 0) & (F.col("height") <= 1)
    return nodes.withColumn("done", done), reduce(DataFrame.unionByName, tops)


def _pairs(digests: str) -> Column:
    """The parents of a run of neighbours that starts at an even place."""
    return F.expr(
        f"transform(sequence(0, (size({digests}) - 1) div 2), i -> unhex(sha2(concat("
        f"lower(hex(get({digests}, int(2 * i)))), coalesce(lower(hex(get({digests}, int(2 * i + 1)))), '')), 256)))"
    )


def _nodes(level: int, up: int, digests: str, carried: str) -> Column:
    """The nodes of a block at ``level``, each with its sibling; leaves with their digests and what they carry."""
    leaf = level == 0
    return F.expr(
        f"transform({digests}, (d, i) -> struct({level} AS level, shiftleft(block, {BLOCK_LEVELS - up}) + i AS at,"
        f" if(height > 0, array(get({digests}, i ^ 1)), CAST(array() AS array<binary>)) AS segment,"
        f" {'d' if leaf else 'CAST(NULL AS binary)'} AS digest,"
        f" {'get(nodes, i).carried' if leaf else f'CAST(NULL AS {carried})'} AS carried))"
    )


def _ranked(leaves: DataFrame, folder: str) -> DataFrame:
    """The leaves with their rank in their tree and its height, without gathering a tree.

    Rows are numbered before they are ordered, so that no run of equal ones is one range.
    """
    order = ["tree", "place", "digest", "number"]
    numbered = leaves.withColumn("number", F.monotonically_increasing_id())
    path = f"{folder}-sorted"
    ordered = numbered.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "tree", "digest", "carried", F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("part"),
    )
    ordered = written(ordered, path)
    counted = ordered.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    by_part = Window.partitionBy("tree").orderBy("part")
    before = F.sum("rows").over(by_part) - F.col("rows")
    total = F.sum("rows").over(Window.partitionBy("tree"))
    starts = written(counted.select(
        "tree", "part", (F.col("first") - before).alias("first"),
        total.alias("size"),
        F.when(total > 1, F.length(F.conv((total - 1).cast("string"), 10, 2))).otherwise(0).alias("height"),
    ), f"{folder}-starts")
    return ordered.join(starts, ["tree", "part"]).select(
        "tree", (F.col("row") - F.col("first")).alias("at"), "size", "height", "digest", "carried"
    )


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))
